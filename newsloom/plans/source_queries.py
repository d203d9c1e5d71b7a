"""Queries for the sources and sinks: files, topics, listing pages."""

from pyspark.sql import functions as F

from newsloom.functions.markup import location_of, page_title
from newsloom.plans.tables import (
    ARTICLE_FIELDS,
    SCORED_SCHEMA,
    articles,
    land_topic,
    listing_pages,
    read,
    with_articles,
)
from newsloom.session import work_dir
from newsloom.sources.articles import load_articles, parse_messages, read_topic
from newsloom.sources.listing import extract_listing, last_days, listing_rejects, listing_urls, page_texts
from newsloom.sources.sinks import append_results, land_json, read_results

_PLAIN = ["title", "link", "summary", "publish_time", "section", "sub_section", "location", "body"]
_PLAIN_SQL = ", ".join(_PLAIN)


def src_articles(spark, sf_dir):
    path = work_dir(spark, "articles-json")
    land_json(articles(spark, sf_dir).select(*ARTICLE_FIELDS), path)
    loaded = load_articles(spark, path, multiline=False)
    return loaded.select(*_PLAIN, F.size("keywords").alias("keyword_count"))


def bounded_read(spark, sf_dir):
    messages = read_topic(spark, "text", path=land_topic(spark, sf_dir, "topic"))
    return parse_messages(messages, SCORED_SCHEMA).select("article_id", "title", "publish_time", "location")


def land_json_roundtrip(spark, sf_dir):
    path = work_dir(spark, "landed")
    land_json(articles(spark, sf_dir).select(*ARTICLE_FIELDS), path)
    return load_articles(spark, path, multiline=False).select("link", "title", "location", "keywords").select(
        "link", "title", "location", F.concat_ws("|", "keywords").alias("keywords")
    )


def sink_results_roundtrip(spark, sf_dir):
    path = work_dir(spark, "results")
    append_results(articles(spark, sf_dir), path)
    return read_results(spark, path, "2024-01-15", "2024-02-15").select(
        "title", "summary", "publish_time", "section", "sub_section", "location", "predicted_label",
        F.col("publish_date").cast("string").alias("publish_date"),
    )


def listing_extract(spark, sf_dir):
    found = extract_listing(listing_pages(spark, sf_dir))
    return found.select(*_PLAIN, F.concat_ws("|", "keywords").alias("keywords"))


def listing_rejects_query(spark, sf_dir):
    """Listing pages of which every third has its script cut in half."""
    broken = F.when(F.col("page_id") % 3 == 0, F.replace("html", F.lit("]};</script>"), F.lit("</script>")))
    pages = listing_pages(spark, sf_dir).withColumn("html", F.coalesce(broken, "html"))
    return listing_rejects(pages).select("page_id")


def daily_listing_urls(spark, sf_dir):
    """Listing URLs of the days the events cover, newest first."""
    span = read(spark, sf_dir, "events").agg(
        F.max(F.to_date("ts")).alias("end"), F.min(F.to_date("ts")).alias("start")
    )
    days = last_days(span, F.col("end"), F.datediff("end", "start") + 1)
    return listing_urls(days).select(F.col("day").cast("string").alias("day"), "url")


def page_text(spark, sf_dir):
    return page_texts(read(spark, sf_dir, "pages"))


def page_titles(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", page_title(F.col("html")).alias("title"))


def extract_location(spark, sf_dir):
    df = articles(spark, sf_dir).filter(F.col("body").isNotNull())
    return df.select("article_id", location_of(F.col("body")).alias("extracted"))


# The named references that the tables hold.
_PAGE_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"))


def _decode_sql(text):
    for name, char in _PAGE_ENTITIES:
        literal = char.replace("'", "''")
        text = f"replace({text}, '{name}', '{literal}')"
    return f"replace({text}, '&amp;', '&')"


_SPACE = r"[\s\x0b\x{85}\p{Z}]"


def _strip_sql(text):
    return f"regexp_replace({text}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


_TAG_SQL = r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->|<[!/?a-z][^>]*>"
_PAGE_TEXT_SQL = _strip_sql(
    _decode_sql(f"regexp_replace(regexp_replace(html, '{_TAG_SQL}', chr(1), 'g'), chr(1) || '+', chr(10), 'g')")
)
_CAPS_SQL = rf"^((?:[A-Z]|{_SPACE})+):{_SPACE}"


def _location_sql(body):
    return (
        f"CASE WHEN regexp_matches({body}, '{_CAPS_SQL}') "
        f"THEN {_strip_sql(f"regexp_extract({body}, '{_CAPS_SQL}', 1)")} ELSE 'Location not found' END"
    )


_LISTED_SQL = with_articles(
    rf"""
SELECT title, link, summary, publish_time, section, sub_section, keywords, body,
       {_location_sql('body')} AS location
FROM (
  SELECT title, link,
         CASE WHEN article_id % 7 = 0 THEN 'Summary not available.' ELSE summary END AS summary,
         publish_time,
         CASE WHEN article_id % 11 <> 0 THEN section ELSE 'N/A' END AS section,
         sub_section,
         array_to_string(keywords, '|') AS keywords,
         {_strip_sql("coalesce(location, '') || ': ' || chr(10) || summary")} AS body
  FROM articles
)"""
)

QUERIES = {
    "src_articles": (
        src_articles,
        with_articles(f"SELECT {_PLAIN_SQL}, CAST(len(keywords) AS INT) AS keyword_count FROM articles"),
    ),
    "listing_extract": (listing_extract, _LISTED_SQL),
    "listing_rejects": (
        listing_rejects_query,
        with_articles(
            """SELECT CAST(article_id // 10 AS BIGINT) AS page_id FROM articles
GROUP BY article_id // 10 HAVING article_id // 10 % 3 = 0"""
        ),
    ),
    "page_text": (page_text, f"SELECT page_id, {_PAGE_TEXT_SQL} AS text FROM pages"),
    "page_title": (
        page_titles,
        f"""SELECT page_id, {_decode_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title
FROM pages""",
    ),
    "extract_location": (
        extract_location,
        with_articles(
            f"SELECT article_id, {_location_sql('body')} AS extracted FROM articles WHERE body IS NOT NULL"
        ),
    ),
    "daily_listing_urls": (
        daily_listing_urls,
        """SELECT day, 'https://news.example.com/nation?sdate=' || day || '&edate=' || day AS url
FROM (SELECT strftime(unnest(generate_series(a, b, INTERVAL 1 DAY)), '%Y-%m-%d') AS day
      FROM (SELECT date_trunc('day', min(ts)) AS a, date_trunc('day', max(ts)) AS b FROM events))""",
    ),
    "bounded_read": (
        bounded_read,
        with_articles("SELECT article_id, title, publish_time, location FROM articles"),
    ),
    "land_json_roundtrip": (
        land_json_roundtrip,
        with_articles("SELECT link, title, location, array_to_string(keywords, '|') AS keywords FROM articles"),
    ),
    "sink_results_roundtrip": (
        sink_results_roundtrip,
        with_articles(
            """SELECT title, summary, publish_time, section, sub_section, location, predicted_label,
       substring(publish_time, 1, 10) AS publish_date
FROM articles WHERE publish_time >= '2024-01-15' AND publish_time < '2024-02-15'"""
        ),
    ),
}
