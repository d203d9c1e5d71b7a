"""Queries for cleaning, splitting and the article reports."""

from pyspark.sql import functions as F

from newsloom.functions.words import letters_only, lower_trim, parse_time
from newsloom.operators import clean, reports
from newsloom.plans.tables import articles, with_articles
from newsloom.schemas import TIME_FORMAT

_CLEANED = ["title", "summary", "publish_time", "section", "sub_section", "location", "predicted_label"]
_CLEANED_SQL = ", ".join(_CLEANED)
_COPY = ["title", "summary", "section", "predicted_label"]
# Java's \s, spelled out: the other engine's \s lacks the vertical tab.
_NOT_LETTERS = r"[^a-zA-Z \t\n\x0b\f\r]"
_PLACE_PATTERN = "ention"
_SEARCH_WORDS = ("ention", "th[ae]")
_MONTH = ("2024-02-01 00:00:00", "2024-03-01 00:00:00")


def clean_dedup(spark, sf_dir):
    """Copies of an article differ in id, link and time only; without these they collapse."""
    return clean.remove_duplicates(articles(spark, sf_dir).select(*_COPY))


def clean_lower(spark, sf_dir):
    return articles(spark, sf_dir).select("article_id", lower_trim(F.col("summary")).alias("summary"))


def clean_special(spark, sf_dir):
    return articles(spark, sf_dir).select("article_id", letters_only(F.col("summary")).alias("summary"))


def clean_articles(spark, sf_dir):
    return clean.clean_articles(articles(spark, sf_dir).select(*_CLEANED))


def parse_publish_time(spark, sf_dir):
    time = parse_time(F.col("publish_time"), TIME_FORMAT).cast("timestamp_ntz")
    return articles(spark, sf_dir).select("article_id", time.alias("publish_time_ts"))


def select_columns(spark, sf_dir):
    return clean.select_columns(articles(spark, sf_dir), ["title", "location", "predicted_label"])


def drop_null_features(spark, sf_dir):
    return clean.drop_nulls(articles(spark, sf_dir), "location", "predicted_label")


def train_test_split(spark, sf_dir):
    return clean.with_split(articles(spark, sf_dir), "article_id").select("article_id", "split")


def label_totals(spark, sf_dir):
    return clean.label_counts(articles(spark, sf_dir), "predicted_label")


def _report(function, *columns, **options):
    def run(spark, sf_dir):
        result = function(articles(spark, sf_dir), **options)
        return result.select(*columns) if columns else result

    return run


_LOCATED = "location IS DISTINCT FROM ''"
_LABELS_SQL = ", ".join(
    f"CAST(count(*) FILTER (WHERE predicted_label = '{label}') AS BIGINT) AS {label}"
    for label in ("positive", "neutral", "negative")
)
_ALL_ON_A_LINE = " AND ".join(f"regexp_matches(line, '{word}', 'i')" for word in _SEARCH_WORDS)


def _line_test(column):
    return f"len(list_filter(string_split({column}, chr(10)), lambda line: {_ALL_ON_A_LINE})) > 0"


QUERIES = {
    "clean_dedup": (clean_dedup, with_articles(f"SELECT DISTINCT {', '.join(_COPY)} FROM articles")),
    "clean_lower": (
        clean_lower,
        with_articles("SELECT article_id, lower(trim(summary, ' ')) AS summary FROM articles"),
    ),
    "clean_special": (
        clean_special,
        with_articles(
            f"SELECT article_id, regexp_replace(summary, '{_NOT_LETTERS}', '', 'g') AS summary FROM articles"
        ),
    ),
    "clean_articles": (
        clean_articles,
        with_articles(
            f"""SELECT * REPLACE (regexp_replace(lower(trim(summary, ' ')), '{_NOT_LETTERS}', '', 'g') AS summary)
FROM (SELECT DISTINCT {_CLEANED_SQL} FROM articles)"""
        ),
    ),
    "parse_publish_time": (
        parse_publish_time,
        with_articles("SELECT article_id, CAST(publish_time AS TIMESTAMP) AS publish_time_ts FROM articles"),
    ),
    "select_columns": (select_columns, with_articles("SELECT title, location, predicted_label FROM articles")),
    "drop_null_features": (
        drop_null_features,
        with_articles(
            """SELECT location, predicted_label FROM articles
WHERE location IS NOT NULL AND predicted_label IS NOT NULL"""
        ),
    ),
    "train_test_split": (
        train_test_split,
        with_articles(
            """SELECT article_id,
       CASE WHEN CAST('0x' || substring(md5(CAST(article_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
            THEN 'train' ELSE 'test' END AS split
FROM articles"""
        ),
    ),
    "label_totals": (
        label_totals,
        with_articles("SELECT predicted_label, count(*) AS count FROM articles GROUP BY predicted_label"),
    ),
    "count_location_positive": (
        _report(reports.count_location_positive, location=_PLACE_PATTERN),
        with_articles(
            f"""SELECT count(*) AS count FROM articles WHERE predicted_label = 'positive'
AND (regexp_matches(title, '{_PLACE_PATTERN}', 'i') OR regexp_matches(summary, '{_PLACE_PATTERN}', 'i'))"""
        ),
    ),
    "recent_by_location_and_label": (
        _report(
            reports.recent_by_location_and_label,
            "article_id", "title", "publish_time", "location", "predicted_label",
            n=5, key="article_id",
        ),
        with_articles(
            f"""SELECT article_id, title, publish_time, location, predicted_label FROM articles
WHERE {_LOCATED} AND predicted_label IN ('negative', 'neutral')
ORDER BY publish_time DESC NULLS LAST, article_id LIMIT 5"""
        ),
    ),
    "empty_keywords_by_sub_section": (
        _report(reports.empty_keywords_by_sub_section),
        with_articles(
            """SELECT sub_section, count(*) AS empty_keywords_count FROM articles
WHERE len(keywords) = 0 GROUP BY sub_section"""
        ),
    ),
    "average_articles_per_day": (
        _report(reports.average_articles_per_day, start=_MONTH[0], end=_MONTH[1]),
        with_articles(
            f"""SELECT avg(n) AS average_articles_per_day FROM (
  SELECT count(*) AS n FROM articles WHERE CAST(publish_time AS TIMESTAMP) >= TIMESTAMP '{_MONTH[0]}'
    AND CAST(publish_time AS TIMESTAMP) < TIMESTAMP '{_MONTH[1]}' GROUP BY substring(publish_time, 1, 10))
HAVING avg(n) IS NOT NULL"""
        ),
    ),
    "group_by_label_latest": (
        _report(reports.group_by_label_latest),
        with_articles(
            """SELECT predicted_label, count(*) AS count, max(publish_time) AS latest_article
FROM articles GROUP BY predicted_label"""
        ),
    ),
    "group_by_label_latest_title": (
        _report(reports.group_by_label_latest_title, key="article_id"),
        with_articles(
            """SELECT predicted_label, count, publish_time AS latest_article, title AS latest_title FROM (
  SELECT *, count(*) OVER (PARTITION BY predicted_label) AS count,
         row_number() OVER (PARTITION BY predicted_label ORDER BY publish_time DESC, article_id DESC) AS rn
  FROM articles) WHERE rn = 1"""
        ),
    ),
    "top_locations_positive": (
        _report(reports.top_locations_positive, limit=3),
        with_articles(
            f"""SELECT location, count(*) AS count FROM articles WHERE predicted_label = 'positive' AND {_LOCATED}
GROUP BY location ORDER BY count DESC, location NULLS LAST LIMIT 3"""
        ),
    ),
    "search_all_keywords": (
        _report(reports.search_all_keywords, "article_id", "title", "predicted_label", keywords=_SEARCH_WORDS),
        with_articles(
            f"""SELECT article_id, title, predicted_label FROM articles
WHERE {_line_test('title')} OR {_line_test('summary')}"""
        ),
    ),
    "monthly_sentiment_distribution": (
        _report(reports.monthly_sentiment_distribution),
        with_articles(
            """SELECT CAST(year(CAST(publish_time AS TIMESTAMP)) AS INT) AS year,
       CAST(month(CAST(publish_time AS TIMESTAMP)) AS INT) AS month,
       predicted_label AS sentiment, count(*) AS count
FROM articles GROUP BY ALL"""
        ),
    ),
    "location_sentiment_heatmap": (
        _report(reports.location_sentiment_heatmap),
        with_articles(
            f"""SELECT location, count(*) AS total, {_LABELS_SQL} FROM articles
WHERE {_LOCATED} GROUP BY location"""
        ),
    ),
    "publishing_peak_hours": (
        _report(reports.publishing_peak_hours),
        with_articles(
            """SELECT CAST(hour(CAST(publish_time AS TIMESTAMP)) AS INT) AS hour, count(*) AS count
FROM articles GROUP BY ALL"""
        ),
    ),
    "low_content_quality": (
        _report(
            reports.low_content_quality,
            "article_id", "title", "summary", "summary_length", "has_keywords",
            key="article_id",
        ),
        with_articles(
            """SELECT article_id, title, summary, CAST(length(summary) AS INT) AS summary_length,
       coalesce(len(keywords) > 0, false) AS has_keywords
FROM articles WHERE length(summary) < 50 OR NOT coalesce(len(keywords) > 0, false)"""
        ),
    ),
}
