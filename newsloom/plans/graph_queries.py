"""Queries for the graph tables and the pattern reports."""

from pyspark.sql import functions as F

from newsloom.functions.words import SHORT_STOP_WORDS, STOP_WORDS
from newsloom.operators import compressed
from newsloom.operators import graph_reports as reports
from newsloom.operators.graph import build_graph, load_graph_buckets, merge_graphs, save_graph_buckets, upsert_graph
from newsloom.plans.tables import graph, load_rows, with_graph
from newsloom.session import work_dir


def _part(name, *columns):
    def run(spark, sf_dir):
        part = getattr(graph(spark, sf_dir), name)
        return part.select(*columns) if columns else part

    return run


def _report(function, **options):
    return lambda spark, sf_dir: function(graph(spark, sf_dir), **options)


def _related(function, **options):
    def run(spark, sf_dir):
        tables = graph(spark, sf_dir)
        return function(tables, reports.related_edges(tables), **options)

    return run


def _words_sql(stop_words, extra=""):
    drop = ", ".join(f"'{word}'" for word in ["", *stop_words])
    return (
        "unnest(list_filter(string_split(lower(title), ' '), "
        f"lambda w: w NOT IN ({drop}){extra})) AS word"
    )


BUCKETS = 16  # of the stored graph
CHOSEN = 20  # titles whose combinations are multiplied out
NEWEST = 100  # rows of the newest related pairs

_WORD = _words_sql(STOP_WORDS)
_YMD = "CAST(year({0}) AS VARCHAR) || '-' || CAST(month({0}) AS VARCHAR)"
_PERIOD = """CASE WHEN hour(publish_time) >= 6 AND hour(publish_time) < 12 THEN 'Morning'
            WHEN hour(publish_time) >= 12 AND hour(publish_time) < 18 THEN 'Afternoon' ELSE 'Night' END"""
_SUMS = ", ".join(
    f"CAST(sum(CASE WHEN category = '{label}' THEN 1 ELSE 0 END) AS BIGINT) AS {label}_count"
    for label in ("positive", "neutral", "negative")
)
_PERIOD_CELLS = ", ".join(
    f"CAST(count(c.category) FILTER (WHERE c.category = '{label}') AS BIGINT) AS {label}"
    for label in ("positive", "neutral", "negative")
)
_SECTIONS = "belongs_to JOIN part_of USING (sub_section) JOIN has_category USING (title)"
_SECTION_COUNTS = (
    f"SELECT section, sub_section, category, count(*) AS count FROM {_SECTIONS} GROUP BY section, sub_section, category"
)
_PLACES = "reported_in JOIN has_category USING (title)"
_PAIRS = """SELECT a.title AS news1, b.title AS news2, a.location,
       CAST(year(a.date) AS INT) AS publish_year, CAST(month(a.date) AS INT) AS publish_month,
       CAST(day(a.date) AS INT) AS publish_day{extra}
FROM place_days a JOIN place_days b ON a.location = b.location AND a.date = b.date AND a.title < b.title"""


def _place_words_sql(extra=""):
    return f"""SELECT location, sentiment, word, count(*) AS total_count
FROM (SELECT location, category AS sentiment, {_words_sql(STOP_WORDS, extra)} FROM {_PLACES})
GROUP BY ALL ORDER BY total_count DESC, location, sentiment, word LIMIT 20"""


def _listed_sql(table, column):
    return (
        f"(SELECT title, string_agg(CAST({column} AS VARCHAR), '|' ORDER BY CAST({column} AS VARCHAR)) "
        f"AS {column} FROM {table} GROUP BY title)"
    )


_SIDE = f"""(SELECT title, date, category, location, sub_section FROM {_listed_sql('published_on', 'date')}
  JOIN {_listed_sql('has_category', 'category')} USING (title)
  JOIN {_listed_sql('reported_in', 'location')} USING (title)
  JOIN {_listed_sql('belongs_to', 'sub_section')} USING (title))"""

_SQL = {
    "graph_news_nodes": "SELECT title, summary, publish_time FROM news",
    "graph_merge": "SELECT title, summary, publish_time FROM news",
    "graph_upsert": """SELECT title, summary, publish_time, places, days FROM news
JOIN (SELECT title, count(*) AS places FROM reported_in GROUP BY title) USING (title)
JOIN (SELECT title, count(*) AS days FROM published_on GROUP BY title) USING (title)""",
    "graph_part_of": "SELECT sub_section, section FROM part_of",
    "graph_belongs_to": "SELECT title, sub_section FROM belongs_to",
    "graph_reported_in": "SELECT title, location FROM reported_in",
    "graph_has_category": "SELECT title, category FROM has_category",
    "graph_published_on": "SELECT title, date FROM published_on",
    "graph_rejects": """SELECT article_id, title, 'location' AS null_keys FROM articles WHERE location IS NULL""",
    "related_edges": "SELECT title, related_title FROM related",
    "related_title_words": f"""
, pairs AS (SELECT DISTINCT word, related_title FROM (SELECT {_WORD}, related_title FROM related)),
top_words AS (SELECT word, count(*) AS related_count FROM pairs GROUP BY word
              ORDER BY related_count DESC, word LIMIT 10)
SELECT word, related_count, related_title FROM pairs JOIN top_words USING (word)""",
    "related_pair_profile": f"""SELECT a.title AS news1, a.date AS publish_dates1, a.category AS categories1,
       a.location AS locations1, a.sub_section AS sub_sections1, b.title AS news2, b.date AS publish_dates2,
       b.category AS categories2, b.location AS locations2, b.sub_section AS sub_sections2
FROM related r JOIN {_SIDE} a ON a.title = r.title JOIN {_SIDE} b ON b.title = r.related_title""",
    "news_with_date": """SELECT title AS news_title, summary AS news_summary, date AS publish_date
FROM news JOIN published_on USING (title) ORDER BY publish_date DESC, news_title LIMIT 10""",
    "top_title_words": f"""SELECT word, count(*) AS article_count
FROM (SELECT {_words_sql(SHORT_STOP_WORDS)} FROM news) GROUP BY word ORDER BY article_count DESC, word LIMIT 10""",
    "article_profile": """SELECT title AS news_title, summary AS news_summary, CAST(date AS VARCHAR) AS publish_date,
       sub_section AS subsection_name, section AS section_name, location AS location_name, category AS category_name
FROM news JOIN published_on USING (title) JOIN belongs_to USING (title) JOIN part_of USING (sub_section)
JOIN reported_in USING (title) JOIN has_category USING (title)""",
    "word_trend_by_date": f"""SELECT word, publish_date, count(*) AS total_articles
FROM (SELECT {_WORD}, CAST(date AS VARCHAR) AS publish_date FROM published_on)
GROUP BY ALL ORDER BY publish_date DESC, total_articles DESC, word LIMIT 10""",
    "word_trend_by_ymd": f"""SELECT word, publish_date, count(*) AS total_articles
FROM (SELECT {_WORD}, {_YMD.format('publish_time')} || '-' || CAST(day(publish_time) AS VARCHAR) AS publish_date
      FROM news)
GROUP BY ALL ORDER BY publish_date DESC, total_articles DESC, word LIMIT 10""",
    "word_sentiment_by_date": f"""SELECT word, formatted_publish_date, {_SUMS}, count(*) AS total_count
FROM (SELECT {_WORD}, CAST(date AS VARCHAR) AS formatted_publish_date, category
      FROM published_on JOIN has_category USING (title))
GROUP BY word, formatted_publish_date ORDER BY total_count DESC, word, formatted_publish_date LIMIT 10""",
    "time_period_sentiment": f"""SELECT {_PERIOD} AS time_period, category AS sentiment, count(*) AS total_articles
FROM news JOIN has_category USING (title) JOIN published_on USING (title) GROUP BY ALL""",
    "time_period_matrix": f"""SELECT p.time_period, {_PERIOD_CELLS}
FROM (VALUES ('Morning'), ('Afternoon'), ('Night')) p(time_period)
LEFT JOIN (SELECT {_PERIOD} AS time_period, category
           FROM news JOIN has_category USING (title) JOIN published_on USING (title)) c
  ON c.time_period = p.time_period
GROUP BY p.time_period""",
    "section_month_sentiment": f"""SELECT section, sub_section, {_YMD.format('date')} AS publish_month, {_SUMS},
       count(*) AS total_count
FROM {_SECTIONS} JOIN published_on USING (title) GROUP BY section, sub_section, publish_month
ORDER BY total_count DESC, section, sub_section, publish_month LIMIT 10""",
    "location_sentiment_words": _place_words_sql(),
    "location_sentiment_counts": f"""SELECT location, category AS sentiment, count(*) AS total_count FROM {_PLACES}
GROUP BY ALL ORDER BY total_count DESC, location, sentiment LIMIT 20""",
    "keyword_by_location": _place_words_sql(" AND contains(w, 'tion')"),
    "same_place_same_day": _PAIRS.format(extra=""),
    "same_place_same_day_hour": _PAIRS.format(extra=",\n       CAST(0 AS INT) AS publish_hour"),
    "news_per_location": "SELECT location, count(*) AS news_count FROM reported_in GROUP BY location",
    "news_per_sub_section": "SELECT sub_section, count(*) AS article_count FROM belongs_to GROUP BY sub_section",
    "category_cooccurrence": f"SELECT * FROM ({_SECTION_COUNTS}) WHERE count > 5",
    "category_clusters": f"SELECT * FROM ({_SECTION_COUNTS}) WHERE count > 2",
    "top_location_categories": f"""SELECT location, category, count(*) AS article_count FROM {_PLACES}
GROUP BY ALL ORDER BY article_count DESC, location, category LIMIT 10""",
    "category_by_section": _SECTION_COUNTS,
    "section_category_by_day": f"""SELECT section, category, substring(d, 1, 4) AS publish_year,
       substring(d, 6, 2) AS publish_month, substring(d, 9, 2) AS publish_day, count(*) AS article_count
FROM (SELECT section, category, CAST(date AS VARCHAR) AS d FROM {_SECTIONS} JOIN published_on USING (title))
GROUP BY ALL""",
    "sub_section_categories": """SELECT sub_section, category, count(*) AS count
FROM belongs_to JOIN has_category USING (title) GROUP BY ALL""",
    "article_profile_factors": """SELECT title AS news_title, 'publish_date' AS kind, CAST(date AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS within FROM published_on
UNION ALL SELECT title, 'location', location, NULL FROM reported_in
UNION ALL SELECT title, 'category', category, NULL FROM has_category
UNION ALL SELECT title, 'sub_section', sub_section, NULL FROM belongs_to
UNION ALL SELECT NULL, 'section', section, sub_section FROM part_of""",
    "article_profile_counts": """SELECT title AS news_title, n_dates, n_locations, n_categories, n_sections,
       n_dates * n_locations * n_categories * n_sections AS n_combinations
FROM (SELECT title, count(*) AS n_dates FROM published_on GROUP BY title)
JOIN (SELECT title, count(*) AS n_locations FROM reported_in GROUP BY title) USING (title)
JOIN (SELECT title, count(*) AS n_categories FROM has_category GROUP BY title) USING (title)
JOIN (SELECT title, count(*) AS n_sections FROM belongs_to JOIN part_of USING (sub_section) GROUP BY title) USING (title)""",
    "article_profile_of_titles": f"""SELECT title AS news_title, summary AS news_summary, CAST(date AS VARCHAR) AS publish_date,
       sub_section AS subsection_name, section AS section_name, location AS location_name, category AS category_name
FROM (SELECT * FROM news ORDER BY title LIMIT {CHOSEN}) JOIN published_on USING (title) JOIN belongs_to USING (title)
JOIN part_of USING (sub_section) JOIN reported_in USING (title) JOIN has_category USING (title)""",
    "related_pair_counts": """
, each AS (SELECT title, n1 * n2 * n3 * n4 AS n, newest
  FROM (SELECT title, count(*) AS n1, CAST(max(date) AS VARCHAR) AS newest FROM published_on GROUP BY title)
  JOIN (SELECT title, count(*) AS n2 FROM has_category GROUP BY title) USING (title)
  JOIN (SELECT title, count(*) AS n3 FROM reported_in GROUP BY title) USING (title)
  JOIN (SELECT title, count(*) AS n4 FROM belongs_to GROUP BY title) USING (title))
SELECT a.title AS news1, b.title AS news2, a.newest AS newest1, a.n AS rows1, b.n AS rows2, CAST(CAST(a.n AS HUGEINT) * b.n AS DECIMAL(38, 0)) AS n_rows
FROM related r JOIN each a ON a.title = r.title JOIN each b ON b.title = r.related_title""",
    "newest_related_rows": f"""
, entries AS (SELECT DISTINCT r.title AS news1, r.related_title AS news2, CAST(p.date AS VARCHAR) AS publish_date1
  FROM related r JOIN published_on p ON p.title = r.title ORDER BY publish_date1 DESC, news1, news2 LIMIT {NEWEST}),
sides AS (SELECT title, CAST(date AS VARCHAR) AS d, category AS c, location AS l, sub_section AS s
  FROM (SELECT news1 AS title FROM entries UNION SELECT news2 FROM entries) JOIN published_on USING (title)
  JOIN has_category USING (title) JOIN reported_in USING (title) JOIN belongs_to USING (title)),
left_rows AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY title, d ORDER BY c, l, s) <= {NEWEST}),
right_rows AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY title ORDER BY d DESC, c, l, s) <= {NEWEST})
SELECT news1, publish_date1, a.c AS category1, a.l AS location1, a.s AS sub_section1, news2, b.d AS publish_date2,
       b.c AS category2, b.l AS location2, b.s AS sub_section2
FROM entries JOIN left_rows a ON a.title = news1 AND a.d = publish_date1 JOIN right_rows b ON b.title = news2
ORDER BY publish_date1 DESC, news1, news2, a.c, a.l, a.s, b.d DESC, b.c, b.l, b.s LIMIT {NEWEST}""",
    "place_day_groups": """SELECT location, date, n AS n_titles, n * (n - 1) // 2 AS n_pairs
FROM (SELECT location, date, count(*) AS n FROM place_days GROUP BY location, date)""",
    "place_day_members": f"""SELECT location, date, part, count(*) AS n_titles, string_agg(title, '|' ORDER BY title) AS titles
FROM (SELECT *, ('0x' || substr(md5(title), 1, 8))::BIGINT % CAST(ceil(count(*) OVER (PARTITION BY location, date) / {compressed.BLOCK}) AS BIGINT) AS part
      FROM place_days) GROUP BY location, date, part""",
    "pairs_per_title": """SELECT title AS news_title, count(*) AS n_groups, CAST(sum(n - 1) AS BIGINT) AS n_pairs
FROM place_days JOIN (SELECT location, date, count(*) AS n FROM place_days GROUP BY location, date) USING (location, date) GROUP BY title""",
    "pairs_of_titles": f"""SELECT a.title AS news, b.title AS other, location, date
FROM place_days a JOIN place_days b USING (location, date)
WHERE a.title <> b.title AND a.title IN (SELECT title FROM news ORDER BY title LIMIT {CHOSEN})""",
    "pairs_of_place": """SELECT a.title AS news1, b.title AS news2, a.location, CAST(year(a.date) AS INT) AS publish_year,
       CAST(month(a.date) AS INT) AS publish_month, CAST(day(a.date) AS INT) AS publish_day
FROM place_days a JOIN place_days b ON a.location = b.location AND a.date = b.date AND a.title < b.title
WHERE a.location = 'ASIA BUILDING' AND a.date = DATE '2024-01-20'""",
    "neighbour_words": f"""
, linked AS (SELECT DISTINCT a.title, b.title AS related_title FROM place_days a JOIN place_days b USING (location, date) WHERE a.title <> b.title),
pairs AS (SELECT DISTINCT word, related_title FROM (SELECT {_WORD}, related_title FROM linked)),
top_words AS (SELECT word, count(*) AS related_count FROM pairs GROUP BY word ORDER BY related_count DESC, word LIMIT 10)
SELECT word, related_count, related_title FROM pairs JOIN top_words USING (word)""",
}



def graph_news_nodes(spark, sf_dir):
    time = F.col("publish_time").cast("timestamp_ntz").alias("publish_time")
    return graph(spark, sf_dir).news.select("title", "summary", time)


def graph_merge(spark, sf_dir):
    """News nodes after loading the odd articles into a graph of the even ones."""
    rows = load_rows(spark, sf_dir)
    even, odd = (build_graph(rows.filter(F.col("article_id") % 2 == rest), order_by=["article_id"]) for rest in (0, 1))
    time = F.col("publish_time").cast("timestamp_ntz").alias("publish_time")
    return merge_graphs(even, odd).news.select("title", "summary", time)


def graph_upsert(spark, sf_dir):
    """News nodes with their places and days, after loading every hundredth article into a stored graph of the others."""
    rows = load_rows(spark, sf_dir)
    first, later = (build_graph(rows.filter(kept), order_by=["article_id"]) for kept in ("article_id % 100 <> 0", "article_id % 100 = 0"))
    path = work_dir(spark, "graph-buckets")
    save_graph_buckets(first, path, BUCKETS)
    upsert_graph(spark, path, later, BUCKETS, work_dir(spark, "graph-staging"))
    loaded = load_graph_buckets(spark, path)
    time = F.col("publish_time").cast("timestamp_ntz").alias("publish_time")
    count = lambda df, name: df.groupBy("title").agg(F.count("*").alias(name))
    return loaded.news.select("title", "summary", time).join(count(loaded.reported_in, "places"), "title").join(count(loaded.published_on, "days"), "title")


def related_edges(spark, sf_dir):
    return reports.related_edges(graph(spark, sf_dir))


def _chosen(tables):
    return tables.news.select("title").orderBy("title").limit(CHOSEN)


def article_profile_of_titles(spark, sf_dir):
    tables = graph(spark, sf_dir)
    return compressed.profiles_of(tables, _chosen(tables))


def pairs_of_titles(spark, sf_dir):
    tables = graph(spark, sf_dir)
    return compressed.pairs_of_titles(tables, _chosen(tables))


def place_day_members(spark, sf_dir):
    members = compressed.place_day_members(graph(spark, sf_dir))
    return members.select("location", "date", "part", F.size("titles").cast("long").alias("n_titles"), F.array_join("titles", "|").alias("titles"))


_RUN = {
    "graph_news_nodes": graph_news_nodes,
    "graph_merge": graph_merge,
    "graph_upsert": graph_upsert,
    "graph_part_of": _part("part_of"),
    "graph_belongs_to": _part("belongs_to"),
    "graph_reported_in": _part("reported_in"),
    "graph_has_category": _part("has_category"),
    "graph_published_on": _part("published_on"),
    "graph_rejects": _part("rejects", "article_id", "title", "null_keys"),
    "related_edges": related_edges,
    "related_title_words": _related(reports.related_title_words),
    "related_pair_profile": _related(reports.related_pair_profile),
    "keyword_by_location": _report(reports.keyword_by_location, keyword="tion"),
    "article_profile_factors": _report(compressed.profile_factors),
    "article_profile_counts": _report(compressed.profile_counts),
    "article_profile_of_titles": article_profile_of_titles,
    "related_pair_counts": _related(compressed.related_pair_counts),
    "newest_related_rows": _related(compressed.newest_related_rows, limit=NEWEST),
    "place_day_groups": _report(compressed.place_day_groups),
    "place_day_members": place_day_members,
    "pairs_per_title": _report(compressed.pairs_per_title),
    "pairs_of_titles": pairs_of_titles,
    "pairs_of_place": _report(compressed.pairs_of_place, location="ASIA BUILDING", date="2024-01-20"),
    "neighbour_words": _report(compressed.neighbour_words),
}
# The rest are named after their function.
_RUN |= {name: _report(getattr(reports, name)) for name in _SQL if name not in _RUN}

QUERIES = {name: (_RUN[name], with_graph(sql)) for name, sql in _SQL.items()}
