"""The given tables as articles, graph, topic and listing pages; each with its SQL twin."""

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.words import parse_time
from newsloom.operators.graph import build_graph
from newsloom.schemas import ARTICLE_SCHEMA, TIME_FORMAT
from newsloom.session import work_dir
from newsloom.sources.sinks import land_json

ARTICLE_FIELDS = ARTICLE_SCHEMA.fieldNames()
SCORED_SCHEMA = T.StructType(
    [*ARTICLE_SCHEMA.fields, T.StructField("predicted_label", T.StringType()), T.StructField("article_id", T.LongType())]
)

# Sentiment words that occur in the tables: English ones, and common made-up words of each
# language so that all three labels occur.
LEXICON = (
    ("idiot", -2.3),
    ("worthless", -1.9),
    ("stupid", -2.4),
    ("best", 3.2),
    ("orre", 1.5),
    ("ononst", -1.3),
    ("enti", 0.9),
    ("reen", -0.8),
    ("elle", 0.7),
    ("ère", -1.1),
)


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark, sf_dir):
    """Articles: one per document, with a time from its event and a place from its customer.

    The title is the whole first line, the summary the whole text. Times, places and labels are
    brought together first, by the document's number, so that texts are exchanged once, as one
    column, and only where they are asked for. A document's place is that of the customer whose
    key is the document's modulo the table's key range.
    """
    customers = read(spark, sf_dir, "customer")
    key_range = customers.agg((F.max("c_custkey") + 1).alias("key_range"))
    docs = read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("article_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        "text",
        F.col("lang").alias("section"),
        F.col("source").alias("sub_section"),
    )
    times = (
        read(spark, sf_dir, "events")
        .filter(F.col("event_id") % 5 == 0)
        .select(F.expr("event_id div 5").alias("article_id"), "ts")
        .crossJoin(F.broadcast(key_range))  # one row
        .withColumn("c_custkey", F.col("article_id") % F.col("key_range"))
    )
    labels = read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "article_id")
    # nation and region have a fixed 25 and 5 rows
    places = (
        customers.join(
            F.broadcast(read(spark, sf_dir, "nation")),
            F.col("c_nationkey") == F.col("n_nationkey"),
            "left",
        )
        .join(
            F.broadcast(read(spark, sf_dir, "region")),
            F.col("n_regionkey") == F.col("r_regionkey"),
            "left",
        )
        .select("c_custkey", F.concat("r_name", F.lit(" "), "c_mktsegment").alias("place"))
    )
    facts = times.join(places, "c_custkey", "left").join(labels, "article_id", "left").drop("c_custkey", "key_range")
    spot = F.col("article_id") % 20
    return (
        docs.join(facts, "article_id")
        .select(
            "article_id",
            "title",
            F.concat(F.lit("https://news.example.com/"), F.col("article_id").cast("string")).alias("link"),
            F.col("text").alias("summary"),
            F.date_format(
                F.date_trunc("second", "ts") + F.make_interval(F.lit(0), (F.col("article_id") % 3).cast("int")),
                TIME_FORMAT,
            ).alias("publish_time"),
            "section",
            "sub_section",
            F.filter(F.split(F.lower("title"), " "), lambda word: F.length(word) >= 9).alias("keywords"),
            F.when(spot == 0, "")
            .when(spot == 1, "Location not found")
            .when(spot == 2, F.lit(None))
            .otherwise(F.col("place"))
            .alias("location"),
            F.when(spot == 0, F.concat(F.lit("  : "), "text"))
            .when(spot == 1, F.col("text"))
            .otherwise(F.concat("place", F.lit(": "), "text"))
            .alias("body"),
            F.when(F.col("toxic") == 1, "negative")
            .when(F.col("quality") == 1, "positive")
            .otherwise("neutral")
            .alias("predicted_label"),
        )
    )


ARTICLES_SQL = """
articles AS (
  SELECT d.doc_id AS article_id,
         string_split(d.text, chr(10))[1] AS title,
         'https://news.example.com/' || CAST(d.doc_id AS VARCHAR) AS link,
         d.text AS summary,
         strftime(date_trunc('second', e.ts) + to_months(CAST(d.doc_id % 3 AS INT)), '%Y-%m-%d %H:%M:%S')
           AS publish_time,
         d.lang AS section, d.source AS sub_section,
         list_filter(string_split(lower(string_split(d.text, chr(10))[1]), ' '),
                     lambda w: length(w) >= 9) AS keywords,
         CASE d.doc_id % 20 WHEN 0 THEN '' WHEN 1 THEN 'Location not found' WHEN 2 THEN NULL
              ELSE r.r_name || ' ' || c.c_mktsegment END AS location,
         CASE d.doc_id % 20 WHEN 0 THEN '  : ' || d.text WHEN 1 THEN d.text
              ELSE r.r_name || ' ' || c.c_mktsegment || ': ' || d.text END AS body,
         CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive' ELSE 'neutral' END
           AS predicted_label
  FROM documents d
  JOIN events e ON e.event_id = d.doc_id * 5
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN customer c ON c.c_custkey = d.doc_id % (SELECT max(c_custkey) + 1 FROM customer)
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

# Only the CTEs a query names are evaluated.
GRAPH_SQL = (
    ARTICLES_SQL
    + """,
loaded AS (
  SELECT *, CAST(publish_time AS TIMESTAMP) AS t FROM articles
  WHERE title IS NOT NULL AND section IS NOT NULL AND sub_section IS NOT NULL AND location IS NOT NULL
    AND predicted_label IS NOT NULL AND publish_time IS NOT NULL
),
news AS (
  SELECT title, summary, t AS publish_time
  FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY t DESC, article_id DESC) AS rn FROM loaded)
  WHERE rn = 1
),
part_of AS (SELECT DISTINCT sub_section, section FROM loaded),
belongs_to AS (SELECT DISTINCT title, sub_section FROM loaded),
reported_in AS (SELECT DISTINCT title, location FROM loaded),
has_category AS (SELECT DISTINCT title, predicted_label AS category FROM loaded),
published_on AS (SELECT DISTINCT title, CAST(t AS DATE) AS date FROM loaded),
place_days AS (SELECT location, date, title FROM reported_in JOIN published_on USING (title)),
spokes AS (
  SELECT m.title, l.lead FROM place_days m
  JOIN (SELECT location, date, min(title) AS lead FROM place_days GROUP BY ALL) l USING (location, date)
  WHERE m.title <> l.lead
),
related AS (SELECT title, lead AS related_title FROM spokes UNION SELECT lead, title FROM spokes)"""
)


def with_articles(sql):
    return f"WITH {ARTICLES_SQL}\n{sql}"


def with_graph(sql):
    return f"WITH {GRAPH_SQL}\n{sql}"


_LOADED = {}
_SOURCES = ("documents", "events", "labels", "customer", "nation", "region")


def source_state(spark, sf_dir):
    """What a copy of the articles was made from: the application, and when each table last changed."""
    sc = spark.sparkContext
    times = []
    for name in _SOURCES:
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        times.append(path.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(path).getModificationTime())
    return sc.applicationId, sf_dir, *times


def graph_input(spark, sf_dir):
    """Scored articles as the graph load takes them."""
    return articles(spark, sf_dir).select(
        "article_id",
        "title",
        "summary",
        parse_time(F.col("publish_time"), TIME_FORMAT).alias("publish_time_ts"),
        "section",
        "sub_section",
        "location",
        "predicted_label",
    )


def _written(spark, sf_dir, name, *left_out):
    key = name, *source_state(spark, sf_dir)
    if key not in _LOADED:
        path = work_dir(spark, name)
        graph_input(spark, sf_dir).drop(*left_out).write.mode("overwrite").parquet(path)
        _LOADED[key] = path
    return spark.read.parquet(_LOADED[key])


def load_rows(spark, sf_dir):
    """The written copy of the load rows, made once per session and state of the tables."""
    return _written(spark, sf_dir, "graph-rows")


def graph(spark, sf_dir):
    """The graph of all articles. Edges come from a written copy without the summaries.

    Each edge table reads the load rows anew; from the copy that is a few short columns instead of the joins.
    News nodes and rejects are the only ones to hold a summary and are made from the articles themselves, so
    that texts move only for reports that read them.
    """
    edges = build_graph(_written(spark, sf_dir, "graph-edges", "summary").withColumn("summary", F.lit("")), order_by=["article_id"])
    whole = build_graph(graph_input(spark, sf_dir), order_by=["article_id"])
    return replace(edges, news=whole.news, rejects=whole.rejects)


def lexicon(spark):
    return spark.createDataFrame(list(LEXICON), "token string, valence double")


def land_topic(spark, sf_dir, name):
    """Scored articles as JSON lines in a fresh folder: the message log of the stream queries.

    A message holds its text up to three times (title, summary, body), so the files are compressed.
    """
    path = work_dir(spark, name)
    land_json(articles(spark, sf_dir).select(*SCORED_SCHEMA.fieldNames()), path, compression="snappy")
    return path


def listing_pages(spark, sf_dir, per_page=10):
    """Listing pages with ten articles each, written as the site writes them."""
    escaped = F.replace(F.replace(F.replace(F.col("summary"), F.lit("&"), F.lit("&amp;")),
                                  F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    caps = F.coalesce(F.col("location"), F.lit(""))
    entry = F.struct(
        F.col("title").alias("article_title"),
        F.col("article_id").cast("string").alias("permalink"),
        "publish_time",
        F.when(F.col("article_id") % 7 == 0, "{}")
        .otherwise(F.to_json(F.struct(F.array("summary").alias("summary"))))
        .alias("article_custom_fields"),
        F.concat(F.lit("<p><b>"), caps, F.lit(": "), F.lit("</b></p><div>"), escaped, F.lit("</div>")).alias(
            "article_body"
        ),
        F.when(F.col("article_id") % 11 != 0, F.col("section")).alias("section_name"),
        F.col("sub_section").alias("sub_section_name"),
        F.col("keywords").alias("keyword_tagging"),
    )
    script = F.to_json(F.struct(F.collect_list(entry).alias("data")))
    html = F.concat(
        F.lit("<html><head><script>var listing = "), script, F.lit(";</script></head><body></body></html>")
    )
    return (
        articles(spark, sf_dir)
        .groupBy(F.floor(F.col("article_id") / per_page).alias("page_id"))
        .agg(html.alias("html"))
    )
