"""Stream queries: each runs its stream once over what is there, and reads back what it wrote."""

from pyspark.sql import functions as F

from newsloom.functions.words import parse_time
from newsloom.operators.clean import clean_text
from newsloom.operators.models import batch_score
from newsloom.plans.model_queries import fit_and_save, load_fitted
from newsloom.plans.tables import SCORED_SCHEMA, articles, land_topic, read, source_state, with_articles
from newsloom.schemas import TIME_FORMAT
from newsloom.session import work_dir
from newsloom.sources.articles import parse_messages, read_topic_stream
from newsloom.sources.sinks import land_json
from newsloom.streaming import articles as ops
from newsloom.streaming.results import Output, fan_out, read_changes, read_output, write_changes
from newsloom.streaming.sinks import run_bounded, write_files

_TOPICS = {}
_FROM, _TO = "2024-01-20 00:00:00", "2024-02-10 23:59:59"


def _topic(spark, sf_dir):
    """The landed message log, written once per session and state of the tables."""
    key = source_state(spark, sf_dir)
    if key not in _TOPICS:
        _TOPICS[key] = land_topic(spark, sf_dir, "stream-topic")
    return _TOPICS[key]


def _stream(spark, sf_dir):
    return parse_messages(read_topic_stream(spark, "text", path=_topic(spark, sf_dir)), SCORED_SCHEMA)


def _appended(spark, df, path=None):
    path = path or work_dir(spark, "stream")
    run_bounded(write_files(df, f"{path}/data", f"{path}/checkpoint", available_now=True))
    return spark.read.schema(df.schema).parquet(f"{path}/data")


def _counted(spark, df, key):
    path = work_dir(spark, "stream")
    run_bounded(write_changes(df, [key], f"{path}/data", f"{path}/checkpoint", available_now=True))
    return read_changes(spark, f"{path}/data", df.schema, [key])


def stream_parse_json(spark, sf_dir):
    parsed = _stream(spark, sf_dir).withColumn("keyword_count", F.size("keywords"))
    columns = ["article_id", "title", "summary", "publish_time", "section", "sub_section", "location", "keyword_count"]
    return _appended(spark, parsed.select(*columns))


def stream_file_sink(spark, sf_dir):
    return _appended(spark, _stream(spark, sf_dir).select("article_id", "link", "body"))


def stream_filter_sub_section(spark, sf_dir):
    found = ops.filter_sub_section(_stream(spark, sf_dir), "SRC3")
    return _appended(spark, found.select("article_id", "sub_section"))


def stream_filter_sentiment(spark, sf_dir):
    found = ops.filter_sentiment(_stream(spark, sf_dir), "Positive")
    return _appended(spark, found.select("article_id", "predicted_label"))


def stream_filter_date(spark, sf_dir):
    found = ops.filter_date(_stream(spark, sf_dir), _FROM, _TO)
    return _appended(spark, found.select("article_id", "publish_time"))


def stream_count_by_location(spark, sf_dir):
    return _counted(spark, ops.count_by_location(_stream(spark, sf_dir)), "location")


def stream_count_by_section(spark, sf_dir):
    return _counted(spark, ops.count_by_section(_stream(spark, sf_dir)), "section")


def stream_explode_keywords(spark, sf_dir):
    exploded = ops.explode_keywords(_stream(spark, sf_dir))
    return _appended(spark, exploded.select("article_id", "keyword", F.size("keywords").alias("keyword_count")))


def stream_keyword_count(spark, sf_dir):
    return _counted(spark, ops.keyword_count(_stream(spark, sf_dir)), "keyword")


OUTPUTS = (
    Output("sub_section", lambda batch: ops.filter_sub_section(batch, "SRC3").select("article_id")),
    Output("sentiment", lambda batch: ops.filter_sentiment(batch, "Positive").select("article_id")),
    Output("date", lambda batch: ops.filter_date(batch, _FROM, _TO).select("article_id")),
    Output("location_counts", ops.count_by_location, ("location",)),
    Output("section_counts", ops.count_by_section, ("section",)),
    Output("keyword_counts", ops.keyword_count, ("keyword",)),
)


def stream_fan_out(spark, sf_dir):
    """Six results from one read of the stream, four files a batch: result, key, and its number."""
    path = work_dir(spark, "fan-out")
    source = read_topic_stream(spark, "text", path=_topic(spark, sf_dir), maxFilesPerTrigger=4)
    stream = parse_messages(source, SCORED_SCHEMA)
    run_bounded(fan_out(stream, OUTPUTS, f"{path}/data", f"{path}/checkpoint", available_now=True))
    shape, out = spark.createDataFrame([], stream.schema), None
    for output in OUTPUTS:
        rows = read_output(spark, f"{path}/data", output, output.make(shape).schema)
        key = rows[rows.columns[0]].cast("string").alias("key")
        n = rows[rows.columns[1]] if output.keys else F.lit(1).cast("long")
        part = rows.select(F.lit(output.name).alias("result"), key, n.alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


def _windows(counts, label="event_type"):
    return counts.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        label,
        "count",
    )


def _event_windows(stream):
    # The table's times have no zone, which a watermark does not accept.
    events = stream.select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return _windows(ops.window_counts(events, time="ts", label="event_type"))


def stream_sentiment_windows(spark, sf_dir):
    schema = read(spark, sf_dir, "events").schema
    # As a glob, since a stream takes a folder but not a single file.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return _appended(spark, _event_windows(stream))


def stream_article_windows(spark, sf_dir):
    """Scored articles per label in windows over their publish times."""
    parsed = _stream(spark, sf_dir).withColumn("publish_time", parse_time(F.col("publish_time"), TIME_FORMAT))
    return _appended(spark, _windows(ops.window_counts(parsed), "predicted_label"))


def stream_late_data(spark, sf_dir):
    """Even event ids first, odd ones in a later run of the same stream: most come too late."""
    events = read(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    path = work_dir(spark, "late")
    for rest in (0, 1):
        events.filter(F.col("event_id") % 2 == rest).write.mode("append").parquet(f"{path}/source")
        stream = spark.readStream.schema(events.schema).parquet(f"{path}/source")
        result = _appended(spark, _event_windows(stream), path)
    return result


def stream_dedup(spark, sf_dir):
    """Every message sent twice in one run and once more in a later one; each link comes out once."""
    path = work_dir(spark, "twice")
    rows = articles(spark, sf_dir).select("link", "title", "publish_time")
    for run, copies in enumerate(([1, 2], [1])):
        land_json(rows.withColumn("copy", F.explode(F.array(*map(F.lit, copies)))).drop("copy"), f"{path}/in/{run}")
        messages = read_topic_stream(spark, "text", path=f"{path}/in/*")
        stream = parse_messages(messages, rows.schema, keep=["arrival"])
        result = _appended(spark, ops.dedup_stream(stream).drop("arrival"), path)
    return result


def stream_score(spark, sf_dir):
    """Every article of the scored stream, and whether batch scoring gives the same label."""
    feature_model, model = load_fitted(spark, fit_and_save(spark, sf_dir))
    cleaned = clean_text(_stream(spark, sf_dir).select("article_id", "summary"))
    scored = ops.score_stream(cleaned, feature_model, model)
    streamed = _appended(spark, scored.select("article_id", F.col("predicted_label").alias("streamed")))
    batch = batch_score(clean_text(articles(spark, sf_dir).select("article_id", "summary")), feature_model, model)
    same = F.col("predicted_label").eqNullSafe(F.col("streamed")).alias("same_as_batch")
    return streamed.join(batch.select("article_id", "predicted_label"), "article_id", "left").select("article_id", same)


_STARTS = (
    "SELECT event_type, unnest([time_bucket(INTERVAL 5 MINUTE, ts), "
    "time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]) AS s, event_id FROM events"
)
_WATERMARK = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events{0})"

QUERIES = {
    "stream_parse_json": (
        stream_parse_json,
        with_articles(
            """SELECT article_id, title, summary, publish_time, section, sub_section, location,
       CAST(len(keywords) AS INT) AS keyword_count FROM articles"""
        ),
    ),
    "stream_file_sink": (stream_file_sink, with_articles("SELECT article_id, link, body FROM articles")),
    "stream_filter_sub_section": (
        stream_filter_sub_section,
        with_articles("SELECT article_id, sub_section FROM articles WHERE lower(sub_section) = 'src3'"),
    ),
    "stream_filter_sentiment": (
        stream_filter_sentiment,
        with_articles("SELECT article_id, predicted_label FROM articles WHERE lower(predicted_label) = 'positive'"),
    ),
    "stream_filter_date": (
        stream_filter_date,
        with_articles(
            f"SELECT article_id, publish_time FROM articles WHERE publish_time BETWEEN '{_FROM}' AND '{_TO}'"
        ),
    ),
    "stream_count_by_location": (
        stream_count_by_location,
        with_articles("SELECT location, count(*) AS news_count FROM articles GROUP BY location"),
    ),
    "stream_count_by_section": (
        stream_count_by_section,
        with_articles("SELECT section, count(*) AS news_count FROM articles GROUP BY section"),
    ),
    "stream_explode_keywords": (
        stream_explode_keywords,
        with_articles(
            "SELECT article_id, unnest(keywords) AS keyword, CAST(len(keywords) AS INT) AS keyword_count FROM articles"
        ),
    ),
    "stream_keyword_count": (
        stream_keyword_count,
        with_articles(
            """SELECT keyword, count(*) AS keyword_freq FROM (SELECT unnest(keywords) AS keyword FROM articles)
GROUP BY keyword"""
        ),
    ),
    "stream_fan_out": (
        stream_fan_out,
        with_articles(
            f"""SELECT 'sub_section' AS result, CAST(article_id AS VARCHAR) AS key, 1::BIGINT AS n FROM articles WHERE lower(sub_section) = 'src3'
UNION ALL SELECT 'sentiment', CAST(article_id AS VARCHAR), 1 FROM articles WHERE lower(predicted_label) = 'positive'
UNION ALL SELECT 'date', CAST(article_id AS VARCHAR), 1 FROM articles WHERE publish_time BETWEEN '{_FROM}' AND '{_TO}'
UNION ALL SELECT 'location_counts', location, count(*) FROM articles GROUP BY location
UNION ALL SELECT 'section_counts', section, count(*) FROM articles GROUP BY section
UNION ALL SELECT 'keyword_counts', keyword, count(*) FROM (SELECT unnest(keywords) AS keyword FROM articles) GROUP BY keyword"""
        ),
    ),
    "stream_sentiment_windows": (
        stream_sentiment_windows,
        f"""SELECT s AS window_start, s + INTERVAL 10 MINUTE AS window_end, event_type, count(*) AS count
FROM ({_STARTS}) WHERE s + INTERVAL 10 MINUTE <= {_WATERMARK.format('')} GROUP BY ALL""",
    ),
    "stream_article_windows": (
        stream_article_windows,
        with_articles(
            """, timed AS (SELECT predicted_label, CAST(publish_time AS TIMESTAMP) AS t FROM articles),
starts AS (SELECT predicted_label, unnest([time_bucket(INTERVAL 5 MINUTE, t),
                                           time_bucket(INTERVAL 5 MINUTE, t) - INTERVAL 5 MINUTE]) AS s FROM timed)
SELECT s AS window_start, s + INTERVAL 10 MINUTE AS window_end, predicted_label, count(*) AS count
FROM starts WHERE s + INTERVAL 10 MINUTE <= (SELECT max(t) - INTERVAL 1 HOUR FROM timed) GROUP BY ALL"""
        ),
    ),
    "stream_late_data": (
        stream_late_data,
        f"""SELECT s AS window_start, s + INTERVAL 10 MINUTE AS window_end, event_type, count(*) AS count
FROM ({_STARTS})
WHERE s + INTERVAL 10 MINUTE <= {_WATERMARK.format('')}
  AND (event_id % 2 = 0 OR s + INTERVAL 10 MINUTE > {_WATERMARK.format(' WHERE event_id % 2 = 0')})
GROUP BY ALL""",
    ),
    "stream_dedup": (stream_dedup, with_articles("SELECT link, title, publish_time FROM articles")),
    "stream_score": (stream_score, with_articles("SELECT article_id, true AS same_as_batch FROM articles")),
}
