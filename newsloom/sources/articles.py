"""Reading articles from files and topics."""

from pyspark.sql import functions as F

from newsloom.schemas import ARTICLE_SCHEMA, LEXICON_SCHEMA


def load_articles(spark, path, multiline=True, schema=ARTICLE_SCHEMA):
    """Articles from JSON files under a declared schema (no inference pass).

    ``multiline`` reads pretty-printed arrays, one whole file per task; JSON lines split.
    """
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def load_lexicon(spark, path):
    """A tab-separated lexicon; columns after token and valence are ignored."""
    return spark.read.schema(LEXICON_SCHEMA).option("sep", "\t").csv(path)


def _kafka_options(options):
    return {"startingOffsets": "earliest", "failOnDataLoss": "false", **options}


def read_topic(spark, fmt="kafka", **options):
    """Bounded read: every message from the earliest offset to the end offsets at the start.

    ``fmt`` names any source with a ``value`` column ("text" replays files of JSON lines).
    """
    if fmt == "kafka":
        options = {**_kafka_options(options), "endingOffsets": "latest"}
    reader = spark.read.format(fmt).options(**options)
    return reader.load().select(F.col("value").cast("string").alias("json_data"))


def read_topic_stream(spark, fmt="kafka", **options):
    """The same messages as a stream, with ``arrival``: the broker's time, or that of a file of messages."""
    reader = spark.readStream.format(fmt)
    arrival = F.col("timestamp")
    if fmt == "kafka":
        options = _kafka_options(options)
    elif fmt == "text":
        reader = reader.schema("value string")
        arrival = F.col("_metadata.file_modification_time")
    messages = reader.options(**options).load()
    return messages.select(F.col("value").cast("string").alias("json_data"), arrival.alias("arrival"))


def parse_messages(df, schema=ARTICLE_SCHEMA, keep=()):
    """Article columns from ``json_data``, and the message columns ``keep``; a malformed message becomes an all-null row."""
    return df.select(F.from_json("json_data", schema).alias("data"), *keep).select("data.*", *keep)


def split_malformed(df, schema=ARTICLE_SCHEMA):
    """(articles, rejected messages) where the parse leaves every field null."""
    fields = [F.col(f"data.{name}") for name in schema.fieldNames()]
    parsed = df.withColumn("data", F.from_json("json_data", schema))
    bad = F.coalesce(*[field.cast("string") for field in fields]).isNull()
    return parsed.filter(~bad).select("data.*"), parsed.filter(bad).select("json_data")
