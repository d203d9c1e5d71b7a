"""The property graph of articles as node and edge tables.

News nodes are keyed by title, so articles with one title are one node, and a section is only
reachable through its sub-sections. Every report goes through these edges: a flat count over
articles would give other numbers.
"""

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("title", "section", "sub_section", "location", "predicted_label", "publish_time_ts")


@dataclass(frozen=True)
class NewsGraph:
    news: DataFrame  # title, summary, publish_time, _order (what decides between articles of one title)
    part_of: DataFrame  # sub_section, section
    belongs_to: DataFrame  # title, sub_section
    reported_in: DataFrame  # title, location
    has_category: DataFrame  # title, category
    published_on: DataFrame  # title, date
    rejects: DataFrame  # input rows with a null key, and which


def build_graph(df, order_by=()):
    """Node and edge tables of scored articles (``KEYS`` and ``summary``).

    Rows with a null key cannot be merged into a graph and go to ``rejects``. Of several
    articles with one title the latest gives summary and time; ``order_by`` columns break
    ties. All tables are distinct sets, which Spark reduces before its shuffle, so a title or
    section that holds much of the data arrives as at most one row per map task.
    """
    whole = F.lit(True)
    for key in KEYS:
        whole = whole & F.col(key).isNotNull()
    nulls = F.concat_ws(",", *[F.when(F.col(key).isNull(), key) for key in KEYS])
    valid = df.filter(whole)

    def edges(left, right):
        return valid.select(left, right).distinct()

    rows = valid.withColumn("_order", F.struct("publish_time_ts", *order_by)).withColumnRenamed("publish_time_ts", "publish_time")
    return NewsGraph(
        news=_latest(rows),
        part_of=edges("sub_section", "section"),
        belongs_to=edges("title", "sub_section"),
        reported_in=edges("title", "location"),
        has_category=edges("title", F.col("predicted_label").alias("category")),
        published_on=edges("title", F.to_date("publish_time_ts").alias("date")),
        rejects=df.filter(~whole).withColumn("null_keys", nulls),
    )


def _latest(rows, *held):
    """One node per title: the last by time, then the order columns, then summary."""
    latest = F.max(F.struct("_order", "summary", "publish_time")).alias("latest")
    return rows.groupBy(*held, "title").agg(latest).select(*held, "title", "latest.summary", "latest.publish_time", "latest._order")


def merge_graphs(old, new):
    """Upsert ``new`` into ``old``: sets are united, a title's later node wins by the rule of ``build_graph``."""
    sets = ("part_of", "belongs_to", "reported_in", "has_category", "published_on")
    return NewsGraph(
        news=_latest(old.news.unionByName(new.news)),
        rejects=old.rejects.unionByName(new.rejects),
        **{name: getattr(old, name).unionByName(getattr(new, name)).distinct() for name in sets},
    )


def save_graph(graph, path):
    for part in fields(graph):
        getattr(graph, part.name).write.mode("overwrite").parquet(f"{path}/{part.name}")


def load_graph(spark, path):
    return NewsGraph(**{part.name: spark.read.parquet(f"{path}/{part.name}") for part in fields(NewsGraph)})


def save_graph_tables(graph, prefix, buckets):
    """As catalog tables; those with a title are bucketed by it, so title joins need no shuffle."""
    for part in fields(graph):
        writer = getattr(graph, part.name).write.mode("overwrite").format("parquet")
        if part.name not in ("part_of", "rejects"):
            writer = writer.bucketBy(buckets, "title").sortBy("title")
        writer.saveAsTable(f"{prefix}{part.name}")


def load_graph_tables(spark, prefix):
    return NewsGraph(**{part.name: spark.table(f"{prefix}{part.name}") for part in fields(NewsGraph)})


# Incremental loads ------------------------------------------------------------------------

_BY = {"part_of": "sub_section"}  # all other tables are cut by title
_SETS = ("part_of", "belongs_to", "reported_in", "has_category", "published_on")


def _bucketed(graph, name, buckets):
    return getattr(graph, name).withColumn("_bucket", F.pmod(F.xxhash64(_BY.get(name, "title")), F.lit(buckets)).cast("int"))


def save_graph_buckets(graph, path, buckets):
    """As Parquet in one partition folder for each bucket of titles, which ``upsert_graph`` can replace alone.

    A bucket should hold some hundred MB: the number is fixed when the graph is first written.
    """
    for name in ("news", *_SETS):
        rows = _bucketed(graph, name, buckets)
        rows.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/{name}")
    graph.rejects.write.mode("overwrite").parquet(f"{path}/rejects")


def load_graph_buckets(spark, path):
    tables = {name: spark.read.parquet(f"{path}/{name}").drop("_bucket") for name in ("news", *_SETS)}
    return NewsGraph(rejects=spark.read.parquet(f"{path}/rejects"), **tables)


def upsert_graph(spark, path, new, buckets, staging):
    """Loads ``new`` into a graph of ``save_graph_buckets``; returns the buckets it rewrote by table.

    Only buckets that ``new`` touches are read, merged by the rules of ``merge_graphs``, written below
    ``staging`` and then put in place by dynamic partition overwrite, so a load that is cut off and run again
    gives the same graph. Rejected rows are appended last.
    """
    touched = {}
    for name in ("news", *_SETS):
        rows = _bucketed(new, name, buckets)
        # at most ``buckets`` numbers
        touched[name] = sorted(row[0] for row in rows.select("_bucket").distinct().collect())
        old = spark.read.parquet(f"{path}/{name}").filter(F.col("_bucket").isin(touched[name]))
        # one exchange, by bucket, does for both the merging and the writing
        both = old.unionByName(rows).repartition("_bucket")
        merged = _latest(both, "_bucket") if name == "news" else both.distinct()
        merged.write.mode("overwrite").parquet(f"{staging}/{name}")
    for name in touched:
        # staged by bucket already, so no exchange is needed
        rows = spark.read.parquet(f"{staging}/{name}")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(f"{path}/{name}")
    new.rejects.write.mode("append").parquet(f"{path}/rejects")
    return touched


def run_parameterised(spark, sql, parameters=None, **views):
    """A SQL query with bound parameters over graph tables given as keyword arguments."""
    return spark.sql(sql, args=parameters or {}, **views) if views else spark.sql(sql, args=parameters or {})
