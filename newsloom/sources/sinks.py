"""Writing articles and scored results. Everything is written by the executors."""

from pyspark.sql import functions as F

from newsloom.schemas import RESULT_COLUMNS


def land_json(df, path, compression=None):
    """Raw articles as JSON lines, replacing what was there."""
    df.write.mode("overwrite").json(path, compression=compression)


def append_results(df, path, fmt="parquet"):
    """Append scored articles, one folder per publish date.

    The rebalance step gives each date its own files; adaptive execution merges the small
    dates and splits a hot one, so that no task writes a whole big date alone.
    """
    results = df.select(*RESULT_COLUMNS).withColumn("publish_date", F.substring("publish_time", 1, 10))
    (
        results.hint("rebalance", F.col("publish_date"))
        .write.mode("append").format(fmt).partitionBy("publish_date").save(path)
    )


def append_one(spark, record, path, schema, fmt="parquet"):
    """Append a single record (a dict)."""
    spark.createDataFrame([record], schema).write.mode("append").format(fmt).save(path)


def read_results(spark, path, start_date=None, end_date=None):
    """Results of half-open [start_date, end_date); only those date folders are listed."""
    df = spark.read.option("basePath", path).parquet(path)
    if start_date:
        df = df.filter(F.col("publish_date") >= start_date)
    if end_date:
        df = df.filter(F.col("publish_date") < end_date)
    return df
