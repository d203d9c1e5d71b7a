"""The shared folder for written tables and files."""

import uuid

from pyspark.sql import functions as F

HUB = 256  # rows that no task minds
HUBS = 50_000


def shared_folder(spark, name):
    """A fresh path below ``spark.checkpoint.dir``, which all executors share.

    A local master without that setting uses the warehouse folder; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    if base.startswith("/"):
        base = f"file://{base}"
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df, name, **options):
    """``df`` written to the shared folder and read again: its lineage ends there."""
    path = shared_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


def hub_size(total):
    """Rows of a key from which on it is a hub among ``total`` rows; there are ``HUBS`` hubs at most."""
    return max(HUB, total // HUBS)


def hub_join(rows, one, on, size, total):
    """``rows`` joined with ``one``, which has one row a key and in ``size`` at least the number of its rows.

    Keys of more than ``hub_size`` rows, ``HUBS`` at most, are broadcast and their rows stay where they are;
    only other keys meet in a task. ``total`` is the sum of ``size`` over all keys, or less.
    """
    cut = hub_size(total)
    heavy, light = one.filter(F.col(size) > cut), one.filter(F.col(size) <= cut)
    rest = rows.join(F.broadcast(heavy.select(on)), on, "left_anti").join(light, on)
    return rows.join(F.broadcast(heavy), on).unionByName(rest)
