"""Session settings and the shared work folder."""

import uuid

from pyspark.sql import SparkSession


def build_session(app_name="newsloom", master=None, shuffle_partitions=None, **conf):
    """A session with the settings the operators count on.

    Adaptive execution sizes the shuffles and splits skewed join partitions, so
    ``shuffle_partitions`` only has to be set for very small or very large runs.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark, name):
    """A fresh folder for ``name`` below the shared checkpoint folder.

    The cluster names that folder in ``spark.checkpoint.dir``. Without the setting a local
    master uses its warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/newsloom/{name}-{uuid.uuid4().hex}"
