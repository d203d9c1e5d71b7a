"""Stream results that a reader may open at any time: batches in folders of their own, then a commit file.

A batch writes below a folder named by its id and, when all is there, a file ``commits/<id>``. Readers take
what the newest commit names, so a batch that was cut off is never seen, the result before it stays whole,
and a batch that runs again writes the same folder or, where it had been committed, nothing.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from newsloom.streaming.sinks import _writer

COMPACT = 20  # batches of changes after which the whole result is written once


class Commits:
    """The commit files below a path of any Hadoop file system; each names the last whole result."""

    def __init__(self, spark, path):
        self.path, self.jvm = path, spark.sparkContext._jvm
        self.files = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits/{name}" if name else self.path)

    def newest(self):
        """(batch id, id of the last whole result or None); None before the first commit."""
        folder = self._at(".")
        if not self.files.exists(folder):
            return None
        names = [status.getPath().getName() for status in self.files.listStatus(folder)]
        done = [name.split("_") for name in names if name[0].isdigit()]
        if not done:
            return None
        batch, whole = max(done, key=lambda parts: int(parts[0]))
        return int(batch), (int(whole) if whole else None)

    def add(self, batch, whole=None):
        # an empty file whose name says all: it is there or not
        self.files.create(self._at(f"{batch}_{'' if whole is None else whole}"), True).close()


def _folders(spark, path, schema, batches):
    """Rows of the given batches, with the batch's id as ``_batch``; one scan of all their folders."""
    if not batches:
        return spark.createDataFrame([], schema).withColumn("_batch", F.lit(0).cast("long"))
    rows = spark.read.schema(schema).parquet(*(f"{path}/{batch}" for batch in batches))
    return rows.withColumn("_batch", F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)/[^/]+$", 1).cast("long"))


def _passed(batch):
    """Runs a batch whose rows are there already: the stream's own state still has to take it in."""
    batch.write.format("noop").mode("overwrite").save()


def write_latest(df, path, checkpoint, trigger_interval=None, available_now=False):
    """A complete-mode result: each batch is a whole one beside the one before. Read it by ``read_latest``."""

    def whole(batch, number):
        commits = Commits(batch.sparkSession, path)
        newest = commits.newest()
        if newest is not None and newest[0] >= number:
            _passed(batch)
            return
        batch.write.mode("overwrite").parquet(f"{path}/whole/{number}")
        commits.add(number, number)

    writer = _writer(df, "complete", trigger_interval, available_now)
    return writer.option("checkpointLocation", checkpoint).foreachBatch(whole).start()


def read_latest(spark, path, schema):
    newest = Commits(spark, path).newest()
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/whole/{newest[1]}")


def write_changes(df, keys, path, checkpoint, trigger_interval=None, available_now=False, compact=COMPACT):
    """An aggregate in update mode: a batch writes the keys that it changed, not the whole result.

    Every ``compact`` batches the result so far is written whole, so that a reader opens few folders.
    """
    schema = df.schema

    def changes(batch, number):
        spark = batch.sparkSession
        commits = Commits(spark, path)
        newest = commits.newest()
        if newest is not None and newest[0] >= number:
            _passed(batch)
            return
        batch.write.mode("overwrite").parquet(f"{path}/changes/{number}")
        whole = newest[1] if newest else None
        if (number + 1) % compact == 0:
            _merged(spark, path, schema, keys, number, whole).write.mode("overwrite").parquet(f"{path}/whole/{number}")
            whole = number
        commits.add(number, whole)

    writer = _writer(df, "update", trigger_interval, available_now)
    return writer.option("checkpointLocation", checkpoint).foreachBatch(changes).start()


def _merged(spark, path, schema, keys, batch, whole):
    """Each key's row of its last batch up to ``batch``, from the whole result and the changes after it."""
    first = 0 if whole is None else whole + 1
    rows = _folders(spark, f"{path}/changes", schema, range(first, batch + 1))
    if whole is not None:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{path}/whole/{whole}").withColumn("_batch", F.lit(-1).cast("long")))
    names = [name for name in schema.fieldNames() if name not in keys]
    latest = F.max_by(F.struct(*names), "_batch").alias("_row")
    return rows.groupBy(*keys).agg(latest).select(*[name if name in keys else f"_row.{name}" for name in schema.fieldNames()])


def read_changes(spark, path, schema, keys):
    newest = Commits(spark, path).newest()
    if newest is None:
        return spark.createDataFrame([], schema)
    return _merged(spark, path, schema, keys, *newest)


@dataclass(frozen=True)
class Output:
    """One result of a fan-out: ``make`` turns a batch into rows.

    Without ``keys`` rows are kept as they are; with them, they are partial and summed by key when read.
    """

    name: str
    make: object
    keys: tuple = ()


def fan_out(df, outputs, path, checkpoint, trigger_interval=None, available_now=False):
    """Several results from one read of a stream; each batch is kept while its results are written."""

    def write(batch, number):
        commits = Commits(batch.sparkSession, path)
        newest = commits.newest()
        if newest is not None and newest[0] >= number:
            return
        batch = batch.persist()
        try:
            for output in outputs:
                output.make(batch).write.mode("overwrite").parquet(f"{path}/{output.name}/{number}")
        finally:
            batch.unpersist()
        commits.add(number)

    writer = _writer(df, "append", trigger_interval, available_now)
    return writer.option("checkpointLocation", checkpoint).foreachBatch(write).start()


def read_output(spark, path, output, schema):
    """A result of all committed batches. ``schema`` is that of what ``make`` returns."""
    newest = Commits(spark, path).newest()
    rows = _folders(spark, f"{path}/{output.name}", schema, range(newest[0] + 1) if newest else ()).drop("_batch")
    if not output.keys:
        return rows
    sums = [F.sum(name).alias(name) for name in schema.fieldNames() if name not in output.keys]
    return rows.groupBy(*output.keys).agg(*sums).select(*schema.fieldNames())
