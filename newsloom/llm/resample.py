"""Importance resampling towards a target: documents drawn by how much likelier the target makes their words.

A feature is a run of one or two consecutive words, put into one of ``BUCKETS`` buckets by its CRC-32.
Newlines are no part of words, so they cut texts into segments whose inner features never change:

* each distinct line of the corpus is counted once, times its occurrences (lines are grouped with their
  numbers before the shuffle, so a line that stands in a third of all rows is one row a task);
* pairs of words that meet over line ends are counted apart, from the last word of one line with words
  and the first of the next.

Both give a vector of ``BUCKETS`` counts a task. The gain of a bucket compares the target's share with the
corpus's; a document's weight is its features' mean gain. Noise from the key's digest makes the draw of the
highest scores a weighted draw without replacement. The order of all scores comes from ranges: sorted
parts, whose sizes are summed up, so no task sees all rows.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.crc import joined_crcs, span_crcs
from newsloom.llm.texts import chunks, give_back, word_spans
from newsloom.llm.work import written

BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = 25  # per cent
SEED = 7


def _buckets(buffer, offsets, buckets):
    """(buckets of the words, of the pairs, first words of texts, first pairs of texts)."""
    lower, starts, ends, firsts = word_spans(buffer, offsets)
    crcs = span_crcs(lower, starts, ends)
    left = np.ones(len(starts), bool)
    left[firsts[1:][firsts[1:] > 0] - 1] = False  # the last word of a text begins no pair
    left = np.flatnonzero(left)
    pairs = joined_crcs(lower, left, crcs, starts, ends)
    return crcs % np.uint32(buckets), pairs % np.uint32(buckets), firsts, np.searchsorted(left, firsts)


def _crossing(buffer, offsets, buckets):
    """Buckets of the pairs of words that a newline parts."""
    lower, starts, ends, firsts = word_spans(buffer, offsets)
    if len(starts) < 2:
        return np.zeros(0, np.uint32)
    lines = np.searchsorted(np.flatnonzero(buffer == 10), starts)
    met = lines[1:] != lines[:-1]
    met[firsts[1:-1][(firsts[1:-1] > 0) & (firsts[1:-1] < len(starts))] - 1] = False  # two texts
    left = np.flatnonzero(met)
    both = np.stack((left, left + 1), 1).ravel()  # only these words are read
    crcs = span_crcs(lower, starts[both], ends[both])
    return joined_crcs(lower, np.arange(0, len(both), 2), crcs, starts[both], ends[both]) % np.uint32(buckets)


def _vector(counts):
    found = np.flatnonzero(counts)
    return pa.RecordBatch.from_pydict({"bucket": pa.array(found, pa.int32()), "n": pa.array(counts[found])})


def bucket_counts(docs, text="text", buckets=BUCKETS):
    """The number of features in each bucket over all texts, as a numpy vector; null texts have none."""

    def inside(batches):
        total = np.zeros(buckets, np.int64)
        for rows, buffer, offsets in chunks(batches, "line"):
            times = rows.column(1).to_numpy(zero_copy_only=False)
            words, pairs, firsts, pair_firsts = _buckets(buffer, offsets, buckets)
            for found, first in ((words, firsts), (pairs, pair_firsts)):
                # doubles hold these sums exactly: a chunk's features times its lines' occurrences stay below 2 ** 53
                total += np.bincount(found, np.repeat(times, np.diff(first)), buckets).astype(np.int64)
        yield _vector(total)

    def across(batches):
        total = np.zeros(buckets, np.int64)
        for _, buffer, offsets in chunks(batches):
            total += np.bincount(_crossing(buffer, offsets, buckets), minlength=buckets)
        yield _vector(total)

    texts = docs.select(F.col(text).alias("text")).filter("text IS NOT NULL")
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    parts = lines.mapInArrow(inside, "bucket int, n long").unionByName(texts.mapInArrow(across, "bucket int, n long"))
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row a bucket
        out[row.bucket] = row.n
    return out


def gains(corpus, target):
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of the B buckets."""
    size = len(corpus)
    s_all, t_all = float(corpus.sum()), float(target.sum())
    ratio = lambda s, t: (t + 1) * (s_all + size) / ((s + 1) * (t_all + size))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs, gain, key="doc_id", text="text"):
    """key, n_words, n_features, weight of every row: the floored mean gain of its features, 0 without any."""
    kind, buckets = dict(docs.dtypes)[key], len(gain)

    def run(batches):
        for rows, buffer, offsets in chunks(batches):
            words, pairs, firsts, pair_firsts = _buckets(buffer, offsets, buckets)
            n_words = np.diff(firsts)
            n = n_words + np.diff(pair_firsts)
            total = np.zeros(len(n), np.int64)
            for found, first in ((words, firsts), (pairs, pair_firsts)):
                sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(gain[found])))
                total += sums[first[1:]] - sums[first[:-1]]
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_pydict({"key": rows.column(0), "n_words": n_words, "n_features": n, "weight": weight})
        give_back()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_words long, n_features long, weight long")


def ranked(scored, order):
    """Adds ``rank`` 1, 2, 3, ... in that order: sorted ranges, each after the rows of those before it."""
    parts = written(
        scored.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}),
        "ranked",
    )
    # one row a part, so the window's one task holds as many rows as there were tasks
    before = parts.groupBy("part").agg(F.count("*").alias("size")).withColumn(
        "before", F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    )
    before = F.broadcast(before.select("part", F.coalesce("before", F.lit(0)).alias("before")))
    return parts.join(before, "part").withColumn("rank", F.col("before") + F.col("place") + 1).drop("part", "place", "before")


def resample(docs, target, key="doc_id", text="text", share=SHARE, least_words=LEAST_WORDS, seed=SEED, buckets=BUCKETS):
    """key, n_features, weight, score, rank of every row of ``docs``; ``target`` has a column ``text``.

    Of the N rows with at least ``least_words`` words, floor(share * N / 100) of highest score have a rank, ties
    going to the smaller key; other ranks are null. A null or empty text has no words, no features and weight 0.
    A null key has no score, is not drawn, and is not among the N rows. Rows of one key share their noise; equal
    ones take ranks next to each other. An empty ``docs`` gives no rows, an empty ``target`` counts as no features.
    Other columns are left out, so their names cannot clash.
    """
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, "text", buckets))
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    scored = weights(docs, gain, key, text).withColumn("score", (F.col("weight") + gumbel).cast("long"))
    # written rows have a number each, so that rows of one key spread over ranges as well
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    wide = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    drawn = scored.filter(wide).count() * share // 100
    kept = ["key", "n_features", "weight", "score", "rank"]
    placed = ranked(scored.filter(wide), [F.col("score").desc(), F.col("key"), F.col("row")])
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).select(kept)
    rest = scored.filter(~wide | F.col("score").isNull()).withColumn("rank", F.lit(None).cast("long")).select(kept)
    return placed.unionByName(rest).withColumnRenamed("key", key)
