"""Document fingerprints: the quartiles of hashed byte-triplet counts, and the length, as a short digest.

Every window of four bytes counts three triplets (its first byte with two of the other three) in
``BUCKETS`` buckets. Each bucket is encoded by the quartile of its count (2 bits), the length on a
logarithmic scale (8 bits). The distance of two digests is the sum of squared quartile differences plus
the difference of lengths; divided by its mean over unlike texts it gives a score between 0 and 1.
"""

import hashlib
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.llm.texts import chunks, mix

BUCKETS = 256
BOUND = 2.5 * BUCKETS  # the mean distance of independent digests: this or more is a likeness of 0
LENGTH_STEP = 1.1
_TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))


def _lengths(sizes):
    return np.minimum(255, np.log1p(sizes) / np.log(LENGTH_STEP)).astype(np.uint8)


def digests(buffer, offsets):
    """One digest a text: the length byte, then the quartiles, four to a byte."""
    n, width = len(offsets) - 1, 1 + BUCKETS // 4
    counts = np.zeros((n, BUCKETS), np.int32)
    if len(buffer) > 3:
        b = buffer.astype(np.uint64)
        owner = np.repeat(np.arange(n), np.diff(offsets))
        inside = owner[:-3] == owner[3:]
        place = owner[:-3][inside] * BUCKETS
        for k, at in enumerate(_TRIPLETS):
            key = sum(b[i : len(b) - 3 + i] << np.uint64(8 * j) for j, i in enumerate(at))
            slot = (mix(key[inside] + np.uint64(k << 40)) % np.uint64(BUCKETS)).astype(np.int64)
            counts += np.bincount(place + slot, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.int32)
    ranked = np.sort(counts, axis=1)
    levels = np.zeros((n, BUCKETS), np.uint8)
    for q in (1, 2, 3):
        levels += counts > ranked[:, BUCKETS * q // 4 - 1][:, None]
    packed = levels[:, 0::4] | levels[:, 1::4] << 2 | levels[:, 2::4] << 4 | levels[:, 3::4] << 6
    out = np.empty((n, width), np.uint8)
    out[:, 0], out[:, 1:] = _lengths(np.diff(offsets)), packed
    return out


_TABLE = np.zeros((256, 256), np.uint8)
for _a, _b in itertools.product(range(256), repeat=2):
    _TABLE[_a, _b] = sum(((_a >> s & 3) - (_b >> s & 3)) ** 2 for s in (0, 2, 4, 6))


def likeness(left, right):
    """Scores 0 to 1 of digests, row by row; equal digests score 1."""
    bits = _TABLE[left[:, 1:], right[:, 1:]].sum(axis=1, dtype=np.int64)
    lengths = np.abs(left[:, 0].astype(int) - right[:, 0])
    return 1 - np.minimum(1.0, (bits + lengths) / BOUND)


def fingerprints(docs, key="doc_id", text="text"):
    """key and fingerprint (hex) of every row; a null or empty text has the digest of no bytes."""
    kind = dict(docs.dtypes)[key]

    def run(batches):
        for rows, buffer, offsets in chunks(batches):
            found = [x.tobytes().hex() for x in digests(buffer, offsets)]
            yield pa.RecordBatch.from_pydict({"key": rows.column(0), "fingerprint": found})

    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return out.mapInArrow(run, f"key {kind}, fingerprint string").withColumnRenamed("key", key)


def near(left="fingerprint", right="other"):
    """A column: the likeness of two hex fingerprints; null where one is null."""

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        both = (a.notna() & b.notna()).to_numpy()
        out = np.full(len(a), np.nan)
        if both.any():
            pack = lambda x: np.frombuffer(bytes.fromhex("".join(x[both])), np.uint8).reshape(both.sum(), -1)
            out[both] = likeness(pack(a), pack(b))
        return pd.Series(out).where(both, None)

    return score(left, right)


def edited(text, following):
    """The last third of the code points replaced by as many first ones (or all) of the next text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def compare_with_next(docs, key="doc_id", text="text", partitions=None):
    """Fingerprint of each text, of its edited form, and their likeness, with the next text by descending key.

    Repeated keys follow in order of their text, a null key comes last; after the last row comes the
    first, and a single row follows itself. Texts move once: the key range is split into blocks, the
    first row of each block is also sent to the block before it, and each block is read in order.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    blocks = partitions or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = rows.filter(F.col("key").isNotNull())
    quantiles = known.approxQuantile("key", [i / blocks for i in range(1, blocks)], 0.2 / blocks)
    edges = sorted({int(x) for x in quantiles}, reverse=True)
    # block of a key: the number of edges above it; null keys have the last block
    block = F.when(F.col("key").isNull(), len(edges) + 1).otherwise(
        F.size(F.filter(F.lit(edges).cast("array<bigint>"), lambda e: e > F.col("key"))) if edges else F.lit(0)
    )
    placed = rows.withColumn("block", block)
    heads = {
        r.block: r.key for r in placed.groupBy("block").agg(F.max("key").alias("key")).collect()
    }  # at most one row a block
    if not heads:
        return spark.createDataFrame([], _COMPARED.format("bigint")).withColumnRenamed("key", key)
    order = sorted(heads)
    before = dict(zip(order[1:], order, strict=False)) | {order[0]: order[-1]}
    full = range(len(edges) + 2)
    at = F.col("block") + 1
    head = F.element_at(F.array([F.lit(heads.get(b)).cast("bigint") for b in full]), at)
    guest_of = F.element_at(F.array([F.lit(before.get(b)).cast("int") for b in full]), at)
    # All rows of a block's greatest key go to the block before it as well; the first follows its own rows.
    guests = F.when(F.col("key").eqNullSafe(head), guest_of)
    places = F.array(
        F.struct(F.col("block").alias("block"), F.lit(False).alias("guest")),
        F.struct(guests.alias("block"), F.lit(True).alias("guest")),
    )
    both = placed.select("key", "text", F.explode(places).alias("to")).select("key", "text", "to.*").filter("block IS NOT NULL")
    dealt = both.repartition(blocks, "block").sortWithinPartitions("block", "guest", F.col("key").desc_nulls_last(), "text")

    def run(batches):
        held = None  # (block, key, text) that waits for the row after it
        done = -1  # a block whose guest has been used
        for batch in batches:
            ready = []
            for at, name, words, guest in zip(*(batch.column(i).to_pylist() for i in (2, 0, 1, 3)), strict=True):
                if at == done:
                    continue
                if held is not None:
                    ready.append((held[1], held[2], words))
                held = None if guest else (at, name, words)
                if guest:
                    done = at
                if len(ready) >= 500:
                    yield _compared(ready)
                    ready = []
            if ready:
                yield _compared(ready)

    out = dealt.mapInArrow(run, _COMPARED.format("bigint"))
    return out.withColumnRenamed("key", key)


_COMPARED = "key {}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _digests_of(texts):
    parts = [chunk[1:] for chunk in chunks([pa.record_batch({"text": pa.array(texts, pa.string())})])]
    return np.concatenate([digests(*x) for x in parts])


def _compared(rows):
    keys, texts, following = zip(*rows, strict=True)
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    own, new = _digests_of(texts), _digests_of(changed)
    # the next text is mostly the next row's own
    after = np.concatenate((own[1:], _digests_of(following[-1:])))
    odd = [i for i in range(len(texts) - 1) if following[i] is not texts[i + 1]]
    if odd:
        after[odd] = _digests_of([following[i] for i in odd])
    return pa.RecordBatch.from_pydict(
        {
            "key": pa.array(keys, pa.int64()),
            "n_chars": pa.array(map(len, texts), pa.int64()),
            "edited_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in changed],
            "fingerprint": [x.tobytes().hex() for x in own],
            "edited_fingerprint": [x.tobytes().hex() for x in new],
            "near_edited": likeness(own, new),
            "near_next": likeness(own, after),
        }
    )
