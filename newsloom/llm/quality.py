"""Quality by compression: zstandard dictionaries of good and of bad text, and the difference of the sizes.

A text is compressed in blocks with each dictionary, so that the dictionary keeps its part in long
texts too. The sizes' difference over the plain size, and the better size over the plain size, give a
probability by logistic calibration on labelled rows that neither dictionary has seen.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.llm.texts import chunks
from newsloom.llm.toxicity import fold
from newsloom.llm.vectors import sigmoid

BLOCK = 1024
LEVEL = 3
DICTIONARY_BYTES = 64 << 10
SAMPLE_BLOCKS = 4_000  # blocks (2 BLOCK bytes) of text of each label that a dictionary is built from
MAX_DICTIONARY_ROWS = 3_000  # labelled rows of each kind they come from: those of least key hash
MAX_CALIBRATION_ROWS = 10_000
THRESHOLD = 0.3


def _compressors(dictionaries):
    import zstandard

    return [
        zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False
        )
        if d
        else zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)
        for d in dictionaries
    ]


def measure(buffer, offsets, compressors):
    """One row a text: difference of sizes (bad less good) and better size, both over the plain size."""
    data = buffer.tobytes()
    out = np.zeros((len(offsets) - 1, 2))
    for i, (start, stop) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if stop > start:
            parts = [data[k : min(stop, k + BLOCK)] for k in range(start, stop, BLOCK)]
            good, bad = (sum(len(c.compress(x)) for x in parts) for c in compressors)
            out[i] = (bad - good) / (stop - start), min(good, bad) / (stop - start)
    return out


def _sampled(texts):
    """The SAMPLE_BLOCKS blocks of least content hash, out of all blocks of all the texts."""

    def run(batches):
        for _, buffer, offsets in chunks(batches):
            data = buffer.tobytes()
            blocks = [data[k : min(j, k + 2 * BLOCK)] for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) for k in range(i, j, 2 * BLOCK)]
            yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.binary())})

    blocks = texts.select("text").mapInArrow(run, "block binary")
    return [bytes(r.block) for r in blocks.orderBy(F.xxhash64("block"), "block").limit(SAMPLE_BLOCKS).collect()]


def _dictionary(blocks):
    """A trained dictionary; where there is too little text to train one, the text itself."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def _terms(x):
    return np.column_stack((np.ones(len(x)), x, x[:, 0] * x[:, 1], x**2))


def calibrate(x, y, rounds=50, ridge=1e-3):
    """Logistic regression of labels on standardised measures and their products, by Newton steps."""
    centre, width = x.mean(axis=0), x.std(axis=0) + 1e-9
    terms = _terms(np.clip((x - centre) / width, -6, 6))
    beta = np.zeros(terms.shape[1])
    for _ in range(rounds):
        s = sigmoid(terms @ beta)
        grad = terms.T @ (y - s) / len(y) - ridge * beta
        curve = (terms * (s * (1 - s))[:, None]).T @ terms / len(y) + ridge * np.eye(len(beta))
        step = np.linalg.solve(curve, grad)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return centre, width, beta


def apply(x, calibration):
    centre, width, beta = calibration
    return sigmoid(_terms(np.clip((x - centre) / width, -6, 6)) @ beta)


def train(docs, labels, key="doc_id", folds=5, held=0):
    """(dictionaries, calibration); ``labels`` has the key and ``quality``, used outside fold ``held`` alone.

    Labelled rows are dealt by a hash of the key: one half builds the dictionaries, the other
    calibrates. With one label only, or none, every score is that label's share (or a half).
    """
    usable = labels.select(key, "quality").filter((fold(key, folds) != held) & F.col("quality").isin(0, 1)).dropDuplicates([key])
    order = F.xxhash64(F.col(key), F.lit(5))
    half = F.pmod(F.xxhash64(F.col(key), F.lit(3)), F.lit(2))
    counts = {r.quality: r["count"] for r in usable.groupBy("quality").count().collect()}
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    flat = ((b"", b""), (np.zeros(2), np.ones(2), np.array([np.log((share + 1e-3) / (1 - share + 1e-3)), 0, 0, 0, 0, 0])))
    if len(counts) < 2:
        return flat
    texts = docs.filter(F.col(key).isNotNull()).select(key, "text")
    picked = {
        kind: usable.filter((F.col("quality") == kind) & (half == 0)).orderBy(order).limit(MAX_DICTIONARY_ROWS) for kind in (0, 1)
    }
    sides = []
    for kind in (1, 0):
        sides.append(_dictionary(_sampled(texts.join(F.broadcast(picked[kind]), key))))
    checked = usable.filter(half == 1).orderBy(order).limit(MAX_CALIBRATION_ROWS)
    measured = _measured(texts.join(F.broadcast(checked), key), sides, ["quality"]).collect()
    y = np.array([r.quality for r in measured], float)
    if not 0 < y.sum() < len(y):
        return flat
    x = np.array([(r.difference, r.size) for r in measured])
    best = np.lexsort((x[:, 1], x[:, 0], y))
    return tuple(sides), calibrate(x[best], y[best])


def _measured(docs, dictionaries, keep):
    """``keep`` columns, difference and size of every row; needs a column ``text``."""
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)  # twice DICTIONARY_BYTES
    kinds = dict(docs.dtypes)

    def run(batches):
        compressors = _compressors(held.value)
        for rows, buffer, offsets in chunks(batches):
            x = measure(buffer, offsets, compressors)
            columns = {f"k{i}": rows.column(i) for i in range(len(keep))}
            yield pa.RecordBatch.from_pydict({**columns, "difference": x[:, 0], "size": x[:, 1]})

    schema = ", ".join(f"k{i} {kinds[c]}" for i, c in enumerate(keep)) + ", difference double, size double"
    out = docs.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), "text").mapInArrow(run, schema)
    return out.withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})


def score(docs, model, key="doc_id", text="text"):
    """key and score (0 to 1) of every row, repeated rows included; a null or empty text scores as size 0."""
    dictionaries, calibration = model
    kind = dict(docs.dtypes)[key]
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches):
        compressors = _compressors(held.value)
        for rows, buffer, offsets in chunks(batches):
            yield pa.RecordBatch.from_pydict({"key": rows.column(0), "score": apply(measure(buffer, offsets, compressors), calibration)})

    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return out.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
