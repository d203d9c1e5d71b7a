"""Toxicity by non-negative positive-unlabelled learning, in numpy.

The positives P are confirmed toxic texts; the unlabelled U are texts whose labels are not looked at.
With the class prior p, the risk of the negative class is estimated as R_U - p R_P, and kept from
falling below zero: where it does, the step climbs out instead of following it down. The model is
linear in the presence of hashed byte 5-grams, of which those are used that tell P from U most.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.llm.texts import chunks
from newsloom.llm.vectors import SLOTS, gram_slots, row_sums, selected, sigmoid

THRESHOLD = 0.3  # texts scored so or higher count as toxic
MAX_POSITIVE = 4_000  # bounds of the training sample: rows of least key hash
MAX_UNLABELLED = 12_000
FEATURES = 4_096
LEAST_WORTH = 4.0  # standard errors by which a feature's shares in P and U must differ
SEED_PRIOR = 0.1  # where no label tells the share of toxic texts


def fold(key="doc_id", folds=4):
    """The fold of a key: crc32 of the key as text, modulo ``folds``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def _sample(docs, labels, key, folds, held):
    """Training rows (key, text, positive), the prior, all from folds other than ``held``.

    U is drawn from all rows of the folds, labelled or not, so that it has the corpus' own mixture.
    """
    trained = labels.filter((fold(key, folds) != held) & F.col("toxic").isNotNull())
    n, toxic = trained.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("long"))).first()
    prior = min(0.9, max(0.001, (toxic or 0) / n)) if n else SEED_PRIOR
    order = F.xxhash64(F.col(key), F.lit(7))
    positives = trained.filter("toxic = 1").select(key).distinct().orderBy(order).limit(MAX_POSITIVE)
    own = docs.select(key, "text").filter(F.col(key).isNotNull() & (fold(key, folds) != held))
    # at most MAX_POSITIVE keys on the small side
    marked = own.join(F.broadcast(positives), key).withColumn("positive", F.lit(1))
    total = own.select(key).count()
    share = MAX_UNLABELLED / max(total, 1)
    drawn = own.filter(F.pmod(F.xxhash64(F.col(key), F.lit(11)), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30)))
    return marked.unionByName(drawn.withColumn("positive", F.lit(0))), prior


def _select(sample):
    """The slots that tell positives from unlabelled texts best, counted on the executors."""

    def count(batches):
        found = np.zeros((2, SLOTS), np.int32)
        for rows, buffer, offsets in chunks(batches):
            slots, owner = gram_slots(buffer, offsets)
            pairs = np.unique(owner * SLOTS + slots)
            kind = np.array(rows.column(1))
            for k in (0, 1):
                found[k] += np.bincount(pairs[kind[pairs // SLOTS] == k] % SLOTS, minlength=SLOTS).astype(np.int32)
        used = np.flatnonzero(found.any(axis=0))
        yield pa.RecordBatch.from_pydict({"slot": used, "u": found[0][used].astype(np.int64), "p": found[1][used].astype(np.int64)})

    counts = sample.select("text", "positive").mapInArrow(count, "slot long, u long, p long")
    return counts.groupBy("slot").agg(F.sum("u").alias("u"), F.sum("p").alias("p"))


def train(docs, labels, key="doc_id", folds=4, held=2, steps=200, rate=0.1, decay=3e-4):
    """(slots, weights, bias) of the model; ``labels`` has the key and ``toxic``.

    Without a confirmed toxic text no slot is chosen and every score is the prior.
    """
    labels = labels.select(key, "toxic")
    sample, prior = _sample(docs, labels, key, folds, held)
    counts = _select(sample)
    n_u, n_p = sample.agg(F.sum(1 - F.col("positive")), F.sum("positive")).first()
    bias = float(np.log(prior / (1 - prior)))
    if not n_p or not n_u:
        return np.zeros(0, np.int64), np.zeros(0), bias
    rate_p, rate_u = (F.col("p") + 0.5) / (n_p + 1), (F.col("u") + 0.5) / (n_u + 1)
    worth = F.abs(rate_p - rate_u) / F.sqrt((rate_p + rate_u) / 2 * (1 - (rate_p + rate_u) / 2) * (1 / n_p + 1 / n_u))
    best = counts.filter(worth >= LEAST_WORTH).orderBy(worth.desc(), "slot").limit(FEATURES).collect()
    slots = np.array(sorted(r.slot for r in best), np.int64)
    place = np.full(SLOTS, -1, np.int16)
    place[slots] = np.arange(len(slots))

    def features(batches):
        for rows, buffer, offsets in chunks(batches):
            found, firsts = selected(buffer, offsets, place)
            found = found.astype("<i2")
            yield pa.RecordBatch.from_pydict(
                {"positive": rows.column(1), "found": [found[a:b].tobytes() for a, b in zip(firsts, firsts[1:], strict=False)]}
            )

    rows = sample.select("text", "positive").mapInArrow(features, "positive int, found binary").collect()  # at most MAX_POSITIVE + about MAX_UNLABELLED
    rows.sort(key=lambda r: (r.positive, r.found))
    found = [np.frombuffer(r.found, "<i2") for r in rows]
    weights, bias = fit(found, np.array([r.positive for r in rows]), len(slots), prior, bias, steps, rate, decay)
    return slots, weights, bias


def fit(found, positive, width, prior, bias, steps=200, rate=0.1, decay=3e-4):
    """Weights and bias by Adam on the non-negative risk with logistic loss; ``found``: features of each row."""
    sizes = np.array([len(x) for x in found])
    flat = np.concatenate([*found, np.zeros(0, np.int16)]).astype(np.int64)
    owner = np.repeat(np.arange(len(found)), sizes)
    firsts = np.concatenate(([0], np.cumsum(sizes)))
    p, u = positive == 1, positive == 0
    theta = np.zeros(width + 1)
    theta[-1] = bias
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        score = row_sums(theta[flat], firsts) + theta[-1]
        s = sigmoid(score)
        loss_negative = np.logaddexp(0, score)
        negative = loss_negative[u].mean() - prior * loss_negative[p].mean()
        slope = np.zeros(len(score))  # of the risk by each score
        slope[u] = s[u] / u.sum()
        slope[p] = -prior * s[p] / p.sum()
        if negative < 0:
            slope = -slope
        else:
            slope[p] += prior * (s[p] - 1) / p.sum()
        grad = np.append(np.bincount(flat, slope[owner], width), slope.sum()) + decay * np.append(theta[:-1], 0)
        mean = 0.9 * mean + 0.1 * grad
        spread = 0.999 * spread + 0.001 * grad**2
        theta -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-10)
    return theta[:-1], float(theta[-1])


def score(docs, model, key="doc_id", text="text"):
    """key and score (0 to 1) of every row; a null or empty text has the score of no features."""
    slots, weights, bias = model
    kind = dict(docs.dtypes)[key]
    held = docs.sparkSession.sparkContext.broadcast((slots, weights))  # at most FEATURES entries

    def run(batches):
        at, weight = held.value
        place = np.full(SLOTS, -1, np.int16)
        place[at] = np.arange(len(at))
        for rows, buffer, offsets in chunks(batches):
            found, firsts = selected(buffer, offsets, place)
            yield pa.RecordBatch.from_pydict({"key": rows.column(0), "score": sigmoid(row_sums(weight[found], firsts) + bias)})

    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return out.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)


def reject(docs, model, key="doc_id", text="text", threshold=THRESHOLD):
    """The rows of ``docs``, all columns, that score below the threshold; scored where they lie."""
    slots, weights, bias = model
    held = docs.sparkSession.sparkContext.broadcast((slots, weights))
    at = docs.columns.index(text)

    def run(batches):
        slots, weight = held.value
        place = np.full(SLOTS, -1, np.int16)
        place[slots] = np.arange(len(slots))
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(at)], ["text"])
            first = 0
            for rows, buffer, offsets in chunks([texts]):
                found, firsts = selected(buffer, offsets, place)
                low = sigmoid(row_sums(weight[found], firsts) + bias) < threshold
                yield batch.slice(first, rows.num_rows).filter(pa.array(low))
                first += rows.num_rows

    return docs.mapInArrow(run, docs.schema)
