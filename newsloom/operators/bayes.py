"""Naive Bayes for all folds and smoothings from one pass of sums.

A multinomial model needs only each label's rows and its sum per slot. These are taken once, by fold; the
model that leaves a fold out has the total less the fold's own sums, and every smoothing starts from the
same sums. A second pass counts right guesses of the left-out folds.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import NaiveBayesModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.sql import functions as F

from newsloom.operators.sparse import Entries, column, entry_rows

_ROWS = -1  # the slot that counts rows


def fold_sums(train, x, y, fold, folds, size):
    """(rows, sums): the rows of each (fold, label), and its sum of every slot.

    The result has folds * labels * size numbers, whatever the rows.
    """

    def run(batches):
        for batch in batches:
            entries = Entries.of(batch)
            label, own = column(batch, y, np.int64), column(batch, fold, np.int64)
            group = np.concatenate(((label * folds + own)[entries.owner], label * folds + own))
            slot = np.concatenate((entries.slot, np.full(len(batch), _ROWS)))
            key, back = np.unique(group * (size + 1) + slot + 1, return_inverse=True)
            n = np.bincount(back, np.concatenate((entries.value, np.ones(len(batch)))), len(key))
            yield pa.RecordBatch.from_pydict({"key": key, "n": n})

    parts = entry_rows(train, x, y, fold).mapInArrow(run, "key long, n double")
    found = parts.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    key, n = found["key"].to_numpy(), found["n"].to_numpy()
    group, slot = key // (size + 1), key % (size + 1) - 1
    labels = int(group.max(initial=-1)) // folds + 1
    rows, sums = np.zeros((folds, labels)), np.zeros((folds, labels, size))
    whole = slot == _ROWS
    rows[group[whole] % folds, group[whole] // folds] = n[whole]
    sums[group[~whole] % folds, group[~whole] // folds, slot[~whole]] = n[~whole]
    return rows, sums


def model_of(rows, sums, smoothing):
    """(pi, theta): log shares of the labels and of the slots within them.

    A label without rows is never guessed.
    """
    labels, size = sums.shape
    with np.errstate(divide="ignore"):
        pi = np.log(rows + smoothing) - np.log(rows.sum() + labels * smoothing)
        theta = np.log(sums + smoothing) - np.log(sums.sum(1, keepdims=True) + size * smoothing)
    pi[rows == 0], theta[rows == 0] = -np.inf, 0.0
    return pi, theta


def guesses(entries, pi, theta):
    """The likeliest label of each row, the least of equals, as Spark's model guesses it.

    Without smoothing a slot that a label lacks excludes the label; a stored zero there makes its score NaN,
    which is never the greatest, but stays where it comes first.
    """
    with np.errstate(invalid="ignore"):
        scores = np.stack([np.bincount(entries.owner, entries.value * theta[k][entries.slot], entries.rows) for k in range(len(pi))], 1) + pi
    odd = np.isnan(scores)
    return np.where(odd[:, 0], 0, np.argmax(np.where(odd, -np.inf, scores), axis=1))


def fold_accuracies(train, x, y, fold, models):
    """Accuracy on each fold of the models that were made without it: ``models[fold][setting]``."""
    sent = train.sparkSession.sparkContext.broadcast(models)  # folds * settings models of a fixed size

    def run(batches):
        models = sent.value
        n, hits = np.zeros(len(models), np.int64), np.zeros((len(models), len(models[0])), np.int64)
        for batch in batches:
            entries = Entries.of(batch, zeros=True)
            label, own = column(batch, y, np.int64), column(batch, fold, np.int64)
            n += np.bincount(own, minlength=len(models))
            for k, settings in enumerate(models):
                inside = own == k
                if inside.any():
                    for j, model in enumerate(settings):
                        hits[k, j] += (guesses(entries, *model) == label)[inside].sum()
        at = np.indices(hits.shape).reshape(2, -1)
        yield pa.RecordBatch.from_pydict({"fold": at[0], "setting": at[1], "hits": hits.ravel(), "n": np.repeat(n, hits.shape[1])})

    parts = entry_rows(train, x, y, fold).mapInArrow(run, "fold long, setting long, hits long, n long")
    out = np.full((len(models), len(models[0])), np.nan)
    for row in parts.groupBy("fold", "setting").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect():
        if row.n:
            out[row.fold, row.setting] = row.hits / row.n
    sent.destroy()
    return out


def spark_model(spark, pi, theta, smoothing, x, y):
    """The numbers as Spark's own model, which scores in the JVM and is saved and loaded as usual."""
    sc = spark.sparkContext
    parts = [Vectors.dense(pi), Matrices.dense(*theta.shape, theta.ravel(order="F")), Matrices.dense(0, 0, [])]
    of_class = sc._jvm.org.apache.spark.ml.classification.NaiveBayesModel
    model = NaiveBayesModel(of_class(f"NaiveBayes_{uuid.uuid4().hex[:12]}", *(_py2java(sc, part) for part in parts)))
    return model._set(smoothing=smoothing, featuresCol=x, labelCol=y, modelType="multinomial")


def cross_validate(train, x, y, fold, folds, size, smoothings):
    """(model of the best smoothing over all rows, mean accuracy of each smoothing), in two reads of the rows."""
    rows, sums = fold_sums(train, x, y, fold, folds, size)
    total_rows, total = rows.sum(0), sums.sum(0)
    models = [[model_of(total_rows - rows[k], total - sums[k], s) for s in smoothings] for k in range(folds)]
    accuracies = np.nanmean(fold_accuracies(train, x, y, fold, models), axis=0)
    best = smoothings[int(np.argmax(accuracies))]
    return spark_model(train.sparkSession, *model_of(total_rows, total, best), best, x, y), accuracies.tolist()
