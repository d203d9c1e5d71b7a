"""Classifier training with cross-validation, evaluation, saving and batch scoring."""

from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes, OneVsRest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import functions as F

from newsloom.operators import bayes, trees
from newsloom.operators.clean import drop_nulls, split_bucket, train_test_split
from newsloom.operators.features import decode_label, labels_of
from newsloom.operators.sparse import vector_size

METRICS = ("accuracy", "weightedPrecision", "weightedRecall", "f1")

# The settings that each model is tried with.
SMOOTHINGS = [0.0, 1.0]
LOGISTIC_REG, LOGISTIC_ELASTIC = [0.0, 0.1], [0.0, 0.5]
SVM_REG = [0.1, 0.01]
TREE_COUNTS, DEPTHS, BINS = [5, 10], [3, 5], [8, 16]


class SentimentTrainer:
    """Splits once, keeps the training rows for the fits, and trains on request.

    Naive Bayes and trees train all folds and settings together (see ``bayes`` and ``trees``); the gradient
    models go through Spark's cross-validation.

    Split and folds come from the key's hash rather than from random numbers per partition:
    a recomputed partition lands in the same split and fold after an executor is lost.
    ``max_train_rows`` bounds the labelled rows that are trained on (those of least key digest);
    None takes all. Held-out rows are never bounded.
    """

    def __init__(
        self, df, x="features", y="indexedLabel", key="link", train_share=0.8, folds=3, parallelism=2, max_train_rows=None
    ):
        self.x, self.y, self.folds, self.parallelism = x, y, folds, parallelism
        train, test = train_test_split(df, key, train_share)
        fold = F.pmod(F.floor(split_bucket(F.col(key), 100 * folds) / 100), F.lit(folds)).cast("int")
        train = train.dropna(subset=[x, y])
        if max_train_rows is not None:
            train = train.orderBy(F.sha2(F.col(key).cast("string"), 256), key).limit(max_train_rows)
        digest = F.xxhash64(F.col(key).cast("string")).alias("_row")
        self.train = train.select(x, y, fold.alias("_fold"), digest).dropna().persist()
        self.test = drop_nulls(test, x, y)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.train.unpersist()

    def naive_bayes(self):
        model = NaiveBayes(labelCol=self.y, featuresCol=self.x)
        search = self._search(model, ParamGridBuilder().addGrid(model.smoothing, SMOOTHINGS).build())
        best, accuracies = bayes.cross_validate(
            self.train, self.x, self.y, "_fold", self.folds, vector_size(self.train, self.x), SMOOTHINGS
        )
        return search._copyValues(CrossValidatorModel(best, accuracies))

    def logistic_regression(self, max_iter=10):
        model = LogisticRegression(labelCol=self.y, featuresCol=self.x, maxIter=max_iter)
        grid = ParamGridBuilder().addGrid(model.regParam, LOGISTIC_REG)
        return self._fit(model, grid.addGrid(model.elasticNetParam, LOGISTIC_ELASTIC).build())

    def linear_svm(self, max_iter=10):
        svm = LinearSVC(labelCol=self.y, featuresCol=self.x, maxIter=max_iter)
        model = OneVsRest(classifier=svm, labelCol=self.y, featuresCol=self.x)
        return self._fit(model, ParamGridBuilder().addGrid(svm.regParam, SVM_REG).build())

    def random_forest(self):
        return self._trees(TREE_COUNTS)

    def decision_tree(self):
        return self._trees([1])

    def _trees(self, tree_counts):
        self.train.count()  # all tasks fill the kept rows; the first row alone would make one of them fill its part
        size = vector_size(self.train, self.x)
        return trees.cross_validate(self.train, self.x, self.y, "_fold", self.folds, size, DEPTHS, BINS, tree_counts)

    def _fit(self, model, grid):
        return self._search(model, grid).fit(self.train)

    def _search(self, model, grid):
        return CrossValidator(
            estimator=model,
            estimatorParamMaps=grid,
            evaluator=self._evaluator("accuracy"),
            numFolds=self.folds,
            foldCol="_fold",
            parallelism=self.parallelism,
        )

    def _evaluator(self, metric):
        return MulticlassClassificationEvaluator(
            labelCol=self.y, predictionCol="prediction", metricName=metric
        )

    def evaluate(self, model):
        """Metrics on the held-out rows, from one scoring pass (see ``classification_metrics``)."""
        return classification_metrics(model.transform(self.test), self.y, "prediction")

    def evaluate_with_spark(self, model):
        """The same four numbers from Spark's own evaluator, by metric name."""
        scored = model.transform(self.test)
        return {metric: self._evaluator(metric).evaluate(scored) for metric in METRICS}


def confusion_matrix(df, label="label", prediction="prediction"):
    return (
        df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
        .agg(F.count("*").alias("n"))
    )


def classification_metrics(df, label="label", prediction="prediction"):
    """One row: accuracy, weighted precision, weighted recall, f1.

    Rows are read once into the confusion matrix (classes squared); all else works on that.
    """
    cells = confusion_matrix(df, label, prediction)
    right = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    as_label = F.struct(
        F.col("label").alias("cls"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("guessed"),
        right.cast("bigint").alias("hit"),
    )
    as_guess = F.struct(
        F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("guessed"),
        F.lit(0).cast("bigint").alias("hit"),
    )
    classes = (
        cells.select(F.inline(F.array(as_label, as_guess)))
        .groupBy("cls")
        .agg(F.sum("actual").alias("actual"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit"))
    )
    precision = F.when(F.col("guessed") > 0, F.col("hit") / F.col("guessed")).otherwise(0.0)
    recall = F.when(F.col("actual") > 0, F.col("hit") / F.col("actual")).otherwise(0.0)
    f1 = F.when(F.col("hit") > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    weight = F.col("actual")
    return classes.agg(
        (F.sum("hit") / F.sum(weight)).alias("accuracy"),
        (F.sum(precision * weight) / F.sum(weight)).alias("weighted_precision"),
        (F.sum(recall * weight) / F.sum(weight)).alias("weighted_recall"),
        (F.sum(f1 * weight) / F.sum(weight)).alias("f1"),
    )


def grid_results(model):
    """Mean accuracy per parameter setting of a fitted cross-validation."""
    if isinstance(model, trees.ForestSearch):
        return model.grid
    return [
        ({param.name: value for param, value in params.items()}, float(score))
        for params, score in zip(model.getEstimatorParamMaps(), model.avgMetrics)
    ]


def save_model(model, path):
    model.write().overwrite().save(path)


def load_best_model(path):
    return CrossValidatorModel.load(path).bestModel


def batch_score(df, feature_model, model):
    """Features, prediction and ``predicted_label`` for cleaned articles, batch or stream."""
    scored = model.transform(feature_model.transform(df))
    return decode_label(scored, labels_of(feature_model))
