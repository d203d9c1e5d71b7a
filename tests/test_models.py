"""Training, evaluation, saving and scoring on a small set whose labels the words give away."""

import json
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from newsloom.operators import bayes, features, models, sparse, trees
from newsloom.operators.clean import clean_text, random_split
from newsloom.plans import model_queries
from newsloom.sources.articles import parse_messages, read_topic_stream
from newsloom.sources.sinks import land_json
from newsloom.streaming.articles import score_stream
from newsloom.streaming.sinks import run_bounded, write_memory

WORDS = {"positive": "good happy win", "negative": "bad sad loss", "neutral": "desk chair table"}
GRIDS = {"naive_bayes": 2, "logistic_regression": 4, "linear_svm": 2, "random_forest": 8, "decision_tree": 4}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"{label}-{i}", f"The {words} item{i % 3}!", label) for label, words in WORDS.items() for i in range(40)]
    df = spark.createDataFrame(data, "link string, summary string, sentiment string").coalesce(1)  # many short jobs
    return clean_text(df).persist()


@pytest.fixture(scope="module")
def fitted_features(rows):
    return features.fit_features(rows, "summary", "sentiment", 64)


def unseen(spark):
    texts = [("a", "good happy win"), ("b", "bad sad loss"), ("c", "desk chair table"), ("d", "nothing known"), ("e", "")]
    return spark.createDataFrame(texts, "link string, summary string")


def test_feature_pipeline(rows, fitted_features):
    assert features.labels_of(fitted_features) == ["negative", "neutral", "positive"]  # equal counts: by name
    out = fitted_features.transform(rows).filter("link = 'positive-0'").first()
    assert out.filtered_words == ["good", "happy", "win", "item"] and out.indexedLabel == 2.0
    assert out.raw_features.toArray().sum() == 4


@pytest.mark.parametrize("name", sorted(GRIDS))
def test_trainer(spark, rows, fitted_features, name):
    with models.SentimentTrainer(fitted_features.transform(rows)) as trainer:
        fitted = getattr(trainer, name)()
        assert trainer.train.count() + trainer.test.count() == 120
        own, theirs = trainer.evaluate(fitted).first(), trainer.evaluate_with_spark(fitted)
    grid = models.grid_results(fitted)
    assert len(grid) == GRIDS[name] and len({str(setting) for setting, _ in grid}) == GRIDS[name]
    assert max(accuracy for _, accuracy in grid) == 1.0
    assert list(own) == pytest.approx([theirs[metric] for metric in models.METRICS]) == [1.0] * 4
    got = {r.link: r.predicted_label for r in models.batch_score(unseen(spark), fitted_features, fitted.bestModel).collect()}
    assert (got["a"], got["b"], got["c"]) == ("positive", "negative", "neutral") and len(got) == 5


def test_save_load_and_stream(spark, rows, fitted_features, tmp_path):
    with models.SentimentTrainer(fitted_features.transform(rows)) as trainer:
        fitted = trainer.naive_bayes()
    features.save_features(fitted_features, str(tmp_path / "features"))
    models.save_model(fitted, str(tmp_path / "model"))
    loaded = features.load_features(str(tmp_path / "features")), models.load_best_model(str(tmp_path / "model"))

    def labels(df):
        return sorted((r.link, r.prediction, r.predicted_label) for r in df.select("link", "prediction", "predicted_label").collect())

    want = labels(models.batch_score(unseen(spark), fitted_features, fitted.bestModel))
    assert labels(models.batch_score(unseen(spark), *loaded)) == want
    land_json(unseen(spark), str(tmp_path / "in"))
    stream = parse_messages(read_topic_stream(spark, "text", path=str(tmp_path / "in"))).select("link", "summary")
    run_bounded(write_memory(score_stream(stream, *loaded), "scored_stream", available_now=True), 120)
    assert labels(spark.table("scored_stream")) == want


def test_bounded_training_rows(rows, fitted_features):
    both = fitted_features.transform(rows)
    with models.SentimentTrainer(both) as whole, models.SentimentTrainer(both, max_train_rows=30) as bounded:
        assert bounded.train.count() == 30 and bounded.train.exceptAll(whole.train).count() == 0
        assert bounded.test.count() == whole.test.count()


def test_metrics_of_wrong_predictions(spark):
    pairs = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 1.0), (2.0, 0.0)]
    scored = spark.createDataFrame(pairs, "label double, prediction double")
    own = models.classification_metrics(scored).first()
    evaluator = models.MulticlassClassificationEvaluator()
    theirs = [evaluator.setMetricName(metric).evaluate(scored) for metric in models.METRICS]
    assert list(own) == pytest.approx(theirs)
    assert own.accuracy == 0.5


def test_single_stages_equal_the_pipeline(rows, fitted_features):
    words = features.remove_stop_words(features.tokenize(rows, "summary", "words"), "words", "filtered_words")
    counted = features.idf(features.hashing_tf(words, "filtered_words", "raw_features"), "raw_features", "features")
    one = counted.filter("link = 'neutral-1'").first()
    assert sorted(one.raw_features.values) == [1.0] * 4 and len(one.features.values) == 4


def test_random_split_keeps_all_rows(rows):
    train, test = random_split(rows)
    assert train.count() + test.count() == 120 and train.intersect(test).count() == 0


@pytest.fixture(scope="module")
def noisy(spark):
    """Sparse and dense vectors, negative values, a slot of many values, an empty vector; labels only partly told."""
    rng, rows = random.Random(3), []
    for i in range(500):
        label, values = rng.randrange(3), {}
        for slot in range(12):
            if rng.random() < 0.5:
                values[slot] = float(rng.choice([1, 2, 3, 5]) + (label if slot % 3 == 0 and rng.random() < 0.6 else 0))
        if 5 in values:
            values[5] -= 4
        if 7 in values:
            values[7] += rng.random()
        values = {k: v for k, v in values.items() if v} if i else {}
        vector = Vectors.sparse(12, values) if i % 2 == 0 else Vectors.dense([values.get(k, 0.0) for k in range(12)])
        rows.append((f"k{i}", float(label), vector))
    df = spark.createDataFrame(rows, ["link", "indexedLabel", "features"]).repartition(3)
    return df.withColumns({"_fold": F.pmod(F.xxhash64("link"), F.lit(3)).cast("int"), "_row": F.xxhash64("link")}).persist()


def tree_rows(df):
    return sparse.entry_rows(df, "features", F.col("indexedLabel").cast("int").alias("label"), F.col("_fold").alias("fold"), F.col("_row").alias("digest"))


def guessed(model, df):
    return sorted((r.link, r.prediction) for r in model.transform(df).select("link", "prediction").collect())


@pytest.mark.parametrize("depth, bins", [(3, 8), (5, 16)])
def test_tree_equals_sparks(noisy, depth, bins):
    theirs = DecisionTreeClassifier(labelCol="indexedLabel", maxDepth=depth, maxBins=bins).fit(noisy)
    rows = tree_rows(noisy)
    own = trees.grow(rows, 12, trees.find_bins(rows, 12, [bins]), depth)[0, -1]
    assert guessed(trees.Forest(own, depth), noisy) == guessed(theirs, noisy)
    assert f"(feature {own[0].slot[1]} <= {own[0].point[1]}" in theirs.toDebugString


def test_trees_of_folds_are_those_of_the_other_rows(noisy, monkeypatch):
    monkeypatch.setattr(trees, "HELD", 50)  # histograms are added up and sent in many parts
    rows = tree_rows(noisy)
    bins = trees.find_bins(rows, 12, [8, 16])
    both = trees.grow(rows, 12, bins, 4, folds=3)
    for fold in range(3):
        alone = trees.grow(rows.filter(F.col("fold") != fold), 12, bins[1:], 4)[0, -1][0]
        assert alone.to_list() == both[1, fold][0].to_list()
    found = trees.cross_validate(noisy, "features", "indexedLabel", "_fold", 3, 12, [2, 4], [8, 16])
    wanted = {}
    for k, b in enumerate((8, 16)):
        for depth in (2, 4):
            right = []
            for fold in range(3):
                part = noisy.filter(F.col("_fold") == fold)
                guesses = trees.Forest(both[k, fold], depth).transform(part)
                right.append(guesses.filter("prediction = indexedLabel").count() / part.count())
            wanted[depth, b] = np.mean(right)
    assert {(s["maxDepth"], s["maxBins"]): a for s, a in found.grid} == pytest.approx(wanted)


def test_forest_samples_rows_and_slots_and_is_kept(spark, noisy, tmp_path):
    found = trees.cross_validate(noisy, "features", "indexedLabel", "_fold", 3, 12, [3], [16], [5, 10])
    again = trees.cross_validate(noisy.repartition(7), "features", "indexedLabel", "_fold", 3, 12, [3], [16], [5, 10])
    assert found.grid == again.grid  # the same samples whatever the partitions
    # other random draws than Spark's, so not its trees, but as good as they are on left-out folds
    model = RandomForestClassifier(labelCol="indexedLabel", maxDepth=3, maxBins=16)
    grid = ParamGridBuilder().addGrid(model.numTrees, [5, 10]).build()
    judge = models.MulticlassClassificationEvaluator(labelCol="indexedLabel", metricName="accuracy")
    theirs = []
    for seed in range(3):
        search = CrossValidator(estimator=model.copy({model.seed: seed}), estimatorParamMaps=grid, evaluator=judge, numFolds=3, foldCol="_fold")
        theirs.append(search.fit(noisy).avgMetrics)
    assert [accuracy for _, accuracy in found.grid] == pytest.approx(np.mean(theirs, axis=0), abs=0.08)
    roots = {tree.slot[1] for tree in found.bestModel.trees}
    assert len(roots) > 1
    found.bestModel.save(spark, str(tmp_path / "forest"))
    loaded = trees.Forest.load(spark, str(tmp_path / "forest"))
    assert guessed(loaded, noisy) == guessed(found.bestModel, noisy)
    drawn = trees.bootstrap(np.arange(20_000), 3, 42)
    assert abs(drawn.mean() - 1) < 0.03 and abs(drawn.var() - 1) < 0.06


def test_thresholds():
    assert trees.thresholds_of([4.0, 1.0], [2, 3], 10, 8).tolist() == [0.5, 2.5]  # five rows lie at zero
    assert trees.thresholds_of([2.0], [10], 10, 8).tolist() == []
    many = trees.thresholds_of(np.arange(1.0, 101.0), np.ones(100), 100, 4).tolist()
    assert many == [25.5, 50.5, 75.5]
    assert trees.thresholds_of([-1.0, 1.0], [1, 1], 3, 8).tolist() == [-0.5, 0.5]


def test_trees_without_rows_or_with_one_label(noisy):
    rows = tree_rows(noisy).filter("label = 1")
    lone = trees.grow(rows, 12, trees.find_bins(rows, 12, [8]), 3)[0, -1][0]
    assert lone.slot[1] == -1 and lone.counts[1].tolist() == [0, rows.count()]
    none = rows.filter("label > 5")
    assert trees.grow(none, 12, trees.find_bins(none, 12, [8]), 3)[0, -1][0].counts.sum() == 0


def test_naive_bayes_equals_sparks(noisy):
    counts = noisy.filter("link <> 'k0'").withColumn("features", F.col("features"))
    keep = [r.link for r in noisy.collect() if min(r.features.toArray()) >= 0]  # the model takes no negative values
    rows = counts.filter(F.col("link").isin(keep)).persist()
    model = NaiveBayes(labelCol="indexedLabel")
    grid = ParamGridBuilder().addGrid(model.smoothing, models.SMOOTHINGS).build()
    judge = models.MulticlassClassificationEvaluator(labelCol="indexedLabel", metricName="accuracy")
    theirs = CrossValidator(estimator=model, estimatorParamMaps=grid, evaluator=judge, numFolds=3, foldCol="_fold").fit(rows)
    own, accuracies = bayes.cross_validate(rows, "features", "indexedLabel", "_fold", 3, 12, models.SMOOTHINGS)
    assert accuracies == pytest.approx(theirs.avgMetrics, abs=1e-12)
    assert own.pi.toArray() == pytest.approx(theirs.bestModel.pi.toArray())
    assert own.theta.toArray() == pytest.approx(theirs.bestModel.theta.toArray())
    assert guessed(own, noisy.filter(F.col("link").isin(keep))) == guessed(theirs.bestModel, noisy.filter(F.col("link").isin(keep)))
    assert own.getSmoothing() == theirs.bestModel.getSmoothing()


def test_naive_bayes_with_stored_zeros_and_unknown_slots_equals_sparks(spark, rows, fitted_features):
    # "item" stands in every text, so its weight is a stored zero
    df = fitted_features.transform(rows).withColumn("_fold", F.pmod(F.xxhash64("link"), F.lit(3)).cast("int")).persist()
    model = NaiveBayes(labelCol="indexedLabel")
    grid = ParamGridBuilder().addGrid(model.smoothing, models.SMOOTHINGS).build()
    judge = models.MulticlassClassificationEvaluator(labelCol="indexedLabel", metricName="accuracy")
    theirs = CrossValidator(estimator=model, estimatorParamMaps=grid, evaluator=judge, numFolds=3, foldCol="_fold").fit(df)
    own, accuracies = bayes.cross_validate(df, "features", "indexedLabel", "_fold", 3, 64, models.SMOOTHINGS)
    assert accuracies == pytest.approx(theirs.avgMetrics, abs=1e-12) and accuracies[0] < accuracies[1]
    assert own.getSmoothing() == theirs.bestModel.getSmoothing() == 1.0


def test_naive_bayes_never_guesses_a_label_without_rows():
    pi, theta = bayes.model_of(np.array([2.0, 0.0, 2.0]), np.array([[3.0, 1.0], [0.0, 0.0], [1.0, 3.0]]), 1.0)
    batch = pa.RecordBatch.from_pydict({"slots": pa.array([[0], [1], []], pa.list_(pa.int32())), "values": pa.array([[2.0], [2.0], []], pa.list_(pa.float64()))})
    assert bayes.guesses(sparse.Entries.of(batch), pi, theta).tolist() == [0, 2, 0]


def test_training_queries_learn(spark):
    """Held-out metrics beat the commonest label, and agree with the grid's shape and split."""
    sf_dir = "/root/testdata/sf0.001"
    labels = model_queries.sentiment_label(spark, sf_dir).collect()
    for name, n in (("train_naive_bayes", 2), ("train_decision_tree", 4)):
        rows = model_queries.QUERIES[name][0](spark, sf_dir).collect()
        assert len({r.params for r in rows}) == len(rows) == n
        assert sum(r.best for r in rows) == 1 and max(rows, key=lambda r: r.mean_accuracy).mean_accuracy == next(r for r in rows if r.best).mean_accuracy
        assert all(r.train_rows + r.test_rows == len(labels) and 0 < r.accuracy <= 1 and 0 <= r.f1 <= 1 for r in rows)
        assert all(isinstance(json.loads(r.params), dict) for r in rows)
    scored = {r.article_id: r.predicted_label for r in model_queries.batch_score(spark, sf_dir).collect()}
    given = {r.article_id: r.sentiment for r in labels}
    assert scored.keys() == given.keys()
    commonest = max(Counter(given.values()).values()) / len(given)
    assert np.mean([scored[k] == given[k] for k in given]) > commonest  # four fifths of these rows were trained on
    back = model_queries.model_roundtrip_predictions(spark, sf_dir).collect()
    assert {r.article_id: r.first_label for r in back} == {r.article_id: r.second_label for r in back} and len(back) == len(given)


def test_label_index_reads_its_own_copy(spark):
    from newsloom.plans import model_queries

    for query in (model_queries.label_index, model_queries.label_decode):
        assert not any("documents.parquet" in name for name in query(spark, "/root/testdata/sf0.001").inputFiles())
    plan = model_queries._labelled_texts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("doc_id#") and len([line for line in plan.splitlines() if "Relation" in line and "n_chars" in line]) == 1


def test_rows_of_least_digest_come_without_a_sort_of_all_rows(spark):
    rng = random.Random(1)
    digests = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(500)]
    df = spark.createDataFrame([(d,) for d in digests], "digest long").repartition(4)
    least, total = trees.least_digests(df, 60)
    assert total == 60 and sorted(r.digest for r in least.collect()) == sorted(digests)[:60]
    plan = least._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Limit" not in plan
    assert trees.least_digests(df, 501)[1] == 500 and trees.least_digests(df, 501)[0].count() == 500
    equal = spark.createDataFrame([(7,)] * 30 + [(d,) for d in range(20, 30)], "digest long")  # a key that repeats
    least, total = trees.least_digests(equal, 10)
    assert total == 10 and [r.digest for r in least.collect()] == [7] * 10


def test_nodes_of_the_same_splits_are_added_up_once(spark, monkeypatch):
    rng, grow_level, numbers = random.Random(5), trees._grow_level, []

    def watched(rows, plan, cells):
        numbers.append((len(plan.models), len(plan.totals)))
        return grow_level(rows, plan, cells)

    monkeypatch.setattr(trees, "_grow_level", watched)
    data = []
    for i in range(300):  # the slots 0 and 1 tell the label; 2 to 5 tell nothing
        label = rng.choice([0, 0, 0, 1, 2])
        values = {0: 1.0} if label == 0 else {1: 2.0} if label == 1 else {}
        data.append((i, float(label), Vectors.sparse(6, values | {rng.randrange(2, 6): 1.0})))
    df = spark.createDataFrame(data, ["link", "indexedLabel", "features"])
    rows = tree_rows(df.withColumns({"_fold": (F.col("link") % 3).cast("int"), "_row": F.xxhash64("link")}))
    grown = trees.grow(rows, 6, trees.find_bins(rows, 6, [8, 16]), 3, folds=3)
    assert numbers == [(8, 1), (8, 1)]  # eight models, one node to add up on each of two levels
    for fold in (-1, 0, 1, 2):
        want = Counter(int(label) for i, label, _ in data if i % 3 != fold)
        assert grown[0, fold][0].counts[1].tolist() == grown[1, fold][0].counts[1].tolist() == [want[k] for k in range(3)]
        leaves = {tuple(c) for k, c in enumerate(grown[0, fold][0].counts.tolist()) if k and sum(c) and grown[0, fold][0].slot[k] < 0}
        assert leaves == {tuple(want[k] if k == j else 0 for k in range(3)) for j in range(3)}


def test_forests_of_folds_are_those_of_the_other_rows(noisy, monkeypatch):
    for name in ("HELD", "ROOM", "BLOCK"):
        monkeypatch.setattr(trees, name, 100)  # many parts and blocks
    rows = tree_rows(noisy)
    bins = trees.find_bins(rows, 12, [4, 16])
    given = {"trees": 3, "subset": 5, "sampled": True}
    both = trees.grow(rows, 12, bins, 3, folds=3, **given)
    for fold in range(3):
        alone = trees.grow(rows.filter(F.col("fold") != fold), 12, bins[:1], 3, **given)[0, -1]
        assert [tree.to_list() for tree in alone] == [tree.to_list() for tree in both[0, fold]]


def test_written_features_equal_the_pipelines(spark, rows, fitted_features, tmp_path):
    model, written = features.fit_written_features(rows, "summary", "sentiment", str(tmp_path / "counts"), 64)
    columns = ["link", "indexedLabel", "raw_features", "features"]
    want = {r.link: r for r in fitted_features.transform(rows).select(columns).collect()}
    assert {r.link: r for r in written.select(columns).collect()} == want
    assert {r.link: r for r in model.transform(rows).select(columns).collect()} == want
    assert all(name.startswith(f"file://{tmp_path}/counts") for name in written.inputFiles())
    assert "summary" not in written.columns  # no text is split again


def test_training_rows_split_texts_once(spark):
    _, rows = model_queries._training_rows(spark, "/root/testdata/sf0.001")
    assert not {"summary", "words", "filtered_words"} & set(rows.columns)
    assert rows.count() == model_queries.sentiment_label(spark, "/root/testdata/sf0.001").count()
