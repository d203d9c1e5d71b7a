import pytest

from newsloom.operators import clean, reports
from newsloom.operators.models import classification_metrics

SCHEMA = (
    "title string, link string, summary string, publish_time string, section string, sub_section string, "
    "keywords array<string>, location string, predicted_label string"
)


def row(link, title="t", summary="s" * 60, time="2025-03-01 00:00:00", keywords=(), place="P", label="positive"):
    return (title, link, summary, time, "S", "SS", None if keywords is None else list(keywords), place, label)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_average_is_half_open_and_skips_empty_days(spark):
    df = frame(spark, [row("1"), row("2"), row("3", time="2025-03-05 00:00:00"), row("4", time="2025-04-01 00:00:00")])
    march = reports.average_articles_per_day(df, "2025-03-01 00:00:00", "2025-04-01 00:00:00")
    assert march.first().average_articles_per_day == 1.5
    assert reports.average_articles_per_day(df, "2020-01-01 00:00:00", "2020-02-01 00:00:00").count() == 0


def test_keywords_null_empty_and_some(spark):
    df = frame(spark, [row("1", keywords=None), row("2"), row("3", keywords=["a"]), row("4", summary=None)])
    assert reports.empty_keywords_by_sub_section(df).first().empty_keywords_count == 2
    low = {r.link: r for r in reports.low_content_quality(df).collect()}
    assert set(low) == {"1", "2", "4"} and low["4"].summary_length is None


def test_null_locations_pass_blank_ones_do_not(spark):
    df = frame(spark, [row("1", place=None), row("2", place=""), row("3", place="Location not found")])
    assert {r.location for r in reports.top_locations_positive(df).collect()} == {None, "Location not found"}
    assert reports.top_locations_positive(df, exclude_unlocated=True).count() == 0
    negative = frame(spark, [row("1", place=None, label="negative"), row("2", place="", label="neutral")])
    assert [r.link for r in reports.recent_by_location_and_label(negative).collect()] == ["1"]


def test_keywords_must_share_a_line(spark):
    df = frame(spark, [
        row("1", title="Communist ideology"), row("2", title="communist\nideology"), row("3", title="x", summary="Ideo COMMUNIST"),
        row("4", title="communist", summary="ideo"),
    ])
    found = reports.search_all_keywords(df, ["communist", "ideo"])
    assert {r.link for r in found.collect()} == {"1", "3"}


def test_heatmap_forms_agree(spark):
    df = frame(spark, [row("1"), row("2", label="negative"), row("3", place="Q"), row("4")])
    flat = {r.location: r.asDict() for r in reports.location_sentiment_heatmap(df).collect()}
    for nested in reports.location_sentiment_heatmap_nested(df).collect():
        assert nested.total == flat[nested.location]["total"] == sum(c["count"] for c in nested.sentiments)
        for cell in nested.sentiments:
            assert flat[nested.location][cell.label] == cell["count"]


def test_top_reports_do_not_sort_everything(spark):
    df = reports.top_locations_positive(frame(spark, [row("1")]))
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_split_is_stable_and_complete(spark):
    df = spark.range(2000)
    train, test = clean.train_test_split(df, "id")
    again, _ = clean.train_test_split(df.repartition(7), "id")
    assert train.count() + test.count() == 2000 and 1500 < train.count() < 1700
    assert train.exceptAll(again).count() == 0


def test_metrics_equal_sparks_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rows = [(0.0, 0.0)] * 5 + [(1.0, 0.0)] * 2 + [(1.0, 1.0)] * 3 + [(2.0, 1.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = classification_metrics(df).first()
    for metric, value in zip(("accuracy", "weightedPrecision", "weightedRecall", "f1"), ours):
        assert value == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(df))
