import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import graph_reports as reports
from newsloom.operators.graph import (
    build_graph,
    load_graph,
    load_graph_buckets,
    merge_graphs,
    run_parameterised,
    save_graph,
    save_graph_buckets,
    upsert_graph,
)

SCHEMA = (
    "title string, summary string, publish_time_ts timestamp, section string, sub_section string, "
    "location string, predicted_label string"
)


def article(title="T", summary="s", time="2024-01-09 10:00:00", section="S", sub="SS", place="P", label="positive"):
    when = dt.datetime.fromisoformat(time) if time else None
    return (title, summary, when, section, sub, place, label)


def graph_of(spark, rows):
    return build_graph(spark.createDataFrame(rows, SCHEMA))


def test_null_keys_are_rejected(spark):
    bad = [article(**{name: None}) for name in ("title", "time", "section", "sub", "place", "label")]
    graph = graph_of(spark, [article(), *bad])
    assert graph.rejects.count() == 6 and graph.news.count() == 1
    assert {r.null_keys for r in graph.rejects.collect()} >= {"title", "location"}


def test_one_title_is_one_node_and_fans_out(spark):
    graph = graph_of(spark, [
        article(summary="old", place="P1", label="positive"),
        article(summary="new", time="2024-01-10 10:00:00", place="P2", label="negative"),
    ])
    assert graph.news.collect()[0].summary == "new"
    rows = reports.location_sentiment_counts(graph).collect()
    assert {(r.location, r.sentiment, r.total_count) for r in rows} == {
        (p, s, 1) for p in ("P1", "P2") for s in ("positive", "negative")}


def test_section_counts_repeat_for_shared_sub_sections(spark):
    graph = graph_of(spark, [article("A", section="S1"), article("B", section="S2")])
    rows = reports.category_by_section(graph).collect()
    assert {(r.section, r["count"]) for r in rows} == {("S1", 2), ("S2", 2)}


def test_unpadded_days_sort_as_text(spark):
    graph = graph_of(spark, [article("one"), article("two", time="2024-01-10 10:00:00")])
    assert reports.word_trend_by_ymd(graph).first().publish_date == "2024-1-9"
    assert reports.word_trend_by_date(graph).first().publish_date == "2024-01-10"


def test_period_matrix_of_nothing_is_zero(spark):
    rows = reports.time_period_matrix(graph_of(spark, [article(place=None)])).collect()
    assert [tuple(r) for r in rows] == [(p, 0, 0, 0) for p in ("Morning", "Afternoon", "Night")]


@pytest.mark.parametrize("block_size", [1, 3, 1000])
def test_pairs_equal_brute_force_for_any_block_size(spark, block_size):
    rng = random.Random(7)
    rows = [
        article(f"t{i}", place="hot" if rng.random() < 0.6 else f"p{rng.randrange(4)}",
                time=f"2024-01-0{rng.randrange(1, 3)} 10:00:00")
        for i in range(60)
    ]
    pairs = reports.same_place_same_day(graph_of(spark, rows), block_size=block_size)
    got = sorted((r.news1, r.news2, r.location, r.publish_day) for r in pairs.collect())
    want = sorted(
        (min(a[0], b[0]), max(a[0], b[0]), a[5], a[2].day)
        for a, b in itertools.combinations(rows, 2)
        if a[5] == b[5] and a[2].date() == b[2].date() and a[0] != b[0]
    )
    assert got == want
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize(("block_bytes", "part_bytes"), [(8, 2000), (40, 10**6), (10**6, 100)])
def test_pairs_equal_brute_force_for_any_parts(spark, block_bytes, part_bytes):
    rng = random.Random(8)
    rows = [
        article(f"t{i % 50}" * rng.randrange(1, 3), place="hot" if rng.random() < 0.7 else f"p{rng.randrange(4)}",
                time=f"2024-01-0{rng.randrange(1, 4)} 10:00:00")
        for i in range(70)
    ]
    places, days = ({(r[0], r[k]) for r in rows} for k in (5, 2))
    groups = {}
    for (title, place), (other, when) in itertools.product(places, days):
        if title == other:
            groups.setdefault((place, when.day), set()).add(title)
    pairs = reports.same_place_same_day_hour(graph_of(spark, rows), block_bytes=block_bytes, part_bytes=part_bytes)
    want = sorted((a, b, p, 2024, 1, d, 0) for (p, d), titles in groups.items() for a, b in itertools.combinations(sorted(titles), 2))
    assert sorted(map(tuple, pairs.collect())) == want


@pytest.mark.parametrize("report", [reports.same_place_same_day, reports.same_place_same_day_hour])
def test_pairs_are_written_as_numbers_of_titles(spark, tmp_path, report):
    rng = random.Random(9)
    titles = [rng.randbytes(700).hex() for _ in range(900)]
    pairs = report(graph_of(spark, [article(t, place=f"p{i % 3}") for i, t in enumerate(titles)]))
    pairs.write.parquet(str(tmp_path / "pairs"))
    assert spark.read.parquet(str(tmp_path / "pairs")).count() == 3 * 300 * 299 // 2
    # each title a few times in all, where the pairs hold 300 million characters of them
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 4 * sum(map(len, titles))


def test_related_reports(spark):
    graph = graph_of(spark, [article("alpha x"), article("beta y"), article("gamma z", place="Q")])
    related = reports.related_edges(graph)
    assert {tuple(r) for r in related.collect()} == {("alpha x", "beta y"), ("beta y", "alpha x")}
    words = reports.related_title_words(graph, related).collect()
    assert {(r.word, r.related_title) for r in words} == {
        ("alpha", "beta y"), ("x", "beta y"), ("beta", "alpha x"), ("y", "alpha x")}
    assert reports.related_pair_profile(graph, related).count() == 2


def test_merge_save_and_load(spark, tmp_path):
    both = merge_graphs(
        graph_of(spark, [article(summary="old")]),
        graph_of(spark, [article(summary="new", time="2024-02-01 00:00:00"), article("U")]),
    )
    save_graph(both, str(tmp_path / "g"))
    loaded = load_graph(spark, str(tmp_path / "g"))
    assert {(r.title, r.summary) for r in loaded.news.collect()} == {("T", "new"), ("U", "s")}
    assert loaded.published_on.count() == 3
    found = run_parameterised(spark, "SELECT title FROM {news} WHERE summary = :s", {"s": "new"}, news=loaded.news)
    assert [r.title for r in found.collect()] == ["T"]


def test_merge_breaks_ties_as_the_build_does(spark):
    rows = [(*article(summary="zzz"), 1), (*article(summary="aaa"), 2)]
    df = spark.createDataFrame(rows, SCHEMA + ", article_id int")
    parts = [build_graph(df.filter(F.col("article_id") == i), order_by=["article_id"]) for i in (1, 2)]
    assert build_graph(df, order_by=["article_id"]).news.first().summary == "aaa"
    assert merge_graphs(*parts).news.first().summary == merge_graphs(*parts[::-1]).news.first().summary == "aaa"


def test_edges_are_sets(spark):
    graph = graph_of(spark, [article(), article(), article()])
    for name in ("part_of", "belongs_to", "reported_in", "has_category", "published_on"):
        assert getattr(graph, name).count() == 1
    assert graph.news.filter(F.col("title") == "T").count() == 1


def test_upsert_rewrites_only_its_buckets(spark, tmp_path):
    rng = random.Random(8)

    def some(i):
        return article(
            f"title {i}", summary=f"s{rng.randrange(9)}", time=f"2024-01-{rng.randrange(1, 28):02d} 10:00:00", section=f"S{rng.randrange(3)}",
            sub=f"SS{rng.randrange(5)}", place=f"p{rng.randrange(6)}", label=rng.choice(["positive", "negative"]),
        )

    first = [some(i % 300) for i in range(400)] + [article(place=None)]
    later = [some(7), some(7), some(1000), article(title=None), article("title 8", time="2023-01-01 10:00:00", place="old place")]
    path, buckets = str(tmp_path / "graph"), 32
    save_graph_buckets(graph_of(spark, first), path, buckets)
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "graph").rglob("*.parquet") if "_bucket" in str(f)}
    before = files()
    for attempt in ("one", "two"):  # a load that is run again changes nothing but the list of rejects
        touched = upsert_graph(spark, path, graph_of(spark, later), buckets, str(tmp_path / attempt))
        assert len(touched["news"]) <= 3
        stay = {f for f in before if int(f.split("_bucket=")[1].split("/")[0]) not in touched[f.split("/graph/")[1].split("/")[0]]}
        after = files()
        assert all(after.get(f) == before[f] for f in stay) and len(stay) > 0.6 * len(before)
        whole, found = graph_of(spark, first + later), load_graph_buckets(spark, path)
        for name in ("news", "part_of", "belongs_to", "reported_in", "has_category", "published_on"):
            columns = [c for c in getattr(whole, name).columns if c != "_order"]
            one, two = (sorted(map(tuple, getattr(g, name).select(columns).collect()), key=str) for g in (whole, found))
            assert one == two, name
    assert found.rejects.count() == 3


def test_written_load_rows_follow_the_tables(spark, tmp_path):
    import os
    import shutil

    from newsloom.plans.tables import load_rows

    for name in ("documents", "events", "labels", "customer", "nation", "region"):
        source = f"/root/testdata/sf0.001/{name}.parquet"
        copy = shutil.copytree if os.path.isdir(source) else shutil.copy
        copy(source, tmp_path / f"{name}.parquet")
    before = load_rows(spark, str(tmp_path))
    assert before.inputFiles() == load_rows(spark, str(tmp_path)).inputFiles()
    fewer = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(20).collect()
    schema = spark.read.parquet(f"{tmp_path}/documents.parquet").schema
    spark.createDataFrame(fewer, schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert load_rows(spark, str(tmp_path)).count() == 20 < before.count()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_upsert_merges_a_bucket_in_one_exchange(spark):
    from newsloom.operators.graph import _latest

    rows = graph_of(spark, [article("A"), article("B")]).news.withColumn("_bucket", F.lit(1)).localCheckpoint()
    assert exchanges(_latest(rows.repartition("_bucket"), "_bucket")) == 1


def test_related_words_count_digests(spark):
    graph = graph_of(spark, [article("alpha x x"), article("beta y")])
    words = reports.related_title_words(graph, reports.related_edges(graph))
    assert "xxhash64" in words._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.word, r.related_count) for r in words.collect()) == [("alpha", 1), ("beta", 1), ("x", 1), ("y", 1)]


def test_edges_come_without_summaries(spark):
    from newsloom.plans.tables import graph

    tables = graph(spark, "/root/testdata/sf0.001")
    assert "summary" not in spark.read.parquet(*tables.reported_in.inputFiles()).columns
    assert tables.news.filter("summary = ''").count() == 0 < tables.news.count()


def test_topic_is_compressed(spark):
    from newsloom.plans.tables import land_topic

    files = spark.read.text(land_topic(spark, "/root/testdata/sf0.001", "compressed-topic")).inputFiles()
    assert files and all(name.endswith(".snappy") for name in files)
