import json
from collections import Counter

import pytest

from newsloom.plans.tables import LEXICON
from newsloom.schemas import ARTICLE_SCHEMA
from newsloom.sources.articles import load_articles, load_lexicon, parse_messages, read_topic_stream, split_malformed
from newsloom.sources.sinks import append_one
from newsloom.streaming import articles as ops
from newsloom.streaming import results
from newsloom.streaming.sinks import run_bounded, write_console, write_files, write_memory


def messages(folder, *lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.txt").write_text("\n".join(lines) + "\n")


def test_malformed_messages_give_null_rows(spark):
    lines = [json.dumps({"title": "a"}), '{"title": "b', json.dumps({"title": "c", "keywords": "wrong"}), None]
    df = spark.createDataFrame([(line,) for line in lines], "json_data string")
    assert sorted(str(r.title) for r in parse_messages(df).collect()) == ["None", "None", "a", "c"]
    good, bad = split_malformed(df)
    assert good.count() == 2 and bad.count() == 2


def test_memory_console_and_file_sinks(spark, tmp_path):
    messages(tmp_path / "in", json.dumps({"title": "a", "section": "S"}), json.dumps({"title": "b", "section": "S"}))

    def stream():
        return parse_messages(read_topic_stream(spark, "text", path=str(tmp_path / "in")))

    run_bounded(write_memory(ops.count_by_section(stream()), "counts", "complete", available_now=True), 60)
    assert [tuple(r) for r in spark.table("counts").collect()] == [("S", 2)]
    assert run_bounded(write_console(stream().select("title"), available_now=True, num_rows=1), 60)
    run_bounded(write_files(stream().select("title"), str(tmp_path / "out"), available_now=True), 60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    endless = write_memory(stream().select("title"), "endless", trigger_interval="1 second")
    assert run_bounded(endless, 1) is False and not endless.isActive


def test_row_dedup_and_inclusive_dates(spark, tmp_path):
    line = json.dumps({"title": "a", "publish_time": "2025-03-01 00:00:00"})
    late = json.dumps({"title": "b", "publish_time": "2025-04-01 00:00:00"})
    messages(tmp_path / "in", line, line, late)
    stream = parse_messages(read_topic_stream(spark, "text", path=str(tmp_path / "in")))
    kept = ops.filter_date(ops.dedup_stream_rows(stream), "2025-03-01 00:00:00", "2025-04-01 00:00:00")
    run_bounded(write_memory(kept.select("title"), "kept", available_now=True), 60)
    assert sorted(r.title for r in spark.table("kept").collect()) == ["a", "b"]


def test_dedup_keeps_first_copies_in_any_publish_order(spark, tmp_path):
    for link, day in (("a", 20), ("b", 25), ("c", 2), ("a", 20), ("d", 1)):
        messages(tmp_path / "in", json.dumps({"link": link, "publish_time": f"2025-03-{day:02} 00:00:00"}))
    stream = read_topic_stream(spark, "text", path=str(tmp_path / "in"), maxFilesPerTrigger=1)
    kept = ops.dedup_stream(parse_messages(stream, keep=["arrival"])).select("link")
    run_bounded(write_memory(kept, "first_copies", available_now=True), 120)
    assert sorted(r.link for r in spark.table("first_copies").collect()) == ["a", "b", "c", "d"]


def test_files_and_single_records(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"title": "x", "keywords": ["k"]}, {"title": "y"}], indent=4))
    assert load_articles(spark, str(tmp_path / "a.json")).count() == 2
    append_one(spark, {"title": "z"}, str(tmp_path / "one"), ARTICLE_SCHEMA)
    assert spark.read.parquet(str(tmp_path / "one")).first().title == "z"
    (tmp_path / "lex.tsv").write_text("".join(f"{t}\t{v}\t0.5\t[1]\n" for t, v in LEXICON))
    rows = load_lexicon(spark, str(tmp_path / "lex.tsv")).collect()
    assert [tuple(r) for r in rows] == list(LEXICON)


def keyword_stream(spark, folder, **options):
    return ops.keyword_count(parse_messages(read_topic_stream(spark, "text", path=str(folder), **options)))


def counted(df):
    return {r.keyword: r.keyword_freq for r in df.collect()}


def test_changes_follow_the_changed_keys_and_survive_a_cut(spark, tmp_path, monkeypatch):
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    batches = [["a", "b", "a"], ["b"], ["c", None], ["a"], ["d", "b"]]
    wanted, seen = Counter(), []
    add, cut = results.Commits.add, {"at": 3}

    def fails_once(self, batch, whole=None):
        if batch == cut["at"]:
            cut["at"] = None
            raise OSError("the driver is lost after the batch was written")
        add(self, batch, whole)

    monkeypatch.setattr(results.Commits, "add", fails_once)

    def run():
        df = keyword_stream(spark, tmp_path / "in")
        run_bounded(results.write_changes(df, ["keyword"], path, checkpoint, available_now=True, compact=2), 120)
        return df.schema

    for number, words in enumerate(batches):
        messages(tmp_path / "in", json.dumps({"keywords": words}))
        if number == 3:
            before = dict(wanted)
            with pytest.raises(Exception, match="the driver is lost"):
                run()
            schema = keyword_stream(spark, tmp_path / "in").schema
            assert counted(results.read_changes(spark, path, schema, ["keyword"])) == before  # as if it had not begun
        wanted.update(words)
        schema = run()
        assert counted(results.read_changes(spark, path, schema, ["keyword"])) == dict(wanted)
        seen.append(spark.read.schema(schema).parquet(f"{path}/changes/{number}").count())
    assert seen == [len(set(words)) for words in batches]
    assert results.Commits(spark, path).newest() == (4, 3)


def test_a_committed_batch_is_not_written_again(spark, tmp_path):
    path = str(tmp_path / "out")
    messages(tmp_path / "in", json.dumps({"keywords": ["a"]}))
    for attempt in ("one", "two"):  # a lost checkpoint makes the same batch anew
        df = keyword_stream(spark, tmp_path / "in")
        run_bounded(results.write_changes(df, ["keyword"], path, str(tmp_path / attempt), available_now=True), 120)
        assert counted(results.read_changes(spark, path, df.schema, ["keyword"])) == {"a": 1}


def test_latest_keeps_the_finished_result(spark, tmp_path, monkeypatch):
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    messages(tmp_path / "in", json.dumps({"keywords": ["a"]}))
    df = keyword_stream(spark, tmp_path / "in")
    assert results.read_latest(spark, path, df.schema).count() == 0
    run_bounded(results.write_latest(df, path, checkpoint, available_now=True), 120)
    messages(tmp_path / "in", json.dumps({"keywords": ["a", "b"]}))

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(results.Commits, "add", lost)
        with pytest.raises(Exception, match="lost"):
            run_bounded(results.write_latest(keyword_stream(spark, tmp_path / "in"), path, checkpoint, available_now=True), 120)
    assert counted(results.read_latest(spark, path, df.schema)) == {"a": 1}
    run_bounded(results.write_latest(keyword_stream(spark, tmp_path / "in"), path, checkpoint, available_now=True), 120)
    assert counted(results.read_latest(spark, path, df.schema)) == {"a": 2, "b": 1}


def test_fan_out_reads_once_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    lines = [json.dumps({"title": f"t{i}", "location": f"L{i % 2}", "sub_section": "News" if i % 3 else "Sport"}) for i in range(7)]
    for line in lines:
        messages(tmp_path / "in", line)
    kept = []

    def news_of(batch):
        kept.append(batch.is_cached)  # all results come from one copy of the batch
        return ops.filter_sub_section(batch, "news").select("title")

    outputs = (
        results.Output("news", news_of),
        results.Output("places", ops.count_by_location, ("location",)),
    )
    path = str(tmp_path / "out")
    for attempt in ("one", "two"):
        stream = parse_messages(read_topic_stream(spark, "text", path=str(tmp_path / "in"), maxFilesPerTrigger=3))
        query = results.fan_out(stream, outputs, path, str(tmp_path / attempt), available_now=True)
        run_bounded(query, 120)
        assert len(query.recentProgress) >= 3 and kept == [True] * 3  # the repeated batches are not made again
        news = results.read_output(spark, path, outputs[0], spark.createDataFrame([], "title string").schema)
        assert sorted(r.title for r in news.collect()) == ["t1", "t2", "t4", "t5"]
        places = results.read_output(spark, path, outputs[1], spark.createDataFrame([], "location string, news_count long").schema)
        assert sorted(map(tuple, places.collect())) == [("L0", 4), ("L1", 3)]
    assert results.Commits(spark, path).newest() == (2, None)
