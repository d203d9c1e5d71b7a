"""Factor and group forms against the combinations that they stand for."""

import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from test_graph import article, graph_of

from newsloom.functions.words import STOP_WORDS
from newsloom.operators import compressed
from newsloom.operators import graph_reports as reports


@pytest.fixture(scope="module")
def rows():
    """Titles of one and of several groups, hot titles and places, a title alone in its group, repeats of a word."""
    rng = random.Random(9)
    words = ["rain", "sun", "vote", "bank", "the", "goal"]
    out = []
    for i in range(90):
        title = " ".join(rng.choice(words) for _ in range(rng.randint(1, 3)))
        if rng.random() < 0.7:
            title += f" {i}"
        out.append(
            article(
                title,
                time=f"2024-01-{rng.randrange(1, 6):02d} 10:00:00",
                section=f"S{rng.randrange(3)}",
                sub=f"SS{rng.randrange(4)}",
                place="hot" if rng.random() < 0.4 else f"p{rng.randrange(12)}",
                label=rng.choice(["positive", "negative", "neutral"]),
            )
        )
    return [*out, article("lonely rain", place="nowhere")]


@pytest.fixture(scope="module")
def graph(spark, rows):
    return graph_of(spark, rows)


@pytest.fixture(scope="module")
def related(graph):
    return reports.related_edges(graph).persist()


def test_counts_are_the_profile_rows(graph):
    wanted = {r.news_title: r.n for r in reports.article_profile(graph).groupBy("news_title").agg(F.count("*").alias("n")).collect()}
    assert {r.news_title: r.n_combinations for r in compressed.profile_counts(graph).collect()} == wanted


def test_factors_multiply_to_the_profile(graph):
    values, sections = defaultdict(lambda: defaultdict(list)), defaultdict(list)
    for r in compressed.profile_factors(graph).collect():
        if r.kind == "section":
            assert r.news_title is None
            sections[r.within].append(r.value)
        else:
            values[r.news_title][r.kind].append(r.value)
    made = {
        (title, date, sub, section, place, label)
        for title, kinds in values.items()
        for date, sub, place, label in itertools.product(*(kinds[k] for k in ("publish_date", "sub_section", "location", "category")))
        for section in sections[sub]
    }
    whole = reports.article_profile(graph).collect()
    names = ("news_title", "publish_date", "subsection_name", "section_name", "location_name", "category_name")
    assert made == {tuple(r[n] for n in names) for r in whole} and len(made) == len(whole)


def test_profiles_of_chosen_titles(spark, graph):
    chosen = ["lonely rain", "rain", "sun", "unknown"]
    found = compressed.profiles_of(graph, spark.createDataFrame([(t,) for t in chosen * 2], "title string"))
    wanted = reports.article_profile(graph).filter(F.col("news_title").isin(chosen))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def all_related_rows(graph, related):
    sides = defaultdict(list)
    for r in graph.published_on.join(graph.has_category, "title").join(graph.reported_in, "title").join(graph.belongs_to, "title").collect():
        sides[r.title].append((str(r.date), r.category, r.location, r.sub_section))
    out = []
    for r in related.collect():
        for (d1, *one), (d2, *two) in itertools.product(sides[r.title], sides[r.related_title]):
            out.append((r.title, d1, *one, r.related_title, d2, *two))
    return out


def down(date):
    return tuple(-int(x) for x in date.split("-"))


@pytest.mark.parametrize("limit", [1, 7, 60, 10**6])
def test_newest_related_rows_are_the_first_of_all(graph, related, limit):
    wanted = sorted(all_related_rows(graph, related), key=lambda r: (down(r[1]), r[0], r[5], r[2:5], down(r[6]), r[7:]))
    found = compressed.newest_related_rows(graph, related, limit=limit).collect()
    assert [tuple(r) for r in found] == wanted[:limit]


def test_related_counts_are_the_rows_of_a_pair(graph, related):
    wanted, newest = defaultdict(int), defaultdict(str)
    for r in all_related_rows(graph, related):
        wanted[r[0], r[5]] += 1
        newest[r[0], r[5]] = max(newest[r[0], r[5]], r[1])
    found = compressed.related_pair_counts(graph, related).collect()
    assert {(r.news1, r.news2): int(r.n_rows) for r in found} == wanted
    assert {(r.news1, r.news2): r.newest1 for r in found} == newest


def test_groups_and_titles_count_their_pairs(graph):
    pairs = [(r.news1, r.news2, r.location, r.publish_day) for r in reports.same_place_same_day(graph).collect()]
    assert sum(r.n_pairs for r in compressed.place_day_groups(graph).collect()) == len(pairs)
    wanted = defaultdict(int)
    for one, two, *_ in pairs:
        wanted[one] += 1
        wanted[two] += 1
    found = {r.news_title: r.n_pairs for r in compressed.pairs_per_title(graph).collect()}
    assert {t: n for t, n in found.items() if n} == wanted and found["lonely rain"] == 0


@pytest.mark.parametrize("block", [1, 4, 2000])
def test_member_lists_hold_every_title_once(graph, block):
    lists = compressed.place_day_members(graph, block=block).collect()
    found = sorted((r.location, r.date, t) for r in lists for t in r.titles)
    assert found == sorted(map(tuple, compressed.place_days(graph).collect()))
    assert all(r.titles == sorted(r.titles) for r in lists)


def test_pairs_of_chosen_titles_and_places(spark, graph):
    pairs = [tuple(r) for r in reports.same_place_same_day(graph).collect()]
    chosen = ["lonely rain", "rain", "sun"]
    found = compressed.pairs_of_titles(graph, spark.createDataFrame([(t,) for t in chosen], "title string")).collect()
    wanted = [(a, b, p[2], p[5]) for p in pairs for a, b in ((p[0], p[1]), (p[1], p[0])) if a in chosen]
    assert sorted((r.news, r.other, r.location, r.date.day) for r in found) == sorted(wanted)
    assert sorted(map(tuple, compressed.pairs_of_place(graph, "hot").collect())) == sorted(p for p in pairs if p[2] == "hot")
    assert sorted(map(tuple, compressed.pairs_of_place(graph, date="2024-01-02").collect())) == sorted(p for p in pairs if p[5] == 2)
    assert compressed.pairs_of_place(graph, "no such place").count() == 0


@pytest.mark.parametrize("limit", [1, 3, 10, 1000])
def test_neighbour_words_equal_all_pairs(graph, limit):
    linked = defaultdict(set)
    for r in reports.same_place_same_day(graph).collect():
        linked[r.news1].add(r.news2)
        linked[r.news2].add(r.news1)
    by_word = defaultdict(set)
    for title, others in linked.items():
        for word in title.lower().split(" "):
            if word and word not in STOP_WORDS:
                by_word[word] |= others
    first = sorted(by_word, key=lambda w: (-len(by_word[w]), w))[:limit]
    found = compressed.neighbour_words(graph, limit=limit).collect()
    assert sorted((r.word, r.related_count, r.related_title) for r in found) == sorted((w, len(by_word[w]), t) for w in first for t in by_word[w])


def test_nothing_is_made_of_nothing(spark):
    graph = graph_of(spark, [article(place=None)])
    related = reports.related_edges(graph)
    for found in (
        compressed.profile_factors(graph),
        compressed.profile_counts(graph),
        compressed.related_pair_counts(graph, related),
        compressed.newest_related_rows(graph, related),
        compressed.place_day_groups(graph),
        compressed.place_day_members(graph),
        compressed.pairs_per_title(graph),
        compressed.neighbour_words(graph),
    ):
        assert found.count() == 0


@pytest.mark.parametrize("limit", [1, 5, 100, 1000])
def test_neighbour_words_in_several_rounds(graph, monkeypatch, limit):
    wanted = sorted(map(tuple, compressed.neighbour_words(graph, limit=limit).collect()))
    monkeypatch.setattr(compressed, "LANES", 1)  # 64 words a round, of which there are more
    assert sorted(map(tuple, compressed.neighbour_words(graph, limit=limit).collect())) == wanted
