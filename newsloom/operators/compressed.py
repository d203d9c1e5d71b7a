"""Reports whose rows are combinations, kept as what they are combined from.

A title of many dates, places and sub-sections stands for the product of them, and a place's day for all
pairs of its titles. The tables here hold the factors and say how many combinations they stand for; rows
are multiplied out only for chosen titles, places, days, or for the first rows of an order.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.functions.words import STOP_WORDS, title_words
from newsloom.operators.clean import split_bucket

BLOCK = 2_000  # titles in a member list
LANES = 8  # longs that hold the words counted together


# Profiles ---------------------------------------------------------------------------------


def profile_factors(graph):
    """news_title, kind, value, within: what each title combines; a section stands within its sub-section."""
    kinds = (
        ("publish_date", graph.published_on.select("title", F.col("date").cast("string").alias("value"))),
        ("location", graph.reported_in.select("title", F.col("location").alias("value"))),
        ("category", graph.has_category.select("title", F.col("category").alias("value"))),
        ("sub_section", graph.belongs_to.select("title", F.col("sub_section").alias("value"))),
    )
    nothing = F.lit(None).cast("string").alias("within")
    plain = [df.select(F.col("title").alias("news_title"), F.lit(kind).alias("kind"), "value", nothing) for kind, df in kinds]
    # sections of a sub-section are those of the whole graph, so they follow from the sub-section's row
    sections = graph.part_of.select(
        F.lit(None).cast("string").alias("news_title"), F.lit("section").alias("kind"), F.col("section").alias("value"), F.col("sub_section").alias("within")
    )
    out = sections
    for df in plain:
        out = out.unionByName(df)
    return out


def profile_counts(graph):
    """One row a title: how many dates, places, labels and (sub-section, section) pairs, and their product.

    Sections are counted per sub-section first, so no pair of title and section is made.
    """
    per = graph.part_of.groupBy("sub_section").agg(F.count("*").alias("n"))
    count = lambda df, name: df.groupBy("title").agg(F.count("*").alias(name))
    sections = graph.belongs_to.join(per, "sub_section").groupBy("title").agg(F.sum("n").alias("n_sections"))
    out = (
        count(graph.published_on, "n_dates")
        .join(count(graph.reported_in, "n_locations"), "title")
        .join(count(graph.has_category, "n_categories"), "title")
        .join(sections, "title")
    )
    product = F.col("n_dates") * F.col("n_locations") * F.col("n_categories") * F.col("n_sections")
    return out.withColumn("n_combinations", product).withColumnRenamed("title", "news_title")


def profiles_of(graph, titles):
    """The rows of ``graph_reports.article_profile`` for the titles of a table with a column ``title``."""
    from newsloom.operators.graph_reports import article_profile

    chosen = titles.select("title").distinct()
    keep = lambda df: df.join(chosen, "title", "left_semi")
    named = {name: keep(getattr(graph, name)) for name in ("news", "belongs_to", "reported_in", "has_category", "published_on")}
    return article_profile(type(graph)(part_of=graph.part_of, rejects=graph.rejects, **named))


def _sides(graph, titles):
    """title, date, category, location, sub_section of the given titles, multiplied out."""
    chosen = lambda df: df.join(titles, "title", "left_semi")
    dated = chosen(graph.published_on).select("title", F.col("date").cast("string").alias("date"))
    return dated.join(chosen(graph.has_category), "title").join(chosen(graph.reported_in), "title").join(chosen(graph.belongs_to), "title")


def related_pair_counts(graph, related):
    """One row a related pair: the rows that it stands for, and the newest date of its first side."""
    count = lambda df: df.groupBy("title").agg(F.count("*").alias("n"))
    tables = (graph.has_category, graph.reported_in, graph.belongs_to)
    each = graph.published_on.groupBy("title").agg(F.count("*").alias("rows"), F.max("date").cast("string").alias("newest"))
    for df in tables:
        each = each.join(count(df), "title").withColumn("rows", F.col("rows") * F.col("n")).drop("n")
    links = related.filter(F.col("title") != F.col("related_title"))
    first = each.select(F.col("title").alias("news1"), F.col("rows").alias("rows1"), F.col("newest").alias("newest1"))
    second = each.select(F.col("title").alias("news2"), F.col("rows").alias("rows2"))
    # as decimals, since two hot titles stand for more rows than a long counts
    product = (F.col("rows1").cast("decimal(19,0)") * F.col("rows2").cast("decimal(19,0)")).alias("n_rows")
    return (
        links.select(F.col("title").alias("news1"), F.col("related_title").alias("news2"))
        .join(first, "news1")
        .join(second, "news2")
        .select("news1", "news2", "newest1", "rows1", "rows2", product)
    )


_SIDE = ("category", "location", "sub_section")


def newest_related_rows(graph, related, limit=100):
    """The first ``limit`` of the related pairs' combinations: newest date of the first side, then all columns.

    Only pairs and dates that can reach the limit are multiplied out, and of each side no more than ``limit``
    rows: each entry (pair, first date) stands for at least one row, so ``limit`` entries are enough, and the
    first rows of a product come from the first rows of its sides.
    """
    dated = graph.published_on.select(F.col("title").alias("news1"), F.col("date").cast("string").alias("publish_date1"))
    links = related.filter(F.col("title") != F.col("related_title")).select(F.col("title").alias("news1"), F.col("related_title").alias("news2"))
    for df in (graph.has_category, graph.reported_in, graph.belongs_to):  # a pair with an empty side has no rows
        links = links.join(df.select(F.col("title").alias("news1")), "news1", "left_semi").join(df.select(F.col("title").alias("news2")), "news2", "left_semi")
    links = links.join(graph.published_on.select(F.col("title").alias("news2")), "news2", "left_semi")
    entries = links.join(dated, "news1").orderBy(F.desc("publish_date1"), "news1", "news2").limit(limit)
    titles = entries.select(F.inline(F.array(F.struct(F.col("news1").alias("title")), F.struct(F.col("news2").alias("title"))))).distinct()
    sides = _sides(graph, F.broadcast(titles))  # at most twice the limit
    order = Window.partitionBy("title", "date").orderBy(*_SIDE)
    left = sides.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit).drop("place")
    order = Window.partitionBy("title").orderBy(F.desc("date"), *_SIDE)
    right = sides.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit).drop("place")
    named = lambda df, side: df.select(
        F.col("title").alias(f"news{side}"), F.col("date").alias(f"publish_date{side}"), *(F.col(c).alias(f"{c}{side}") for c in _SIDE)
    )
    rows = entries.join(named(left, 1), ["news1", "publish_date1"]).join(named(right, 2), "news2")
    columns = [f"{c}{side}" for side in (1, 2) for c in ("news", "publish_date", *_SIDE)]
    first = [F.desc("publish_date1"), "news1", "news2", *(f"{c}1" for c in _SIDE), F.desc("publish_date2"), *(f"{c}2" for c in _SIDE)]
    return rows.select(columns).orderBy(*first).limit(limit)


# Places and days --------------------------------------------------------------------------


def place_days(graph, exclude_unlocated=False):
    """location, date, title of every title that a place reported and a day published."""
    located = graph.reported_in
    if exclude_unlocated:
        located = located.filter(~F.col("location").isin("", "Location not found"))
    return located.join(graph.published_on, "title").select("location", "date", "title")


def place_day_groups(graph, **options):
    """One row a place and day: its titles, and the pairs that they make, by formula."""
    groups = place_days(graph, **options).groupBy("location", "date").agg(F.count("*").alias("n_titles"))
    return groups.withColumn("n_pairs", F.expr("n_titles * (n_titles - 1) div 2"))


def place_day_members(graph, block=BLOCK, **options):
    """The titles of a place and day as sorted lists; a group of more than ``block`` titles has several.

    ``part`` numbers the lists; any two titles of a group's lists are a pair.
    """
    members = place_days(graph, **options)
    parts = members.groupBy("location", "date").agg(F.ceil(F.count("*") / block).alias("parts"))
    placed = members.join(parts, ["location", "date"]).withColumn("part", split_bucket(F.col("title"), F.col("parts")))
    return placed.groupBy("location", "date", "part").agg(F.array_sort(F.collect_list("title")).alias("titles"))


def pairs_per_title(graph, **options):
    """One row a title: its groups, and the pairs that they put it in."""
    members = place_days(graph, **options)
    sizes = members.groupBy("location", "date").agg(F.count("*").alias("n"))
    return (
        members.join(sizes, ["location", "date"])
        .groupBy(F.col("title").alias("news_title"))
        .agg(F.count("*").alias("n_groups"), F.sum(F.col("n") - 1).alias("n_pairs"))
    )


def pairs_of_titles(graph, titles, **options):
    """Pairs of same place and day that hold one of the chosen titles: news, other, location, date.

    Work follows the members of the chosen titles' groups. A pair of two chosen titles comes once for each.
    """
    members = place_days(graph, **options)
    own = members.join(titles.select("title").distinct(), "title", "left_semi")
    others = members.select("location", "date", F.col("title").alias("other"))
    return own.join(others, ["location", "date"]).filter("title <> other").select(F.col("title").alias("news"), "other", "location", "date")


def pairs_of_place(graph, location=None, date=None, **options):
    """``graph_reports.same_place_same_day`` for one place, one day, or both, chosen before any pair is made."""
    from newsloom.operators.graph_reports import same_place_same_day

    places, days = graph.reported_in, graph.published_on
    if location is not None:
        places = places.filter(F.col("location") == location)
    if date is not None:
        days = days.filter(F.col("date") == F.lit(date).cast("date"))
    parts = {name: getattr(graph, name) for name in ("news", "part_of", "belongs_to", "has_category", "rejects")}
    return same_place_same_day(type(graph)(reported_in=places, published_on=days, **parts), **options)


# Words and their neighbourhood ------------------------------------------------------------


def _title_id():
    """A title as two longs, which aggregates hold in place."""
    return F.xxhash64("title").alias("a"), F.xxhash64(F.lit(1), "title").alias("b")


def _held(words):
    """By word, place and day: the word's titles there, their number, and of a single one its id."""
    return words.groupBy("word", "location", "date").agg(F.count("*").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))


def _masks(held, numbered):
    """Per place and day the words of a numbered list that it holds, as bits of ``LANES`` longs."""
    bits = [F.bit_or(F.when(F.col("lane") == i, F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(f"m{i}") for i in range(LANES)]
    return held.join(F.broadcast(numbered), "word").groupBy("location", "date").agg(*bits)  # at most 64 * LANES words


def _numbered(spark, words):
    rows = [(word, k, k // 64, (1 << k % 64) - (1 << 64 if k % 64 == 63 else 0)) for k, word in enumerate(words)]
    return spark.createDataFrame(rows, "word string, k int, lane int, bit long")


def _united(members, masks, *title):
    """Per title the words of all its places and days."""
    return members.join(masks, ["location", "date"]).groupBy(*title).agg(*(F.bit_or(f"m{i}").alias(f"m{i}") for i in range(LANES)))


def _bit_counts(batches):
    """How many rows have each bit, batch by batch."""
    for batch in batches:
        lanes = np.stack([batch.column(i).to_numpy().astype("<i8") for i in range(batch.num_columns)], axis=1)
        bits = np.unpackbits(np.ascontiguousarray(lanes).view(np.uint8), axis=1, bitorder="little")
        yield pa.RecordBatch.from_pydict({"k": np.arange(bits.shape[1], dtype=np.int32), "n": bits.sum(0, dtype=np.int64)})


def _alone(held, members, words):
    """(word, a, b) of titles that alone have the word in every place and day of theirs."""
    own = held.filter("n = 1").join(F.broadcast(words.select("word")), "word").groupBy("word", "a", "b").agg(F.count("*").alias("of"))
    return own.join(members.groupBy("a", "b").agg(F.count("*").alias("of")), ["a", "b", "of"]).select("word", "a", "b")


def neighbour_words(graph, stop_words=STOP_WORDS, limit=10, **options):
    """``graph_reports.related_title_words`` where all titles of a place and day are related, without their pairs.

    A word's related titles are the members of the groups that hold one of its titles, but a title that alone
    has the word in all its groups. They are counted for ``64 * LANES`` words at a time: the words are bits of a
    group, and the groups of a title are united, so a read of the members counts all of them. Words come by the
    sizes of their groups, which bound the count, until no other can be among the first.
    """
    titles = place_days(graph, **options)
    a, b = _title_id()
    members = titles.select("location", "date", a, b).persist()
    words = titles.select("location", "date", a, b, F.explode(F.array_distinct(title_words(F.col("title"), stop_words))).alias("word"))
    spark, kept = members.sparkSession, _held(words).persist()
    try:
        sizes = members.groupBy("location", "date").agg(F.count("*").alias("size"))
        most = F.sum(F.col("size") - F.when(F.col("n") == 1, 1).otherwise(0)).alias("most")
        bounds = kept.join(sizes, ["location", "date"]).groupBy("word").agg(most).filter("most > 0").persist()
        whole = members.join(sizes.filter("size > 1"), ["location", "date"], "left_semi").select("a", "b").distinct().count()
        first, after = [], F.lit(True)
        while True:
            may = after
            if len(first) == limit:
                bar, last = first[-1]
                upper = F.least("most", F.lit(whole))
                may = may & ((upper > -bar) | ((upper == -bar) & (F.col("word") < last)))
            batch = bounds.filter(may).orderBy(F.desc("most"), "word").limit(64 * LANES).collect()
            if not batch:
                break
            numbered = _numbered(spark, [row.word for row in batch])
            united = _united(members, _masks(kept, numbered), "a", "b").select(*(f"m{i}" for i in range(LANES)))
            counts = united.mapInArrow(_bit_counts, "k int, n long").groupBy("k").agg(F.sum("n").alias("n"))
            less = _alone(kept, members, numbered).groupBy("word").agg(F.count("*").alias("less"))
            counts = numbered.join(counts, "k").join(less, "word", "left").select("word", (F.col("n") - F.coalesce("less", F.lit(0))).alias("n"))
            first = sorted(first + [(-row.n, row.word) for row in counts.collect() if row.n > 0])[:limit]
            end = batch[-1]
            after = (F.col("most") < end.most) | ((F.col("most") == end.most) & (F.col("word") > end.word))
            if len(batch) < 64 * LANES:
                break
        bounds.unpersist()
    finally:
        kept.unpersist()
        members.unpersist()
    # at most ``limit`` words from here on, so all rows are of the answer
    parts = None
    for start in range(0, max(len(first), 1), 64 * LANES):
        chosen = first[start : start + 64 * LANES]
        numbered = _numbered(spark, [word for _, word in chosen])
        top = numbered.join(spark.createDataFrame([(word, -n) for n, word in chosen], "word string, related_count long"), "word")
        held = _held(words.join(F.broadcast(numbered.select("word")), "word"))
        united = _united(titles, _masks(held, numbered), "title")
        bit = F.element_at(F.array(*(f"m{i}" for i in range(LANES))), F.col("lane") + 1).bitwiseAND(F.col("bit"))
        rows = united.crossJoin(F.broadcast(top)).filter(bit != 0).select("word", "related_count", F.col("title").alias("related_title"), *_title_id())
        rows = rows.join(_alone(held, titles.select("location", "date", *_title_id()), numbered), ["word", "a", "b"], "left_anti")
        rows = rows.select("word", "related_count", "related_title")
        parts = rows if parts is None else parts.unionByName(rows)
    return parts
