"""Pattern reports over the graph tables.

Three habits keep the joins small: counts are taken per sub-section before the join with
PART_OF; an edge that only multiplies a count is reduced to its number per title; and labels
become columns of one row per title before dates or words fan out.
"""

from pyspark.sql import functions as F

from newsloom.functions.words import SHORT_STOP_WORDS, STOP_WORDS, title_words
from newsloom.schemas import LABELS


def _words(df, stop_words):
    return df.withColumn("word", F.explode(title_words(F.col("title"), stop_words)))


def _unpadded(date, *parts):
    return F.concat_ws("-", *[part(date).cast("string") for part in parts])


def _label_sums(weight, label):
    """One sum per label, and their total."""
    sums = [F.sum(F.when(label == name, weight).otherwise(F.lit(0))).alias(f"{name}_count") for name in LABELS]
    return [*sums, F.sum(F.when(label.isin(*LABELS), weight).otherwise(F.lit(0))).alias("total_count")]


def _label_flags(graph):
    """One row per title: 1 or 0 for each label it has."""
    flags = [F.max((F.col("category") == name).cast("bigint")).alias(name) for name in LABELS]
    return graph.has_category.groupBy("title").agg(*flags)


# Related articles -----------------------------------------------------------------------


def related_edges(graph, exclude_unlocated=False):
    """Default RELATED_TO edges (title, related_title), both directions.

    Nothing in the model creates these edges, so they are an argument of the reports. This
    default ties every article of a place and day to that group's lead article (the first
    title): linear in the articles, where linking all of them to each other would be quadratic.
    """
    members = _place_days(graph, exclude_unlocated)
    leads = members.groupBy("location", "date").agg(F.min("title").alias("lead"))
    spokes = members.join(leads, ["location", "date"]).filter(F.col("title") != F.col("lead"))
    both = F.array(
        F.struct(F.col("title"), F.col("lead").alias("related_title")),
        F.struct(F.col("lead").alias("title"), F.col("title").alias("related_title")),
    )
    return spokes.select(F.inline(both)).distinct()


def related_title_words(graph, related, stop_words=STOP_WORDS, limit=10):
    """The words whose articles have most distinct related titles, one row per related title.

    The lists come as rows, since one list per word would put a common word's titles into one
    value. Distinct titles are counted in two steps, which a hot word survives, by a digest of
    128 bits: whole titles are only exchanged for the first words.
    """
    links = related.filter(F.col("title") != F.col("related_title"))
    words = links.select("related_title", F.explode(F.array_distinct(title_words(F.col("title"), stop_words))).alias("word"))
    digest = F.xxhash64("related_title").alias("a"), F.xxhash64(F.lit(1), "related_title").alias("b")
    counts = words.select("word", *digest).distinct().groupBy("word").agg(F.count("*").alias("related_count"))
    top = counts.orderBy(F.desc("related_count"), "word").limit(limit)
    # At most ``limit`` rows, so this side is always small enough to broadcast.
    return words.join(F.broadcast(top), "word").select("word", "related_count", "related_title").distinct()


def related_pair_profile(graph, related, sep="|"):
    """Related pairs with the dates, categories, places and sub-sections of both sides.

    A pair stands for every combination of its eight lists. They are kept as lists because a
    title that many articles share has tens of thousands of combinations on its own side, and
    the pairs of two such titles would multiply to billions of rows that say nothing more.
    """

    def listed(edges, column):
        values = F.sort_array(F.collect_set(F.col(column).cast("string")))
        return edges.groupBy("title").agg(F.concat_ws(sep, values).alias(column))

    profile = (
        listed(graph.published_on, "date")
        .join(listed(graph.has_category, "category"), "title")
        .join(listed(graph.reported_in, "location"), "title")
        .join(listed(graph.belongs_to, "sub_section"), "title")
    )

    def side(number):
        return profile.select(
            F.col("title").alias(f"news{number}"),
            F.col("date").alias(f"publish_dates{number}"),
            F.col("category").alias(f"categories{number}"),
            F.col("location").alias(f"locations{number}"),
            F.col("sub_section").alias(f"sub_sections{number}"),
        )

    links = related.filter(F.col("title") != F.col("related_title")).select(
        F.col("title").alias("news1"), F.col("related_title").alias("news2")
    )
    newest = F.substring_index("publish_dates1", sep, -1)
    return links.join(side(1), "news1").join(side(2), "news2").orderBy(newest.desc(), "news1", "news2")


# Titles and profiles --------------------------------------------------------------------


def news_with_date(graph, limit=10):
    dated = graph.news.join(graph.published_on, "title").select(
        F.col("title").alias("news_title"), F.col("summary").alias("news_summary"), F.col("date").alias("publish_date")
    )
    return dated.orderBy(F.desc("publish_date"), "news_title").limit(limit)


def top_title_words(graph, stop_words=SHORT_STOP_WORDS, limit=10):
    counts = _words(graph.news.select("title"), stop_words).groupBy("word").agg(F.count("*").alias("article_count"))
    return counts.orderBy(F.desc("article_count"), "word").limit(limit)


def article_profile(graph):
    """Every combination of a title's date, sub-section, section, location and category.

    Sections join the narrow BELONGS_TO edges, so the wide combinations only meet by title.
    """
    return (
        graph.news.join(graph.published_on, "title")
        .join(graph.reported_in, "title")
        .join(graph.has_category, "title")
        .join(graph.belongs_to.join(graph.part_of, "sub_section"), "title")
        .select(
            F.col("title").alias("news_title"),
            F.col("summary").alias("news_summary"),
            F.col("date").cast("string").alias("publish_date"),
            F.col("sub_section").alias("subsection_name"),
            F.col("section").alias("section_name"),
            F.col("location").alias("location_name"),
            F.col("category").alias("category_name"),
        )
    )


# Words over time and place --------------------------------------------------------------


def _word_trend(dated, stop_words, limit):
    words = _words(dated, stop_words).groupBy("word", "publish_date").agg(F.count("*").alias("total_articles"))
    return words.orderBy(F.desc("publish_date"), F.desc("total_articles"), "word").limit(limit)


def word_trend_by_date(graph, stop_words=STOP_WORDS, limit=10):
    """Word counts per date of the PUBLISHED_ON edges, newest date first."""
    dated = graph.published_on.select("title", F.col("date").cast("string").alias("publish_date"))
    return _word_trend(dated, stop_words, limit)


def word_trend_by_ymd(graph, stop_words=STOP_WORDS, limit=10):
    """The same by the node's own time, written y-m-d without padding and sorted as text."""
    ymd = _unpadded(F.col("publish_time"), F.year, F.month, F.dayofmonth)
    return _word_trend(graph.news.select("title", ymd.alias("publish_date")), stop_words, limit)


def word_sentiment_by_date(graph, stop_words=STOP_WORDS, limit=10):
    dated = graph.published_on.join(_label_flags(graph), "title")
    sums = [F.sum(name).alias(f"{name}_count") for name in LABELS]
    total = F.sum(F.col(LABELS[0]) + F.col(LABELS[1]) + F.col(LABELS[2])).alias("total_count")
    counts = (
        _words(dated, stop_words)
        .groupBy("word", F.col("date").cast("string").alias("formatted_publish_date"))
        .agg(*sums, total)
    )
    return counts.orderBy(F.desc("total_count"), "word", "formatted_publish_date").limit(limit)


def location_sentiment_words(graph, stop_words=STOP_WORDS, keyword=None, limit=20):
    """Word counts per location and label; with ``keyword`` only words that contain it.

    Words are lowered, the keyword is not.
    """
    words = title_words(F.col("title"), stop_words)
    if keyword is not None:
        words = F.filter(words, lambda word: word.contains(keyword))
    counts = (
        graph.reported_in.join(graph.has_category, "title")
        .withColumn("word", F.explode(words))
        .groupBy("location", F.col("category").alias("sentiment"), "word")
        .agg(F.count("*").alias("total_count"))
    )
    return counts.orderBy(F.desc("total_count"), "location", "sentiment", "word").limit(limit)


def keyword_by_location(graph, keyword, stop_words=STOP_WORDS, limit=20):
    return location_sentiment_words(graph, stop_words, keyword, limit)


# Time of day ----------------------------------------------------------------------------


def _period_counts(graph):
    """Title x label x date combinations per time of day and label.

    The hour is the node's; the dates only count, so each title carries their number.
    """
    hour = F.hour("publish_time")
    period = (
        F.when((hour >= 6) & (hour < 12), "Morning").when((hour >= 12) & (hour < 18), "Afternoon").otherwise("Night")
    )
    dates = graph.published_on.groupBy("title").agg(F.count("*").alias("dates"))
    return (
        graph.news.select("title", period.alias("time_period"))
        .join(dates, "title")
        .join(graph.has_category, "title")
    )


def time_period_sentiment(graph, by_count=True):
    """Counts per time of day and label, by falling count or by label within each period."""
    counts = (
        _period_counts(graph)
        .groupBy("time_period", F.col("category").alias("sentiment"))
        .agg(F.sum("dates").alias("total_articles"))
    )
    order = [F.desc("total_articles"), "sentiment"] if by_count else ["sentiment"]
    return counts.orderBy("time_period", *order)


def time_period_matrix(graph):
    """Three periods by three labels, zeros included."""
    periods = ("Morning", "Afternoon", "Night")
    cells = {
        (period, label): F.coalesce(
            F.sum(F.when((F.col("time_period") == period) & (F.col("category") == label), F.col("dates"))), F.lit(0)
        ).alias(f"{period}_{label}")
        for period in periods
        for label in LABELS
    }
    rows = [
        F.struct(F.lit(period).alias("time_period"), *[F.col(f"{period}_{label}").alias(label) for label in LABELS])
        for period in periods
    ]
    return _period_counts(graph).agg(*cells.values()).select(F.inline(F.array(*rows)))


# Sections -------------------------------------------------------------------------------


def _sub_section_categories(graph):
    return (
        graph.belongs_to.join(graph.has_category, "title")
        .groupBy("sub_section", "category")
        .agg(F.count("*").alias("count"))
    )


def _section_categories(graph):
    """Counts per section, sub-section and category; PART_OF only repeats a sub-section's count."""
    return _sub_section_categories(graph).join(graph.part_of, "sub_section").select(
        "section", "sub_section", "category", "count"
    )


def section_month_sentiment(graph, limit=10):
    month = _unpadded(F.col("date"), F.year, F.month).alias("publish_month")
    months = graph.published_on.groupBy("title", month).agg(F.count("*").alias("dates"))
    per_sub_section = (
        months.join(graph.has_category, "title")
        .join(graph.belongs_to, "title")
        .groupBy("sub_section", "publish_month")
        .agg(*_label_sums(F.col("dates"), F.col("category")))
    )
    counts = per_sub_section.join(graph.part_of, "sub_section").select(
        "section", "sub_section", "publish_month", *[f"{name}_count" for name in (*LABELS, "total")]
    )
    return counts.orderBy(F.desc("total_count"), "section", "sub_section", "publish_month").limit(limit)


def category_cooccurrence(graph, min_count=5):
    """Section, sub-section and category combinations with more than ``min_count`` titles."""
    counts = _sub_section_categories(graph).filter(F.col("count") > min_count).join(graph.part_of, "sub_section")
    return counts.select("section", "sub_section", "category", "count").orderBy(
        F.desc("count"), "section", "sub_section", "category"
    )


def category_clusters(graph, min_count=2):
    return category_cooccurrence(graph, min_count)


def category_by_section(graph):
    return _section_categories(graph).orderBy("section", "sub_section", F.desc("count"), "category")


def sub_section_categories(graph):
    return _sub_section_categories(graph).orderBy(F.desc("count"), "sub_section", "category")


def section_category_by_day(graph):
    per_sub_section = (
        graph.published_on.join(graph.has_category, "title")
        .join(graph.belongs_to, "title")
        .groupBy("sub_section", "category", "date")
        .agg(F.count("*").alias("n"))
    )
    text = F.col("date").cast("string")
    counts = (
        per_sub_section.join(graph.part_of, "sub_section")
        .groupBy("section", "category", "date")
        .agg(F.sum("n").alias("article_count"))
        .orderBy(F.desc("date"), "section", "category")
    )
    return counts.select(
        "section",
        "category",
        F.substring(text, 1, 4).alias("publish_year"),
        F.substring(text, 6, 2).alias("publish_month"),
        F.substring(text, 9, 2).alias("publish_day"),
        "article_count",
    )


# Places ---------------------------------------------------------------------------------


def _location_categories(graph):
    return (
        graph.reported_in.join(graph.has_category, "title")
        .groupBy("location", "category")
        .agg(F.count("*").alias("count"))
    )


def location_sentiment_counts(graph, limit=20):
    counts = _location_categories(graph).withColumnsRenamed({"category": "sentiment", "count": "total_count"})
    return counts.orderBy(F.desc("total_count"), "location", "sentiment").limit(limit)


def top_location_categories(graph, limit=10):
    counts = _location_categories(graph).withColumnRenamed("count", "article_count")
    return counts.orderBy(F.desc("article_count"), "location", "category").limit(limit)


def news_per_location(graph):
    counts = graph.reported_in.groupBy("location").agg(F.count("*").alias("news_count"))
    return counts.orderBy(F.desc("news_count"), "location")


def news_per_sub_section(graph):
    counts = graph.belongs_to.groupBy("sub_section").agg(F.count("*").alias("article_count"))
    return counts.orderBy(F.desc("article_count"), "sub_section")


def _place_days(graph, exclude_unlocated):
    located = graph.reported_in
    if exclude_unlocated:
        located = located.filter(~F.col("location").isin("", "Location not found"))
    return located.join(graph.published_on, "title").select("location", "date", "title")


def same_place_same_day(graph, exclude_unlocated=False, block_size=2000, block_bytes=300_000, part_bytes=400_000):
    """Pairs of titles from one place on one day, each once, the lesser title first.

    The answer itself is the pairs, so its rows are quadratic in a group; nothing beyond it is
    computed. A group larger than ``block_size`` titles or ``block_bytes`` is cut into blocks by
    title hash; a cell is what one block's titles have before another's, in order. Cells are dealt
    by range to parts of about ``part_bytes`` of titles: so few that a column's dictionary holds
    them (Parquet's is 1 MB), and a pair is written as two short numbers instead of two titles.
    """
    group = ["location", "date"]
    members = _place_days(graph, exclude_unlocated)
    sizes = members.groupBy(group).agg(
        F.count("*").alias("n"), F.sum(F.octet_length("title") + 4).alias("bytes")
    ).select(
        *group, "bytes",
        F.greatest(F.ceil(F.col("n") / block_size), F.ceil(F.col("bytes") / block_bytes)).cast("int").alias("blocks"),
    )
    # one number: the bytes of titles on the first side of all cells
    dealt = sizes.agg(F.sum(F.col("bytes") * F.col("blocks"))).first()[0] or 0
    parts = int(dealt // part_bytes) + 1
    placed = members.join(sizes.drop("bytes"), group).withColumn(
        "block", F.pmod(F.xxhash64("title"), F.col("blocks")).cast("int")
    )
    # Any two blocks meet twice, once each way; a block meets itself once, from one copy of its titles.
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    firsts = F.transform(others, lambda k: F.struct(F.col("block").alias("low"), k.alias("high"), F.lit(True).alias("first")))
    seconds = F.transform(
        F.filter(others, lambda k: k != F.col("block")),
        lambda k: F.struct(k.alias("low"), F.col("block").alias("high"), F.lit(False).alias("first")),
    )
    cell = [*group, "low", "high"]
    cells = (
        placed.select(*group, "title", F.inline(F.concat(firsts, seconds)))
        .repartitionByRange(parts, *cell)
        .groupBy(cell)
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("first"), F.col("title")))).alias("firsts"),
            F.sort_array(F.collect_list(F.when(~F.col("first") | (F.col("low") == F.col("high")), F.col("title")))).alias("seconds"),
        )
    )
    pairs = cells.withColumn("news1", F.explode("firsts")).withColumn("news2", F.explode("seconds")).filter("news1 < news2")
    return pairs.select(
        "news1",
        "news2",
        "location",
        F.year("date").alias("publish_year"),
        F.month("date").alias("publish_month"),
        F.dayofmonth("date").alias("publish_day"),
    )


def same_place_same_day_hour(graph, **options):
    """The same with the hour of the date, which is always midnight."""
    pairs = same_place_same_day(graph, **options)
    day = F.make_date("publish_year", "publish_month", "publish_day")
    return pairs.withColumn("publish_hour", F.hour(day.cast("timestamp_ntz")))
