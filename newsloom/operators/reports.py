"""Reports over scored articles."""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from newsloom.functions.words import parse_time
from newsloom.schemas import LABELS, TIME_FORMAT


def _located(df, exclude_unlocated):
    """Drop blank locations. Null ones stay (the store's "not equal" keeps them), unless excluded."""
    df = df.filter(~F.col("location").eqNullSafe(F.lit("")))
    if exclude_unlocated:
        df = df.filter(F.coalesce(F.col("location"), F.lit("Location not found")) != "Location not found")
    return df


def _published(df):
    return parse_time(F.col("publish_time"), TIME_FORMAT)


def _label_counts():
    return [F.count_if(F.col("predicted_label") == label).alias(label) for label in LABELS]


def count_location_positive(df, location):
    """Positive articles with ``location`` (a regular expression, any case) in title or summary."""
    pattern = f"(?iu){location}"
    hit = F.col("title").rlike(pattern) | F.col("summary").rlike(pattern)
    return df.filter((F.col("predicted_label") == "positive") & hit).agg(F.count("*").alias("count"))


def recent_by_location_and_label(df, n=5, key="link", exclude_unlocated=False):
    """Newest negative or neutral articles with a location."""
    wanted = _located(df, exclude_unlocated).filter(F.col("predicted_label").isin("negative", "neutral"))
    return wanted.orderBy(F.col("publish_time").desc_nulls_last(), F.col(key)).limit(n)


def empty_keywords_by_sub_section(df):
    empty = df.filter(F.col("keywords").isNotNull() & (F.size("keywords") == 0))
    counts = empty.groupBy("sub_section").agg(F.count("*").alias("empty_keywords_count"))
    return counts.orderBy(F.desc("empty_keywords_count"), "sub_section")


def average_articles_per_day(df, start, end):
    """Mean articles per day with articles, in half-open [start, end); no row for an empty range.

    The bounds also apply to the raw string, so that they reach the scan.
    """
    first, last = F.to_timestamp(F.lit(start), TIME_FORMAT), F.to_timestamp(F.lit(end), TIME_FORMAT)
    in_range = df.filter((F.col("publish_time") >= start) & (F.col("publish_time") < end))
    days = (
        in_range.withColumn("_time", _published(df))
        .filter((F.col("_time") >= first) & (F.col("_time") < last))
        .groupBy(F.to_date("_time").alias("day"))
        .agg(F.count("*").alias("n"))
    )
    mean = days.agg(F.avg("n").alias("average_articles_per_day"))
    return mean.filter(F.col("average_articles_per_day").isNotNull())


def group_by_label_latest(df):
    latest = df.groupBy("predicted_label").agg(
        F.count("*").alias("count"), F.max("publish_time").alias("latest_article")
    )
    return latest.orderBy(F.desc("count"), "predicted_label")


def group_by_label_latest_title(df, key="link"):
    """As above, with the title of the latest article."""
    newest = F.max(F.struct("publish_time", key, "title"))
    latest = df.groupBy("predicted_label").agg(F.count("*").alias("count"), newest.alias("_newest"))
    return latest.select(
        "predicted_label",
        "count",
        F.col("_newest.publish_time").alias("latest_article"),
        F.col("_newest.title").alias("latest_title"),
    ).orderBy(F.desc("count"), "predicted_label")


def top_locations_positive(df, limit=3, exclude_unlocated=False):
    positive = _located(df, exclude_unlocated).filter(F.col("predicted_label") == "positive")
    counts = positive.groupBy("location").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.col("location").asc_nulls_last()).limit(limit)


def search_all_keywords(df, keywords):
    """Articles with every keyword (regular expressions, any case) on one line of the title, or
    on one line of the summary.

    Testing line by line is linear; one look-ahead chain would retry at every character.
    """

    def together(column):
        lines = F.split(F.col(column), "\n")
        tests = [lambda line, word=word: line.rlike(f"(?idu){word}") for word in keywords]
        return F.exists(lines, lambda line: reduce(and_, [test(line) for test in tests]))

    return df.filter(together("title") | together("summary"))


def monthly_sentiment_distribution(df):
    time = _published(df)
    counts = df.groupBy(
        F.year(time).alias("year"), F.month(time).alias("month"), F.col("predicted_label").alias("sentiment")
    ).agg(F.count("*").alias("count"))
    return counts.orderBy("year", "month", F.desc("count"), "sentiment")


def location_sentiment_heatmap(df, exclude_unlocated=False):
    """Per location: total and one column per label."""
    counts = _located(df, exclude_unlocated).groupBy("location").agg(F.count("*").alias("total"), *_label_counts())
    return counts.orderBy(F.desc("total"), F.col("location").asc_nulls_last())


def location_sentiment_heatmap_nested(df, exclude_unlocated=False):
    """Per location: total and an array of {label, count}, labels in order."""
    counts = (
        _located(df, exclude_unlocated)
        .groupBy("location", F.col("predicted_label").alias("label"))
        .agg(F.count("*").alias("count"))
    )
    cells = F.sort_array(F.collect_list(F.struct("label", "count")))
    nested = counts.groupBy("location").agg(F.sum("count").alias("total"), cells.alias("sentiments"))
    return nested.orderBy(F.desc("total"), F.col("location").asc_nulls_last())


def publishing_peak_hours(df):
    counts = df.groupBy(F.hour(_published(df)).alias("hour")).agg(F.count("*").alias("count"))
    return counts.orderBy("hour")


def low_content_quality(df, key="link", min_length=50):
    """Articles with a short summary (in code points) or no keywords; null counts as none."""
    judged = df.select(
        key,
        "title",
        "summary",
        F.length("summary").alias("summary_length"),
        F.coalesce(F.size("keywords") > 0, F.lit(False)).alias("has_keywords"),
    )
    low = judged.filter((F.col("summary_length") < min_length) | ~F.col("has_keywords"))
    return low.orderBy(F.col("summary_length").asc_nulls_first(), key)
