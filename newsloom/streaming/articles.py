"""Operators over article streams. All but the watermark ones are the batch forms too."""

from pyspark.sql import functions as F

from newsloom.operators.models import batch_score


def score_stream(df, feature_model, model):
    return batch_score(df, feature_model, model)


def filter_sub_section(df, name):
    return df.filter(F.lower("sub_section") == name.lower())


def filter_sentiment(df, label):
    return df.filter(F.lower("predicted_label") == label.lower())


def filter_date(df, start, end, column="publish_time"):
    """Both ends inclusive. On a string column this compares strings, which the fixed time
    format makes the same as comparing times; on a timestamp column Spark compares times."""
    return df.filter(F.col(column).between(start, end))


def count_by_location(df):
    return df.groupBy("location").agg(F.count("*").alias("news_count"))


def count_by_section(df):
    return df.groupBy("section").agg(F.count("*").alias("news_count"))


def explode_keywords(df):
    """One row per keyword; rows without keywords fall out."""
    return df.withColumn("keyword", F.explode("keywords"))


def keyword_count(df):
    return explode_keywords(df).groupBy("keyword").agg(F.count("*").alias("keyword_freq"))


def window_counts(
    df, duration="10 minutes", slide="5 minutes", time="publish_time", label="predicted_label", delay="1 hour"
):
    """Counts per label in sliding event-time windows (tumbling where slide equals duration).

    ``time`` must be a TIMESTAMP. State is kept until the watermark passes a window's end.
    """
    return (
        df.withWatermark(time, delay)
        .groupBy(F.window(time, duration, slide), label)
        .agg(F.count("*").alias("count"))
    )


def dedup_stream(df, key="link", time="arrival", delay="1 hour"):
    """Drop repeats of ``key`` that arrive within ``delay``; older state is released.

    ``time`` is when a message arrived, which rises with the batches. Publish times do not: a
    watermark on them would drop first copies of articles that were published earlier.
    """
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def dedup_stream_rows(df):
    """Drop whole-row repeats over the stream's whole life. State grows without bound."""
    return df.dropDuplicates()
