"""Cleaning, projection and splitting of article tables."""

from pyspark.sql import functions as F

from newsloom.functions.words import letters_only, lower_trim


def remove_duplicates(df):
    """Whole-row duplicates; copies collapse on the map side before the shuffle."""
    return df.dropDuplicates()


def lowercase(df, column):
    return df.withColumn(column, lower_trim(F.col(column)))


def remove_special(df, column):
    return df.withColumn(column, letters_only(F.col(column)))


def clean_text(df, column="summary"):
    """Lower, trim and strip one column, without the duplicate removal (row-wise)."""
    return df.withColumn(column, letters_only(lower_trim(F.col(column))))


def clean_articles(df, column="summary"):
    """The cleaning in front of every feature stage: duplicates out, then the text."""
    return clean_text(remove_duplicates(df), column)


def select_columns(df, columns):
    return df.select(*columns)


def drop_nulls(df, x, y):
    return df.select(x, y).dropna()


def split_bucket(key, buckets=100):
    """Evenly spread bucket of a key, the same on every run, cluster and partitioning."""
    digest = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(buckets))


def with_split(df, key, train_share=0.8):
    """Add ``split``: 'train' or 'test' by the key's bucket."""
    cut = round(train_share * 100)
    return df.withColumn("split", F.when(split_bucket(F.col(key)) < cut, "train").otherwise("test"))


def train_test_split(df, key, train_share=0.8):
    marked = with_split(df, key, train_share)
    return (
        marked.filter(F.col("split") == "train").drop("split"),
        marked.filter(F.col("split") == "test").drop("split"),
    )


def random_split(df, train_share=0.8, seed=42):
    """Spark's own seeded split; its result depends on the input partitioning."""
    return df.randomSplit([train_share, 1 - train_share], seed=seed)


def label_counts(df, column="sentiment"):
    return df.groupBy(column).agg(F.count("*").alias("count"))
