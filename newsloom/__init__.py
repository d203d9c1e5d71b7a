"""News-article analytics on Spark: DataFrame in, DataFrame out."""
