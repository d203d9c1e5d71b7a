"""Tokens, term weights, label indexes and the five-stage feature pipeline."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, IDF, IndexToString, StopWordsRemover, StringIndexer, Tokenizer
from pyspark.sql import functions as F


def encode_label(df, input_col, output_col):
    return StringIndexer(inputCol=input_col, outputCol=output_col).fit(df).transform(df)


def decode_label(df, labels, input_col="prediction", output_col="predicted_label"):
    return IndexToString(inputCol=input_col, outputCol=output_col, labels=list(labels)).transform(df)


def tokenize(df, input_col, output_col):
    return Tokenizer(inputCol=input_col, outputCol=output_col).transform(df)


def remove_stop_words(df, input_col, output_col):
    return StopWordsRemover(inputCol=input_col, outputCol=output_col).transform(df)


def hashing_tf(df, input_col, output_col):
    return HashingTF(inputCol=input_col, outputCol=output_col).transform(df)


def idf(df, input_col, output_col):
    return IDF(inputCol=input_col, outputCol=output_col).fit(df).transform(df)


def _counting_stages(x, num_features):
    """From texts to hashed term counts; nothing to fit."""
    return [
        Tokenizer(inputCol=x, outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered_words"),
        HashingTF(inputCol="filtered_words", outputCol="raw_features", numFeatures=num_features),
    ]


def fit_features(df, x, y, num_features=1 << 18):
    """Fit label index, tokens, stop words, hashed term counts and IDF as one pipeline."""
    label, idf = StringIndexer(inputCol=y, outputCol="indexedLabel"), IDF(inputCol="raw_features", outputCol="features")
    return Pipeline(stages=[label, *_counting_stages(x, num_features), idf]).fit(df)


def fit_written_features(df, x, y, path, num_features=1 << 18):
    """The model of ``fit_features`` and the rows it gives, without texts and words.

    Texts are split and counted once, into a copy at ``path``; the label index, the IDF and the features come from that.
    """
    counting = _counting_stages(x, num_features)
    PipelineModel(counting).transform(df).drop(x, "words", "filtered_words").write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    label = StringIndexer(inputCol=y, outputCol="indexedLabel").fit(rows)
    weights = IDF(inputCol="raw_features", outputCol="features").fit(rows)
    return PipelineModel([label, *counting, weights]), weights.transform(label.transform(rows))


def labels_of(feature_model):
    """Label names by index, from the first stage."""
    return feature_model.stages[0].labels


def save_features(model, path):
    model.write().overwrite().save(path)


def load_features(path):
    return PipelineModel.load(path)


def term_frequency(df, key, words_col):
    """(key, term, tf): the relational form of the hashed counts, without collisions."""
    return (
        df.select(key, F.explode(words_col).alias("term"))
        .groupBy(key, "term")
        .agg(F.count("*").alias("tf"))
    )


def tfidf(df, key, words_col):
    """(key, term, tf, df, tfidf) with weight tf * ln((N + 1) / (df + 1)), from one read of the rows.

    Each row brings a null term along, whose frequencies add up to N. Terms per row, documents per term and
    N all come from the same exchange of (key, term), which Spark makes once. The join on ``term`` is
    skewed towards common words only on the (key, term) side; the document counts hold one row per term.
    """
    nothing = F.array(F.lit(None).cast("string"))
    tf = (
        df.select(key, F.explode(F.concat(nothing, F.coalesce(F.col(words_col), F.array().cast("array<string>")))).alias("term"))
        .groupBy(key, "term")
        .agg(F.count("*").alias("tf"))
    )
    counts = tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("_all"))
    total = counts.filter("term IS NULL").agg(F.coalesce(F.max("_all"), F.lit(0)).alias("n")).scalar()
    weight = F.col("tf") * F.log((total + F.lit(1)) / (F.col("df") + F.lit(1)))
    # the sum is of use here too: without it the two sides would no longer share their exchange
    found = counts.filter("_all > 0").select("term", "df")
    return tf.join(found, "term").select(key, "term", "tf", "df", weight.alias("tfidf"))
