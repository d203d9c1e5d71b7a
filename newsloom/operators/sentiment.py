"""Sentiment of a text column against a lexicon table (token, valence)."""

from pyspark.sql import functions as F

from newsloom.functions.valence import bare, label_of, modified, normalise, raw_tokens, words_with_context


def _known(lexicon):
    """token and mean valence; "" stands for a row, which counts the copies of a row."""
    words = lexicon.filter(F.col("token").isNotNull() & F.col("valence").isNotNull() & (F.col("token") != ""))
    words = words.groupBy("token").agg(F.avg("valence").alias("valence"))
    mark = lexicon.sparkSession.range(1).select(F.lit("").alias("token"), F.lit(0.0).alias("valence"))
    return words, words.unionByName(mark)


def _totals(df, key, of, text, lexicon, modifiers, kept=None):
    """_key, _of, _total, _copies (and ``kept`` of one of the rows) by key and digest, from the tokens alone."""
    words, known = _known(lexicon)
    if modifiers is None:
        # tokens become rows before they are trimmed, which Spark then compiles; null stands for the mark. The outer
        # form spares a test for empty arrays, which there are none of and which would split each text once more
        raw = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(raw_tokens(text), F.array().cast("array<string>")))
        rows = df.select(key.alias("_key"), of.alias("_of"), *([kept.alias("_row")] if kept is not None else []), F.explode_outer(raw).alias("_raw"))
        mine = [F.when(F.col("_raw").isNull(), F.col("_row")).alias("_row")] if kept is not None else []
        tokens = rows.filter("_raw IS NULL OR _raw <> ''").select("_key", "_of", *mine, F.coalesce(bare(F.col("_raw")), F.lit("")).alias("token"))
    else:
        tokens = _context_tokens(df, key, of, text, modifiers, kept)
    value = F.col("valence")
    if modifiers:
        # At most as many rows as there are modifying words.
        both = words.filter(F.col("token").isin([*modifiers.negations, *modifiers.boosters]))
        value = modified(value, modifiers, both.agg(F.collect_set("token")).scalar())
    copies = F.sum(F.when(F.col("token") == "", 1))
    first = [F.first("_row", ignorenulls=True).alias("_row")] if kept is not None else []
    return tokens.join(known, "token").groupBy("_key", "_of").agg((F.sum(value) / copies).alias("_total"), copies.alias("_copies"), *first)


def _context_tokens(df, key, of, text, modifiers, kept):
    """_key, _of, (_row,) token and the modifying words before it; each row's mark first."""
    found = words_with_context(text, modifiers)
    backs = [F.lit(None).cast("string").alias(f"back{i + 1}") for i in range(len(modifiers.decay))] if modifiers else []
    blank = F.struct(F.lit("").alias("token"), *backs)
    tokens = F.concat(F.array(blank), F.coalesce(found, F.array().cast(f"array<struct<token:string{''.join(f',back{i + 1}:string' for i in range(len(backs)))}>>")))
    # only the mark carries what is kept
    rows = df.select(key.alias("_key"), of.alias("_of"), *([kept.alias("_row")] if kept is not None else []), F.explode_outer(tokens).alias("_t"))
    mine = [F.when(F.col("_t.token") == "", F.col("_row")).alias("_row")] if kept is not None else []
    return rows.select("_key", "_of", *mine, "_t.*")


def _score():
    return F.coalesce(normalise(F.col("_total")), F.lit(0.0)).alias("sentiment_score")


def sentiment_scores(df, text_col, lexicon, key="link", keep=(), modifiers=None):
    """``key``, the narrow columns ``keep`` and ``sentiment_score`` of every row, from one read of the texts.

    The scores are those of ``score_sentiment``; ``keep`` travels with one mark a row instead of being joined
    back. Rows that agree in all of them come as often as they are there.
    """
    of = F.xxhash64(text_col, *keep)
    kept = F.struct(F.lit(True).alias("_is"), *(F.col(c) for c in keep))
    totals = _totals(df, F.col(key), of, F.col(text_col), lexicon, modifiers, kept)
    rows = totals.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return rows.select(F.col("_key").alias(key), *(F.col(f"_row.{c}").alias(c) for c in keep), _score())


def score_sentiment(df, text_col, lexicon, key="link", modifiers=None):
    """Add ``sentiment_score``, by one join of the tokens with a lexicon of any size.

    Tokens carry only the key and a digest of the text, so rows that share a key are scored each
    by its own text. The sum is reduced before its shuffle; Spark broadcasts the lexicon where its
    size allows, and a hot token skews the token side alone, which adaptive execution splits.
    A lexicon token listed several times counts with its mean valence; null tokens or valences are
    not scored. A null or empty text gives 0.0. All columns are joined back, which reads ``df`` again;
    ``sentiment_scores`` does without where few are asked for.
    """
    df = df.withColumn("_digest", F.xxhash64(text_col))
    totals = _totals(df, F.col(key), F.col("_digest"), F.col(text_col), lexicon, modifiers)
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_digest").eqNullSafe(F.col("_of"))
    return df.join(totals, same, "left").select("*", _score()).drop("_key", "_of", "_digest", "_total", "_copies")


def add_sentiment_label(df, text_col, lexicon, **options):
    """Add ``sentiment_score`` and ``sentiment`` (positive, neutral or negative)."""
    scored = score_sentiment(df, text_col, lexicon, **options)
    return scored.withColumn("sentiment", label_of(F.col("sentiment_score")))


def sentiment_labels(df, text_col, lexicon, **options):
    """``sentiment_scores`` with ``sentiment``."""
    return sentiment_scores(df, text_col, lexicon, **options).withColumn("sentiment", label_of(F.col("sentiment_score")))
