"""The training-text pipeline: toxicity, line dedup, near-duplicate documents, benchmark passages, token ids.

Every stage takes (spark, docs, sf_dir), works on all rows it is given, and all but the last return the
columns of ``documents``. Labels and the benchmark are read from ``sf_dir``.

A null or empty text is kept by all stages and has no ids. Repeated rows are scored alike, keep the same
lines, and leave one row in the near-copy stage if they have words. A row of null key is a document of its own. Columns of any
name come back as they were. Empty tables give no rows; without labels no document is rejected as toxic.
"""

from pyspark.sql import functions as F

from newsloom.llm import bpe, decontaminate, jaccard, lines, toxicity
from newsloom.llm.work import shared_folder


def drop_toxic(spark, docs, sf_dir):
    """Documents that score below the threshold; the model is learned from these documents and the labels."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject(docs, model)


def drop_lines(spark, docs, sf_dir):
    """Documents with repeated and nearly repeated lines taken out, ``n_chars`` counted anew."""
    return _counted(lines.drop_repeated(docs).select(docs.columns))


def drop_near_copies(spark, docs, sf_dir):
    """One document of each class of near-copies."""
    return jaccard.keep_one(docs)


def drop_passages(spark, docs, sf_dir):
    """Documents with benchmark passages cut out of their texts, ``n_chars`` counted anew."""
    benchmark = decontaminate.load_benchmark(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _counted(decontaminate.remove(docs, benchmark))


def encode(spark, docs, sf_dir):
    """doc_id, n_tokens, and the digests of the ids and of the bytes they decode to."""
    encoded = bpe.encode(docs, decoded=True)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _counted(docs):
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_passages),
    ("byte-level BPE encoding and decoding", encode),
]

#: A learned score and an edit-distance join over all lines are beyond SQL; ``tests/llm/test_queries.py`` holds the stages to brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = shared_folder(spark, f"stage-{i + 1}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
