"""One query for each operator over its whole table, and its SQL where SQL can say the same."""

from pyspark.sql import functions as F

from newsloom.llm import alignment, bpe, chat, decontaminate, fingerprint, jaccard, lines, near_dup, pii, quality, resample, token_files, toxicity
from newsloom.llm.work import shared_folder


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_encode_decode(spark, sf_dir):
    """doc_id, n_tokens, sha256 of the ids and of the bytes they decode to."""
    encoded = bpe.encode(_read(spark, sf_dir, "documents"), decoded=True)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_quartile_fingerprint(spark, sf_dir):
    """Fingerprint of each text and of its edited form, and how near they and the next text are."""
    return fingerprint.compare_with_next(_read(spark, sf_dir, "documents"))


def _scored(docs, scores, folds, held, threshold):
    return scores.select(
        "doc_id",
        (toxicity.fold("doc_id", folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op3_toxicity_nnpu(spark, sf_dir):
    """Toxicity score of every document, learned outside fold 2 of 4."""
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.train(docs, _read(spark, sf_dir, "labels"))
    return _scored(docs, toxicity.score(docs, model), 4, 2, toxicity.THRESHOLD)


def op4_token_files(spark, sf_dir):
    """Start, length and crc32 of each document's ids, read back from the token files."""
    shards = token_files.write(_read(spark, sf_dir, "documents"), shared_folder(spark, "op4"))
    return token_files.read(shards)


def op5_quality_compression(spark, sf_dir):
    """Quality score of every document, learned outside fold 0 of 5."""
    docs = _read(spark, sf_dir, "documents")
    model = quality.train(docs, _read(spark, sf_dir, "labels"))
    return _scored(docs, quality.score(docs, model), 5, 0, quality.THRESHOLD)


def op6_disclosure_pii(spark, sf_dir):
    """Personal data and the terms that disclose it in every document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs)
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    written = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"] != "term")
    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def op7_jaccard_forest(spark, sf_dir):
    """Class of near-copies and number of links of every document."""
    return jaccard.classes(_read(spark, sf_dir, "documents"))


def op8_line_dedup(spark, sf_dir):
    """Lines kept and dropped in every document, and the sha256 of the text that stays."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_repeated(docs).select("doc_id", "n_lines", "n_same", "n_near", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op9_chat_windows(spark, sf_dir):
    """What reading the formatted windows of every conversation gives back."""
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    markers = "</s>[INST] ok [/INST]"  # the conversation that says control strings
    told = spark.createDataFrame([(-1, 0, "user", markers), (-1, 1, "assistant", markers)], turns.schema)
    back = chat.read_back(chat.windows(turns.unionByName(told)))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_fm_decontamination(spark, sf_dir):
    """Words of benchmark windows in every document, and the items they belong to."""
    benchmark = decontaminate.load_benchmark(_read(spark, sf_dir, "benchmark"))
    found = decontaminate.report(_read(spark, sf_dir, "documents"), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_tokenizer_alignment(spark, sf_dir):
    """How the tokens of two public vocabularies line up in every document."""
    return alignment.align(_read(spark, sf_dir, "documents"))


def op12_minhash_near_dup(spark, sf_dir):
    """Component of near-copies of every document, over sets of word pairs."""
    return near_dup.near_duplicates(_read(spark, sf_dir, "documents"))


def op13_importance_resample(spark, sf_dir):
    """Weight towards the benchmark's words, noisy score and rank in the draw of every document."""
    return resample.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


_OP10_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(w) - 9))) AS k FROM items WHERE len(w) > 0)
),
spans AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS k
        FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
hits AS (SELECT doc_id, k, n, item_id FROM spans JOIN windows USING (n, phrase)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
_OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS g
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(w) - 4))) AS k FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
),
classes AS (SELECT a AS doc_id, min(b) AS class_id, count(*) AS n_class FROM reach GROUP BY a)
SELECT doc_id, class_id, coalesce(n, 0) AS n_links, n_class
FROM classes LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a) USING (doc_id)
"""

_OP12_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 1], ' ') AS g
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(w) - 1))) AS k FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""

_ALL = (
    op1_bpe_encode_decode,
    op2_quartile_fingerprint,
    op3_toxicity_nnpu,
    op4_token_files,
    op5_quality_compression,
    op6_disclosure_pii,
    op7_jaccard_forest,
    op8_line_dedup,
    op9_chat_windows,
    op10_fm_decontamination,
    op11_tokenizer_alignment,
    op12_minhash_near_dup,
    op13_importance_resample,
)
QUERIES = {f.__name__: f for f in _ALL}
SQL = {"op7_jaccard_forest": _OP7_SQL, "op10_fm_decontamination": _OP10_SQL, "op12_minhash_near_dup": _OP12_SQL}
