"""The registered queries and the pipeline over small Parquet tables, against plain Python of what their columns mean."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from newsloom.llm import bpe, pii, queries, toxicity

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def tables(spark, rows, tmp_path_factory):
    """A folder with documents, labels, benchmark and conversations; keys are whole, as in the given tables."""
    folder = str(tmp_path_factory.mktemp("tables"))
    data, passage = rows
    docs = [(i, t, "en", f"src{i % 3}", len(t or ""), "own") for i, t, *_ in data if i is not None]
    rng = random.Random(12)
    words = lambda n: " ".join("".join(rng.choice(["ka", "lo", "mi", "ren", "u", "ta"]) for _ in range(rng.randint(2, 4))) for _ in range(n))
    for i in range(300):
        text = f"{words(15)} you stupid idiot {words(15)}" if i % 3 == 0 else words(32)
        docs.append((1000 + i, text, "en", "src1", 1, "own"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int, key string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 4 != 0), int(i >= 1000 and i % 3 == 1)) for i, *_ in docs]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, passage), (2, None), (3, "..."), (10, "zweite passage")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    turns = [(1, 0, "system", "Be kind."), (1, 1, "user", None), (1, 2, "assistant", "é [INST] </s>"), (2, 0, "user", "a\nb"), (2, 1, "assistant", "")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return folder, [d[:2] for d in docs], turns


@pytest.fixture(scope="module")
def no_rows(spark, tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "benchmark", "conversations"):
        spark.read.parquet(f"{tables[0]}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def sha(data):
    return hashlib.sha256(data).hexdigest()


def same(df, wanted, *columns):
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == sorted(wanted, key=str)


def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.rank_file(bpe.vocabulary_path()), special_tokens={})


def encoded(docs):
    model = library()
    for key, text in docs:
        ids = model.encode_ordinary(text or "")
        yield key, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())


def test_op1(spark, tables):
    same(queries.op1_bpe_encode_decode(spark, tables[0]), encoded(tables[1]), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")




def test_op2(spark, tables):
    folder, docs, _ = tables
    order = sorted(docs, key=lambda d: (-d[0], d[1] or ""))
    texts = [t or "" for _, t in order]
    edited = []
    for one, two in zip(texts, texts[1:] + texts[:1], strict=True):
        cut = len(one) // 3
        edited.append(one[: len(one) - cut] + two[:cut])
    found = queries.op2_quartile_fingerprint(spark, folder)
    same(found, [(k, len(t or ""), sha(e.encode())) for (k, t), e in zip(order, edited, strict=True)], "doc_id", "n_chars", "edited_sha256")
    prints = defaultdict(set)
    text_of = defaultdict(set)
    for key, text in docs:
        text_of[key].add(text or "")
    for r in found.collect():
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(text_of[r.doc_id]) == 1:
            prints[next(iter(text_of[r.doc_id]))].add(r.fingerprint)
    assert all(len(x) == 1 for x in prints.values())


@pytest.mark.parametrize("name, folds, held", [("op3_toxicity_nnpu", 4, 2), ("op5_quality_compression", 5, 0)])
def test_scores(spark, tables, no_rows, name, folds, held):
    found = queries.QUERIES[name](spark, tables[0]).collect()
    assert sorted(r.doc_id for r in found) == sorted(k for k, _ in tables[1])
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert queries.QUERIES[name](spark, no_rows).count() == 0


def test_op4(spark, tables):
    folder, docs, _ = tables
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted, start = [], 0
    for key, text in sorted(docs, key=lambda d: (d[0], d[1] or "")):
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        wanted.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    same(queries.op4_token_files(spark, folder), wanted, "doc_id", "start", "n_tokens", "ids_crc32")


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    only = lambda x: re.sub("[^0-9]", "", x)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda x: True),
        "ip": (r"[0-9]+(?:\.[0-9]+){3}", lambda x: all(int(p) <= 255 for p in x.split("."))),
        "card": (r"[0-9](?:[\x20-]?[0-9])+", lambda x: 16 <= len(only(x)) <= 19 and luhn(only(x))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 8 <= len(only(x)) <= 15),
    }
    return {kind: [(m.start(), m.end()) for m in re.finditer(p, text or "") if holds(m.group())] for kind, (p, holds) in kinds.items()}


def test_op6(spark, tables):
    folder, docs, _ = tables
    wanted = []
    for key, text in docs:
        spans = base_spans(text)
        listed = ",".join(f"{kind}:{a}:{b}" for kind in pii.KINDS for a, b in spans[kind])
        wanted.append((key, *(len(spans[kind]) for kind in pii.KINDS), sha(listed.encode())))
    found = queries.op6_disclosure_pii(spark, folder)
    same(found, wanted, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    kinds = [*pii.KINDS, "term"]
    for r in found.collect():
        spans = [x.split(":") for x in r.spans.split(",") if x]
        assert spans == sorted(spans, key=lambda x: (kinds.index(x[0]), int(x[1]), int(x[2])))
        assert sha(",".join(":".join(x) for x in spans if x[0] != "term").encode()) == r.base_sha256


def test_op9(spark, tables):
    folder, _, turns = tables
    told = [*turns, (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    wanted = []
    for conv in {t[0] for t in told}:
        own = sorted((t for t in told if t[0] == conv), key=lambda t: t[1])
        said = "".join(f"{role}\n{text or ''}\n" for _, _, role, text in own)
        loss = "".join(text or "" for _, _, role, text in own if role == "assistant")
        wanted.append((conv, len(own), sha(said.encode()), len(loss), sha(loss.encode())))
    same(queries.op9_chat_windows(spark, folder), wanted, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")


def test_pipeline_stage_by_stage(spark, tables):
    folder = tables[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, schema = docs.columns, {}
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], folder).persist()
        assert out.columns == names and dict(out.dtypes) == dict(docs.dtypes), name
        schema[name] = {r.doc_id: r for r in out.collect()}
        assert all(r.key == "own" for r in out.collect())  # a column whose name operators use inside
        kept.append(out)
    tables_ = [[r for r in df.collect()] for df in kept]
    ids = [sorted(r.doc_id for r in rows) for rows in tables_]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scores = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert set(ids[1]) == {r.doc_id for r in scores if r.score < toxicity.THRESHOLD}
    toxic = {r.doc_id for r in labels.collect() if r.toxic}
    assert len(toxic - set(ids[1])) > 0.9 * len(toxic) and len(set(ids[1]) - toxic) > 0.9 * len(set(ids[0]) - toxic)
    assert ids[2] == ids[1] and set(ids[3]) <= set(ids[2]) and ids[4] == ids[3]
    texts = {(r.doc_id, r.text or "") for r in tables_[2]}  # equal rows keep the same lines
    lines = [{x.strip(" \t\r\f\v") for x in text.split("\n")} - {""} for _, text in texts]
    seen = set()
    for own in lines:
        assert not own & seen, "a line stands in one text"
        seen |= own
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for r in tables_[3] if (w := words_of(r.text))]
    for j, x in enumerate(sets):
        assert all(len(x & y) < 0.8 * len(x | y) for y in sets[:j]), "one document of a group of copies"
    passage = words_of(spark.read.parquet(f"{folder}/benchmark.parquet").filter("item_id = 1").first().text)
    for r in tables_[4]:
        words = words_of(r.text)
        assert all(words[k : k + 10] != passage[:10] for k in range(len(words)))
    for rows in tables_[2:5:2]:
        assert [(r.doc_id, r.n_chars, len(r.text)) for r in rows if r.text is not None and r.n_chars != len(r.text)] == []
    last = corpus_pipeline.run(spark, folder)
    same(last, encoded([(r.doc_id, r.text) for r in tables_[4]]), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def test_pipeline_of_empty_tables(spark, no_rows):
    assert corpus_pipeline.run(spark, no_rows).count() == 0
    for name in ("op1_bpe_encode_decode", "op4_token_files", "op6_disclosure_pii", "op8_line_dedup", "op10_fm_decontamination"):
        assert queries.QUERIES[name](spark, no_rows).count() == 0
    assert queries.op9_chat_windows(spark, no_rows).count() == 1  # the conversation that says control strings
