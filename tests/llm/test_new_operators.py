"""Alignment, near-dedup and resampling against brute force, on awkward rows, ties and empty tables."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from newsloom.llm import alignment, crc, near_dup, queries, resample, token_files, work

SCHEMA = "doc_id long, text string, key string, size int, node long, row long, part int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOOSE = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def same_rows(found, wanted):
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


@pytest.fixture(scope="module")
def texts():
    """Null, empty, blank, long, repeated and near texts; repeated and null keys; words longer than a CRC table."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))
    base = [word() for _ in range(120)]
    out = [None, "", " \t\n", "x", "X", "x y", "x\x0by", "▁x", "a<|endoftext|>b </s> <0x41>\n\t é日本語😀\x00", " " * 40 + "a" * 300 + "=" * 77]
    out += ["w" * 100 + "\n" + "w" * 100 + " b", "one\n\ntwo\nThree", " ".join(base), " ".join(base), " ".join(word() for _ in range(4000))]
    for _ in range(90):
        changed = list(base)
        for _ in range(rng.randint(0, 12)):
            changed[rng.randrange(len(base))] = word()
        out.append(rng.choice([" ", "\n"]).join(changed))
    rows = [(i, t, "k", 3, 4, 5, 6) for i, t in enumerate(out)]
    return [*rows, (None, out[13], "k", 3, 4, 5, 6), (13, out[13], "k", 3, 4, 5, 6), (13, "x y", "k", 3, 4, 5, 6)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_crcs_of_spans_and_of_joined_spans():
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 90, 400)
    ends = np.cumsum(sizes)
    starts, buffer = ends - sizes, rng.integers(0, 256, int(ends[-1])).astype(np.uint8)
    spans = [buffer[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    found = crc.span_crcs(buffer, starts, ends)
    assert found.tolist() == [zlib.crc32(x) for x in spans]
    left = np.arange(399)
    assert crc.joined_crcs(buffer, left, found, starts, ends).tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(spans, spans[1:])]


def test_alignment_equals_brute_force(docs, none, texts):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    symbols = token_files.byte_symbols()
    a_bytes = {i: bytes(symbols[c] for c in s) for s, i in a_model.get_vocab(with_added_tokens=False).items() if set(s) <= set(symbols)}
    b_bytes = [
        bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(b_model.vocab_size())
    ]
    aligned, held = [], Counter()
    for key, text, *_ in texts:
        groups, left, right = [], [], []
        if text:
            a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
            if b"".join(b_bytes[x] for x in b) == (" " + text).encode():
                end_a = np.cumsum([len(a_bytes[x]) for x in a]).tolist()
                end_b = np.cumsum([len(b_bytes[x]) for x in b]).tolist()
                for kind, ids, ends in ((left, a, end_a), (right, b, end_b)):
                    kind.extend(zip(ids, ends, strict=True))
                low = 0
                for cut in sorted(set(end_a) & set(end_b)):
                    groups.append([[x for x, end in side if low < end <= cut] for side in (left, right)])
                    low = cut
        aligned.append((key, len(left), len(right), groups))
        held.update({(x, y) for u, v in groups for x in u for y in v})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    wanted = []
    for key, n_a, n_b, groups in aligned:
        links = [(x, y) for u, v in groups for x in u for y in v]
        written = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        wanted.append((key, n_a, n_b, len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), digest))
    assert sum(n_a == 0 for _, n_a, *_ in aligned) == 3  # null, empty, and the text whose sign B writes as a space
    same_rows(alignment.align(docs).collect(), wanted)
    assert alignment.align(none).count() == 0


def test_alignment_in_small_chunks_and_steps(docs, monkeypatch):
    whole = sorted(map(tuple, alignment.align(docs).collect()), key=str)
    monkeypatch.setattr(alignment, "CHUNK", 500)
    monkeypatch.setattr(alignment, "PRODUCT", 3)
    assert sorted(map(tuple, alignment.align(docs).collect()), key=str) == whole


def components_by_force(texts, words, percent):
    sets = []
    for _, text, *_ in texts:
        found = LOOSE.findall(lowered(text))
        sets.append({tuple(found[k : k + words]) for k in range(max(len(found) - words + 1, min(len(found), 1)))})
    root = list(range(len(texts)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for j, x in enumerate(sets):
        for k, y in enumerate(sets[:j]):
            if x and y and texts[j][0] is not None and texts[k][0] is not None and 100 * len(x & y) >= percent * len(x | y):
                root[max(top(j), top(k))] = min(top(j), top(k))
    least = {}
    for k, (key, *_) in enumerate(texts):
        if key is not None:
            least[top(k)] = min(least.get(top(k), key), key)
    return [(r[0], len(s), least[top(k)] if r[0] is not None else None, r[0] is None or least[top(k)] == r[0]) for k, (r, s) in enumerate(zip(texts, sets, strict=True))]


@pytest.mark.parametrize("block, tried", [(256, 8), (6, 0)])  # the second leaves most of the work to pairs of blocks
def test_near_duplicates_equal_brute_force(docs, texts, monkeypatch, block, tried):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "TRIED", tried)
    same_rows(near_dup.near_duplicates(docs).collect(), components_by_force(texts, 2, 80))


def test_near_duplicates_of_none_and_with_hubs(spark, none, texts, monkeypatch):
    assert near_dup.near_duplicates(none).count() == 0
    monkeypatch.setattr(work, "HUB", 2)  # hubs are broadcast from three rows on
    rows = [r for r in texts if r[0] is not None and r[0] < 60]
    same_rows(near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect(), components_by_force(rows, 2, 80))


def test_universal_minima_estimate_the_similarity():
    rng = np.random.default_rng(4)
    value = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    x, y = np.sort(value[:2000]), np.sort(value[1000:])  # similarity 1/3
    found = near_dup.minima(np.concatenate((x, y)), np.array([0, 2000, 4000]), 2000)
    assert abs((found[0] == found[1]).mean() - 1 / 3) < 0.05
    assert near_dup.least_matches(128, 80) == math.floor(102.4 - 5 * math.sqrt(128 * 0.16))


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_alignment_holds_a_chunk_and_a_row_at_a_time():
    """What a task takes beside its batch does not follow the batch: one chunk's arrays, then one row's objects."""
    import pyarrow as pa

    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(5000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"key": pa.array(range(len(texts))), "text": texts})
    paths = token_files.tokenizer_path(alignment.BYTE_LEVEL), token_files.tokenizer_path(alignment.PIECES)
    alignment.Aligned(*paths, ["tables made once"])
    first = next(alignment.chunks([batch], limit=alignment.CHUNK))[0].column(1).to_pylist()
    assert batch.nbytes > 4e6 and peak_mb(lambda: alignment.Aligned(*paths, first)) < 200

    n = 40_000
    flat = lambda x: np.asarray(x, "<i4").tobytes()
    row = {"doc": [1, 2], **dict.fromkeys(("n_a", "n_b", "n_groups", "n_links"), [1, 1]), "groups": ["", "x"]}
    row |= {"same": flat([0, 1]), "same_times": flat([1, 1]), "same_firsts": flat([0, 1, 2]), "other": flat(range(n)), "other_times": flat([1] * n)}
    row |= {"other_firsts": flat([0, n, n]), "pairs": list(range(n)), "told": [5] * n, "wide": n}
    many = pa.RecordBatch.from_pylist([row] * 30)
    finish = alignment._finish(np.array([3, 4]), np.array([5, 4]))
    assert [x.column("n_best").to_pylist() + x.column("count_sum").to_pylist() for x in finish([many])] == [[n, 1, 5 * n + 3, 4]] * 30
    assert peak_mb(lambda: [None for _ in finish([many])]) < 20


def features(text):
    found = WORD.findall(lowered(text))
    return found + [f"{a} {b}" for a, b in zip(found, found[1:])], len(found)


def drawn(texts, target, share, least, seed, buckets):
    number = lambda x: zlib.crc32(x.encode()) % buckets
    s, t = Counter(), Counter()
    for counts, group in ((s, [r[1] for r in texts]), (t, target)):
        for text in group:
            counts.update(map(number, features(text)[0]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (all_s + buckets) / ((s[k] + 1) * (all_t + buckets)))) for k in range(buckets)]
    rows = []
    for key, text, *_ in texts:
        own, n = features(text)
        weight = sum(gain[number(x)] for x in own) // len(own) if own else 0
        score = None
        if key is not None:
            h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((key, len(own), weight, score, n))
    order = sorted((-r[3], r[0], k) for k, r in enumerate(rows) if r[4] >= least and r[3] is not None)
    ranks = {k: i + 1 for i, (_, _, k) in enumerate(order[: share * len(order) // 100])}
    return [(*r[:4], ranks.get(k)) for k, r in enumerate(rows)]


@pytest.mark.parametrize("share, least", [(25, 20), (100, 1)])
def test_resampling_equals_brute_force(spark, docs, texts, share, least):
    target = ["a b\nc d", None, "", "é x y", "a\nb"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "row long, text string")
    found = resample.resample(docs, bench, share=share, least_words=least).collect()
    same_rows(found, drawn(texts, target, share, least, 7, 10_000))


def test_resampling_of_none_and_towards_nothing(docs, none, texts):
    assert resample.resample(none, docs).count() == 0
    same_rows(resample.resample(docs, none).collect(), drawn(texts, [], 25, 20, 7, 10_000))


def test_ranks_follow_the_order_over_many_ranges(spark):
    rows = [(k, (k * 7919) % 97) for k in range(500)]
    found = resample.ranked(spark.createDataFrame(rows, "key long, score long"), [resample.F.col("score").desc(), resample.F.col("key")])
    assert [r.key for r in found.orderBy("rank").collect()] == [k for k, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert sorted(r["rank"] for r in found.collect()) == list(range(1, 501))


def test_queries_return_the_columns_agreed_on(spark, texts, tmp_path):
    spark.createDataFrame([r[:2] for r in texts if r[0] is not None], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [r for r in texts if r[0] is not None]
    same_rows(queries.op12_minhash_near_dup(spark, str(tmp_path)).collect(), components_by_force(rows, 2, 80))
    same_rows(queries.op13_importance_resample(spark, str(tmp_path)).collect(), drawn(rows, ["a b c"], 25, 20, 7, 10_000))
    found = queries.op11_tokenizer_alignment(spark, str(tmp_path))
    assert dict(found.dtypes) == dict.fromkeys(("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), "bigint") | {"groups_sha256": "string"}
