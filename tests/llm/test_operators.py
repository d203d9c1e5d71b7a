"""Every operator against a brute-force version, a round trip or held-out accuracy, on awkward rows and empty tables."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from newsloom.llm import bpe, chat, components, decontaminate, fingerprint, fm_index, jaccard, lines, pii, quality, token_files, toxicity
from newsloom.llm.work import shared_folder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def keyed(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_bpe_equals_the_library_and_decodes(docs, none, rows):
    import public_tokenizers
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.rank_file(bpe.vocabulary_path()), special_tokens={})
    got = bpe.decode(bpe.encode(docs)).collect()
    found = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded).decode()) for r in got), key=repr)
    assert found == sorted(((i, library.encode_ordinary(t or ""), t or "") for i, t, *_ in rows[0]), key=repr)
    assert bpe.encode(none).count() == 0


def test_perfect_hash_is_minimal_and_refuses_strangers():
    keys = np.random.default_rng(1).integers(1, 1 << 63, 5000).astype(np.uint64)
    table = bpe.PerfectHash(keys[:4000])
    assert sorted(table.find(keys[:4000])) == list(range(4000))
    assert (table.find(keys[4000:]) == -1).all()
    assert (bpe.PerfectHash(keys[:0]).find(keys) == -1).all()


def test_fingerprints_and_edited_texts(docs, none, rows):
    got = {(r.doc_id, r.near_next, r.edited_sha256): r for r in fingerprint.compare_with_next(docs, partitions=5).collect()}
    order = sorted(rows[0], key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [r[1] or "" for r in order]
    want = [hashlib.sha256(fingerprint.edited(a, b).encode()).hexdigest() for a, b in zip(texts, texts[1:] + texts[:1], strict=True)]
    assert sorted((r.edited_sha256 for r in got.values()), key=str) == sorted(want)
    alike = fingerprint.fingerprints(docs).filter("doc_id = 5 OR doc_id = 6").select("fingerprint").distinct()
    assert alike.count() == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
    assert fingerprint.compare_with_next(none).count() == 0


def labelled(spark, rng_seed=3):
    rng = np.random.default_rng(rng_seed)
    stock = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "house", "green", "light"]
    rows, labels = [], []
    for i in range(900):
        bad = i % 3 == 0
        text = " ".join(rng.choice(stock, 40))
        rows.append((i, f"{text} you scum {text}" if bad else text))
        labels.append((i, 0 if bad else 1, 1 if bad else 0))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_holds_out(spark, docs):
    texts, labels = labelled(spark)
    model = toxicity.train(texts, labels)
    scores = {r.doc_id: r.score for r in toxicity.score(texts, model).collect()}
    held = [i for i in scores if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(scores[i] >= 0.3) == (i % 3 == 0) for i in held]) > 0.95
    assert {i % 3 for i in [r.doc_id for r in toxicity.reject(texts, model).collect()]} == {1, 2}
    assert toxicity.score(docs, model).count() == docs.count()
    flat = toxicity.train(docs, labels.filter("doc_id < 0"))
    assert len({r.score for r in toxicity.score(docs, flat).collect()}) == 1


def test_quality_holds_out(spark, docs):
    texts, labels = labelled(spark)
    model = quality.train(texts, labels)
    scores = {r.doc_id: r.score for r in quality.score(texts, model).collect()}
    held = [i for i in scores if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(scores[i] >= 0.3) == (i % 3 != 0) for i in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in quality.score(docs, model).collect())
    assert quality.score(docs, quality.train(docs, labels.filter("doc_id < 0"))).count() == docs.count()


def test_token_files_round_trip(spark, docs, none, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_files.tokenizer_path())
    library.encode_special_tokens = True
    order = sorted(rows[0], key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids = [[*library.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in order]
    starts = [0, *itertools.accumulate(map(len, ids))][:-1]
    want = sorted((r[0], s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for r, s, x in zip(order[1:], starts[1:], ids[1:], strict=True))
    shards = token_files.write(docs, shared_folder(spark, "test"), partitions=4)
    got = token_files.read(shards).filter("doc_id IS NOT NULL")
    assert keyed(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    assert token_files.read(token_files.write(none, shared_folder(spark, "test"))).count() == 0


def test_token_files_hold_added_tokens_as_the_library_does(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_files.tokenizer_path())
    texts = ["a<|endoftext|>b", "plain é", "<|endoftext|>", "", " x <|endoftext|><|endoftext|> it's\n", None, "<|endof", "text|> <|ENDOFTEXT|>", "last"]
    assert library.encode(texts[0], add_special_tokens=False).ids == [64, 50256, 65]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = token_files.read(token_files.write(docs, shared_folder(spark, "test"), partitions=1), with_ids=True).collect()
    want = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in sorted(got, key=lambda r: r.doc_id)] == want
    assert sorted(r.start for r in got) == [0, *itertools.accumulate(map(len, want))][:-1]


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = [int(x) for x in value if x.isdigit()]
    if kind == "card":
        doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return {"ip": lambda: max(map(int, value.split("."))) <= 255, "phone": lambda: 8 <= len(digits) <= 15}.get(kind, lambda: True)()


def test_pii_base_spans_and_terms(docs, none, rows):
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(docs).collect()}
    for i, text, *_ in rows[0]:
        want = [(k, m.start(), m.end()) for k, p in KINDS.items() for m in re.finditer(p, text or "") if passes(k, m[0])]
        assert [s for s in got[i] if s[0] != "term"] == want
    assert [s[0] for s in got[17]] == ["email", "term"]  # quokka stands with that address alone
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[17] == "[EMAIL] knows [TERM]" and clean[0] is None and clean[1] == ""
    assert pii.find(none).count() == 0


def test_pii_terms_of_entities_in_one_or_two_documents(spark):
    texts = ["write to one@mail.org about zyzzyva today", "ask two@mail.org on quagga", "tell two@mail.org of quagga"]
    texts += ["please write about today and tell them, ask them"] * 297
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).filter("doc_id < 3").collect()}
    assert clean == {0: "write to [EMAIL] about [TERM] today", 1: "ask [EMAIL] on [TERM]", 2: "tell [EMAIL] of [TERM]"}


def test_pii_terms_are_marked_wherever_they_stand(spark):
    far = "so it was said, " * 20
    texts = [f"Zyzzyva wrote as one@mail.org. {far}ZYZZYVA, zyzzyvas", "zyzzyva and Zyzzyva", "12 quagga 34 56 one2@mail.org 4111 1111 1111 1111"]
    texts += ["so it was said and wrote as zyzzyvas, 1111 4111"] * 997
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).filter("doc_id < 4").collect()}
    assert clean[0] == f"[TERM] wrote as [EMAIL]. {far}[TERM], zyzzyvas" and clean[1] == "[TERM] and [TERM]"
    assert clean[2] == "12 [TERM] 34 56 [EMAIL] [CARD]" and clean[3] == texts[3]
    card = spark.createDataFrame([(0, "12, quagga 34, 56, 4111 1111 1111 1111, 78, okapi"), *((i, "none") for i in range(1, 300))], "doc_id long, text string")
    assert pii.sanitise(card).filter("doc_id = 0").first().text == "12, [TERM] 34, 56, [CARD], 78, [TERM]"


def brute_classes(texts, threshold=0.8):
    sets = []
    for text in texts:
        w = words(text)
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    links = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j and a and len(a & b) >= threshold * len(a | b)}
    return links


@pytest.mark.parametrize("small", [32, 1])
def test_jaccard_equals_brute_force(docs, none, rows, small, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", small)  # 1: all buckets go by blocks
    own = [r for r in rows[0] if r[0] is not None]
    links = brute_classes([r[1] for r in own])
    count = Counter(i for i, _ in links)
    got = jaccard.classes(docs).filter("doc_id IS NOT NULL")
    assert keyed(got, "doc_id", "n_links") == sorted(((r[0], count[i]) for i, r in enumerate(own)), key=repr)
    label = {r.doc_id: r.class_id for r in got.collect()}
    assert all(label[own[i][0]] == label[own[j][0]] for i, j in links) and label[7] == 5
    kept = jaccard.keep_one(docs)
    assert {r.doc_id for r in kept.collect()} == {None, *(i for i, c in label.items() if i == c)} and kept.columns == docs.columns
    assert jaccard.classes(none).count() == 0


@pytest.mark.parametrize("small", [32, 1])
def test_jaccard_repeated_keys(spark, small, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", small)
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    near = lambda x: x + " more"
    rows = [(3, a), (5, a), (5, b), (5, c), (9, near(b)), (8, near(c)), (4, d), (4, d), (4, near(d)), (None, d), (6, ""), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.classes(docs).filter("doc_id IS NOT NULL AND doc_id != 6")
    own = [(3, 3, 1, 2), (5, 3, 1, 2), (5, 5, 1, 2), (5, 5, 1, 2), (9, 5, 1, 2), (8, 5, 1, 2)] + [(4, 4, 2, 3)] * 3
    assert keyed(got, "doc_id", "class_id", "n_links", "n_class") == sorted(own, key=repr)
    kept = keyed(jaccard.keep_one(docs), "doc_id", "text")
    of_four = [x for x in kept if x[0] == 4]
    assert len(of_four) == 1 and of_four[0][1] in (d, near(d))
    assert sorted(set(kept) - set(of_four), key=repr) == sorted({(3, a), (5, b), (5, c), (None, d), (6, "")}, key=repr) and len(kept) == 7


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)], "u long, v long")
    assert keyed(components.components(edges), "node", "label") == sorted([(i, 0) for i in range(41)][1:] + [(0, 0)] + [(i, 100) for i in range(100, 140)], key=repr)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = list(itertools.accumulate(range(1, len(b) + 1), lambda left, j, x=x, row=row: min(left + 1, row[j] + 1, row[j - 1] + (x != b[j - 1])), initial=i))
    return row[-1]


def test_lines_equal_brute_force(docs, none, rows):
    first = {}
    for i, text in sorted(((-1 if r[0] is None else r[0]), r[1] or "") for r in rows[0]):
        for pos, line in enumerate(text.split("\n")):
            if bare := line.strip(" \t\r\f\v"):
                first.setdefault(bare, (i, pos))
    near = {max((a, b), key=first.get) for a, b in itertools.combinations(first, 2) if 0 < (edits := sum(min(len(a), len(b)) >= n for n in lines.FROM)) and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits}
    assert near
    got = {r.doc_id: r.text for r in lines.drop_repeated(docs).collect()}
    for i, text, *_ in rows[0]:
        own = -1 if i is None else i
        stay = [x for pos, x in enumerate((text or "").split("\n")) if not (b := x.strip(" \t\r\f\v")) or (first[b] == (own, pos) and b not in near)]
        assert (got[i] or "") == "\n".join(stay)
    assert lines.drop_repeated(none).count() == 0


def test_short_lines_are_compared_too(spark):
    rows = [(i, f"abcdefghijklmno{c}") for i, c in enumerate("pqrstu")] + [(10, "shorty"), (11, "shortx"), (12, "eight be"), (13, "eight by")]
    found = {r.doc_id: r.n_near for r in lines.drop_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 0, 11: 0, 12: 0, 13: 1}


def test_banded_distance_equals_the_whole_table(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng, pairs = np.random.default_rng(6), []
    for _ in range(1500):
        a = [str(x) for x in rng.choice(list("abé"), int(rng.choice([8, 9, 16, 23, 24, 25, 70])))]
        b = list(a) if rng.random() < 0.9 else [str(x) for x in rng.choice(list("abé"), len(a))]
        for _ in range(int(rng.integers(5))):
            at = int(rng.integers(len(b)))
            b[at : at + 1] = [[], ["c"], [b[at], "a"], ["a"]][rng.integers(4)]
        short, long = sorted(("".join(a), "".join(b)), key=len)
        if len(long) - len(short) <= lines.EDITS:
            pairs.append((short, long))
    col, chars = lines.F.col, lambda c: lines.F.split(c, "")
    df = spark.createDataFrame(pairs, "a string, b string")
    # the whole lines, and what is left of them without their shared ends
    whole = lines._distance(chars("a"), chars("b"), lines.F.length("a"), lines.F.length("b")) <= lines.allowed(lines.F.length("a"))
    may = lines._may_be_near(lines._pieces(col("a"), lines.F.length("a")), lines.F.length("a"), col("b"))
    found = df.select("a", "b", whole.alias("whole"), lines._near(col("a"), col("b")).alias("near"), may.alias("may")).collect()
    assert all(r.whole == r.near <= r.may for r in found) and not all(r.may for r in found)
    assert all(r.near == (distance(r.a, r.b) <= sum(len(r.a) >= n for n in lines.FROM)) for r in found)
    assert 300 < sum(r.near for r in found) < len(found) - 300


def test_lines_lose_all_that_they_share_before_their_distance(spark):
    """What is left starts and ends differently, however long the lines; only lines edited at both ends of it are compared cell by cell."""
    long = "é" * 70_000
    pairs = [("abcdefgh", "abXdefgh"), ("aaaa", "aaaaaa"), (long + "x" + long, long + "yy" + long), ("", "ab"), ("1 abc 2", "3 abc 4"), ("1 abc 2", "3 bcd 4")]
    col = lines.F.col
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("t", lines._trimmed(col("a"), col("b")))
    may = lines._edited_at_ends(col("t.a"), col("t.b"), lines.F.length("t.a"), lines.F.length("t.b"))
    found = [(r.a, r.b, r.may) for r in df.select("t.a", "t.b", may.alias("may")).collect()]
    assert found[:5] == [("c", "X", True), ("", "aa", True), ("x", "yy", True), ("", "ab", True), ("1 abc 2", "3 abc 4", True)]
    assert found[5] == ("1 abc 2", "3 bcd 4", False)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_every_near_pair_meets_in_a_segment(edits):
    """The shifts of the probes reach a segment of any line within the edits."""
    rng = np.random.default_rng(edits)
    for _ in range(300):
        a = "".join(rng.choice(list("ab"), 30))
        b = list(a)
        for _ in range(edits):
            at = int(rng.integers(len(b)))
            b[at : at + 1] = [[], ["c"], [b[at], "c"]][rng.integers(3)]
        short, long = sorted((a, "".join(b)), key=len)
        parts, n = edits + 1, len(short)
        base, extra = divmod(n, parts)
        size = [base + (i >= parts - extra) for i in range(parts)]
        start = [sum(size[:i]) for i in range(parts)]
        meets = any(
            less == len(long) - n and start[i] + s >= 0 and long[start[i] + s : start[i] + s + size[i]] == short[start[i] : start[i] + size[i]]
            for less, i, s in lines.shifts(edits)
        )
        assert meets


def test_chat_reads_back(spark):
    turns = [(1, None, "system", "Be [kind] <s>"), (2, 0, "user", None), (2, 1, "assistant", "\\s \\\\l</s>")]
    turns += [(1, k, ("user", "assistant")[k % 2], f"turn {k} " + "word " * (7 * k % 90)) for k in range(60)]
    turns += [(3, 0, "assistant", "long " * 2000), (3, 0, "assistant", "long " * 2000), (None, 1, "user", "no conversation")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4)
    windows = chat.windows(df).cache()
    back = {r.conv_id: r for r in chat.read_back(windows).collect()}
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2], t[3] or ""))
        assert [tuple(x) for x in back[conv].turns] == [(t[2], t[3] or "") for t in own]
        assert back[conv].loss == [t[3] or "" for t in own if t[2] == "assistant"]
    of_one = [r for r in windows.filter("conv_id = 1").collect()]
    assert len(of_one) > 3 and all("Be \\bkind] \\ls>" in r.formatted for r in of_one)
    assert any(chat.REPEATED + "user" in r.formatted for r in of_one)
    assert chat.read_back(chat.windows(df.limit(0))).count() == 0


def test_fm_index_finds_all_places():
    rng = np.random.default_rng(4)
    for _ in range(60):
        text = np.concatenate(([0], rng.integers(0, 4, rng.integers(1, 60)), [0]))
        index = fm_index.FMIndex(text, 4)
        phrase = rng.integers(1, 4, rng.integers(1, 4))
        low, high = index.search(phrase[None, :], np.array([len(phrase)]))
        want = [i for i in range(len(text)) if text[i : i + len(phrase)].tolist() == phrase.tolist()]
        assert sorted(index.locate(np.arange(low[0], max(low[0], high[0])))) == want


def test_decontamination_equals_brute_force(spark, docs, none, rows):
    data, passage = rows
    items = [(1, passage), (2, passage + " end"), (10, "the idiot"), (11, "stupid idiot"), (12, None), (13, "...")]
    benchmark = decontaminate.load_benchmark(spark.createDataFrame(items, "item_id long, text string"))
    windows = {(i, tuple(w[k : k + 10])) for i, t in items if (w := words(t)) for k in range(max(1, len(w) - 9))}
    got = {r.doc_id: r for r in decontaminate.report(docs, benchmark).collect()}
    for i, text, *_ in data:
        own, hit, found = words(text), set(), set()
        for item, w in windows:
            for k in range(len(own) - len(w) + 1):
                if tuple(own[k : k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    found.add(str(item))
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == (len(own), len(hit), sorted(found))
    clean = {r.doc_id: r.text for r in decontaminate.remove(docs, benchmark).collect()}
    assert clean[13] == "" and clean[0] is None and clean[8] == data[8][1]
    assert decontaminate.report(none, benchmark).count() == 0
    empty = decontaminate.load_benchmark(none.select("doc_id", "text").withColumnRenamed("doc_id", "item_id"))
    assert decontaminate.report(docs, empty).filter("n_hit > 0").count() == 0


NAMES = ("_key", "_k", "_t", "_cut", "key", "k", "t", "cut", "c_0", "text_", "label", "node")


def with_names(df):
    """Columns of every name that operators use inside, each with its own value in every row."""
    return df.select("doc_id", "text").withColumns({name: pii.F.lit(f"own {name}") for name in NAMES})


def test_columns_of_any_name_come_back(docs):
    for run in (jaccard.keep_one, pii.sanitise, lines.drop_repeated):
        out = run(with_names(docs))
        assert out.columns[: len(NAMES) + 2] == ["doc_id", "text", *NAMES]
        assert all(row[name] == f"own {name}" for row in out.collect() for name in NAMES)


@pytest.mark.parametrize("copies", [1, 2, 4])
def test_copies_of_a_row_disclose_as_one_does(spark, copies):
    planted = [(1, "write to ann@home.org about zyzzyva")] * copies
    others = [(i, f"nothing to see in text number {i}") for i in range(2, 299)]
    df = spark.createDataFrame(planted + others, "doc_id long, text string")
    out = [r.text for r in pii.sanitise(df).filter("doc_id = 1").collect()]
    assert len(out) == copies and len(set(out)) == 1 and "[TERM]" in out[0] and "zyzzyva" not in out[0]
