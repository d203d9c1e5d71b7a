"""N-gram Jaccard join: banded MinHash finds candidates, exact set comparison decides.

Texts of equal shingle sets are one node with a number of copies. Each node has ``TREES`` bands of one
depth, the greatest up to ``DEEPEST`` minimum hashes at which two texts of the threshold's similarity
share one with probability ``RECALL``. This is no LSH forest: prefixes have that depth for all nodes.
Nodes that share a band form a bucket.

* Small buckets give pairs; a pair of several trees is compared once.
* Large buckets are dealt into pairs of blocks, each compared in one task that returns sums and one edge
  a node, not pairs; a pair is counted in the first tree that it shares.

Only nodes that share a bucket have their sets made again, from whole texts.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.llm.components import _written, components
from newsloom.llm.shingles import SHINGLE, depth_for, minimums, prefix_keys, set_names, shingle_sets
from newsloom.llm.texts import chunks

THRESHOLD = 0.8
TREES = 24
DEEPEST = 8
RECALL = 0.99999
SMALL = 32  # members up to which a bucket gives pairs
BLOCK = 512  # members of a block of a larger one
SENT = 500_000  # keys up to which a list of nodes is broadcast (8 bytes each)


def _key(key):
    return F.col(key).cast("long").alias("key")


def _text_name(text):
    return F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t")


def _signed(docs, key, text, words, trees, depth):
    """key, t (tells the texts of a repeated key), two names of the shingle set, its size, and the prefix keys of the trees."""

    def run(batches):
        for rows, buffer, offsets in chunks(batches):
            value, firsts = shingle_sets(buffer, offsets, words)
            keys = prefix_keys(minimums(value, firsts, trees * depth), trees, depth)
            h1, h2 = set_names(value, firsts)
            lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, trees, dtype=np.int32), pa.array(keys.ravel()))
            columns = {"key": rows.column(0), "t": rows.column(2), "h1": h1, "h2": h2, "n": np.diff(firsts), "trees": lists}
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(_key(key), F.col(text).alias("text"), _text_name(text)).filter(F.col("key").isNotNull())
    return rows.mapInArrow(run, "key long, t long, h1 long, h2 long, n long, trees array<bigint>").filter("n > 0")


def _sets(docs, nodes, key, text, words):
    """node, n, copies, trees and the sorted shingles (64-bit, as bytes) of the given nodes."""

    def run(batches):
        for rows, buffer, offsets in chunks(batches):
            value, firsts = shingle_sets(buffer, offsets, words)
            h1, h2 = set_names(value, firsts)
            raw = value.view(np.uint8).tobytes()
            own = [raw[8 * a : 8 * b] for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"key": rows.column(0), "h1": h1, "h2": h2, "shingles": pa.array(own, pa.binary())})

    rows = docs.select(_key(key), F.col(text).alias("text"))
    wanted = nodes.select("key")
    wanted = F.broadcast(wanted) if wanted.count() <= SENT else wanted
    made = rows.join(wanted, "key", "left_semi").mapInArrow(run, "key long, h1 long, h2 long, shingles binary")
    # a repeated key may stand at another text: the set's names tell
    return made.join(nodes, ["key", "h1", "h2"]).groupBy("node").agg(
        *(F.first(c).alias(c) for c in ("n", "copies", "trees", "shingles"))
    )


def _similar(a, b, threshold):
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= threshold * (len(a) + len(b) - both) - 1e-9


def _check_pairs(threshold):
    def run(batches):
        for batch in batches:
            at = {name: i for i, name in enumerate(batch.schema.names)}
            left, right = batch.column(at["shingles_a"]), batch.column(at["shingles_b"])
            kept = [
                _similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), threshold)
                for x, y in zip(left, right, strict=True)
            ]
            yield batch.select(["a", "b", "copies_a", "copies_b"]).filter(pa.array(kept, pa.bool_()))

    return run


def _check_block(threshold):
    """One pair of blocks of one bucket: per node its linked copies, and the least node that it hangs together with here."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", ignore_index=True)
        m = len(group)
        sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
        sizes = np.array([len(x) for x in sets])
        copies, block = group["copies"].to_numpy(), group["block"].to_numpy()
        trees = np.array(group["trees"].tolist(), np.int64)
        tree, within = int(group["tree"].iloc[0]), group["i"].iloc[0] == group["j"].iloc[0]
        number = np.unique(np.concatenate(sets), return_inverse=True)[1]
        owner = np.repeat(np.arange(m), sizes)
        order = np.argsort(number, kind="stable")
        holders, starts = owner[order], np.searchsorted(number[order], np.arange(number.max(initial=-1) + 2))
        own = np.split(number, np.cumsum(sizes)[:-1])
        linked, root = np.zeros(m, np.int64), np.arange(m)

        def top(k):
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for a in range(m):
            later = np.arange(m) > a
            if not within:
                later &= block != block[a]
            first = np.argmax(trees == trees[a], axis=1)  # the first tree that each shares with a
            later &= (first == tree) & (trees[:, tree] == trees[a, tree])
            if not later.any():
                continue
            spans = [holders[starts[s] : starts[s + 1]] for s in own[a]]
            both = np.bincount(np.concatenate(spans), minlength=m)
            hit = np.flatnonzero(later & (both >= threshold * (sizes + sizes[a] - both) - 1e-9))
            linked[a] += copies[hit].sum()
            linked[hit] += copies[a]
            for b in hit.tolist():
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
        roots = group["node"].to_numpy()[[top(k) for k in range(m)]]
        out = pd.DataFrame({"node": group["node"], "links": linked, "root": roots})
        return out[(out["links"] > 0) | (out["node"] != out["root"])]

    return run


def _classed(docs, key, text, threshold=THRESHOLD, words=SHINGLE, trees=TREES, recall=RECALL):
    """key, t, label, class_id, n_links, n_class of every row with a key and words; ``label`` alone tells classes apart."""
    depth = depth_for(threshold, trees, DEEPEST, recall)
    signed = _written(_signed(docs, key, text, words, trees, depth), "signed")
    # A repeated key may be the least one of several sets, so nodes have numbers of their own, fixed once written.
    nodes = _written(
        signed.groupBy("h1", "h2")
        .agg(F.min("key").alias("key"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("trees").alias("trees"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    spread = nodes.select("node", F.posexplode("trees").alias("tree", "bucket"))
    sizes = spread.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = _written(spread.join(sizes, "bucket"), "members")
    candidates = members.select("node").distinct().join(nodes, "node")
    sets = _written(_sets(docs, candidates, key, text, words), "sets")

    small = members.filter(F.col("size") <= SMALL).groupBy("bucket").agg(F.array_sort(F.collect_list("node")).alias("m"))
    pairs = small.select(
        F.explode(
            F.flatten(
                F.transform("m", lambda a, k: F.transform(F.slice("m", k + 2, F.size("m")), lambda b: F.struct(a.alias("a"), b.alias("b"))))
            )
        ).alias("p")
    ).select("p.a", "p.b").distinct()
    # the first shared tree may lie in a large bucket, which then counts the pair
    side = lambda s: sets.select(*(F.col(c).alias(x) for c, x in (("node", s), ("n", f"n_{s}"), ("copies", f"copies_{s}"), ("trees", f"trees_{s}"), ("shingles", f"shingles_{s}"))))
    joined = pairs.join(side("b"), "b").join(side("a"), "a").filter(
        F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b") - 1e-6
    )
    first = F.element_at(F.filter(F.arrays_zip("trees_a", "trees_b"), lambda t: t["trees_a"] == t["trees_b"]), 1)["trees_a"]
    joined = joined.withColumn("bucket", first)
    large_buckets = members.filter(F.col("size") > SMALL).select("bucket").distinct()
    joined = joined.join(large_buckets, "bucket", "left_anti").select("a", "b", "copies_a", "copies_b", "shingles_a", "shingles_b")
    links = _written(joined.mapInArrow(_check_pairs(threshold), "a long, b long, copies_a long, copies_b long"), "links")

    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    large = members.filter(F.col("size") > SMALL).withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    dealt = large.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "node", "tree", "bucket", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    compared = (
        dealt.join(sets.select("node", "copies", "trees", "shingles"), "node")
        .groupBy("bucket", "i", "j")
        .applyInPandas(_check_block(threshold), "node long, links long, root long")
    )
    compared = _written(compared, "compared")

    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        compared.select(F.col("node").alias("u"), F.col("root").alias("v"))
    )
    labels = components(edges)
    counts = (
        links.select(F.col("a").alias("node"), F.col("copies_b").alias("links"))
        .unionByName(links.select(F.col("b").alias("node"), F.col("copies_a").alias("links")))
        .unionByName(compared.select("node", "links"))
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )
    placed = (
        nodes.select("h1", "h2", "node", "key", "copies")
        .join(labels, "node", "left")
        .join(counts, "node", "left")
        .select(
            "h1",
            "h2",
            "key",
            "copies",
            F.coalesce("label", "node").alias("label"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    of_label = placed.groupBy("label").agg(F.min("key").alias("class_id"), F.sum("copies").alias("n_class"))
    placed = placed.drop("key", "copies").join(of_label, "label")
    return signed.select("key", "t", "h1", "h2").join(placed, ["h1", "h2"]).select("key", "t", "label", "class_id", "n_links", "n_class")


def classes(docs, key="doc_id", text="text", **options):
    """key, class_id, n_links, n_class of every row; ``options``: threshold, words, trees, recall.

    Two rows are linked where their shingle sets have that Jaccard similarity or more; n_links counts the
    other rows a row is linked to, class_id is the least key reached over links, n_class the rows of the
    class. A text without words, null ones included, is linked to nothing, and its class is its own key.
    A null key has a null class and no links. Rows of one key keep one row each, every text with its own
    links; equal rows are linked. Classes that share a repeated key as their least have equal class_ids.
    """
    found = _classed(docs, key, text, **options).select("key", "class_id", "n_links", "n_class")
    # texts without words: those rows that were not signed
    bare = _bare(docs, key, text).select("key", F.col("key").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.when(F.col("key").isNotNull(), 1).cast("long").alias("n_class"))
    return found.unionByName(bare).withColumnRenamed("key", key)


def _bare(docs, key, text):
    """Rows with a null key or no word in the text."""
    words = F.coalesce(F.regexp_like(F.col(text), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")), F.lit(False))
    return docs.select(F.col(key).cast("long").alias("key"), words.alias("has")).filter(F.col("key").isNull() | ~F.col("has")).select("key")


def keep_one(docs, key="doc_id", text="text", **options):
    """``docs``, all columns, with one row a class: the one of least key. Rows of null key or without words all stay.

    Of a class's rows of least key, those of one text are looked at, and one of them stays.
    """
    found = _written(_classed(docs, key, text, **options).select("key", "t", "label"), "classed")
    rows = found.groupBy("label", "key", "t").agg(F.count("*").alias("n"))
    first = found.groupBy("label").agg(F.min("key").alias("key")).join(rows, ["label", "key"]).groupBy("label", "key").agg(F.min("t").alias("t"))
    repeated = _written(rows.filter("n > 1").join(first, ["label", "key", "t"], "left_semi").select("key", "t"), "repeated")
    gone = rows.join(first, ["label", "key", "t"], "left_anti").select("key", "t").unionByName(repeated)
    # the columns of docs are numbered, so that none has an inner name
    names = {c: f"c_{i}" for i, c in enumerate(docs.columns)}
    named = docs.select(_key(key), _text_name(text), *(F.col(c).alias(n) for c, n in names.items()))
    back = [F.col(n).alias(c) for c, n in names.items()]
    stay = named.join(gone, ["key", "t"], "left_anti").select(back)
    n = repeated.count()
    if not n:
        return stay
    repeated = F.broadcast(repeated) if n <= SENT else repeated
    one = named.join(repeated, ["key", "t"], "left_semi").dropDuplicates(["key", "t"])
    return stay.unionByName(one.select(back))
