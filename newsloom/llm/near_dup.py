"""MinHash near-dedup: universal hash minima in bands, signatures compared, full sets compared, components.

Documents of equal shingle sets are one node with a number of copies. ``BANDS * ROWS`` minima under random
members of a universal family (multiply, add, keep the high bits) make the signature; each band of
``ROWS`` minima is a bucket. A pair at the threshold of 0.8 shares none of 32 bands of 4 with probability
(1 - 0.8 ** 4) ** 32 = 4.7e-8.

Only what hangs together is asked for, so a bucket of many near-copies needs no look at all its pairs:

1. in every bucket the pairs of likeliest signatures that hold it together, a spanning forest, are compared,
   and components are formed; large buckets are dealt into parts that all hold the first node;
2. in buckets of several components, each node outside the part's largest one tries its ``TRIED`` likeliest
   partners of other components;
3. in buckets that still have several components, all pairs of different components are compared where they
   stand, likeliest first, until they hang together. Large ones are dealt into blocks, by component where
   one fills a block, and pairs of blocks of one component are left out.

Each step gives no more rows than a bucket has members (times ``TRIED``), and the last leaves out nothing.

Comparing is by signature first (low bytes of the minima; ``DEVIATIONS`` standard deviations are allowed
below the threshold), then by the full sets, made again from whole texts.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.llm.components import components
from newsloom.llm.texts import _LOWER, chunks, mix, ragged, span_hashes
from newsloom.llm.work import hub_join, written

PERCENT = 80
WORDS = 2
BANDS, ROWS = 32, 4
DEVIATIONS = 5
TRIED = 8
BLOCK = 256  # members of a part or block of a bucket
SENT = 500_000  # keys up to which a list of documents is broadcast (8 bytes each)

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(buffer, offsets):
    """(hashes, firsts) of the words of lower-cased (A-Z) texts: runs of all but blanks (20, 09 to 0D)."""
    lower = _LOWER[buffer]
    edge = np.ones(len(lower) + 1, bool)  # where a word may begin or end besides blanks
    edge[1:-1] = False
    edge[offsets] = True
    inside = ~_BLANK[lower]
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False))) + 1
    return span_hashes(lower, starts, ends), np.searchsorted(starts, offsets)


def shingle_sets(buffer, offsets, words=WORDS):
    """(hashes, firsts): each text's distinct shingles, sorted; fewer words than ``words``, but not none, are one."""
    hashes, firsts = word_hashes(buffer, offsets)
    sizes = np.diff(firsts)
    whole = np.maximum(sizes - words + 1, (sizes > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(sizes)), whole)
    at = ragged(firsts[:-1], whole)
    end = firsts[1:][owner]
    value = np.zeros(len(at), np.uint64)
    for k in range(words):
        there = at + k < end
        value[there] = mix(value[there] * _STEP + hashes[at[there] + k] + np.uint64(k + 1))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.searchsorted(owner[new], np.arange(len(sizes) + 1))


def set_names(value, firsts):
    """Two 64-bit sums that name each set."""
    out = []
    for salt in (3, 4):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value ^ mix(np.uint64([salt]))))))
        out.append((sums[firsts[1:]] - sums[firsts[:-1]]).astype(np.int64))
    return out


def minima(value, firsts, count):
    """count minima (32-bit) of each set under x -> (a x + b mod 2^64) >> 32; an empty set has all ones."""
    out = np.full((len(firsts) - 1, count), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(firsts))
    if len(full):
        x = value >> np.uint64(32)
        a, b = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * _STEP).reshape(2, count)
        starts, line = firsts[:-1][full], np.empty_like(x)
        for k in range(count):
            np.multiply(x, a[k], out=line)
            line += b[k]
            out[full, k] = np.minimum.reduceat(line, starts) >> np.uint64(32)
    return out


def band_keys(found, bands):
    """One 64-bit bucket of each band of each set; bands never share one."""
    n = len(found)
    part = found.reshape(n, bands, -1).astype(np.uint64)
    key = np.zeros((n, bands), np.uint64) + np.arange(bands, dtype=np.uint64)
    for k in range(part.shape[2]):
        key = mix(key * _STEP + part[:, :, k] + np.uint64(1))
    return key.astype(np.int64)


def _rows(docs, key, text):
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))


def _signed(docs, key, text, words, bands, rows):
    """key, n, two names of the shingle set, its buckets and its signature, of every row."""

    def run(batches):
        for own, buffer, offsets in chunks(batches):
            value, firsts = shingle_sets(buffer, offsets, words)
            found = minima(value, firsts, bands * rows)
            keys = band_keys(found, bands)
            h1, h2 = set_names(value, firsts)
            low = (found & np.uint32(255)).astype(np.uint8)
            columns = {
                "key": own.column(0),
                "n": np.diff(firsts),
                "h1": h1,
                "h2": h2,
                "buckets": pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), pa.array(keys.ravel())),
                "signature": pa.array([x.tobytes() for x in low], pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    schema = "key long, n long, h1 long, h2 long, buckets array<bigint>, signature binary"
    return _rows(docs, key, text).mapInArrow(run, schema)


def _sets(docs, nodes, key, text, words):
    """node and its sorted shingles (64-bit, as bytes), for the given nodes."""

    def run(batches):
        for own, buffer, offsets in chunks(batches):
            value, firsts = shingle_sets(buffer, offsets, words)
            h1, h2 = set_names(value, firsts)
            raw = value.tobytes()
            sets = [raw[8 * a : 8 * b] for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"key": own.column(0), "h1": h1, "h2": h2, "shingles": pa.array(sets, pa.binary())})

    keys = nodes.select("key").distinct()
    keys = F.broadcast(keys) if keys.count() <= SENT else keys
    made = _rows(docs, key, text).join(keys, "key", "left_semi").mapInArrow(run, "key long, h1 long, h2 long, shingles binary")
    # rows of one key may hold one text several times, or other texts
    return made.join(nodes, ["key", "h1", "h2"]).groupBy("node").agg(F.first("shingles").alias("shingles"))


def least_matches(count, percent, deviations=DEVIATIONS):
    """Equal low bytes that a pair of that similarity has but for a chance of ``deviations`` standard deviations."""
    p = percent / 100
    return math.floor(count * p - deviations * math.sqrt(count * p * (1 - p)))


def _fits(n_a, n_b, percent):
    return 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)


def _linked(percent):
    """Pairs whose full sets are similar enough, in whole numbers."""

    def run(batches):
        for batch in batches:
            at = {name: i for i, name in enumerate(batch.schema.names)}
            kept = []
            for x, y in zip(batch.column(at["shingles_a"]), batch.column(at["shingles_b"]), strict=True):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def _with_sides(pairs, sides, total):
    """Pairs with the columns of both nodes; a node of very many pairs is sent to its pairs."""
    named = lambda s: sides.select(*(F.col(c).alias(s if c == "node" else f"{c}_{s}") for c in sides.columns))
    for side in ("a", "b"):
        one = pairs.groupBy(side).agg(F.count("*").alias("_pairs")).join(named(side), side)
        pairs = hub_join(pairs, one, side, "_pairs", total).drop("_pairs")
    return pairs


class _Comparer:
    """Compares pairs of nodes of one corpus by their full sets."""

    def __init__(self, docs, nodes, key, text, percent, words):
        self.docs, self.nodes, self.key, self.text, self.percent, self.words = docs, nodes, key, text, percent, words

    def sets(self, wanted):
        """node and shingles of a table of nodes."""
        nodes = written(self.nodes.select("node", "key", "h1", "h2").join(wanted.distinct(), "node"), "wanted")
        return written(_sets(self.docs, nodes, self.key, self.text, self.words), "sets")

    def linked(self, pairs):
        """Of a written table of pairs those whose sets are similar enough."""
        sets = self.sets(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))))
        found = _with_sides(pairs, sets, pairs.count()).select("a", "b", "shingles_a", "shingles_b")
        return written(found.mapInArrow(_linked(self.percent), "a long, b long"), "linked")


class _Group:
    """Nodes of one part of a bucket, with the matches of their signatures where a link is possible."""

    def __init__(self, node, component, n, signature, percent, least):
        order = np.argsort(node)
        self.node, self.component, n, low = (x[order] for x in (node, component, n, signature))
        matches = np.stack([(low == row).sum(1) for row in low]).astype(np.int32)
        likely = (matches >= least) & _fits(n[:, None], n[None], percent)
        self.matches = np.where(likely, matches, -1)  # -1: no link
        self.matches[self.component[:, None] == self.component[None]] = -1

    def forest(self):
        """(i, j): the likeliest pairs that tie all components together that can be tied."""
        m = len(self.node)
        weight = self.matches.copy()
        weight[self.component[:, None] == self.component[None]] = 1 << 20  # tied already
        best, of, left, out = np.full(m, -1), np.full(m, -1), np.ones(m, bool), []
        for _ in range(m):
            k = int(np.argmax(np.where(left, best, -2)))
            left[k] = False
            if 0 <= best[k] < 1 << 20:
                out.append((of[k], k))
            closer = left & (weight[k] > best)
            best[closer], of[closer] = weight[k][closer], k
        return out

    def tries(self, count):
        """(i, j): the likeliest partners of the nodes outside the largest component."""
        names, at, sizes = np.unique(self.component, return_inverse=True, return_counts=True)
        out = []
        for i in np.flatnonzero(at != np.argmax(sizes)).tolist():
            ranked = np.argsort(-self.matches[i], kind="stable")[:count]
            out.extend((i, j) for j in ranked.tolist() if self.matches[i, j] >= 0)
        return out


def _parts(size, salt):
    """The part of its bucket that a node is in; the first node of a bucket is in all."""
    parts = F.ceil(F.col(size) / BLOCK).cast("long")
    own = F.array(F.pmod(F.xxhash64("node", F.lit(salt)), parts))
    return F.explode(F.when(F.col("node") == F.col("head"), F.sequence(F.lit(0).cast("long"), parts - 1)).otherwise(own))


def _grouped(rows, *by):
    fields = [c for c in rows.columns if c not in by]
    return rows.groupBy(*by).agg(F.collect_list(F.struct(*fields)).alias("m")).select("m")


def _chosen(choose, percent, least):
    """Pairs that ``choose`` picks from each list of nodes; lists of two are compared at once."""

    def run(batches):
        for batch in batches:
            lists = batch.column(0)
            bounds = lists.offsets.to_numpy()
            flat = lists.flatten()
            node, component, n = (flat.field(c).to_numpy() for c in ("node", "component", "n"))
            signature = np.frombuffer(b"".join(flat.field("signature").to_pylist()), np.uint8).reshape(len(node), -1)
            bounds = bounds - bounds[0]
            sizes = np.diff(bounds)
            i = bounds[:-1][sizes == 2]
            j = i + 1
            hit = (signature[i] == signature[j]).sum(1) >= least
            hit &= _fits(n[i], n[j], percent) & (component[i] != component[j])
            out = [np.stack((node[i[hit]], node[j[hit]]), 1)]
            for k in np.flatnonzero(sizes > 2).tolist():
                part = slice(bounds[k], bounds[k + 1])
                group = _Group(node[part], component[part], n[part], signature[part], percent, least)
                found = choose(group)
                if found:
                    out.append(group.node[np.array(found)])
            both = np.sort(np.concatenate(out), 1)
            yield pa.RecordBatch.from_pydict({"a": both[:, 0], "b": both[:, 1]})

    return run


def _needed(percent, least):
    """Nodes that have a likely partner of another component in their pair of blocks."""

    def run(batches):
        for batch in batches:
            out = []
            for cell in batch.column(0):
                rows = cell.values
                group = _Group(
                    *(rows.field(c).to_numpy() for c in ("node", "component", "n")),
                    np.frombuffer(b"".join(rows.field("signature").to_pylist()), np.uint8).reshape(len(rows), -1),
                    percent,
                    least,
                )
                out.append(group.node[(group.matches >= 0).any(1)])
            yield pa.RecordBatch.from_pydict({"node": np.unique(np.concatenate([np.zeros(0, np.int64), *out]))})

    return run


def _compared(percent, least):
    """Links of one pair of blocks that tie together what hangs together there, by full sets."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        low = np.frombuffer(b"".join(group["signature"]), np.uint8).reshape(len(group), -1)
        columns = [group[c].to_numpy() for c in ("node", "component", "n")]
        order = np.argsort(columns[0])
        sets = [np.frombuffer(group["shingles"].iloc[k], np.uint64) for k in order]
        part = _Group(*columns, low, percent, least)
        i, j = np.nonzero(np.triu(part.matches >= 0))
        root, out = dict(zip(part.component.tolist(), part.component.tolist(), strict=True)), []

        def top(k):
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for k in np.argsort(-part.matches[i, j], kind="stable").tolist():
            x, y = i[k], j[k]
            one, two = top(part.component[x]), top(part.component[y])
            if one != two:
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    root[max(one, two)] = min(one, two)
                    out.append((part.node[x], part.node[y]))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return run


def _dealt(apart):
    """bucket, x, y, node, component: the members (bucket, node, component) dealt to the pairs of blocks that they are in."""
    cells = apart.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    mixed = cells.filter(F.col("size") <= BLOCK).groupBy("bucket").agg(F.sum("size").alias("mixed"))
    parts = lambda size: F.ceil(F.col(size) / BLOCK).cast("long")
    full = F.col("size") > BLOCK
    placed = written(
        apart.join(cells, ["bucket", "component"])
        .join(mixed, "bucket", "left")
        .select(
            "bucket",
            "node",
            "component",
            F.when(full, F.col("component")).otherwise(F.lit(-1)).alias("of"),  # -1: a block of small components
            F.when(full, F.pmod(F.xxhash64("node"), parts("size"))).otherwise(F.pmod(F.xxhash64("component"), parts("mixed"))).alias("part"),
        ),
        "placed",
    )
    blocks = placed.select("bucket", F.struct("of", "part").alias("block")).distinct()
    x, y = blocks.withColumnRenamed("block", "x"), blocks.withColumnRenamed("block", "y")
    pairs = x.join(y, "bucket").filter("x <= y AND (x.of <> y.of OR x.of = -1)")
    sides = F.array_distinct(F.array("x", "y"))
    pairs = pairs.select("bucket", "x", "y", F.explode(sides).alias("block"))
    return placed.withColumn("block", F.struct("of", "part")).join(pairs, ["bucket", "block"]).select("bucket", "x", "y", "node", "component")


def _merged(labels, found):
    """(node, label) of all linked nodes after more links; only labels that the new links tie are looked at."""
    if labels is None:
        return written(components(found, "a", "b"), "labels")
    of = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
    tied = found.join(of("a"), "a", "left").join(of("b"), "b", "left")
    tied = tied.select(F.coalesce("label_a", "a").alias("u"), F.coalesce("label_b", "b").alias("v"))
    moved = written(components(tied), "moved")
    kept = labels.join(moved.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
    kept = kept.select("node", F.coalesce("to", "label").alias("label"))
    return written(kept.unionByName(moved.join(labels, "node", "left_anti")), "labels")


def _apart(members, labels):
    """Members of buckets that lie in several components; pairs of two are settled by the first step."""
    named = members.filter("size > 2").join(labels, "node", "left").withColumn("component", F.coalesce("label", "node")).drop("label")
    several = named.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("bucket")
    return written(named.join(several, "bucket", "left_semi"), "apart")


def _labels(comparer, members, least):
    """(node, label) of the components; nodes without a link are left out."""
    percent, signs = comparer.percent, comparer.nodes.select("node", "n", "signature")
    labels, apart = None, members.withColumn("component", F.col("node"))
    for salt, choose in enumerate((lambda group: group.forest(), lambda group: group.tries(TRIED))):
        rows = apart.withColumn("part", _parts("size", salt)).select("bucket", "part", "node", "component").join(signs, "node")
        lists = _grouped(rows, "bucket", "part")
        pairs = written(lists.mapInArrow(_chosen(choose, percent, least), "a long, b long").distinct(), "pairs")
        if pairs.isEmpty() and labels is not None:
            break
        labels = _merged(labels, comparer.linked(pairs))
        apart = _apart(members, labels)
        if apart.isEmpty():
            return labels
    dealt = written(_dealt(apart.select("bucket", "node", "component")), "dealt")
    needed = written(_grouped(dealt.join(signs, "node"), "bucket", "x", "y").mapInArrow(_needed(percent, least), "node long").distinct(), "needed")
    if needed.isEmpty():
        return labels
    sets = comparer.sets(needed).join(signs, "node")
    last = dealt.join(sets, "node").groupBy("bucket", "x", "y").applyInPandas(_compared(percent, least), "a long, b long")
    return _merged(labels, written(last, "last"))


def near_duplicates(docs, key="doc_id", text="text", percent=PERCENT, words=WORDS, bands=BANDS, rows=ROWS, deviations=DEVIATIONS):
    """key, n_shingles, component_id, kept of every row.

    Two rows are linked where ``100 * |both sets| >= percent * |either|``; component_id is the least key reached
    over links, the row's own included, and kept says whether it is the row's own. A text without words, null ones
    included, has no shingles and is linked with nothing. A row of null key is linked with nothing, has a null
    component and is kept. Rows of one key keep a row each, every text with its own links; equal rows are all kept
    or all not. An empty table gives no rows. Other columns are left out, so their names cannot clash.
    """
    signed = written(_signed(docs, key, text, words, bands, rows), "signed")
    full = signed.filter("n > 0 AND key IS NOT NULL")
    nodes = written(
        full.groupBy("h1", "h2")
        .agg(F.min("key").alias("key"), F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("n", "buckets", "signature")))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    total = nodes.count()
    spread = nodes.select("node", F.explode("buckets").alias("bucket"))
    heads = written(spread.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("head")).filter("size > 1"), "heads")
    members = written(hub_join(spread, heads, "bucket", "size", total * bands), "members")
    comparer = _Comparer(docs, nodes, key, text, percent, words)
    labels = _labels(comparer, members, least_matches(bands * rows, percent, deviations))
    named = written(nodes.select("node", "h1", "h2", "key", "copies").join(labels, "node"), "named")
    of_label = named.groupBy("label").agg(F.min("key").alias("component_id"), F.count("*").alias("size"))
    named = hub_join(named.select("label", "h1", "h2", "copies"), of_label, "label", "size", total).select("h1", "h2", "copies", "component_id")
    alone = nodes.filter("copies > 1").join(labels, "node", "left_anti").select("h1", "h2", "copies", F.col("key").alias("component_id"))
    told = written(named.unionByName(alone), "told")  # all sets but those of one row that is linked with nothing
    rows_ = full.select("key", "n", "h1", "h2")
    found = hub_join(rows_, told, ["h1", "h2"], "copies", signed.count()).select("key", "n", "component_id")
    rest = rows_.join(told, ["h1", "h2"], "left_anti").select("key", "n", F.col("key").alias("component_id"))
    bare = signed.filter("NOT (n > 0 AND key IS NOT NULL)").select("key", "n", F.col("key").alias("component_id"))
    return found.unionByName(rest).unionByName(bare).select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
