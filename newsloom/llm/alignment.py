"""Cross-tokenizer alignment: groups of tokens of two vocabularies over the same bytes, and how often ids meet.

A text's tokens of A and of B are cut into groups wherever both end. Two ids are linked where they stand
in one group. Most groups are one token of A beside one of B with the same bytes, so the map from an A id
to the B id of those bytes, made once, tells such a pair without naming B:

* pairs of that map are counted in vectors as long as A's vocabulary, one vector a task;
* all other pairs go through a shuffle, once for each chunk of texts: a chunk carries its distinct pairs
  with the number of its documents that hold them, is given the corpus-wide counts of just these, and
  its documents point into that list. No row is made for a pair of one document, and a pair that all
  documents hold is one row a chunk, spread over ``SALT`` tasks.

Texts are read and encoded once; what the second step needs is written beside the lists of pairs.
"""

import functools
import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.llm.texts import binary_array, chunks, give_back, ragged
from newsloom.llm.token_files import library_encoder, tokenizer_path
from newsloom.llm.work import written

BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
CHUNK = 1 << 20  # bytes of text; a task's arrays take about a hundred times that
GROUP = 16 << 20  # row groups that a reader decodes at once
SALT = 4
PRODUCT = 1 << 20  # pairs made at once; a group of more is one step

_CHUNK_SCHEMA = (
    "chunk long, doc array<long>, known array<boolean>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups array<string>, same binary, same_times binary, same_firsts binary, other binary, other_times binary, other_firsts binary, "
    "pairs array<long>, held array<long>, vector binary"
)


class Pieces:
    """A piece model: its ids, and the bytes of each."""

    def __init__(self, path):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.vocab_size())
        entries = [
            bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode()
            for i in ids
        ]
        # the B id of some bytes: a piece goes before a byte token, which only stands in for missing pieces
        self.of = {entries[i]: i for i in sorted(ids, key=lambda i: (not self.model.is_byte(i), -i))}
        self.length = np.array([len(x) for x in entries], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def encode(self, texts):
        ids = self.model.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for own in ids for x in own), np.int32, int(sizes.sum()))
        return flat, np.concatenate(([0], np.cumsum(sizes)))


@functools.lru_cache(maxsize=1)
def _tokenizers(path_a, path_b):
    """(encoder of A, pieces of B, A id to the B id of the same bytes or -1), one per Python worker."""
    encoder, pieces = library_encoder(path_a)[0], Pieces(path_b)
    known = encoder.known
    same = np.full(len(known.length), -1, np.int64)
    for entry, i in known.ranks.items():
        same[i] = pieces.of.get(entry, -1)
    return encoder, pieces, same


def vocabulary_size(path_a):
    return len(library_encoder(path_a)[0].known.length)


@functools.lru_cache(maxsize=1)
def _digits(n):
    """Decimal digits of 0 to n - 1, left-aligned, and how many each has."""
    width = len(str(n))
    table = np.char.ljust(np.arange(n).astype(f"S{width}"), width).view(np.uint8).reshape(n, width)
    return table, np.char.str_len(np.arange(n).astype(f"S{width}")).astype(np.int64)


def _valid(data, sizes, buffer, offsets):
    """Whether each text's joined token bytes are the text's: ``data`` in runs of ``sizes`` against the buffer."""
    own = np.diff(offsets)
    right = sizes == own
    stops = np.concatenate(([0], np.cumsum(sizes)))
    look = np.flatnonzero(right)
    differ = data[ragged(stops[look], own[look])] != buffer[ragged(offsets[look], own[look])]
    if differ.any():
        right[look[np.repeat(np.arange(len(look)), own[look])[differ]]] = False
    return right


def _written_groups(a, b, at_a, at_b, last_a, last_b, firsts):
    """The texts ``a1,a2|b1;a3|b2``: digits and one sign a token, without the sign that ends a text."""
    n = len(a) + len(b)
    ids, sign = np.zeros(n, np.int64), np.zeros(n, np.uint8)
    ids[at_a], ids[at_b] = a, b
    sign[at_a], sign[at_b] = np.where(last_a, 124, 44), np.where(last_b, 59, 44)
    table, digits = _digits(1 << 17)
    lengths = digits[ids] + 1
    stops = np.concatenate(([0], np.cumsum(lengths)))
    out = np.zeros(int(stops[-1]), np.uint8)
    for k in range(table.shape[1]):
        deep = np.flatnonzero(digits[ids] > k)
        if len(deep):
            out[stops[deep] + k] = table[ids[deep], k]
    out[stops[1:] - 1] = sign
    data, bounds = out.tobytes(), stops[firsts].tolist()
    return [hashlib.sha256(data[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(bounds, bounds[1:], strict=False)]


def _counted(owner, value, width, times=None):
    """Distinct (owner, value) sorted, with the sum of their times."""
    key = owner * width + value
    if times is None:
        key, n = np.unique(key, return_counts=True)
    else:
        key, back = np.unique(key, return_inverse=True)
        n = np.bincount(back, times, len(key)).astype(np.int64)
    return key // width, key % width, n


def _products(a_owner, a, a_times, b_owner, b, b_times, n_groups, wide):
    """(group, a, b, times) of all pairs of distinct ids in a group, in steps of about ``PRODUCT`` pairs."""
    first_a, first_b = (np.searchsorted(x, np.arange(n_groups + 1)) for x in (a_owner, b_owner))
    sizes = np.diff(first_b)[a_owner]
    steps = np.concatenate(([0], np.cumsum(sizes)))
    begin = 0
    while begin < len(a):
        end = max(begin + 1, int(np.searchsorted(steps, steps[begin] + PRODUCT, "right")) - 1)
        left = np.repeat(np.arange(begin, end), sizes[begin:end])
        right = ragged(first_b[a_owner[begin:end]], sizes[begin:end])
        yield a_owner[left], a[left] * wide + b[right], a_times[left] * b_times[right]
        begin = end


class Aligned:
    """The documents of one chunk, aligned: per-document numbers, and their pairs with multiplicities."""

    def __init__(self, path_a, path_b, texts):
        encoder, pieces, same = _tokenizers(path_a, path_b)
        self.wide = len(pieces.length)
        raw = [b" " + x.encode() if x else b"" for x in texts]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
        buffer = np.frombuffer(b"".join(raw), np.uint8)
        a, a_firsts, data, sizes = encoder.exact(buffer, offsets)
        # np.add.reduceat would take a next value for an empty text
        summed = lambda sizes, firsts: np.diff(np.concatenate(([0], np.cumsum(sizes)))[firsts])
        good = _valid(data, summed(sizes, a_firsts), buffer, offsets)
        b, b_firsts = pieces.encode(texts)
        lengths = pieces.length[b]
        good &= _valid(pieces.flat[ragged(pieces.start[b], lengths)], summed(lengths, b_firsts), buffer, offsets) & (np.diff(offsets) > 0)

        docs = len(texts)
        doc_a, doc_b = (np.repeat(np.arange(docs), np.diff(x)) for x in (a_firsts, b_firsts))
        a, sizes, doc_a = (x[good[doc_a]] for x in (a.astype(np.int64), sizes, doc_a))
        b, lengths, doc_b = (x[good[doc_b]] for x in (b.astype(np.int64), lengths, doc_b))
        self.good, self.n_a, self.n_b = good, np.bincount(doc_a, minlength=docs), np.bincount(doc_b, minlength=docs)
        end_a, end_b = np.cumsum(sizes), np.cumsum(lengths)
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        first_a = np.cumsum(in_a) - in_a
        doc = doc_a[first_a] if len(cuts) else np.zeros(0, np.int64)
        self.n_groups = np.bincount(doc, minlength=docs)
        links = np.concatenate(([0], np.cumsum(in_a * in_b)))
        firsts = np.concatenate(([0], np.cumsum(self.n_groups)))
        self.n_links = links[firsts[1:]] - links[firsts[:-1]]
        self.groups = self._texts(a, b, end_a, end_b, cuts, group_a, group_b, in_a, in_b, first_a)

        one = (in_a == 1) & (in_b == 1)
        first_b = np.cumsum(in_b) - in_b
        plain = np.zeros(len(cuts), bool)
        plain[one] = same[a[first_a[one]]] == b[first_b[one]]
        same_doc, same_id, same_times = [doc[plain]], [a[first_a[plain]]], [np.ones(int(plain.sum()), np.int64)]
        other = [[], [], []]
        rest_a, rest_b = ~plain[group_a], ~plain[group_b]
        left = _counted(group_a[rest_a], a[rest_a], len(same))
        right = _counted(group_b[rest_b], b[rest_b], self.wide)
        for group, pair, times in _products(*left, *right, len(cuts), self.wide):
            known = same[pair // self.wide] == pair % self.wide  # the map's pairs count in vectors wherever they stand
            same_doc.append(doc[group[known]])
            same_id.append(pair[known] // self.wide)
            same_times.append(times[known])
            for parts, found in zip(other, _counted(doc[group[~known]], pair[~known], len(same) * self.wide, times[~known]), strict=True):
                parts.append(found)
        joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.same_doc, self.same_id, self.same_times = _counted(*map(joined, (same_doc, same_id)), len(same), joined(same_times))
        other_doc, other_pair, other_times = map(joined, other)
        self.pairs, at = np.unique(other_pair, return_inverse=True)
        self.other_doc, self.other_at, self.other_times = _counted(other_doc, at, max(len(self.pairs), 1), other_times)
        self.held = np.bincount(self.other_at, minlength=len(self.pairs))

    def _texts(self, a, b, end_a, end_b, cuts, group_a, group_b, in_a, in_b, first_a):
        before_b = np.cumsum(in_b) - in_b
        at_a = np.arange(len(a)) + before_b[group_a]
        at_b = np.arange(len(b)) + (first_a + in_a)[group_b]
        firsts = np.concatenate(([0], np.cumsum(self.n_a + self.n_b)))
        return _written_groups(a, b, at_a, at_b, end_a == cuts[group_a], end_b == cuts[group_b], firsts)


def _packed(values, kind="<i4"):
    return np.ascontiguousarray(values, kind).tobytes()


def _encoded(docs, key, text, path_a, path_b):
    """One row a chunk with all that its documents need, and one row a task with the vector of the map's pairs."""

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        vector, number = np.zeros(vocabulary_size(path_a), np.int64), 0
        empty = {name.split()[0]: None for name in _CHUNK_SCHEMA.split(", ")}
        schema = None
        for rows, _, _ in chunks(batches, limit=CHUNK):
            found = Aligned(path_a, path_b, [x or "" for x in rows.column(1).to_pylist()])
            vector += np.bincount(found.same_id, minlength=len(vector))
            n = len(found.good)
            keys = rows.column(0)
            row = {
                "chunk": (task << 32) + number,
                "doc": keys.to_pylist(),
                "known": found.good.tolist(),
                **{name: getattr(found, name).tolist() for name in ("n_a", "n_b", "n_groups", "n_links")},
                "groups": found.groups,
                "same": _packed(found.same_id),
                "same_times": _packed(found.same_times),
                "same_firsts": _packed(np.searchsorted(found.same_doc, np.arange(n + 1))),
                "other": _packed(found.other_at),
                "other_times": _packed(found.other_times),
                "other_firsts": _packed(np.searchsorted(found.other_doc, np.arange(n + 1))),
                "pairs": found.pairs,
                "held": found.held,
            }
            number += 1
            schema = schema or _arrow_schema()
            yield pa.RecordBatch.from_pylist([empty | row], schema)
        yield pa.RecordBatch.from_pylist([empty | {"vector": _packed(vector, "<i8")}], schema or _arrow_schema())
        give_back()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, _CHUNK_SCHEMA)


def _arrow_schema():
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in _CHUNK_SCHEMA.split(", "))])


def _vector_sum(encoded, size):
    """The tasks' vectors added up: documents that hold each A id linked to the B id of its bytes."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.frombuffer(x.as_py(), "<i8")
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": found, "n": total[found]})

    parts = encoded.filter("vector IS NOT NULL").select("vector").mapInArrow(run, "id long, n long")
    return _vocabulary_vector(parts.groupBy("id").agg(F.sum("n").alias("n")), size)


def _vocabulary_vector(df, size):
    out = np.zeros(size, np.int64)
    for row in df.collect():  # at most one row an id of A's vocabulary
        out[row.id] = row.n
    return out


def _finish(same_counts, best):
    """n_best and count_sum of a chunk's documents, from the map's counts and its own pairs' counts."""

    def run(batches):
        for batch in batches:
            # row by row: as Python objects a whole batch would be many times its size
            for row in itertools.chain.from_iterable(batch.slice(i, 1).to_pylist() for i in range(len(batch))):
                read = lambda name: np.frombuffer(row[name], "<i4").astype(np.int64)
                n = len(row["doc"])
                best_sum, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
                told = np.array(row["told"] or [], np.int64)
                pairs = np.array(row["pairs"], np.int64)
                wide = row["wide"]
                for name, ids, counts in (("same", read("same"), None), ("other", read("other"), told)):
                    times, firsts = read(f"{name}_times"), read(f"{name}_firsts")
                    a = ids if counts is None else pairs[ids] // wide
                    count = same_counts[ids] if counts is None else counts[ids]
                    for total, part in ((count_sum, times * count), (best_sum, times * (count == best[a]))):
                        sums = np.concatenate(([0], np.cumsum(part)))
                        total += sums[firsts[1:]] - sums[firsts[:-1]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(row["doc"], pa.int64()),
                        **{name: pa.array(row[name], pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")},
                        "n_best": best_sum,
                        "count_sum": count_sum,
                        "groups_sha256": row["groups"],
                    }
                )

    return run


def align(docs, key="doc_id", text="text", path_a=None, path_b=None):
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    A encodes a space and the text, B the text, to which it adds a space; special tokens' strings are plain
    text. A text that is null, empty, or not what its tokens' bytes join to has no tokens: zeros and ''.
    The count of two linked ids is the number of rows that hold them linked; n_best counts links whose
    count is the greatest of their A id, ties included. Repeated rows and null keys count as rows of their
    own. An empty table gives no rows. Other columns are left out, so their names cannot clash.
    """
    path_a, path_b = path_a or tokenizer_path(BYTE_LEVEL), path_b or tokenizer_path(PIECES)
    size, wide = vocabulary_size(path_a), len(Pieces(path_b).length)
    encoded = written(_encoded(docs, key, text, path_a, path_b), "encoded", **{"parquet.block.size": GROUP})
    same_counts = _vector_sum(encoded, size)
    chunks_ = encoded.filter("chunk IS NOT NULL")
    held = chunks_.select("chunk", F.explode(F.arrays_zip("pairs", "held")).alias("x")).select("chunk", "x.pairs", "x.held")
    counts = written(held.groupBy("pairs").agg(F.sum("held").alias("count")), "counts")
    most = counts.groupBy(F.expr(f"pairs div {wide}").alias("id")).agg(F.max("count").alias("n"))
    best = np.maximum(same_counts, _vocabulary_vector(most, size))
    salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    told = (
        held.select("chunk", "pairs", F.pmod(F.xxhash64("chunk"), F.lit(SALT)).cast("int").alias("salt"))
        .join(salted, ["pairs", "salt"])
        .groupBy("chunk")
        # as many as the chunk's list has, in its order
        .agg(F.array_sort(F.collect_list(F.struct("pairs", "count"))).alias("told"))
        .select("chunk", F.col("told.count").alias("told"))
    )
    joined = chunks_.drop("held", "vector").join(told, "chunk", "left").withColumn("wide", F.lit(wide))
    schema = "key long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return joined.mapInArrow(_finish(same_counts, best), schema).withColumnRenamed("key", key)
