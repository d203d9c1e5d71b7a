"""Byte-level BPE over whole texts: pre-tokens of the vocabulary by a minimal perfect hash, the rest by a heap.

Each chunk's pre-tokens are hashed at once and made distinct. A minimal perfect hash over the
vocabulary (levels of bit arrays; a key's index is the rank of its bit) answers those that are
vocabulary entries themselves; the others are merged pair by pair with a heap over linked bytes, and
kept in a bounded per-task cache. Ids are decoded again, and the decoded bytes compared with the
input, so that a hash collision cannot pass: such a chunk is encoded anew by its bytes.
"""

import base64
import functools
import heapq
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.llm import pretokens
from newsloom.llm.texts import binary_array, chunks, mix, ragged, span_hashes

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHED = 400_000  # merged pre-tokens that a task keeps; changes speed alone


def vocabulary_path(name=VOCABULARY):
    import public_tokenizers

    return public_tokenizers.path(name)


class PerfectHash:
    """Indices 0..n-1 for n distinct 64-bit keys, and -1 for any other key."""

    def __init__(self, keys, spare=2.0):
        keys = np.asarray(keys, np.uint64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("equal keys")
        self.levels, self.before, left = [], [], keys
        while len(left):
            bits = max(64, int(spare * len(left)))
            slots = self._slots(left, len(self.levels), bits)
            alone = np.bincount(slots, minlength=bits) == 1
            self.before.append(np.concatenate(([0], np.cumsum(alone))) + sum(int(x.sum()) for x in self.levels))
            self.levels.append(alone)
            left = left[~alone[slots]]
        self.keys = np.zeros(len(keys), np.uint64)
        self.keys[self._rank(keys)] = keys

    @staticmethod
    def _slots(keys, level, bits):
        return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(bits)).astype(np.int64)

    def _rank(self, keys):
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.levels, self.before, strict=True)):
            slots = self._slots(keys[left], level, len(bits))
            hit = bits[slots]
            found[left[hit]] = before[slots[hit]]
            left = left[~hit]
        return found

    def find(self, keys):
        found = self._rank(keys)
        if len(self.keys):
            found[(found >= 0) & (self.keys[found] != keys)] = -1
        return found


def merge(token, ranks):
    """The ids of one pre-token: the adjacent pair of least rank is merged until none has a rank."""
    n, get = len(token), ranks.get
    end = list(range(1, n + 1))  # end[i]: where the piece that begins at i ends
    back = list(range(-1, n))  # back[i]: where the piece before it begins
    pair = [get(token[i : i + 2]) for i in range(n - 1)]  # pair[i]: rank of the piece at i with the next
    heap = [rank * n + i for i, rank in enumerate(pair) if rank is not None]
    pair.append(None)
    heapq.heapify(heap)
    while heap:
        rank, i = divmod(heapq.heappop(heap), n)
        if pair[i] != rank:  # one of the two has been merged meanwhile
            continue
        middle = end[i]
        end[i] = stop = end[middle]
        pair[middle] = pair[i] = None
        if stop < n:
            back[stop] = i
            pair[i] = rank = get(token[i : end[stop]])
            if rank is not None:
                heapq.heappush(heap, rank * n + i)
        before = back[i]
        if before >= 0:
            pair[before] = rank = get(token[before:stop])
            if rank is not None:
                heapq.heappush(heap, rank * n + before)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[token[i : end[i]]])
        i = end[i]
    return ids


def rank_file(path):
    """Bytes of each entry of a rank file to its id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Vocabulary:
    """Bytes to ids, with the arrays that look up and decode many ids at once."""

    def __init__(self, ranks):
        self.ranks = ranks
        order = sorted(ranks.items(), key=lambda x: x[1])
        lengths = np.array([len(k) for k, _ in order], np.int64)
        self.flat = np.frombuffer(b"".join(k for k, _ in order), np.uint8)
        stops = np.cumsum(lengths)
        hashes = span_hashes(self.flat, stops - lengths, stops)
        self.hash = PerfectHash(hashes)
        ids = np.array([v for _, v in order], np.int64)
        self.id_at = np.zeros(len(ids), np.int64)
        self.id_at[self.hash.find(hashes)] = ids
        self.length, self.start = np.zeros((2, ids.max(initial=-1) + 1), np.int64)
        self.length[ids], self.start[ids] = lengths, stops - lengths

    def decode(self, ids):
        """(bytes of all ids, number of bytes of each id)."""
        lengths = self.length[ids]
        return self.flat[ragged(self.start[ids], lengths)], lengths


class Rows:
    """A growing open-addressed table: distinct 64-bit keys to rows 0, 1, 2, ..."""

    def __init__(self, size=1 << 16):
        self.n = 0
        self.keys, self.rows = np.zeros(size, np.uint64), np.full(size, -1, np.int32)

    def _walk(self, keys, enter):
        """The slot of each key; with ``enter`` a free one where it is absent (keys distinct), else -1."""
        mask = np.int64(len(self.keys) - 1)
        slots = keys.astype(np.int64) & mask
        left = np.arange(len(keys))
        while len(left):
            at = slots[left]
            free = self.rows[at] < 0
            done = ~free & (self.keys[at] == keys[left])
            if enter:
                own = np.flatnonzero(free)
                own = own[np.unique(at[own], return_index=True)[1]]
                self.keys[at[own]], self.rows[at[own]] = keys[left[own]], self.n + left[own]
                done[own] = True
                free[:] = False
            slots[left[free]] = -1
            left = left[~(done | free)]
            # a key that lost its slot to another new key looks at the next one
            slots[left] = (slots[left] + 1) & mask
        return slots

    def find(self, keys):
        slots = self._walk(keys, False)
        return np.where(slots >= 0, self.rows[slots], -1)

    def add(self, keys):
        """Enters distinct absent keys under the next rows."""
        if 2 * (self.n + len(keys)) > len(self.keys):
            size = len(self.keys)
            while 2 * (self.n + len(keys)) > size:
                size *= 2
            held = np.flatnonzero(self.rows >= 0)
            old = self.keys[held][np.argsort(self.rows[held])]
            self.__init__(size)
            self._walk(old, True)
            self.n = len(old)
        self._walk(keys, True)
        self.n += len(keys)


class Encoder:
    """Encodes chunks. ``merge_all(data, starts, ends)`` gives the ids of pre-tokens; ``whole`` asks the vocabulary first."""

    def __init__(self, known, merge_all, whole=True, cached=CACHED):
        self.known, self.merge_all, self.whole, self.cached = known, merge_all, whole, cached
        self.reset()

    def reset(self):
        """Rows of the ids: the vocabulary's entries by their perfect hash, then what was merged."""
        self.first = len(self.known.id_at) if self.whole else 0
        self.table = Rows()
        self.flat, self.stops = self.known.id_at[: self.first].astype(np.int32), np.arange(self.first + 1)

    def encode(self, buffer, offsets):
        """(ids, firsts): all ids of a chunk; text i has ``ids[firsts[i]:firsts[i + 1]]``."""
        starts = pretokens.split(buffer, offsets)
        ends = np.append(starts[1:], len(buffer))
        keys = span_hashes(buffer, starts, ends)
        rows = self.known.hash.find(keys) if self.whole else np.full(len(keys), -1)
        missing = np.flatnonzero(rows < 0)
        if self.table.n > self.cached:
            self.reset()
        found = self.table.find(keys[missing])
        fresh = missing[found < 0]
        if len(fresh):
            new, at = np.unique(keys[fresh], return_index=True)
            own = self.merge_all(buffer.tobytes(), starts[fresh[at]].tolist(), ends[fresh[at]].tolist())
            self.table.add(new)
            counts = np.fromiter(map(len, own), np.int64, len(own))
            self.stops = np.concatenate((self.stops, self.stops[-1] + np.cumsum(counts)))
            self.flat = np.concatenate((self.flat, np.fromiter(itertools.chain.from_iterable(own), np.int32, counts.sum())))
            found[found < 0] = self.table.find(keys[fresh])
        rows[missing] = self.first + found
        begin = self.stops[rows]
        lengths = self.stops[rows + 1] - begin
        firsts = np.concatenate(([0], np.cumsum(lengths)))[np.searchsorted(starts, offsets)]
        return self.flat[ragged(begin, lengths)], firsts

    def encode_by_bytes(self, buffer, offsets):
        """The same without hashes."""
        starts = pretokens.split(buffer, offsets)
        ends = np.append(starts[1:], len(buffer))
        ids = self.merge_all(buffer.tobytes(), starts.tolist(), ends.tolist())
        firsts = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64)[np.searchsorted(starts, offsets)]
        return np.array([y for x in ids for y in x], np.int32), firsts

    def exact(self, buffer, offsets):
        """(ids, firsts, decoded, sizes); the decoded bytes are those of the chunk."""
        ids, firsts = self.encode(buffer, offsets)
        decoded, sizes = self.known.decode(ids)
        if not np.array_equal(decoded, buffer):
            ids, firsts = self.encode_by_bytes(buffer, offsets)
            decoded, sizes = self.known.decode(ids)
        return ids, firsts, decoded, sizes


@functools.lru_cache(maxsize=2)
def heap_encoder(path):
    """One per Python worker, so that its kept pre-tokens serve later tasks too."""
    known = Vocabulary(rank_file(path))

    def merge_all(data, starts, ends):
        tokens = [data[i:j] for i, j in zip(starts, ends, strict=True)]
        return [[known.ranks[x]] if x in known.ranks else merge(x, known.ranks) for x in tokens]

    return Encoder(known, merge_all)


def encode(docs, key="doc_id", text="text", path=None, decoded=False):
    """key, n_tokens, ids (unsigned 32-bit little-endian), with ``decoded`` also the decoded bytes.

    One row per row of ``docs``, repeated rows included; other columns are left out, so their
    names cannot clash. A null or empty text has no ids; a null key stays null.
    """
    path = path or vocabulary_path()
    kind = dict(docs.dtypes)[key]

    def run(batches):
        encoder = heap_encoder(path)
        for rows, buffer, offsets in chunks(batches):
            ids, firsts, back, sizes = encoder.exact(buffer, offsets)
            columns = {
                "key": rows.column(0),
                "n_tokens": pa.array(np.diff(firsts)),
                "ids": binary_array(ids.astype("<u4").view(np.uint8), firsts * 4),
            }
            if decoded:
                columns["decoded"] = binary_array(back, np.concatenate(([0], np.cumsum(sizes)))[firsts])
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"key {kind}, n_tokens long, ids binary" + ", decoded binary" * decoded
    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)
    return out.withColumnRenamed("key", key)


def decode(encoded, path=None):
    """Adds ``decoded`` (bytes) to rows with ``ids``; null ids give null."""
    path = path or vocabulary_path()

    @F.pandas_udf("binary")
    def run(column: pd.Series) -> pd.Series:
        known = heap_encoder(path).known
        return column.map(lambda x: None if x is None else known.decode(np.frombuffer(x, "<u4"))[0].tobytes())

    return encoded.withColumn("decoded", run("ids"))
