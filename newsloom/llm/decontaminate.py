"""Benchmark passages in documents: an FM-index per training shard, searched for every benchmark window.

A shard is a run of documents of bounded size. Its words become benchmark word numbers; a word that no
benchmark text has, and a run of benchmark words shorter than the shortest window, become one separator,
which no window can span. Over that sequence an FM-index is built; windows are searched backward through
wavelet-tree ranks, occurrences located by sampled suffix positions, compared with the window's words,
and merged into removal spans.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.llm.fm_index import FMIndex
from newsloom.llm.texts import chunks, ragged, span_hashes, word_spans

WINDOW = 10
SHARD_BYTES = 2 << 20  # text of one index; a longer document is a shard of its own
MAX_BENCHMARK_BYTES = 64 << 20  # the benchmark is sent to every executor


class Benchmark:
    """Words, windows and their items. Items that are equal words share windows."""

    def __init__(self, items):
        texts = [(item, text or "") for item, text in items]
        parts = list(chunks([pa.record_batch({"text": pa.array([t for _, t in texts], pa.string())})]))
        hashes, words, owners, n = [], [], [], 0
        for rows, buffer, offsets in parts:
            lower, starts, ends, firsts = word_spans(buffer, offsets)
            data = lower.tobytes()
            hashes.append(span_hashes(lower, starts, ends))
            words += [data[i:j] for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
            owners.append(np.repeat(np.arange(n, n + rows.num_rows), np.diff(firsts)))
            n += rows.num_rows
        flat = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        self.known, first, number = np.unique(flat, return_index=True, return_inverse=True)
        self.words = [words[i] for i in first]
        owner = np.concatenate([*owners, np.zeros(0, np.int64)])
        found = {}
        for i, (item, _) in enumerate(texts):
            own = tuple((number[owner == i] + 1).tolist())
            for k in range(max(1, len(own) - WINDOW + 1)) if own else ():
                found.setdefault(own[k : k + WINDOW], set()).add(item)
        self.windows = sorted(found)
        self.items = [sorted(found[w], key=str) for w in self.windows]
        self.lengths = np.array([len(w) for w in self.windows], np.int64)
        self.shortest = int(self.lengths.min()) if self.windows else 0
        self.longest = int(self.lengths.max()) if self.windows else 0
        self.phrases = np.zeros((len(self.windows), self.longest), np.int64)
        for row, w in zip(self.phrases, self.windows, strict=True):
            row[self.longest - len(w) :] = w


def load_benchmark(items, key="item_id", text="text"):
    """The benchmark table as one object, for broadcast; refuses one that is no longer small."""
    rows = items.select(F.col(key).alias("key"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"the benchmark has {size} bytes; pass it in parts of at most {MAX_BENCHMARK_BYTES}")
    return Benchmark([tuple(r) for r in rows.collect()])


def _numbers(benchmark, hashes):
    """Each word's benchmark number from 1, or 0."""
    if not len(benchmark.known):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(benchmark.known, hashes), len(benchmark.known) - 1)
    return np.where(benchmark.known[at] == hashes, at + 1, 0)


def find(benchmark, buffer, offsets, sample=16):
    """(n_words of each text, hits): hits are (text, first word, words, window) of all occurrences, and the word spans."""
    lower, starts, ends, firsts = word_spans(buffer, offsets)
    none = np.zeros((0, 3), np.int64)
    if not benchmark.windows or not len(starts):
        return firsts, none, starts, ends
    number = _numbers(benchmark, span_hashes(lower, starts, ends))
    # runs of benchmark words within a text
    known = number > 0
    turn = np.concatenate(([True], known[1:] != known[:-1]))
    turn[firsts[:-1][firsts[:-1] < len(turn)]] = True
    run_at = np.flatnonzero(turn)
    run_size = np.diff(np.append(run_at, len(number)))
    keep = known[run_at] & (run_size >= benchmark.shortest)
    run_at, run_size = run_at[keep], run_size[keep]
    if not len(run_at):
        return firsts, none, starts, ends
    places = np.cumsum(run_size + 1) - run_size  # where each run begins in the sequence, after its separator
    word_of = np.zeros(int(run_size.sum()) + len(run_size) + 1, np.int64)
    body, words = ragged(places, run_size), ragged(run_at, run_size)
    text = np.zeros(len(word_of), np.int64)
    text[body], word_of[body] = number[words], words
    index = FMIndex(text, sample)
    low, high = index.search(benchmark.phrases, benchmark.lengths)
    counts = np.maximum(0, high - low)
    window = np.repeat(np.arange(len(counts)), counts)
    if not len(window):
        return firsts, none, starts, ends
    rows = ragged(low, counts)
    word = word_of[index.locate(rows)]
    hits = np.column_stack((word, benchmark.lengths[window], window))
    # by bytes: equal hashes do not pass for equal words
    data, same, seen = lower.tobytes(), np.ones(len(hits), bool), {}
    spans = np.unique(ragged(hits[:, 0], hits[:, 1]))
    for k in spans.tolist():
        seen[k] = data[starts[k] : ends[k]] == benchmark.words[number[k] - 1]
    if not all(seen.values()):
        same = np.array([all(seen[k] for k in range(a, a + n)) for a, n, _ in hits.tolist()])
    return firsts, hits[same], starts, ends


def _merged(hits, n_words):
    """(hit words as booleans) of the occurrences."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, hits[:, 0], 1)
    np.add.at(edge, hits[:, 0] + hits[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def _reports(benchmark, buffer, offsets):
    """Per text: n_words, n_hit, items (sorted as strings), removal spans as flat byte positions."""
    firsts, hits, starts, ends = find(benchmark, buffer, offsets)
    hit = _merged(hits, len(starts))
    owner = np.searchsorted(firsts, hits[:, 0], "right") - 1
    items = {}
    for text, window in set(zip(owner.tolist(), hits[:, 2].tolist(), strict=True)):
        items.setdefault(text, set()).update(benchmark.items[window])
    total = np.concatenate(([0], np.cumsum(hit)))
    n_hit = total[firsts[1:]] - total[firsts[:-1]]
    spans = {}
    for text in items:
        own = np.flatnonzero(hit[firsts[text] : firsts[text + 1]]) + firsts[text]
        breaks = np.flatnonzero(np.diff(own) > 1)
        first, last = own[np.concatenate(([0], breaks + 1))], own[np.append(breaks, len(own) - 1)]
        spans[text] = list(zip((starts[first] - offsets[text]).tolist(), (ends[last] - offsets[text]).tolist(), strict=True))
    return np.diff(firsts), n_hit, items, spans


def report(docs, benchmark, key="doc_id", text="text"):
    """key, n_words, n_hit, items (ids, sorted as strings) and spans (byte start and end) of every row.

    A window is ``WINDOW`` consecutive words of an item, or all words of a shorter one. A null text, and a
    text or item without words, has none. Repeated rows are reported each.
    """
    held = docs.sparkSession.sparkContext.broadcast(benchmark)  # at most MAX_BENCHMARK_BYTES of text
    kind = dict(docs.dtypes)[key]

    def run(batches):
        for rows, buffer, offsets in chunks(batches, limit=SHARD_BYTES):
            n_words, n_hit, items, spans = _reports(held.value, buffer, offsets)
            n = len(n_words)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array([sorted(map(str, items.get(i, ()))) for i in range(n)], pa.list_(pa.string())),
                    pa.array([[{"start": a, "end": b} for a, b in spans.get(i, ())] for i in range(n)],
                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                ["key", "n_words", "n_hit", "items", "spans"],
            )

    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"
    return out.mapInArrow(run, schema).withColumnRenamed("key", key)


def remove(docs, benchmark, text="text"):
    """``docs`` with the removal spans cut out of ``text``; other columns and clean texts stay as they are."""
    held = docs.sparkSession.sparkContext.broadcast(benchmark)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = []
            only = pa.RecordBatch.from_arrays([batch.column(at)], ["text"])
            for rows, buffer, offsets in chunks([only], limit=SHARD_BYTES):
                spans = _reports(held.value, buffer, offsets)[3]
                own = rows.column(0)
                if spans:
                    data, values = buffer.tobytes(), own.to_pylist()
                    for i, cut in spans.items():
                        whole = data[offsets[i] : offsets[i + 1]]
                        edges = [0, *itertools.chain.from_iterable(cut), len(whole)]
                        values[i] = b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode()
                    own = pa.array(values, own.type)
                texts.append(own)
            columns = list(batch.columns)
            columns[at] = pa.concat_arrays(texts) if texts else columns[at]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
