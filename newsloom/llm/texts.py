"""Whole texts as byte buffers inside a task: chunks of rows, words, and rolling 64-bit hashes.

A chunk is a run of rows whose texts together take at most ``CHUNK_BYTES``, or one longer text, so
that the arrays of one step stay small; texts are never cut. A null text is an empty one.
"""

import ctypes
import functools

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def give_back():
    """Hand freed memory to the system: a reused Python worker else keeps the most that any task took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def chunks(batches, column="text", limit=CHUNK_BYTES):
    """(rows, buffer, offsets) over Arrow batches; text i is ``buffer[offsets[i]:offsets[i + 1]]``.

    Freed memory is given back when the batches end.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
            yield (
                batch.slice(first, last - first),
                data[offsets[first] : offsets[last]],
                offsets[first : last + 1] - offsets[first],
            )
            first = last
    give_back()


@functools.lru_cache(maxsize=1)
def _powers(n):
    steps = np.full(n, _BASE, np.uint64)
    steps[0] = 1
    back = np.full(n, _INVERSE, np.uint64)
    back[0] = 1
    return np.multiply.accumulate(steps), np.multiply.accumulate(back)


def mix(h):
    """Spreads the bits of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(buffer, starts, ends):
    """A 64-bit hash of each span of bytes that depends on its content alone."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = CHUNK_BYTES
    while size < len(buffer):
        size *= 2
    power, back = _powers(size)
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * power[: len(buffer)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * back[starts])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def word_spans(buffer, offsets):
    """Lower-cased (A-Z) buffer and the byte spans of its words: runs of digits, a-z and non-ASCII.

    Returns (lower, starts, ends, firsts); the words of text i are ``firsts[i]:firsts[i + 1]``.
    """
    lower = _LOWER[buffer]
    inside = _WORD[lower]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(buffer))]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return lower, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buffer, offsets):
    """(hashes, firsts): the hash of every word, and where each text's words begin."""
    lower, starts, ends, firsts = word_spans(buffer, offsets)
    return span_hashes(lower, starts, ends), firsts


def ragged(starts, lengths):
    """Indices start, start + 1, ... of each span, one span after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    jumps = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return jumps + np.arange(total)


def binary_array(data, offsets):
    """An Arrow binary array over one flat byte buffer."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)]
    ).cast(pa.binary())
