"""CRC-32 of many spans of a byte buffer at once, and of spans joined by one more byte, in numpy."""

import functools
import zlib

import numpy as np

#: Spans up to this many bytes go through the tables; longer ones through zlib.
SHORT = 64


@functools.lru_cache(maxsize=1)
def _tables():
    """(step, shift): the table of one byte, and of 0 to SHORT zero bytes for each byte of a value."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    shift = np.zeros((SHORT + 1, 4, 256), np.uint32)
    for part in range(4):
        shift[0, part] = np.arange(256, dtype=np.uint32) << np.uint32(8 * part)
    for n in range(SHORT):
        shift[n + 1] = step[shift[n] & 255] ^ (shift[n] >> np.uint32(8))
    return step, shift.ravel()


def span_crcs(buffer, starts, ends):
    """The unsigned CRC-32 of each span."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint32)
    long_ones = np.flatnonzero(lengths > SHORT)
    short = np.where(lengths > SHORT, 0, lengths).astype(np.uint8)
    order = np.argsort(short, kind="stable")[::-1]  # longest first: a step works on the front of the arrays
    longer = len(short) - np.cumsum(np.bincount(short, minlength=SHORT + 1))
    at, state = starts[order], np.full(len(starts), 0xFFFFFFFF, np.uint32)
    step = _tables()[0]
    for k in range(SHORT):
        m = longer[k]
        if not m:
            break
        front = state[:m]
        state[:m] = step[(front & 255).astype(np.uint8) ^ buffer[at[:m] + k]] ^ (front >> np.uint32(8))
    out[order] = ~state
    for i in long_ones.tolist():
        out[i] = zlib.crc32(buffer[starts[i] : ends[i]])
    return out


def joined_crcs(buffer, left, crcs, starts, ends, byte=32):
    """CRC-32 of span left[k], ``byte`` and span left[k] + 1, from the spans' own CRCs."""
    step, shift = _tables()
    first, right = crcs[left], left + 1
    mid = ~(step[((~first) & 255) ^ byte] ^ ((~first) >> np.uint32(8)))
    lengths = (ends - starts)[right]
    at = np.minimum(lengths, SHORT) * 1024
    out = crcs[right].copy()
    for part in range(4):
        out ^= shift[at + (256 * part + ((mid >> np.uint32(8 * part)) & 255)).astype(np.int64)]
    for i in np.flatnonzero(lengths > SHORT).tolist():
        out[i] = zlib.crc32(buffer[starts[right[i]] : ends[right[i]]], int(mid[i]))
    return out
