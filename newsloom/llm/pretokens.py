"""Pre-tokens of byte-level BPE, split over a whole chunk at once.

The published pattern (contractions; a letter, number or other run with one leading space; white
space) is applied by character class instead of by a matcher: class changes begin pre-tokens, a
single space before a run joins it, and the last white-space character before a run stands alone.
"""

import functools

import numpy as np
import regex

OTHER, LETTER, NUMBER, WHITE, SPACE = range(5)


@functools.lru_cache(maxsize=1)
def _classes():
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.zeros(0x110000, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", WHITE)):
        for found in regex.finditer(pattern, points):
            table[ord(points[found.start()]) : ord(points[found.end() - 1]) + 1] = kind
    table[0xD800:0xE000] = OTHER
    table[32] = SPACE
    return table


def code_points(buffer):
    """(byte positions, code points) of the characters of valid UTF-8."""
    at = np.flatnonzero((buffer & 0xC0) != 0x80)
    lead = buffer[at]
    points = lead.astype(np.int32)
    for low, high, keep, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0xF8, 0x07, 3)):
        which = np.flatnonzero((lead >= low) & (lead < high))
        value = (lead[which] & keep).astype(np.int32)
        for k in range(1, more + 1):
            value = (value << 6) | (buffer[at[which] + k] & 0x3F)
        points[which] = value
    return at, points


def split(buffer, offsets):
    """Byte positions at which the pre-tokens of a chunk begin; none spans two texts."""
    if not len(buffer):
        return np.zeros(0, np.int64)
    at, points = code_points(buffer)
    kind = _classes()[points]
    white = kind >= WHITE
    run = np.minimum(kind, WHITE)
    edge = np.zeros(len(at) + 1, bool)  # a text begins here
    edge[np.searchsorted(at, offsets)] = True
    turn = edge[:-1].copy()
    turn[1:] |= run[1:] != run[:-1]
    turn[0] = True
    begin = turn.copy()
    last_white = white.copy()
    last_white[-1] = False
    last_white[:-1] &= ~white[1:] & ~edge[1:-1]
    begin |= last_white
    joined = np.flatnonzero(last_white & (kind == SPACE))
    begin[joined + 1] = False
    quotes = np.flatnonzero((points == 39) & begin & turn)
    quotes = quotes[quotes + 1 < len(at)]
    quotes = quotes[turn[quotes + 1] & ~edge[quotes + 1] & (kind[quotes + 1] == LETTER)]
    if len(quotes):
        second = points[quotes + 1]
        third = np.where(quotes + 2 < len(at), points[np.minimum(quotes + 2, len(at) - 1)], 0)
        third[edge[np.minimum(quotes + 2, len(at))]] = 0
        s, t, m, d, r, v, e, l = map(ord, "stmdrvel")
        short = np.isin(second, (s, t, m, d))
        long = (((second == r) | (second == v)) & (third == e)) | ((second == l) & (third == l))
        begin[quotes[short | long] + 1] = False
        rest = np.concatenate((quotes[short] + 2, quotes[long] + 3))
        begin[rest[rest < len(at)]] = True
    return at[begin]
