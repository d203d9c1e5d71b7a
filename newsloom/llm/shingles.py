"""Sets of word shingles, their minimum hashes, and exact Jaccard similarities, in numpy."""

import numpy as np

from newsloom.llm.texts import mix, ragged, word_hashes

SHINGLE = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(buffer, offsets, words=SHINGLE):
    """(hashes, firsts): the distinct shingles of each text, sorted within it.

    A shingle is ``words`` consecutive words; a text of fewer, but not none, has one of all its words.
    """
    hashes, firsts = word_hashes(buffer, offsets)
    sizes = np.diff(firsts)
    counts = np.where(sizes >= words, sizes - words + 1, (sizes > 0).astype(np.int64))
    at = ragged(firsts[:-1], counts)
    owner = np.repeat(np.arange(len(sizes)), counts)
    left = (firsts[1:][owner] - at).astype(np.int64)
    value = np.zeros(len(at), np.uint64)
    padded = np.append(hashes, np.zeros(words, np.uint64))
    for k in range(words):
        value = mix(value * _STEP + np.where(left > k, padded[at + k], np.uint64(k)) + np.uint64(1))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(sizes) + 1))


def set_names(value, firsts):
    """Two 64-bit sums that name each set whatever the order."""
    out = []
    for salt in (1, 2):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value + np.uint64(salt)))))
        out.append((sums[firsts[1:]] - sums[firsts[:-1]]).astype(np.int64))
    return out


def minimums(value, firsts, count):
    """count minimum hashes (32-bit) of each set; an empty set has all ones."""
    out = np.full((len(firsts) - 1, count), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(firsts))
    if len(full):
        short = (value >> np.uint64(32)).astype(np.uint32)
        seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64)).astype(np.uint32).reshape(2, count)
        starts = firsts[:-1][full]
        for k in range(count):
            out[full, k] = np.minimum.reduceat((short ^ seeds[0, k]) * (seeds[1, k] | np.uint32(1)), starts)
    return out


def prefix_keys(found, trees, depth):
    """One 64-bit key of each tree: its first ``depth`` minimum hashes; trees lie side by side."""
    n = len(found)
    part = found.reshape(n, trees, -1)[:, :, :depth].astype(np.uint64)
    key = np.zeros((n, trees), np.uint64) + np.arange(trees, dtype=np.uint64)
    for k in range(depth):
        key = mix(key * _STEP + part[:, :, k] + np.uint64(1))
    return key.astype(np.int64)


def depth_for(threshold, trees, deepest, recall):
    """The deepest prefix at which a pair of that similarity shares one in some tree with that probability."""
    for depth in range(deepest, 1, -1):
        if 1 - (1 - threshold**depth) ** trees >= recall:
            return depth
    return 1
