"""Hashed byte 5-grams of whole texts, and small linear models, in numpy."""

import numpy as np

from newsloom.llm.texts import _LOWER, _WORD, mix

SLOTS = 1 << 20
_GRAM = 5


def gram_slots(buffer, offsets):
    """(slot, owner) of each 5-gram of lower-cased text; all that is not a word byte counts as a space.

    Each text is read with one space before and after it, so that the ends of words show.
    """
    lower = _LOWER[buffer]
    lower[~_WORD[lower]] = 32
    n, sizes = len(offsets) - 1, np.diff(offsets)
    padded = np.full(len(lower) + 2 * n, 32, np.uint8)
    owner = np.repeat(np.arange(n), sizes + 2)
    padded[np.arange(len(lower)) + 2 * np.repeat(np.arange(n), sizes) + 1] = lower
    if len(padded) < _GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = len(padded) - _GRAM + 1
    key = np.zeros(last, np.uint64)
    for k in range(_GRAM):
        key |= padded[k : last + k].astype(np.uint64) << np.uint64(8 * k)
    inside = owner[:last] == owner[_GRAM - 1 :]
    return (mix(key[inside]) & np.uint64(SLOTS - 1)).astype(np.int64), owner[:last][inside]


def selected(buffer, offsets, place):
    """(feature, firsts): the distinct features of each text; ``place`` maps a slot to a feature or -1."""
    slots, owner = gram_slots(buffer, offsets)
    feature = place[slots]
    kept = feature >= 0
    width = int(place.max(initial=0)) + 1
    pairs = np.unique(owner[kept] * width + feature[kept])
    return pairs % width, np.searchsorted(pairs, np.arange(len(offsets)) * width)


def row_sums(values, firsts):
    """The sum of each run ``firsts[i]:firsts[i + 1]`` of values."""
    sums = np.concatenate(([0.0], np.cumsum(values)))
    return sums[firsts[1:]] - sums[firsts[:-1]]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
