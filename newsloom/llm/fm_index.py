"""An FM-index over a sequence of small integers, in numpy: suffix array, wavelet-tree ranks, sampled positions."""

import numpy as np


def suffix_array(text):
    """Suffix positions in order, by prefix doubling; only suffixes still tied are sorted again."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1

    def starts_of(values):
        return np.concatenate(([True], values[1:] != values[:-1]))

    head = starts_of(rank[order])
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))  # rank: place of the first equal suffix
    tied = np.flatnonzero(~(head & np.append(head[1:], True)))
    while len(tied):
        at = order[tied]
        after = at + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        by = np.lexsort((second, rank[at]))
        at, second = at[by], second[by]
        first = rank[at]
        order[tied] = at
        own = starts_of(first) | starts_of(second)
        rank[at] = tied[np.maximum.accumulate(np.where(own, np.arange(len(at)), 0))]
        # tied: where neither this nor the next begins a new run
        alone = own & np.append(own[1:], True)
        tied = tied[~alone]
        step *= 2
    return order


class WaveletTree:
    """Ranks of symbols in a sequence: one bit row a level, stable-partitioned by the bits above it."""

    def __init__(self, sequence, width):
        self.levels = max(1, int(width - 1).bit_length())
        self.ones = []
        self.zeros = []
        current = sequence
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(len(bit) - self.ones[-1][-1]))
            current = np.concatenate((current[bit == 0], current[bit == 1]))
        # where each symbol's run begins after the last level: symbols stand there by their reversed bits
        order = np.arange(1 << self.levels)
        reverse = sum(((order >> k) & 1) << (self.levels - 1 - k) for k in range(self.levels))
        counts = np.bincount(sequence, minlength=1 << self.levels)
        self.begin = np.zeros(1 << self.levels, np.int64)
        by = np.argsort(reverse)
        self.begin[by] = np.concatenate(([0], np.cumsum(counts[by])[:-1]))

    def rank(self, symbols, places):
        """How often symbols[i] occurs before places[i]."""
        at = np.asarray(places, np.int64)
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            ones = self.ones[k][at]
            at = np.where((symbols >> level) & 1, self.zeros[k] + ones, at - ones)
        return at - self.begin[symbols]


class FMIndex:
    """Counts and places of phrases in ``text`` (integers from 1; 0 separates and matches nothing)."""

    def __init__(self, text, sample=16):
        text = np.append(text + 1, 0)  # the one least symbol, at the end, makes suffixes and rotations sort alike
        width = int(text.max()) + 1
        order = suffix_array(text)
        self.n = len(text)
        bwt = text[order - 1]
        self.tree = WaveletTree(bwt, width)
        self.bwt = bwt.astype(np.int32)
        counts = np.bincount(text, minlength=width)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        kept = order % sample == 0
        self.kept_before = np.concatenate(([0], np.cumsum(kept, dtype=np.int32)))
        self.kept = kept
        self.places = order[kept]

    def search(self, phrases, lengths):
        """Row ranges [low, high) of phrases (right-aligned rows of symbols; all symbols below the width)."""
        count, longest = phrases.shape
        low, high = np.zeros(count, np.int64), np.full(count, self.n, np.int64)
        width = len(self.before) - 1
        for k in range(longest):
            active = np.flatnonzero((k < lengths) & (high > low))
            if not len(active):
                break
            symbols = phrases[active, longest - 1 - k] + 1
            known = symbols < width
            high[active[~known]] = low[active[~known]]
            active, symbols = active[known], symbols[known]
            low[active] = self.before[symbols] + self.tree.rank(symbols, low[active])
            high[active] = self.before[symbols] + self.tree.rank(symbols, high[active])
        return low, high

    def locate(self, rows):
        """Text positions of rows: steps back through the text up to a sampled position."""
        rows = np.asarray(rows, np.int64).copy()
        steps = np.zeros(len(rows), np.int64)
        left = np.flatnonzero(~self.kept[rows])
        while len(left):
            symbols = self.bwt[rows[left]].astype(np.int64)
            rows[left] = self.before[symbols] + self.tree.rank(symbols, rows[left])
            steps[left] += 1
            left = left[~self.kept[rows[left]]]
        return (self.places[self.kept_before[rows]] + steps) % self.n
