"""Decision trees and forests grown level by level from histograms of sparse entries.

All trees of a grid search grow together. Values are cut into cells once: a row keeps the cells of its entries but those
that zero lies in too, and these rows are persisted. A level is one read of them: each task follows its rows down the trees
so far and adds up (cell, node, fold, label); what no entry fills is the node's total less the rest. So a row costs its
entries, not its slots.

* A tree of less depth is the top of a deeper one, and a smaller forest the first trees of a larger one, so
  depths and forest sizes of the grid need no growing of their own.
* The models of the folds grow beside that of all rows. Nodes that the same splits lead to are one node for all settings
  and folds: their rows are added up once, by fold, and each model leaves its fold out of the sums.
* The cells of a slot lie between the thresholds of all settings; a setting only splits at its own.
* Sums are exchanged as arrays, dealt by blocks of cells.
* Bootstrap weights come from the row's digest: a recomputed partition draws the same sample.

Thresholds, at most ``bins - 1`` a slot, lie between values of a bounded number of rows (``SPLIT_ROWS``, of
least digest); histograms, gains and scores are those of all rows.
"""

import itertools
import json
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.operators.sparse import Entries, column, entry_columns, entry_rows

SPLIT_ROWS = 10_000
HELD = 1 << 21  # sums a task holds before it adds up equal ones
ROOM = 1 << 22  # numbers that a task looks at in one go
BLOCK = 1 << 21  # sums of a block, if all were there


def thresholds_of(values, counts, total, bins):
    """Split points of one slot: midpoints of neighbouring values, all of them or about ``total / bins`` rows apart.

    ``values`` are the distinct values but zero, ``total`` counts the rows that lack one as zeros too.
    """
    order = np.argsort(values)
    values, counts = np.asarray(values, float)[order], np.asarray(counts, float)[order]
    zeros = total - counts.sum()
    if zeros > 0:
        at = int(np.searchsorted(values, 0.0))
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, zeros)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < bins:
        return middle
    # a split goes before the value that leads away from the next multiple of the stride
    seen, stride, kept, target = np.cumsum(counts), total / bins, [], total / bins
    for k in range(len(middle)):
        if abs(seen[k] - target) < abs(seen[k + 1] - target):
            kept.append(middle[k])
            target += stride
    return np.array(kept)


@dataclass
class Bins:
    """Thresholds of all slots: slot k has ``points[firsts[k]:firsts[k + 1]]``."""

    firsts: np.ndarray
    points: np.ndarray


@dataclass
class Cells:
    """The thresholds of all settings together cut a slot's values into cells, numbered over all slots.

    Slots without thresholds have no cells.
    """

    first: np.ndarray  # by slot
    count: np.ndarray  # by slot
    slot: np.ndarray  # by cell
    point: np.ndarray  # by cell: the threshold that ends it, infinity for a slot's last
    may: list  # by setting and cell: whether the setting has that threshold

    @classmethod
    def of(cls, bins_settings, size):
        slots = [np.repeat(np.arange(size), np.diff(bins.firsts)) for bins in bins_settings]
        points = [bins.points[: bins.firsts[-1]] for bins in bins_settings]
        slot, point = np.concatenate(slots), np.concatenate(points)
        order = np.lexsort((point, slot))
        slot, point = slot[order], point[order]
        new = np.ones(len(slot), bool)
        new[1:] = (slot[1:] != slot[:-1]) | (point[1:] != point[:-1])
        slot, point = slot[new], point[new]
        count = np.bincount(slot, minlength=size)
        # a slot has one cell more than thresholds
        at = np.arange(len(slot)) + (np.cumsum(count > 0) - 1)[slot]
        count += count > 0
        cells = cls(np.cumsum(count) - count, count, np.repeat(np.arange(size), count), np.full(count.sum(), np.inf), [])
        cells.point[at] = point
        for slot, point in zip(slots, points, strict=True):
            may = np.zeros(len(cells.slot), bool)
            may[cells.number(slot, point)] = True
            cells.may.append(may)
        return cells

    def number(self, slots, values):
        """The cell of each value: as many thresholds of its slot lie below it as cells of the slot before that."""
        out = self.first[slots]
        rows = np.flatnonzero(self.count[slots])
        while len(rows):
            rows = rows[self.point[out[rows]] < values[rows]]
            out[rows] += 1
        return out

    def zero(self, slots):
        return self.number(slots, np.zeros(len(slots)))


def least_digests(rows, limit):
    """The ``limit`` rows of least digest and their number, without a sort of all rows."""
    part = F.shiftright("digest", 52)
    n, at = 0, None
    for r in sorted(rows.groupBy(part.alias("part")).count().collect()):  # at most 4,096
        if n + r["count"] >= limit:
            at = r.part
            break
        n += r["count"]
    if at is None:
        return rows, n
    digests = rows.filter(part == at).groupBy("digest").count().orderBy("digest").limit(limit)
    for r in digests.collect():
        n += r["count"]
        if n >= limit:
            break
    least = rows.filter(F.col("digest") <= r.digest)
    return (least if n == limit else least.orderBy("digest").limit(limit)), limit


def find_bins(rows, size, bins_settings, limit=SPLIT_ROWS):
    """One ``Bins`` a setting, from the ``limit`` rows of least digest."""

    def run(batches):
        for batch in batches:
            entries = Entries.of(batch)
            order = np.lexsort((entries.value, entries.slot))
            slot, value = entries.slot[order], entries.value[order]
            new = np.flatnonzero((np.diff(slot, prepend=-1) != 0) | (np.diff(value, prepend=0) != 0))
            n = np.diff(new, append=len(slot))
            yield pa.RecordBatch.from_pydict({"slot": slot[new], "value": value[new], "n": n})

    some, total = least_digests(rows, limit)
    found = some.select("slots", "values").mapInArrow(run, "slot long, value double, n long")
    table = found.groupBy("slot", "value").agg(F.sum("n").alias("n")).toArrow()  # at most the entries of the limited rows
    slot, value, n = (table[name].to_numpy() for name in ("slot", "value", "n"))
    order = np.lexsort((value, slot))
    slot, value, n = slot[order], value[order], n[order]
    starts = np.flatnonzero(np.diff(slot, prepend=-1))
    distinct = np.diff(starts, append=len(slot))
    lacking = total - np.add.reduceat(n, starts) if len(starts) else np.zeros(0)
    # all values with the zeros of rows that lack one
    every = np.concatenate((slot, slot[starts][lacking > 0])), np.concatenate((value, np.zeros((lacking > 0).sum())))
    order = np.lexsort((every[1], every[0]))
    every = every[0][order], every[1][order]
    within = every[0][1:] == every[0][:-1]
    middle, owner = ((every[1][:-1] + every[1][1:]) / 2)[within], every[0][1:][within]
    out = []
    for bins in bins_settings:
        bins = min(bins, max(total, 2))
        many = distinct + (lacking > 0) > bins
        taken = [thresholds_of(value[k : k + d], n[k : k + d], total, bins) for k, d in zip(starts[many], distinct[many], strict=True)]
        few = ~np.isin(owner, slot[starts[many]])
        slots = np.concatenate((owner[few], np.repeat(slot[starts[many]], [len(x) for x in taken])))
        points = np.concatenate((middle[few], *taken))
        sizes = np.bincount(slots, minlength=size)
        out.append(Bins(np.concatenate(([0], np.cumsum(sizes))), points[np.argsort(slots, kind="stable")]))
    return out


def cut_rows(rows, sent):
    """Label, fold, digest and the cells of the entries, but those of cells that zero lies in."""

    def run(batches):
        cells = sent.value
        zero = cells.zero(np.arange(len(cells.count)))
        for batch in batches:
            entries = Entries.of(batch)
            cell = cells.number(entries.slot, entries.value)
            kept = (cells.count[entries.slot] > 0) & (cell != zero[entries.slot])
            ends = np.cumsum(np.bincount(entries.owner[kept], minlength=len(batch)))
            own = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(cell[kept], pa.int32()))
            columns = {name: pa.array(column(batch, name, np.int64)) for name in ("label", "fold", "digest")}
            yield pa.RecordBatch.from_pydict(columns | {"cells": own})

    return rows.select("label", "fold", "digest", "slots", "values").mapInArrow(run, "label long, fold long, digest long, cells array<int>")


class Tree:
    """A binary tree in heap order: node k has the children 2k and 2k + 1, the root is 1."""

    def __init__(self, depth, labels):
        self.depth = depth
        self.slot = np.full(2 << depth, -1)
        self.point = np.zeros(2 << depth)
        self.counts = np.zeros((2 << depth, labels))

    def split(self, node, slot, point, left):
        self.slot[node], self.point[node] = slot, point
        self.counts[2 * node], self.counts[2 * node + 1] = left, self.counts[node] - left

    def find(self, entries, depth=None):
        """The node that each row ends in, ``depth`` levels down at most."""
        node = np.ones(entries.rows, np.int64)
        for _ in range(self.depth if depth is None else depth):
            rows = np.flatnonzero(self.slot[node] >= 0)
            if not len(rows):
                break
            at = node[rows]
            value = entries.look_up(rows, self.slot[at])
            # a node of an earlier level that is no split has stopped its rows
            node[rows] = 2 * at + (value > self.point[at])
        return node

    def shares_of_nodes(self):
        return self.counts / np.maximum(self.counts.sum(1, keepdims=True), 1e-300)

    def shares(self, entries, depth=None):
        return self.shares_of_nodes()[self.find(entries, depth)]

    def to_list(self):
        return [self.depth, self.slot.tolist(), self.point.tolist(), self.counts.tolist()]

    @classmethod
    def from_list(cls, saved):
        tree = cls(saved[0], len(saved[3][0]))
        tree.slot, tree.point, tree.counts = map(np.array, saved[1:])
        return tree


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])


def bootstrap(digest, tree, seed):
    """How often each row is drawn for a tree: Poisson of mean 1, from its digest."""
    salt = _mixed(np.uint64([seed * 1_000_003 + tree + 1]))
    drawn = _mixed(digest.astype(np.int64).view(np.uint64) ^ salt) >> np.uint64(11)
    return np.searchsorted(_POISSON, drawn / float(1 << 53), "right").astype(float)


def node_slots(seed, tree, node, size, count):
    """The slots that a node of a tree may split on."""
    return np.random.default_rng([seed, tree, node]).choice(size, count, replace=False)


def gini(counts, total):
    """Gini impurity over the last axis."""
    out = np.ones(counts.shape[:-1])
    for k in range(counts.shape[-1]):
        share = counts[..., k] / np.maximum(total, 1e-300)
        out = out - share * share
    return out


class _Paths:
    """Where the trees lead the rows, all trees at once."""

    def __init__(self, trees, cells):
        slot = np.stack([tree.slot for tree in trees])
        used = np.unique(slot[slot >= 0])
        self.zero = cells.zero(used)
        self.column = np.full(len(cells.count), -1)
        self.column[used] = np.arange(len(used))
        inner = np.nonzero(slot >= 0)
        self.at, self.cut = np.full(slot.shape, -1), np.zeros(slot.shape, np.int64)
        self.at[inner] = self.column[slot[inner]]
        self.cut[inner] = cells.number(slot[inner], np.stack([tree.point for tree in trees])[inner])

    def find(self, part, depth):
        """The nodes (by tree and row) that rows reach 0, 1, ... ``depth`` levels down."""
        values = np.tile(self.zero, (part.rows, 1))
        column = self.column[part.slot]
        known = np.flatnonzero(column >= 0)
        values[part.owner[known], column[known]] = part.cell[known]
        tree, row = np.arange(len(self.at))[:, None], np.arange(part.rows)
        out = [np.ones((len(self.at), part.rows), np.int64)]
        for _ in range(depth):
            node = out[-1]
            at = self.at[tree, node]
            # a node of an earlier level that is no split has stopped its rows
            moved = 2 * node + (values[row, at] > self.cut[tree, node]) if len(self.zero) else node
            out.append(np.where(at >= 0, moved, node))
        return out


@dataclass
class _Part:
    """Some rows of a batch."""

    label: np.ndarray
    fold: np.ndarray
    digest: np.ndarray
    owner: np.ndarray
    cell: np.ndarray
    slot: np.ndarray

    @property
    def rows(self):
        return len(self.label)

    def only(self, kept):
        """The chosen rows."""
        own = kept[self.owner]
        owner = (np.cumsum(kept) - 1)[self.owner[own]]
        return _Part(self.label[kept], self.fold[kept], self.digest[kept], owner, self.cell[own], self.slot[own])

    @classmethod
    def all_of(cls, batch, cells, width, copies):
        """The batch in parts of about ROOM numbers, at ``width`` a row or ``copies`` an entry."""
        label, fold, digest = (column(batch, name, np.int64) for name in ("label", "fold", "digest"))
        own = batch.column(batch.schema.get_field_index("cells"))
        ends, flat = own.offsets.to_numpy() - own.offsets[0].as_py(), own.flatten().to_numpy(zero_copy_only=False)
        step = max(1, ROOM // max(1, width, copies * len(flat) // max(1, len(batch))))
        for k in range(0, len(batch), step):
            to = ends[k : k + step + 1]
            cell = flat[to[0] : to[-1]].astype(np.int64)
            owner = np.repeat(np.arange(len(to) - 1), np.diff(to))
            yield cls(label[k : k + step], fold[k : k + step], digest[k : k + step], owner, cell, cells.slot[cell])


@dataclass
class _Plan:
    """What tasks need for one level."""

    level: int
    models: list  # (setting, fold left out or -1, number of the tree), one for each tree that grows; tree by tree
    trees: list
    shared: np.ndarray  # by model and node of the level: the number of the node, the same for the same splits; -1: closed
    totals: np.ndarray  # rows by number, fold and label
    subset: int  # slots a node may use, 0 for all
    labels: int
    folds: int
    seed: int
    sampled: bool
    edges: np.ndarray  # first cells of the blocks

    @property
    def each(self):
        """Models a tree: settings times folds."""
        return len(self.models) // (1 + self.models[-1][2])

    def places(self):
        """By number: which node of which tree that is."""
        out = np.zeros(len(self.totals), np.int64)
        for (_, _, tree), shared in zip(self.models, self.shared, strict=True):
            out[shared[shared >= 0]] = (tree << self.level) + np.flatnonzero(shared >= 0)
        return out

    def chosen(self, size):
        """Where a slot's places begin, and the places that may use it, slot by slot."""
        places = np.unique(self.places())
        own = [node_slots(self.seed, k >> self.level, (1 << self.level) + k % (1 << self.level), size, self.subset) for k in places.tolist()]
        slot, place = np.concatenate(own), np.repeat(places, self.subset)
        return np.concatenate(([0], np.cumsum(np.bincount(slot, minlength=size)))), place[np.argsort(slot, kind="stable")]


def _summed(held):
    """Ascending keys and their sums."""
    key, n = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(key, kind="stable")  # runs in order are merged
    key, n = key[order], n[order]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    return key[new], np.add.reduceat(n, new) if len(new) else n


def _histograms(sent, cells_sent):
    """Rows by cell, node, fold and label, for the entries that are there: keys and sums by block."""

    def run(batches):
        plan, cells = sent.value, cells_sent.value
        paths, first = _Paths(plan.trees, cells), 1 << plan.level
        left_out, tree = (np.array([m[k] for m in plan.models])[:, None] for k in (1, 2))
        model, places = np.arange(len(plan.models))[:, None], plan.places()
        starts, chosen = plan.chosen(len(cells.count)) if plan.subset else (None, None)
        wide = len(plan.totals) * plan.folds * plan.labels
        held, size = [], 0

        def blocks(key, n):
            to = np.append(np.searchsorted(key, plan.edges * wide), len(key))
            some = np.flatnonzero(np.diff(to))
            sums = {"key": [key[to[k] : to[k + 1]].tobytes() for k in some], "n": [n[to[k] : to[k + 1]].tobytes() for k in some]}
            return pa.RecordBatch.from_pydict({"block": some} | sums)

        for batch in batches:
            for part in _Part.all_of(batch, cells, len(paths.zero) + len(plan.models), plan.each):
                node = paths.find(part, plan.level)[-1]
                shared = np.where(node >= first, plan.shared[model, np.maximum(node - first, 0)], -1)
                fold = np.minimum(part.fold, plan.folds - 1)
                shared[left_out == part.fold] = -1
                if plan.sampled:
                    drawn = np.stack([bootstrap(part.digest, t, plan.seed) for t in range(tree[-1, 0] + 1)]).astype(np.int64)
                    shared[drawn[tree[:, 0]] == 0] = -1
                # each number once for a row
                shared = np.sort(shared.reshape(-1, plan.each, part.rows), axis=1)
                shared[:, :-1][shared[:, :-1] == shared[:, 1:]] = -1
                if plan.subset:
                    n = np.diff(starts)[part.slot]
                    entry = np.repeat(np.arange(len(n)), n)
                    place = chosen[np.arange(len(entry)) + np.repeat(starts[part.slot] - np.cumsum(n) + n, n)]
                for t, k in np.argwhere((shared >= 0).any(2)):
                    number = shared[t, k]
                    if plan.subset:
                        own = place >> plan.level == t
                        at, to = entry[own], place[own]
                        at = at[places[number[part.owner[at]]] == to]
                        at = at[number[part.owner[at]] >= 0]
                    else:
                        at = np.flatnonzero(number[part.owner] >= 0)
                    row = part.owner[at]
                    key = ((part.cell[at] * len(plan.totals) + number[row]) * plan.folds + fold[row]) * plan.labels + part.label[row]
                    if plan.sampled:
                        key = np.repeat(key, drawn[t][row])
                    key.sort()
                    new = np.flatnonzero(np.diff(key, prepend=-1))
                    held.append((key[new], np.diff(new, append=len(key))))
                    size += len(new)
                if size > HELD:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield blocks(*held[0])
                        held, size = [], 0
        if size:
            yield blocks(*_summed(held))

    return run


def _best_splits(sent, cells_sent):
    """The best split of each (model, node) among the cells of a block; blocks come one after the other."""

    def run(batches):
        plan, cells = sent.value, cells_sent.value
        numbers = len(plan.totals)
        # by model and number: the node
        nodes = np.full((len(plan.models), numbers), -1)
        for model, shared in zip(nodes, plan.shared, strict=True):
            model[shared[shared >= 0]] = np.flatnonzero(shared >= 0)

        def best(key, n):
            key, label = np.divmod(key, plan.labels)
            key, fold = np.divmod(key, plan.folds)
            cell, number = np.divmod(key, numbers)
            slots = len(cells.count)
            # the cells of a slot, for each number that has entries there
            pairs, back = np.unique(number * slots + cells.slot[cell], return_inverse=True)
            number, slot = np.divmod(pairs, slots)
            count, low = cells.count[slot], cells.first[slot]
            starts = np.cumsum(count) - count
            here = np.zeros((count.sum(), plan.folds, plan.labels), np.int64)
            here[starts[back] + cell - low[back], fold, label] = n
            here[starts + cells.zero(slot) - low] += plan.totals[number] - np.add.reduceat(here, starts)
            left = np.cumsum(here, axis=0)
            left -= np.repeat(left[starts] - here[starts], count, axis=0)
            cell = np.arange(len(left)) + np.repeat(low - starts, count)
            number = np.repeat(number, count)
            left_all, totals = left.sum(1), plan.totals.sum(1)
            found = []
            for k, (setting, left_out, _) in enumerate(plan.models):
                at = np.flatnonzero((nodes[k][number] >= 0) & cells.may[setting][cell])
                own, total = left_all[at], totals[number[at]]
                if left_out >= 0:
                    own, total = own - left[at, left_out], total - plan.totals[number[at], left_out]
                own, total = own.astype(float), total.astype(float)
                right = total - own
                n, n_left, n_right = total.sum(1), own.sum(1), right.sum(1)
                gain = gini(total, n) - n_left / n * gini(own, n_left) - n_right / n * gini(right, n_right)
                gain[(n_left < 1) | (n_right < 1)] = -1
                to = np.append(np.flatnonzero(np.diff(number[at], prepend=-1)), len(at))
                for a, b in itertools.pairwise(to):
                    top = a + int(np.argmax(gain[a:b]))  # of equals the least slot, then the least threshold
                    if gain[top] > 0:
                        found.append((k, nodes[k][number[at[top]]], gain[top], cell[at[top]], left[at[top]].ravel().tolist()))
            names = ("model", "node", "gain", "cell", "left")
            return pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*found, strict=True)), strict=True))) if found else None

        held, size, last = [], 0, -1
        for batch in batches:
            for block, key, n in zip(*(batch.column(batch.schema.get_field_index(x)) for x in ("block", "key", "n")), strict=True):
                if held and block.as_py() != last:
                    out = best(*_summed(held))
                    held, size = [], 0
                    if out:
                        yield out
                last = block.as_py()
                held.append(tuple(np.frombuffer(x.as_buffer(), np.int64) for x in (key, n)))
                size += len(held[-1][0])
                if size > HELD:
                    held = [_summed(held)]
                    size = len(held[0][0]) // 2
        if held and (out := best(*_summed(held))):
            yield out

    return run


def _grow_level(rows, plan, cells_sent):
    """Splits the open nodes of one level; (model, node): (cell, rows to its left by fold and label)."""
    sent, cells, found = rows.sparkSession.sparkContext.broadcast(plan), cells_sent.value, {}  # bounded by trees, slots and bins
    sums = rows.mapInArrow(_histograms(sent, cells_sent), "block long, key binary, n binary")
    sums = sums.repartition("block").sortWithinPartitions("block")
    best = sums.mapInArrow(_best_splits(sent, cells_sent), "model long, node long, gain double, cell long, left array<long>")
    order = F.struct("gain", -F.col("cell"))  # cells are in order of slot and threshold
    for r in best.groupBy("model", "node").agg(F.max_by(F.struct("cell", "left"), order).alias("b")).collect():
        left, left_out = np.reshape(r.b.left, (plan.folds, plan.labels)), plan.models[r.model][1]
        kept = np.arange(plan.folds) != left_out
        plan.trees[r.model].split((1 << plan.level) + r.node, cells.slot[r.b.cell], cells.point[r.b.cell], left[kept].sum(0))
        found[r.model, r.node] = r.b.cell, left
    sent.destroy()
    return found


def grow(rows, size, bins, depth, folds=0, trees=1, subset=0, sampled=False, seed=42):
    """``trees`` trees a setting and fold: {(setting, fold left out or -1): [Tree, ...]}.

    ``rows`` has label, fold, digest, slots and values; ``bins`` comes from ``find_bins``.
    """
    sent = rows.sparkSession.sparkContext.broadcast(Cells.of(bins, size))
    cut = cut_rows(rows, sent).persist()
    try:
        return grow_cut(cut, sent, len(bins), depth, folds, trees, subset, sampled, seed)
    finally:
        cut.unpersist()
        sent.destroy()


def grow_cut(rows, cells_sent, settings, depth, folds=0, trees=1, subset=0, sampled=False, seed=42):
    """``grow`` for the rows of ``cut_rows``."""
    cells, several = cells_sent.value, max(folds, 1)
    models = [(s, f, t) for t in range(trees) for s in range(settings) for f in [-1, *range(folds)]]

    def count(batches):
        for batch in batches:
            label, fold, digest = (column(batch, name, np.int64) for name in ("label", "fold", "digest"))
            for t in range(trees):
                weight = bootstrap(digest, t, seed) if sampled else np.ones(len(batch))
                key, back = np.unique(fold << 32 | label, return_inverse=True)
                yield pa.RecordBatch.from_pydict({"tree": np.full(len(key), t), "key": key, "n": np.bincount(back, weight, len(key))})

    counted = rows.select("label", "fold", "digest").mapInArrow(count, "tree long, key long, n double")
    found = counted.groupBy("tree", "key").agg(F.sum("n").alias("n")).collect()  # trees * folds * labels rows
    labels = max((r.key & 0xFFFFFFFF for r in found), default=-1) + 1
    totals = np.zeros((trees, several, labels), np.int64)
    for r in found:
        totals[r.tree, min(r.key >> 32, several - 1), r.key & 0xFFFFFFFF] += int(r.n)
    grown = []
    for _, left_out, t in models:
        tree = Tree(depth, labels)
        tree.counts[1] = totals[t][np.arange(several) != left_out].sum(0)
        grown.append(tree)
    used = cells.first[cells.count > 0]
    shared = np.array([[t] for _, _, t in models])
    for level in range(depth if len(used) else 0):
        nodes = slice(1 << level, 2 << level)
        open_ = np.stack([(tree.counts[nodes] > 0).sum(1) > 1 for tree in grown])  # rows of two labels at least
        if not open_.any():
            break
        # numbers anew, of open nodes only
        numbers, back = np.unique(shared[open_], return_inverse=True)
        shared = np.full(shared.shape, -1)
        shared[open_] = back
        totals = totals[numbers]
        # a fold that all models of a node leave out is not added up there
        wanted = np.zeros(totals.shape[:2], bool)
        for own, (_, left_out, _) in zip(shared, models, strict=True):
            wanted[own[own >= 0]] |= np.arange(several) != left_out
        totals[~wanted] = 0
        share = subset / len(cells.count) if subset else 1
        blocks = max(32, int(len(cells.slot) * totals.size * share) // BLOCK)
        edges = np.unique(used[np.searchsorted(used, np.linspace(0, len(cells.slot), blocks, endpoint=False), "right") - 1])
        plan = _Plan(level, models, grown, shared, totals, subset, labels, several, seed, sampled, edges)
        split = _grow_level(rows, plan, cells_sent)
        below, sums, numbered = np.full((len(models), 2 << level), -1), [], {}
        for (model, node), (cell, left) in sorted(split.items()):
            number = shared[model, node]
            if (number, cell) not in numbered:
                numbered[number, cell] = len(sums)
                sums += [left, totals[number] - left]
            below[model, 2 * node : 2 * node + 2] = numbered[number, cell] + np.arange(2)
        if not sums:
            break
        shared, totals = below, np.stack(sums)
    out = {}
    for (setting, left_out, _), tree in zip(models, grown, strict=True):
        out.setdefault((setting, left_out), []).append(tree)
    return out


def vote(trees, entries, depth=None):
    """Sum of the trees' label shares, row by row."""
    return sum(tree.shares(entries, depth) for tree in trees)


class Forest:
    """Trees that vote; a single tree is a forest of one."""

    def __init__(self, trees, depth, x="features"):
        self.trees, self.depth, self.x = trees, depth, x

    def transform(self, df):
        """Adds ``prediction``: the label of most votes, the least of equals. Works on streams too."""
        sent = df.sparkSession.sparkContext.broadcast((self.trees, self.depth))

        @F.pandas_udf("double")
        def guess(slots, values):
            trees, depth = sent.value
            batch = pa.RecordBatch.from_pydict(
                {"slots": pa.array(slots, pa.list_(pa.int32())), "values": pa.array(values, pa.list_(pa.float64()))}
            )
            return pd.Series(np.argmax(vote(trees, Entries.of(batch), depth), axis=1).astype(float), index=slots.index)

        return df.withColumn("prediction", guess(*entry_columns(self.x)))

    def save(self, spark, path):
        saved = json.dumps({"x": self.x, "depth": self.depth, "trees": [tree.to_list() for tree in self.trees]})
        spark.createDataFrame([(saved,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark, path):
        saved = json.loads(spark.read.text(path).first().value)
        return cls([Tree.from_list(x) for x in saved["trees"]], saved["depth"], saved["x"])


class ForestSearch:
    """A fitted grid: ``grid`` lists (setting, mean accuracy), ``bestModel`` is the best one over all rows."""

    def __init__(self, grid, best):
        self.grid, self.bestModel = grid, best

    def transform(self, df):
        return self.bestModel.transform(df)


def cross_validate(train, x, y, fold, folds, size, depths, bins, tree_counts=(1,), seed=42, digest="_row"):
    """Grid search over forest size, depth and bins with one growth of all trees.

    More than one tree means bootstrap rows and, at each node, the square root of the slots.
    """
    names = [F.col(y).cast("int").alias("label"), F.col(fold).alias("fold"), F.col(digest).alias("digest")]
    rows = entry_rows(train, x, *names)
    most, deepest = max(tree_counts), max(depths)
    forest = most > 1
    cells_sent = train.sparkSession.sparkContext.broadcast(Cells.of(find_bins(rows, size, bins), size))
    rows = cut_rows(rows, cells_sent).persist()
    grown = grow_cut(rows, cells_sent, len(bins), deepest, folds, most, math.ceil(math.sqrt(size)) if forest else 0, forest, seed)
    settings = [(n, d, b) for n in tree_counts for d in depths for b in range(len(bins))]
    sent = train.sparkSession.sparkContext.broadcast(grown)

    def run(batches):
        grown, cells = sent.value, cells_sent.value
        hits, n = np.zeros((folds, len(settings)), np.int64), np.zeros(folds, np.int64)
        models = {(b, f): own for (b, f), own in grown.items() if f >= 0}
        paths = {key: _Paths(own, cells) for key, own in models.items()}
        shares = {key: np.stack([tree.shares_of_nodes() for tree in own]) for key, own in models.items()}
        width = max((len(path.zero) + most for path in paths.values()), default=1)
        for batch in batches:
            for part in _Part.all_of(batch, cells, width, 1):
                n += np.bincount(part.fold, minlength=folds)
                for f in np.unique(part.fold):
                    own = part.only(part.fold == f)
                    for b in range(len(bins)):
                        nodes = paths[b, f].find(own, deepest)
                        for d in depths:
                            votes = np.cumsum(shares[b, f][np.arange(most)[:, None], nodes[d]], axis=0)
                            for count in tree_counts:
                                right = np.argmax(votes[count - 1], axis=1) == own.label
                                hits[f, settings.index((count, d, b))] += right.sum()
        at = np.indices(hits.shape).reshape(2, -1)
        yield pa.RecordBatch.from_pydict({"fold": at[0], "setting": at[1], "hits": hits.ravel(), "n": np.repeat(n, len(settings))})

    parts = rows.mapInArrow(run, "fold long, setting long, hits long, n long")
    accuracy = np.full((folds, len(settings)), np.nan)
    for row in parts.groupBy("fold", "setting").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect():
        if row.n:
            accuracy[row.fold, row.setting] = row.hits / row.n
    rows.unpersist()
    sent.destroy()
    cells_sent.destroy()
    mean = np.nanmean(accuracy, axis=0)
    named = lambda n, d, b: ({"numTrees": n} if forest else {}) | {"maxDepth": d, "maxBins": bins[b]}
    count, depth, b = settings[int(np.argmax(mean))]
    grid = [(named(*setting), float(m)) for setting, m in zip(settings, mean, strict=True)]
    return ForestSearch(grid, Forest(grown[b, -1][:count], depth, x))
