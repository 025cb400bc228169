"""Leaf-wise boosted trees for many experiments over one training table, a tree per round and experiment.

Features are cut once at quantiles into at most 256 bins. An experiment is a weight per row: a row drawn n times weighs n, one left out
weighs 0. Every pass over the table serves all experiments:

1. each task walks its rows down the trees grown so far and adds gradients, curvatures and weights by (experiment, node,
   feature, bin), as whole numbers, so that sums don't depend on their order;
2. the sums meet by (experiment, node, feature), running sums over the bins give each cut's gain, and the best cut of
   a node comes to the driver: a row per node and partition;
3. the leaf of the highest gain is split next, until a tree has its leaves. The pass asks for the children of all leaves
   that may be split, so a tree takes about as many passes as it is deep.

A margin per row and experiment is carried: written every few rounds, with the trees since then added on the fly. The losses
of a round come with the next one's first pass, so patience ends an experiment at the exact round. No tree is fitted twice.

Of a table of up to four parts of ``PART_ROWS`` rows a task per experiment reads the rows it weighs and runs all rounds of its own: it sums up
the smaller child of a split, and has the sums of the larger one by subtraction. Its rows lie in unlinked files of the task's temp folder, a byte
per row and feature and 40 bytes a row besides, and are worked on in pieces, so its memory doesn't grow with them. Both ways give the same
trees, as all sums are whole numbers.

The driver holds cuts, trees and losses: bounded by the settings, whatever the rows.
"""

from __future__ import annotations

import json
import mmap
import os
import tempfile
from collections import namedtuple
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.session import materialise

#: Sums are whole numbers of this unit.
UNIT = float(1 << 24)
#: Tables of more than ``WHOLE_PARTS`` parts of so many rows take a pass per step of growth.
PART_ROWS = 8_000_000
#: Parts of a table whose experiments each fit in a task.
WHOLE_PARTS = 4
#: Rows of a partition of a table that takes passes.
DEALT_ROWS = 500_000
#: Rows that a task works on at once: their sums of curvatures and weights fit side by side in a double.
PIECE = 1 << 14
_TRAIN_LOSS, _VAL_LOSS = -1, -2


@dataclass(frozen=True)
class Growth:
    """``carry``: rounds after which margins are written. ``patience`` None runs all rounds."""

    leaves: int = 31
    step: float = 0.1
    rounds: int = 100
    min_rows: int = 20
    min_curvature: float = 1e-3
    bins: int = 255
    patience: int | None = 10
    carry: int = 8


@dataclass
class Tree:
    """Nodes by number, 0 the root; ``feature`` is -1 in leaves; rows of a bin up to ``bin`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def add(self) -> int:
        for column, start in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.right, 0), (self.value, 0.0), (self.gain, 0.0)):
            column.append(start)
        return len(self.feature) - 1

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        feature, cut, left, right = map(np.array, (self.feature, self.bin, self.left, self.right))
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins)) if feature[0] >= 0 else np.empty(0, np.int64)
        while len(rows):
            at = node[rows]
            low = bins[rows, feature[at]] <= cut[at]
            node[rows] = np.where(low, left[at], right[at])
            rows = rows[feature[node[rows]] >= 0]
        return node


class Sprout:
    """A tree while it grows: what is known of its nodes, and the children that leaves would have."""

    def __init__(self, config: Growth):
        self.config, self.tree = config, Tree()
        self.best: dict[int, tuple] = {}  # node: gain, feature, bin, and sums of both sides; gain 0 where none is allowed
        self.sums: dict[int, tuple[int, int]] = {}
        self.leaves = [0]

    def learn(self, node: int, found: tuple) -> None:
        self.best[node] = found

    def _split(self, node: int) -> tuple[int, int]:
        tree = self.tree
        if tree.feature[node] < 0:
            gain, feature, cut, low, high = self.best[node]
            left, right = tree.add(), tree.add()
            tree.feature[node], tree.bin[node], tree.gain[node] = feature, cut, gain
            tree.left[node], tree.right[node] = left, right
            self.sums[left], self.sums[right] = low, high
        return tree.left[node], tree.right[node]

    def wanted(self) -> list[int]:
        """Splits the leaves of the highest gains as far as they are known, and names the nodes to learn of next; none when done."""
        most = self.config.leaves
        while len(self.leaves) < most and all(leaf in self.best for leaf in self.leaves):
            top = max(self.leaves, key=lambda leaf: (self.best[leaf][0], -leaf))
            if self.best[top][0] <= 0:
                return []
            self.leaves.remove(top)
            self.leaves += self._split(top)
        if len(self.leaves) >= most:
            return []
        unknown = [leaf for leaf in self.leaves if leaf not in self.best]
        known = sorted((leaf for leaf in self.leaves if leaf in self.best and self.best[leaf][0] > 0), key=lambda leaf: -self.best[leaf][0])
        ahead = [child for leaf in known[: most - len(self.leaves)] for child in self._split(leaf) if child not in self.best]
        return unknown + ahead

    def finished(self) -> Tree:
        """The tree of the splits made, children that were only looked at left out."""
        out, step = Tree(), self.config.step
        leaves, place = set(self.leaves), {0: 0}
        todo = [0]
        while todo:
            node = todo.pop()
            at = place[node]
            if node in leaves:
                g, h = self.sums.get(node, (0, 0))
                out.value[at] = -step * g / h if h > 0 else 0.0
                continue
            out.feature[at], out.bin[at], out.gain[at] = self.tree.feature[node], self.tree.bin[node], self.tree.gain[node]
            for side, child in ((out.left, self.tree.left[node]), (out.right, self.tree.right[node])):
                place[child] = side[at] = out.add()
                todo.append(child)
        return out


@dataclass
class Fit:
    """For each experiment its start margin, all trees run, losses after each, and the round that is kept."""

    features: list[str]
    cuts: list[list[float]]
    start: list[float]
    trees: list[list[Tree]]
    train_losses: list[list[float]]
    val_losses: list[list[float]]
    best: list[int]
    passes: int = 0


def quantile_cuts(train: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Up to ``bins`` ascending cuts per feature, from a quantile sketch."""
    numbers = train.select(*[F.col(f).cast("double").alias(f) for f in features])
    found = numbers.approxQuantile(features, [i / bins for i in range(bins)], 1 / (8 * bins))
    return [sorted(set(c)) for c in found]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    buffer, at = column.buffers()[2], column.offset * width
    return np.frombuffer(buffer, np.uint8)[at : at + len(column) * width].reshape(-1, width) if len(column) else np.empty((0, width), np.uint8)


def _packed(bins: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer((np.arange(len(bins) + 1) * bins.shape[1]).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bins), [None, offsets, pa.py_buffer(np.ascontiguousarray(bins))])


def binned(df: DataFrame, features: list[str], cuts: list[list[float]], keep: list[str]) -> DataFrame:
    """``keep`` columns and ``bins``, a byte per feature: how many cuts lie below the value. A missing value lies above all."""
    edges = [np.array(c) for c in cuts]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(f"_{i}").to_numpy(zero_copy_only=False) for i in range(len(edges))]
            bins = np.stack([np.searchsorted(e, c, side="left").astype(np.uint8) for e, c in zip(edges, columns)], 1)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], _packed(bins)], names=[*keep, "bins"])

    named = df.select(*keep, *[F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(features)])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.select(*keep).schema.fields)
    return named.mapInArrow(run, f"{kinds}, bins binary")


def _wide(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-margin))


@dataclass
class _Pass:
    """What a pass over the table does: trees to add to the margins, and nodes of growing trees to sum up."""

    width: int
    experiments: int
    start: list[float]
    pending: dict[int, list[Tree]]
    growing: dict[int, tuple[Tree, list[int]]]
    losses: bool

    def margins(self, batch: pa.RecordBatch, bins: np.ndarray) -> np.ndarray:
        if "margins" in batch.schema.names:
            out = _wide(batch.column("margins"), self.experiments, float).copy()
        else:
            out = np.tile(np.array(self.start), (len(bins), 1))
        for e, trees in self.pending.items():
            for tree in trees:
                out[:, e] += np.array(tree.value)[tree.walk(bins)]
        return out

    def sums(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        losses = np.zeros((self.experiments, 2, 2))
        for batch in batches:
            bins = _matrix(batch.column("bins"), self.width)
            weights = _wide(batch.column("weights"), self.experiments, np.int64)
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            val = batch.column("val").to_numpy(zero_copy_only=False).astype(bool)
            margin = self.margins(batch, bins)
            for e, (tree, nodes) in self.growing.items():
                m, w = margin[:, e], weights[:, e]
                if self.losses:
                    loss = np.rint(UNIT * (np.logaddexp(0, m) - label * m)) * w
                    for part in (0, 1):
                        losses[e, part] += loss[val == part].sum(), w[val == part].sum()
                use = np.flatnonzero(~val & (w > 0))
                slot = np.full(len(tree.feature), -1)
                slot[nodes] = np.arange(len(nodes))
                at = slot[tree.walk(bins[use])]
                use, at = use[at >= 0], at[at >= 0]
                p = _sigmoid(m[use])
                parts = np.rint(UNIT * (p - label[use])) * w[use], np.rint(UNIT * p * (1 - p)) * w[use], w[use].astype(float)
                cell = ((at[:, None] * self.width + np.arange(self.width)) * 256 + bins[use]).ravel()
                size = len(nodes) * self.width * 256
                found = np.stack([np.bincount(cell, np.repeat(x, self.width), size) for x in parts])
                for i, node in enumerate(nodes):
                    own = found[:, i * self.width * 256 : (i + 1) * self.width * 256]
                    totals[e, node] = totals[e, node] + own if (e, node) in totals else own
        names = ["experiment", "node", "feature", "bin", "g", "h", "n"]
        for (e, node), found in totals.items():
            cell = np.flatnonzero(found[2])
            columns = [np.full(len(cell), e), np.full(len(cell), node), cell // 256, cell % 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int32)) for c in columns] + [pa.array(found[k][cell].astype(np.int64)) for k in range(3)], names=names
            )
        if self.losses:
            for e in self.growing:
                for part, node in ((0, _TRAIN_LOSS), (1, _VAL_LOSS)):
                    g, n = losses[e, part]
                    row = [pa.array([int(x)], pa.int32()) for x in (e, node, 0, 0)] + [pa.array([int(x)], pa.int64()) for x in (g, 0, n)]
                    yield pa.RecordBatch.from_arrays(row, names=names)

    def carried(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = self.margins(batch, _matrix(batch.column("bins"), self.width))
            offsets = pa.array(np.arange(len(margin) + 1) * self.experiments, pa.int32())
            columns = {n: batch.column(n) for n in batch.schema.names if n != "margins"}
            columns["margins"] = pa.ListArray.from_arrays(offsets, pa.array(margin.ravel()))
            yield pa.RecordBatch.from_pydict(columns)


_SUMS = "experiment int, node int, feature int, bin int, g long, h long, n long"


def _quotient(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.divide(g * g, h, out=np.zeros(np.shape(g)), where=h > 0) / UNIT


def best_cuts(config: Growth):
    """Of each (experiment, node) the cut of the highest gain among the features at hand, the lower feature and bin on ties, with the
    sums of the node and its left side. All sums of a feature must be at hand.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [b for b in batches if len(b)]
        if not read:
            return
        columns = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in read]).astype(np.int64) for i in range(7)]
        order = np.lexsort(columns[3::-1])
        keys, values = np.stack(columns[:4])[:, order], np.stack(columns[4:])[:, order]
        cell = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(0)])
        keys, values = keys[:, cell], np.add.reduceat(values, cell, axis=1)
        first = np.flatnonzero(np.r_[True, (keys[:3, 1:] != keys[:3, :-1]).any(0)])
        sizes = np.diff(np.r_[first, keys.shape[1]])
        upto = np.cumsum(values, axis=1)
        low = upto - np.repeat((upto - values)[:, first], sizes, axis=1)
        whole = np.repeat(np.add.reduceat(values, first, axis=1), sizes, axis=1)
        (g, h, n), (gl, hl, nl) = whole.astype(float), low.astype(float)
        least = config.min_curvature * UNIT
        allowed = (keys[1] >= 0) & (n > nl) & (np.minimum(nl, n - nl) >= config.min_rows) & (np.minimum(hl, h - hl) >= least)
        gain = np.where(allowed, _quotient(gl, hl) + _quotient(g - gl, h - hl) - _quotient(g, h), 0.0)
        by = np.lexsort((keys[3], keys[2], -gain, keys[1], keys[0]))
        top = by[np.flatnonzero(np.r_[True, (keys[:2, by][:, 1:] != keys[:2, by][:, :-1]).any(0)])]
        found = [*(keys[:, top].astype(np.int32)), gain[top], low[0][top], low[1][top], *whole[:, top]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["experiment", "node", "feature", "bin", "gain", "g_low", "h_low", "g", "h", "n"])

    return run


_CUTS = "experiment int, node int, feature int, bin int, gain double, g_low long, h_low long, g long, h long, n long"


Cut = namedtuple("Cut", "experiment node feature bin gain g_low h_low g h n")


def _best(rows: Iterable[tuple]) -> dict[tuple[int, int], Cut]:
    best: dict[tuple[int, int], Cut] = {}
    for r in map(Cut._make, rows):
        key = r.experiment, r.node
        if key not in best or (r.gain, -r.feature, -r.bin) > (best[key].gain, -best[key].feature, -best[key].bin):
            best[key] = r
    return best


def grow(experiments: list[int], config: Growth, one_pass: Callable) -> tuple[dict[int, Tree], dict[int, list]]:
    """A tree per experiment, and the losses (sum, weight) of train and validation before it. ``one_pass`` sums up the nodes asked for."""
    sprouts = {e: Sprout(config) for e in experiments}
    asked = {e: [0] for e in experiments}
    losses: dict[int, list] = {}
    while asked:
        found = one_pass({e: (sprouts[e].tree, nodes) for e, nodes in asked.items()}, not losses)
        if not losses:
            sides = {e: [found.get((e, part)) for part in (_TRAIN_LOSS, _VAL_LOSS)] for e in experiments}
            losses = {e: [(r.g, r.n) if r is not None else (0, 0) for r in pair] for e, pair in sides.items()}
        for e, nodes in asked.items():
            for node in nodes:
                r = found[e, node]
                if node == 0:
                    sprouts[e].sums[0] = (r.g, r.h)
                sprouts[e].learn(node, (r.gain, r.feature, r.bin, (r.g_low, r.h_low), (r.g - r.g_low, r.h - r.h_low)))
        asked = {e: nodes for e in asked if (nodes := sprouts[e].wanted())}
    return {e: sprout.finished() for e, sprout in sprouts.items()}, losses


def _kept(shape: tuple[int, ...] | int, kind) -> np.ndarray:
    """An array of zeros in an unlinked file of the task's temp folder, whose pages can leave memory."""
    size = max(int(np.prod(shape)) * np.dtype(kind).itemsize, 1)
    with tempfile.TemporaryFile() as file:
        os.posix_fallocate(file.fileno(), 0, size)
        return np.frombuffer(mmap.mmap(file.fileno(), size), kind, int(np.prod(shape))).reshape(shape)


def _pieces(start: int, stop: int) -> Iterator[slice]:
    for at in range(start, stop, PIECE):
        yield slice(at, min(at + PIECE, stop))


class _Held:
    """Rows with label, weight and margin, and a column of bins per feature; ``order`` has those of a node of a tree together."""

    def __init__(self, width: int, rows: int, margin: float):
        self.columns = _kept((width, rows), np.uint8)
        self.label, self.weight, self.margin = _kept(rows, np.float32), _kept(rows, np.int32), _kept(rows, float)
        self.order, self.spare = _kept(rows, np.int32), _kept(rows, np.int32)
        self.margin[:] = margin
        self.filled = 0

    def fill(self, bins: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        to = slice(self.filled, self.filled + len(bins))
        self.columns[:, to], self.label[to], self.weight[to] = bins.T, label, weight
        self.filled = to.stop

    def gather(self) -> None:
        """All rows are the root's."""
        for piece in _pieces(0, len(self.order)):
            self.order[piece] = np.arange(piece.start, piece.stop)

    def part(self, start: int, stop: int, feature: int, cut: int) -> int:
        """Puts the rows of these places that go left before the others; where the others begin."""
        column, to, apart = self.columns[feature], start, 0
        for piece in _pieces(start, stop):
            rows = self.order[piece].astype(np.intp)
            low = column.take(rows) <= cut
            left, right = rows[low], rows[~low]
            self.order[to : to + len(left)], self.spare[apart : apart + len(right)] = left, right
            to, apart = to + len(left), apart + len(right)
        self.order[to:stop] = self.spare[:apart]
        return to

    def lift(self, start: int, stop: int, value: float) -> None:
        for piece in _pieces(start, stop):
            self.margin[self.order[piece]] += value

    def add(self, tree: Tree) -> None:
        """Adds the tree to the margins."""
        self.gather()
        todo = [(0, 0, len(self.order))]
        while todo:
            node, start, stop = todo.pop()
            if tree.feature[node] < 0:
                self.lift(start, stop, tree.value[node])
            elif start < stop:
                middle = self.part(start, stop, tree.feature[node], tree.bin[node])
                todo += [(tree.left[node], start, middle), (tree.right[node], middle, stop)]

    def loss(self) -> float:
        total = n = 0
        for piece in _pieces(0, len(self.order)):
            margin, weight = self.margin[piece], self.weight[piece]
            total += int((np.rint(UNIT * (np.logaddexp(0, margin) - self.label[piece] * margin)) * weight).sum())
            n += int(weight.sum(dtype=np.int64))
        return total / UNIT / n if n else float("nan")


class _Rows(_Held):
    """The rows of one experiment's train set, and while a tree grows the places of its nodes' rows and their sums by feature and bin."""

    def __init__(self, width: int, rows: int, margin: float, config: Growth):
        super().__init__(width, rows, margin)
        self.config, self.g, self.h = config, _kept(rows, np.int32), _kept(rows, np.int32)

    def start(self) -> None:
        """A new tree."""
        for piece in _pieces(0, len(self.order)):
            p = _sigmoid(self.margin[piece])
            self.g[piece], self.h[piece] = np.rint(UNIT * (p - self.label[piece])), np.rint(UNIT * p * (1 - p))
        self.gather()
        self.places = {0: (0, len(self.order))}
        self.sums = {0: self._summed(0, len(self.order), True)}

    def _summed(self, start: int, stop: int, every: bool = False) -> np.ndarray:
        """Gradients, curvatures and weights by feature and bin. ``every``: row and place are the same."""
        out = np.zeros((3, len(self.columns), 256))
        own = np.empty(out.shape)
        for piece in _pieces(start, stop):
            rows = piece if every else self.order[piece].astype(np.intp)
            n = self.weight[rows].astype(float)
            g, h = self.g[rows] * n, self.h[rows] * n
            most = [int(x.sum()).bit_length() for x in (h, n)]
            # curvatures and weights are summed as one number, as long as it is whole
            unit = float(1 << most[0]) if sum(most) <= 53 else 0.0
            parts = [g, h + n * unit] if unit else [g, h, n]
            for f, column in enumerate(self.columns):
                at = (column[rows] if every else column.take(rows)).astype(np.intp)
                for k, part in enumerate(parts):
                    own[k, f] = np.bincount(at, part, 256)
            if unit:
                np.floor_divide(own[1], unit, out=own[2])
                own[1] -= own[2] * unit
            out += own
        return out

    def _place(self, tree: Tree, node: int) -> None:
        start, stop = self.places[node]
        middle = self.part(start, stop, tree.feature[node], tree.bin[node])
        self.places |= {tree.left[node]: (start, middle), tree.right[node]: (middle, stop)}

    def _part(self, tree: Tree, node: int) -> None:
        self._place(tree, node)
        small, large = sorted((tree.left[node], tree.right[node]), key=lambda child: self.places[child][1] - self.places[child][0])
        self.sums[small] = self._summed(*self.places[small])
        # the node's own are not asked for again
        self.sums[large] = self.sums.pop(node)
        self.sums[large] -= self.sums[small]

    def _top(self, experiment: int, node: int) -> Cut:
        """As :func:`best_cuts`: the highest gain, the lower feature and bin on ties, at bins that hold rows."""
        own = self.sums[node]
        gl, hl, nl = low = np.cumsum(own, axis=2)
        g, h, n = low[:, 0, -1]
        least = self.config.min_curvature * UNIT
        allowed = (n > nl) & (np.minimum(nl, n - nl) >= self.config.min_rows) & (np.minimum(hl, h - hl) >= least)
        gain = np.where(allowed, _quotient(gl, hl) + _quotient(g - gl, h - hl) - _quotient(g, h), 0.0)
        f, b = (int(x) for x in np.unravel_index(np.argmax(np.where(own[2] > 0, gain, -np.inf)), gain.shape))
        return Cut(experiment, node, f, b, float(gain[f, b]), *(int(x) for x in (gl[f, b], hl[f, b], g, h, n)))

    def cuts(self, growing: dict[int, tuple[Tree, list[int]]], losses: bool) -> dict[tuple[int, int], Cut]:
        found = {}
        for e, (tree, nodes) in growing.items():
            self.tree = tree
            above = {child: node for node, f in enumerate(tree.feature) if f >= 0 for child in (tree.left[node], tree.right[node])}
            for node in nodes:
                if node not in self.places:
                    self._part(tree, above[node])
                found[e, node] = self._top(e, node)
        return found

    def add(self, tree: Tree) -> None:
        """Adds the tree that was grown last: the rows of most of its leaves are together already."""
        todo = [(0, 0)]
        while todo:
            grown, node = todo.pop()
            if tree.feature[node] < 0:
                self.lift(*self.places[grown], tree.value[node])
            else:
                if self.tree.left[grown] not in self.places:
                    self._place(self.tree, grown)
                todo += [(self.tree.left[grown], tree.left[node]), (self.tree.right[grown], tree.right[node])]


_FITTED = "experiment int, trees string, train_losses string, val_losses string, best int"


def _whole(experiment: int, start: float, rows: tuple[int, int], width: int, config: Growth):
    """All rounds of the experiment whose rows the task reads: so many of train and of validation."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, held = sets = _Rows(width, rows[0], start, config), _Held(width, rows[1], start)
        for batch in batches:
            bins = _matrix(batch.column("bins"), width)
            label, weight, val = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight", "val"))
            for own, use in zip(sets, (~val.astype(bool), val.astype(bool))):
                own.fill(bins[use], label[use], weight[use])
        trees: list[Tree] = []
        losses: list[list[float]] = [[], []]
        best, over = 0, False
        for done in range(config.rounds + 1):
            if done:
                for kept, own in zip(losses, sets):
                    kept.append(own.loss())
                best, over = _stopped(losses[1], config.patience)
            if over or done == config.rounds:
                break
            train.start()
            tree = grow([experiment], config, train.cuts)[0][experiment]
            trees.append(tree)
            for own in sets:
                own.add(tree)
        texts = [json.dumps(x) for x in ([t.__dict__ for t in trees], *losses)]
        columns = [pa.array([experiment], pa.int32()), *[pa.array([t]) for t in texts], pa.array([best], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["experiment", "trees", "train_losses", "val_losses", "best"])

    return run


def _fit_whole(table: DataFrame, active: dict[int, int], held: int, config: Growth, out: Fit) -> None:
    """Fits each active experiment in a task that reads all rows it weighs: so many of train, and ``held`` of validation."""

    def one(experiment: int):
        rows = table.select("label", "val", "bins", F.col("weights")[experiment].alias("weight")).where(F.col("weight") > 0)
        work = _whole(experiment, out.start[experiment], (active[experiment], held), len(out.features), config)
        return rows.coalesce(1).mapInArrow(work, _FITTED).first()

    out.passes += 1
    # the longest first: more threads than cores would submit them in any order
    with ThreadPoolExecutor(min(len(active), table.sparkSession.sparkContext.defaultParallelism)) as pool:
        for r in pool.map(one, sorted(active, key=lambda e: -active[e])):
            out.trees[r.experiment] = [Tree(**t) for t in json.loads(r.trees)]
            out.train_losses[r.experiment], out.val_losses[r.experiment] = json.loads(r.train_losses), json.loads(r.val_losses)
            out.best[r.experiment] = r.best


def _stopped(losses: list[float], patience: int | None) -> tuple[int, bool]:
    """(best round, whether patience has run out) of the losses after rounds 1, 2 and so on."""
    best = min(range(len(losses)), key=losses.__getitem__) + 1 if losses else 0
    return best, patience is not None and len(losses) - best >= patience


def fit(train: DataFrame, val: DataFrame, features: list[str], experiments: int, config: Growth = Growth(), cuts: list[list[float]] | None = None) -> Fit:
    """Boosting of all experiments at once. ``train`` has the features, ``label`` 0 or 1 and ``weights``, an array of a whole number per
    experiment; ``val`` has features and label. Writes bins and margins while it runs.
    """
    cuts = cuts or quantile_cuts(train, features, config.bins)
    ones = F.array_repeat(F.lit(1), experiments).alias("weights")
    label = F.col("label").cast("int").alias("label")
    wanted = [F.col(f) for f in features]
    both = train.select(label, F.col("weights").cast("array<int>").alias("weights"), F.lit(False).alias("val"), *wanted).unionByName(
        val.select(label, ones, F.lit(True).alias("val"), *wanted)
    )
    table = materialise(binned(both, features, cuts, ["label", "weights", "val"]), "binned")
    rows = table.count()
    known = table.where(~F.col("val"))
    *sides, trained = known.agg(*[
        F.struct(
            F.sum(F.col("weights")[e] * F.col("label")).alias("p"), F.sum(F.col("weights")[e]).alias("n"),
            F.count_if(F.col("weights")[e] > 0).alias("rows"),
        ).alias(f"e{e}")
        for e in range(experiments)
    ], F.count(F.lit(1)).alias("trained")).first()
    odds = [(s.p or 0, s.n or 0) for s in sides]
    start = [float(np.log(p / (n - p))) if 0 < p < n else 0.0 for p, n in odds]
    out = Fit(features, cuts, start, [[] for _ in odds], [[] for _ in odds], [[] for _ in odds], [0] * experiments)
    active = [e for e, (p, n) in enumerate(odds) if 0 < p < n]
    if rows <= WHOLE_PARTS * PART_ROWS:
        if active:
            _fit_whole(table, {e: sides[e].rows for e in active}, rows - trained, config, out)
        return out
    table = materialise(table.repartition(-(-rows // min(PART_ROWS, DEALT_ROWS))), "dealt")
    pending: dict[int, list[Tree]] = {}

    def work(growing: dict[int, tuple[Tree, list[int]]], losses: bool) -> _Pass:
        return _Pass(len(features), experiments, start, pending, growing, losses)

    def one_pass(growing: dict[int, tuple[Tree, list[int]]], losses: bool) -> dict[tuple[int, int], Cut]:
        out.passes += 1
        dealt = table.mapInArrow(work(growing, losses).sums, _SUMS).repartition("experiment", "node", "feature")
        return _best(dealt.mapInArrow(best_cuts(config), _CUTS).collect())

    for done in range(config.rounds + 1):
        trees, losses = grow(active, config, one_pass)
        for e in list(active) if done else []:
            for kept, (total, n) in zip((out.train_losses[e], out.val_losses[e]), losses[e]):
                kept.append(total / UNIT / n if n else float("nan"))
            out.best[e], over = _stopped(out.val_losses[e], config.patience)
            if over or done == config.rounds:
                active.remove(e)
        if not active:
            break
        for e in active:
            out.trees[e].append(trees[e])
            pending.setdefault(e, []).append(trees[e])
        if (done + 1) % config.carry == 0:
            kinds = "label int, weights array<int>, val boolean, bins binary, margins array<double>"
            table = materialise(table.mapInArrow(work({}, False).carried, kinds), "margins")
            pending = {}
    return out


def scores(model: Fit, df: DataFrame, keep: list[str], names: list[str], rounds: list[int] | None = None) -> DataFrame:
    """A row per row of ``df`` and experiment: ``keep`` columns, the experiment's name, ``score`` and ``prediction``."""
    kept = rounds or model.best
    work = _Pass(len(model.features), len(names), model.start, {e: t[: kept[e]] for e, t in enumerate(model.trees)}, {}, False)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _sigmoid(work.margins(batch, _matrix(batch.column("bins"), work.width)))
            offsets = pa.array(np.arange(len(score) + 1) * len(names), pa.int32())
            columns = [*[batch.column(k) for k in keep], pa.ListArray.from_arrays(offsets, pa.array(score.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "scores"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    found = binned(df, model.features, model.cuts, keep).mapInArrow(run, f"{kinds}, scores array<double>")
    shown = F.array(*[F.lit(n) for n in names])
    rows = found.select(*keep, F.posexplode("scores").alias("_e", "score"))
    return rows.select(F.get(shown, F.col("_e")).alias("experiment"), *keep, "score", (F.col("score") > 0.5).cast("int").alias("prediction"))


def nodes(model: Fit, spark, names: list[str]) -> DataFrame:
    """The trees as a table: a row per node, a leaf without feature; values up to ``threshold`` go left."""
    rows = []
    for name, trees in zip(names, model.trees):
        for t, tree in enumerate(trees):
            for i, f in enumerate(tree.feature):
                inner = f >= 0
                cut = model.cuts[f][tree.bin[i]] if inner and tree.bin[i] < len(model.cuts[f]) else None
                rows.append((
                    name, t + 1, i, model.features[f] if inner else None, cut, tree.left[i] if inner else None,
                    tree.right[i] if inner else None, None if inner else tree.value[i], tree.gain[i] if inner else None,
                ))
    kinds = "experiment string, tree int, node int, feature string, threshold double, left int, right int, value double, gain double"
    return spark.createDataFrame(rows, kinds)
