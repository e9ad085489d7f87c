"""Regression trees of many factor sets, grown level by level for all sets at once.

Columns are cut at quantiles into bins. A level is one pass over the rows: every task walks
its rows down the trees as far as they have grown and adds counts and sums of z per (tree,
node, axis, bin); the split of a node follows from the added sums. A forest grows all its
trees in the same passes; boosting grows one tree after another on what is left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.operators.gram import collected, task_sums

BINS = 32
DEPTH, TREES = 4, 10
STAGES, STAGE_DEPTH, RATE = 10, 3, 0.1
# gains are compared at this many significant digits, so that the order of adding does not
# decide between splits that part the rows alike
DIGITS = 9


@dataclass
class Tree:
    """Nodes in heap order: axis and bin of the split (axis -1: none), and the value."""

    axis: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def widen(self, nodes: int) -> None:
        more = nodes - len(self.axis)
        self.axis += [-1] * more
        self.cut += [0] * more
        self.value += [0.0] * more

    def leaf(self, bins: np.ndarray) -> np.ndarray:
        """Node of each row as far as the tree has grown."""
        axis, cut = np.array(self.axis), np.array(self.cut)
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while True:
            inner = axis[node] >= 0
            if not inner.any():
                return node
            right = bins[rows, np.maximum(axis[node], 0)] > cut[node]
            node = np.where(inner, 2 * node + 1 + right, node)

    def guess(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf(bins)]


def cuts_of(table: DataFrame, width: int) -> list[np.ndarray]:
    """Inner bin edges of columns c0, c1, ...: ``BINS`` - 1 numbers each, equal ones once."""
    shares = [i / BINS for i in range(1, BINS)]
    row = table.agg(*[
        F.percentile_approx(f"c{i}", shares, 100_000).alias(f"c{i}") for i in range(width)
    ]).first()
    return [np.unique(np.array(row[i] or [], float)) for i in range(width)]


def binned(values: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """A value's bin is the number of edges below it."""
    return np.column_stack([np.searchsorted(c, values[:, i], "left") for i, c in enumerate(cuts)])


def _mixed(number: np.ndarray, salt: int) -> np.ndarray:
    """Evenly spread numbers of 64 bits from a row's number and a salt."""
    with np.errstate(over="ignore"):
        x = number.astype(np.int64).view(np.uint64) + np.uint64(salt + 1) * np.uint64(
            0x9E3779B97F4A7C15)
        for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            x = (x ^ x >> np.uint64(30)) * np.uint64(factor)
        return x ^ x >> np.uint64(31)


def drawn(number: np.ndarray, tree: int) -> np.ndarray:
    """How often a bootstrap sample holds each row: Poisson numbers with mean 1."""
    share = _mixed(number, tree) / 2.0 ** 64
    steps = np.cumsum(np.exp(-1.0) / np.array([1.0, 1, 2, 6, 24, 120, 720, 5040]))
    return np.searchsorted(steps, share).astype(float)


def _best_split(count, total, allowed) -> tuple[int, int] | None:
    """(axis, bin) with the greatest fall of squared error of (axis, bin) sums; ties go to
    the smaller axis and bin."""
    n, s = count[0].sum(), total[0].sum()
    left_n, left_s = count.cumsum(axis=1)[:, :-1], total.cumsum(axis=1)[:, :-1]
    right_n, right_s = n - left_n, s - left_s
    good = (left_n > 0) & (right_n > 0) & allowed
    if not good.any():
        return None
    safe_l, safe_r = np.where(good, left_n, 1.0), np.where(good, right_n, 1.0)
    gain = np.where(good, left_s ** 2 / safe_l + right_s ** 2 / safe_r - s * s / n, 0.0)
    if gain.max() <= 0:
        return None
    unit = 10.0 ** (np.floor(np.log10(gain.max())) + 1 - DIGITS)
    at = int(np.argmax(np.rint(gain / unit)))
    return divmod(at, gain.shape[1])


def grow(
    table: DataFrame, places: Sequence[Sequence[int]], cuts: Sequence[np.ndarray],
    chosen: Sequence[int], trees: int, depth: int, sample: bool = False,
    choice: Callable[[int, int, int], np.ndarray] | None = None,
    so_far: dict[int, list[Tree]] | None = None, middle: dict[int, float] | None = None,
) -> dict[int, list[Tree]]:
    """Trees of the sets ``chosen`` on their training rows, ``depth`` passes and one for the leaves.

    ``sample`` draws the rows of each tree. ``choice(set, tree, node)`` masks the (axis, bin)
    splits that a node may take. With ``so_far`` the trees are grown on z less ``middle`` and
    what these trees guess.
    """
    grown = {i: [Tree() for _ in range(trees)] for i in chosen}
    wide = {i: [cuts[c] for c in places[i][:-1]] for i in chosen}

    def level(d: int):
        first, nodes = 2 ** d - 1, 2 ** d

        def measure(i, rows, train, number):
            if i not in grown:
                return np.zeros(1)
            bins, z = binned(rows[train, :-1], wide[i]), rows[train, -1]
            if so_far is not None:
                z = z - middle[i] - RATE * sum((t.guess(bins) for t in so_far[i]), np.zeros(len(z)))
            out = []
            for number_of, tree in enumerate(grown[i]):
                node = tree.leaf(bins) - first
                weight = drawn(number[train], number_of) if sample else np.ones(len(z))
                weight = np.where(node >= 0, weight, 0.0)  # ended above this level
                node = np.maximum(node, 0)
                for axis in range(bins.shape[1]):
                    at = node * BINS + bins[:, axis]
                    out += [np.bincount(at, weight, nodes * BINS),
                            np.bincount(at, weight * z, nodes * BINS)]
            return np.concatenate(out)

        return measure

    for d in range(depth + 1):
        first, nodes = 2 ** d - 1, 2 ** d
        for i, sums in collected(task_sums(table, places, level(d))).items():
            if i not in grown:
                continue
            p = len(places[i]) - 1
            cells = sums.reshape(trees, p, 2, nodes, BINS)
            for number_of, tree in enumerate(grown[i]):
                for node in range(nodes):
                    count, total = (cells[number_of, :, side, node] for side in (0, 1))
                    n = count[0].sum()
                    if n <= 0 or (d and tree.axis[(first + node - 1) // 2] < 0):
                        continue
                    tree.value[first + node] = total[0].sum() / n
                    allowed = np.ones((p, BINS - 1), bool)
                    if choice is not None:
                        allowed = choice(i, number_of, first + node)
                    split = _best_split(count, total, allowed) if d < depth else None
                    if split:
                        tree.widen(2 ** (d + 2) - 1)
                        tree.axis[first + node], tree.cut[first + node] = split
    return grown


def drawn_splits(p_of: dict[int, int], narrow: bool):
    """Masks for forests: a node sees all cuts of one axis drawn at random, or, if ``narrow``,
    one random cut of every axis."""
    def choice(i: int, tree: int, node: int) -> np.ndarray:
        rng = np.random.default_rng([i, tree, node])
        p = p_of[i]
        mask = np.zeros((p, BINS - 1), bool)
        if narrow:
            mask[np.arange(p), rng.integers(0, BINS - 1, p)] = True
        else:
            mask[rng.integers(0, p)] = True
        return mask

    return choice


def boosted(
    table: DataFrame, places, cuts, chosen, middle: dict[int, float], stages: int = STAGES,
) -> dict[int, list[Tree]]:
    """``stages`` trees per set, each on what the mean and those before leave."""
    so_far: dict[int, list[Tree]] = {i: [] for i in chosen}
    for _ in range(stages):
        held = {i: list(trees) for i, trees in so_far.items()}
        made = grow(table, places, cuts, chosen, 1, STAGE_DEPTH, so_far=held, middle=middle)
        for i in chosen:
            so_far[i] += made[i]
    return so_far
