"""Regression trees and their ensembles on one small grid of cells, in numpy.

A grid holds per cell the weight ``n`` of its rows and their weighted sum ``s`` of z. A
tree node is a box of cells, and a split parts a box between two columns or two rows of
cells. Of equal splits the lowest wins, the x axis first. Every function returns or yields
predictions for all cells of the grid, whether rows fell into them or not.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Depth of boosted trees; a tree with this mean loss or more ends the boosting.
BOOST_DEPTH = 3
MAX_ERROR = 0.5
# Splits must gain more than this share of the node's square sum; less is rounding.
LEAST_GAIN = 1e-12


def grow_tree(
    n: np.ndarray, s: np.ndarray, depth: int = BOOST_DEPTH, known: dict | None = None
) -> np.ndarray:
    """Predictions of one tree of least squares; cells without weight take their box's.
    ``known`` keeps what boxes need of ``n``, for further trees on the same weights."""
    out = np.empty_like(s)
    known = {} if known is None else known
    boxes = [(0, n.shape[0], 0, n.shape[1], depth)]
    while boxes:
        x0, x1, y0, y1, left = boxes.pop()
        sums = s[x0:x1, y0:y1]
        total = sums.sum()
        if not left:
            weight = known.get((x0, x1, y0, y1))
            if weight is None:
                weight = known[x0, x1, y0, y1] = n[x0:x1, y0:y1].sum()
            out[x0:x1, y0:y1] = total / weight
            continue
        box = known.get((x0, x1, y0, y1, True))
        if box is None:
            box = known[x0, x1, y0, y1, True] = _weighed(n[x0:x1, y0:y1])
        weight, divisors, sides = box
        best, split = total * total / weight, None
        best += LEAST_GAIN * (best + (sums * sums / divisors).sum())
        for axis, (low, high, open_) in enumerate(sides):
            if not len(open_):
                continue
            t = sums.sum(1 - axis)
            # both ends are summed on their own, so that an empty side is exactly zero
            below, above = t.cumsum()[open_], t[::-1].cumsum()[::-1][1:][open_]
            gain = below ** 2 / low + above ** 2 / high
            at = int(gain.argmax())
            if gain[at] > best:
                best, split = gain[at], (axis, int(open_[at]) + 1)
        if split is None:
            out[x0:x1, y0:y1] = total / weight
        elif split[0] == 0:
            cut = x0 + split[1]
            boxes += [(x0, cut, y0, y1, left - 1), (cut, x1, y0, y1, left - 1)]
        else:
            cut = y0 + split[1]
            boxes += [(x0, x1, y0, cut, left - 1), (x0, x1, cut, y1, left - 1)]
    return out


def _weighed(weights: np.ndarray) -> tuple:
    """Of a box: its weight, divisors of its cells, and per axis the weights on either side of
    the splits that leave some on both, with their places."""
    sides = []
    for axis in (0, 1):
        w = weights.sum(1 - axis)
        low, high = w.cumsum()[:-1], w[::-1].cumsum()[::-1][1:]
        open_ = np.flatnonzero((low > 0) & (high > 0))
        sides.append((low[open_], high[open_], open_))
    return weights.sum(), np.where(weights > 0, weights, np.inf), sides


def gradient_boosting(
    n: np.ndarray, s: np.ndarray, rate: float, steps: Sequence[int]
) -> Iterator[np.ndarray]:
    """The mean, then trees on what is left of z, each shrunk by ``rate``; the predictions
    after each number of trees in ``steps``, which ascend."""
    guess = np.full(s.shape, s.sum() / n.sum())
    done, known = 0, {}
    for step in steps:
        for _ in range(step - done):
            guess = guess + rate * grow_tree(n, s - n * guess, known=known)
        done = step
        yield guess


def adaboost(
    shape: tuple[int, int], cell: np.ndarray, z: np.ndarray, n: np.ndarray, rate: float,
    steps: Sequence[int],
) -> Iterator[np.ndarray]:
    """AdaBoost.R2 with linear loss on points (flat cell, z, rows): trees on reweighted
    points, voted by the weighted median."""
    size = shape[0] * shape[1]
    u = n / n.sum()
    # points are many, so the steps write into two arrays of theirs
    gap, part = np.empty_like(u), np.empty_like(u)
    trees, votes = [], []
    for _ in range(max(steps)):
        np.multiply(u, z, out=part)
        tree = grow_tree(
            np.bincount(cell, u, size).reshape(shape),
            np.bincount(cell, part, size).reshape(shape)).ravel()
        np.take(tree, cell, out=gap, mode="clip")
        np.abs(np.subtract(z, gap, out=gap), out=gap)
        worst = gap.max()
        if worst <= 0:
            trees.append(tree)
            votes.append(1.0)
            break
        loss = np.divide(gap, worst, out=gap)
        error = float(np.multiply(u, loss, out=part).sum())
        if error >= MAX_ERROR:
            if not trees:
                trees.append(tree)
                votes.append(1.0)
            break
        beta = error / (1 - error)
        trees.append(tree)
        votes.append(rate * np.log(1 / beta))
        np.multiply(np.subtract(1, loss, out=part), rate, out=part)
        np.multiply(u, np.power(beta, part, out=part), out=u)
        np.divide(u, u.sum(), out=u)
    for step in steps:
        yield weighted_median(np.array(trees[:step]), np.array(votes[:step])).reshape(shape)


def weighted_median(guesses: np.ndarray, votes: np.ndarray) -> np.ndarray:
    """Per column of ``guesses`` the smallest one that at least half of the votes do not
    exceed."""
    order = np.argsort(guesses, axis=0, kind="stable")
    seen = votes[order].cumsum(0)
    at = (seen >= seen[-1] / 2).argmax(0)
    columns = np.arange(guesses.shape[1])
    return guesses[order[at, columns], columns]


def _corner_sums(grid: np.ndarray) -> np.ndarray:
    out = np.zeros((grid.shape[0] + 1, grid.shape[1] + 1))
    out[1:, 1:] = grid.cumsum(0).cumsum(1)
    return out


class _Box:
    """Many boxes of cells, by the places of their corners in a flat table of corner sums."""

    def __init__(self, x0, x1, y0, y1, width: int) -> None:
        self.sides = (x0, x1, y0, y1)
        low, high = x0 * width, x1 * width
        self.corners = (high + y1, low + y1, high + y0, low + y0)

    def inside(self, sums: np.ndarray) -> np.ndarray:
        a, b, c, d = self.corners
        return sums.take(a) - sums.take(b) - sums.take(c) + sums.take(d)


class _Occupied:
    """First and last line of cells with rows, per box and along one axis.

    The cells of a line are the bits of a number, and lines are joined 1, 2, 4, ... at a time, so
    two lookups give the lines of a box. ``MAX_BITS`` lines at most, as bits are found by the
    exponent of a float."""

    MAX_BITS = 52

    def __init__(self, n: np.ndarray) -> None:
        self.tables = []
        for held in ((n > 0).T, n > 0):
            lines = (held.astype(np.int64) << np.arange(held.shape[1])).sum(1)
            joined, step = [lines], 1
            while 2 * step <= len(lines):
                last = joined[-1]
                joined.append(np.concatenate([last[:-step] | last[step:], last[-step:]]))
                step *= 2
            self.tables.append((np.array(joined).ravel(), len(lines)))
        most = max(n.shape)
        self.below = (np.int64(1) << np.arange(most + 1)) - 1
        self.power = np.array([0, *(int(i).bit_length() - 1 for i in range(1, most + 1))])

    def __call__(self, box: _Box, axis: int) -> tuple[np.ndarray, np.ndarray]:
        start, stop = box.sides[2 * axis:2 * axis + 2]
        low, high = box.sides[2 - 2 * axis:4 - 2 * axis]
        table, length = self.tables[axis]
        power = self.power.take(high - low)
        row = power * length
        bits = table.take(row + low) | table.take(row + high - (1 << power))
        bits &= self.below.take(stop) ^ self.below.take(start)
        return np.frexp(bits & -bits)[1] - 1, np.frexp(bits)[1] - 1


class _Bisected:
    """The same by bisection, for grids of more lines."""

    def __init__(self, n: np.ndarray) -> None:
        self.counts, self.shape = _corner_sums(n), n.shape

    def __call__(self, box: _Box, axis: int) -> tuple[np.ndarray, np.ndarray]:
        x0, x1, y0, y1 = box.sides
        width = self.shape[1] + 1

        def holds(low, high):
            part = _Box(low, high, y0, y1, width) if axis == 0 else _Box(x0, x1, low, high, width)
            return part.inside(self.counts) > 0

        start, stop = box.sides[2 * axis:2 * axis + 2]
        rounds = int(self.shape[axis]).bit_length()
        low, high = start.copy(), stop - 1
        for _ in range(rounds):
            middle = (low + high) // 2
            found = holds(start, middle + 1)
            low, high = np.where(found, low, np.minimum(middle + 1, high)), np.where(found, middle, high)
        first = low
        low, high = start.copy(), stop - 1
        for _ in range(rounds):
            middle = (low + high + 1) // 2
            found = holds(middle, stop)
            low, high = np.where(found, middle, low), np.where(found, high, np.maximum(middle - 1, low))
        return first, high


def random_forest(
    n: np.ndarray, s: np.ndarray, places: Sequence[np.ndarray], features: int, least: int,
    steps: Sequence[int], rng: np.random.Generator,
) -> Iterator[np.ndarray]:
    """Means of fully grown trees on all rows, whose cuts are drawn at random.

    A node of fewer than ``least`` rows, or within one cell, is a leaf. Another draws one
    threshold per axis, uniformly between its outermost occupied ``places``; it takes the
    better axis (``features`` 2) or a random one that can be split (1). All nodes of a
    level of all trees are split together.
    """
    mean = s.sum() / n.sum()
    counts, sums = _corner_sums(n).ravel(), _corner_sums(s - n * mean).ravel()
    occupied = (_Occupied if max(n.shape) <= _Occupied.MAX_BITS else _Bisected)(n)
    trees, width = max(steps), n.shape[1] + 1
    sides = [np.full(trees, v) for v in (0, n.shape[0], 0, n.shape[1])]
    sheet = np.searchsorted(np.asarray(steps), np.arange(trees), side="right")
    painted = np.zeros((len(steps), n.shape[0] + 1, width))
    while len(sheet):
        box = _Box(*sides, width)
        rows, whole = box.inside(counts), box.inside(sums)
        gains, cuts = [], []
        for axis in (0, 1):
            first, last = occupied(box, axis)
            place = places[axis]
            from_ = place[first]
            drawn = from_ + rng.random(len(sheet)) * (place[last] - from_)
            cut = np.clip(np.searchsorted(place, drawn, side="right"), first + 1, np.maximum(last, first + 1))
            if features == 1:
                gain = rng.random(len(sheet))
            else:
                lower = list(sides)
                lower[2 * axis + 1] = np.minimum(cut, sides[2 * axis + 1])
                lower = _Box(*lower, width)
                some, part = lower.inside(counts), lower.inside(sums)
                rest = rows - some
                gain = part ** 2 / np.maximum(some, 1) + (whole - part) ** 2 / np.maximum(rest, 1)
            gains.append(np.where(last > first, gain, -np.inf))
            cuts.append(cut)
        by_y = gains[1] > gains[0]
        grown = (rows >= least) & np.isfinite(np.maximum(*gains))
        leaf = ~grown
        value, at = whole[leaf] / rows[leaf], sheet[leaf]
        x0, x1, y0, y1 = (side[leaf] for side in sides)
        for x, y, sign in ((x0, y0, 1), (x1, y0, -1), (x0, y1, -1), (x1, y1, 1)):
            np.add.at(painted, (at, x, y), sign * value)
        by_y, cut = by_y[grown], np.where(by_y, cuts[1], cuts[0])[grown]
        low = [side[grown] for side in sides]
        high = list(low)
        low[1], low[3] = np.where(by_y, low[1], cut), np.where(by_y, cut, low[3])
        high[0], high[2] = np.where(by_y, high[0], cut), np.where(by_y, cut, high[2])
        sides = [np.concatenate(both) for both in zip(low, high)]
        sheet = np.tile(sheet[grown], 2)
    total = painted.cumsum(0).cumsum(1).cumsum(2)[:, :-1, :-1]
    for at, step in enumerate(steps):
        yield mean + total[at] / step
