"""Near pairs of points by bricks of cells, in numpy.

A cell is as wide as the limit, and a brick has 2 ** ``BITS`` cells along each axis. Rows come
sorted by group and brick; many small groups are searched together, and what is held at once is
bounded by the points of a brick and by ``CANDIDATES``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

# Cells along a brick, as a power of two; bricks stand around the origin; points
# searched together; pairs whose distance is taken at once.
BITS = 5
SHIFT = 1 << (BITS - 1)
ROWS = 1 << 16
CANDIDATES = 1 << 19
# a brick's cells with those of its rim, and one more on either side that stays empty
_SIDE = (1 << BITS) + 4


def half_shell() -> list[tuple[int, int, int]]:
    """The own cell and one of each pair of opposite neighbours: 14 of 27 cells."""
    steps = (-1, 0, 1)
    return [c for c in ((i, j, k) for i in steps for j in steps for k in steps) if c >= (0, 0, 0)]


def found_pairs(
    batches: Iterator[pa.RecordBatch], by: Sequence[str], limit: float
) -> Iterator[pa.RecordBatch]:
    """Rows (by, pos1, pos2) of the pairs whose later cell is in the brick of the rows."""
    for table, group in _whole_bricks(batches, [*by, "_bx", "_by", "_bz"]):
        xyz = [table.column(a).to_numpy() for a in "xyz"]
        pos = table.column("pos").to_numpy()
        cells = [
            np.floor(v / limit).astype(np.int64) + SHIFT - (table.column(f"_b{a}").to_numpy() << BITS)
            for a, v in zip("xyz", xyz)]
        for one, two in near_pairs(group, cells, pos, xyz, limit):
            yield pa.RecordBatch.from_arrays(
                [*[table.column(c).combine_chunks().take(pa.array(one)) for c in by],
                 pa.array(np.minimum(pos[one], pos[two])), pa.array(np.maximum(pos[one], pos[two]))],
                names=[*by, "pos1", "pos2"])


def _whole_bricks(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of about ``ROWS`` rows that end with a brick, with the brick's number per row."""
    held, enough = [], ROWS
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(map(len, held)) < enough:
            continue
        table = pa.concat_tables(held).combine_chunks()
        group = _group_numbers(table, keys)
        whole = int(np.searchsorted(group, group[-1]))
        if whole:
            yield table.slice(0, whole), group[:whole]
        held = [table.slice(whole)]
        enough = max(ROWS, 2 * (len(table) - whole))
    if sum(map(len, held)):
        table = pa.concat_tables(held).combine_chunks()
        yield table, _group_numbers(table, keys)


def _group_numbers(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    new = np.zeros(len(table), bool)
    for key in keys:
        code = table.column(key).combine_chunks().dictionary_encode().indices.to_numpy()
        new[1:] |= code[1:] != code[:-1]
    return new.cumsum()


def near_pairs(
    group: np.ndarray, cells: Sequence[np.ndarray], pos: np.ndarray, xyz: Sequence[np.ndarray],
    limit: float,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs of a group with 0 < distance < ``limit``, one row of which is native:
    its cell, counted from the brick's first, is inside the brick. Each pair comes once, in the
    brick of the row whose cell is later; rows of one place in the order, in one cell, are none."""
    key = group.astype(np.int64)
    native = np.ones(len(group), bool)
    for cell in cells:
        key = key * _SIDE + cell + 2
        native &= (cell >= 0) & (cell < 1 << BITS)
    order = np.argsort(key, kind="stable")
    key, pos, native = key[order], pos[order], native[order]
    xyz = [v[order] for v in xyz]
    at = np.flatnonzero(native)
    keys = key[at]
    # the cells of one column along z are neighbours in the order; in the own column, what
    # comes behind the point itself
    for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1)):
        column = key + (dx * _SIDE + dy) * _SIDE
        low = native.cumsum() if (dx, dy) == (0, 0) else np.searchsorted(keys, column - 1)
        counts = np.searchsorted(keys, column + 1, side="right") - low
        ends = counts.cumsum()
        start = 0
        while start < len(key):
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + CANDIDATES, side="right")), start + 1)
            some = counts[start:stop]
            one = np.repeat(np.arange(start, stop), some)
            first = np.repeat(low[start:stop] - (ends[start:stop] - some - before), some)
            two = at[first + np.arange(len(one))]
            start = stop
            apart = sum((v[one] - v[two]) ** 2 for v in xyz)
            kept = (apart > 0) & (apart < limit * limit)
            one, two = one[kept], two[kept]
            other = (pos[one] != pos[two]) | (key[one] != key[two])
            if other.any():
                yield order[one[other]], order[two[other]]
