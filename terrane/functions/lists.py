"""Delimited lists and range lists held in strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def list_items(text: Column, sep: str = ", ") -> Column:
    """Elements of a delimited list. ``sep`` is taken literally."""
    return F.split(text, "\\Q" + sep + "\\E")


def sorted_unique_list(text: Column, sep: str = ", ") -> Column:
    """The same list with its elements sorted and each kept once."""
    return F.array_join(F.array_sort(F.array_distinct(list_items(text, sep))), sep)


def list_has(text: Column, item: Column, sep: str = ", ") -> Column:
    """True when ``item`` is an element of the delimited list."""
    return F.array_contains(list_items(text, sep), item)


def group_list(item: Column, sep: str = ", ") -> Column:
    """Aggregate: the distinct items of a group, sorted, as one delimited list.

    ``collect_set`` removes repeats before the shuffle, so its state is bounded by
    the number of distinct items and not by the number of rows.
    """
    return F.array_join(F.array_sort(F.collect_set(item)), sep)


def range_positions(ranges: Column) -> Column:
    """Integers named by a range list such as ``'95;100..110'``, ascending."""
    def expand(part: Column) -> Column:
        ends = F.split(F.trim(part), r"\.\.")
        first = F.get(ends, F.lit(0)).cast("int")
        last = F.element_at(ends, -1).cast("int")
        return F.sequence(first, last)

    parts = F.split(ranges, ";")
    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, expand))))
