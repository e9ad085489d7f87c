"""Row predicates and column choice by name."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(text: Column) -> Column:
    """Neither NULL nor empty."""
    return text.isNotNull() & (text != "")


def absent_or_zero(number: Column) -> Column:
    return F.coalesce(number, F.lit(0)) == 0


def blank(text: Column) -> Column:
    """Only white space. NULL stays NULL, so a filter drops it."""
    return F.regexp_like(text, F.lit(r"^\s*$"))


def cols_matching(columns: DataFrame | Iterable[str], pattern: str) -> list[str]:
    """Column names that match ``pattern`` from their first character on."""
    names = columns.columns if isinstance(columns, DataFrame) else columns
    rule = re.compile(pattern)
    return [name for name in names if rule.match(name)]


def ticked(name: str) -> str:
    """A column name for an SQL expression, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal for an SQL expression."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> Column:
    """The column of exactly this name."""
    return F.col(ticked(name))
