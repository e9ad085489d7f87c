"""Expressions over aligned sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def letter_count(text: Column, letter: str) -> Column:
    """How often one letter occurs in ``text``."""
    return (F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))).cast("int")


def residue_at(text: Column, position: Column) -> Column:
    """Character at a 1-based position; past the end it is the last character."""
    return F.right(F.substring(text, F.lit(1), position), F.lit(1))
