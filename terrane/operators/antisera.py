"""Antiserum lots: groups of lots, and the lots of the recent seasons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions.lists import group_list, list_items

# Fixed value of the season rule: the month from which the seasons are named one by one.
NEW_SEASON_START = 10


def lot_groups(sera: DataFrame, sep: str = ", ") -> DataFrame:
    """Sorted unique list of the non-egg lots per (subtype, protocol, variant)."""
    return (
        sera.filter(~F.col("egg_vaccine"))
        .withColumn("_item", F.explode(list_items(F.col("lot"), sep)))
        .groupBy("subtype", "test_protocol", "variant_hash")
        .agg(group_list(F.col("_item"), sep).alias("lot_group"))
    )


def in_recent_seasons(season: Column, hemisphere: Column, as_of: Column) -> Column:
    """True for the seasons reportable on a date. Through September these are all
    seasons since last year; from October on, three named season halves."""
    month, year = F.month(as_of), F.year(as_of)
    since_last_year = season >= year - 1
    label = F.concat(season.cast("string"), hemisphere)
    named = label.isin(
        F.concat(year.cast("string"), F.lit("NH")),
        F.concat(year.cast("string"), F.lit("SH")),
        F.concat((year - 1).cast("string"), F.lit("NH")),
    )
    return F.when(month >= NEW_SEASON_START, named).otherwise(since_last_year)


def reportable_sera(sera: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Distinct non-egg antisera of the recent seasons; ``as_of`` defaults to today."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return (
        sera.filter(
            ~F.col("egg_vaccine")
            & in_recent_seasons(F.col("season"), F.col("hemisphere"), day)
        )
        .select("subtype", "strain_name", "passage", "lot")
        .distinct()
    )
