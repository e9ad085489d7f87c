"""Numeric expressions: titer scaling, rounding to a data-driven digit, hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the assay and the mesh.
TITER_UNIT = 5.0
MESH_STEPS = 25


def log_titer(titer: Column) -> Column:
    """log2(titer / 5); text that is no number and titers of 0 or less give NULL."""
    return F.log2(titer.try_cast("double") / F.lit(TITER_UNIT))


def unlog_titer(logged: Column) -> Column:
    return F.pow(F.lit(2.0), logged) * F.lit(TITER_UNIT)


def number_or_null(c: Column) -> Column:
    """A double, with NaN and unreadable text turned into NULL."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def round_half_even_at(value: Column, scale: Column) -> Column:
    """Round half to even at the decimal place of the leading digit of ``scale``."""
    power = F.pow(F.lit(10.0), -F.floor(F.log10(scale)).cast("double"))
    return F.rint(value * power) / power


def axis_bounds(low: Column, high: Column) -> tuple[Column, Column]:
    """Rounded bounds a tenth wider than the data, clamped at zero when they would
    cross it. Both are NULL for an axis without extent."""
    margin = F.abs(high - low) / F.lit(10.0)
    margin = F.when(margin > 0, margin)
    lower = round_half_even_at(low - margin, margin)
    upper = round_half_even_at(high + margin, margin)
    clamp_low = (low > 0) & (lower <= 0)
    clamp_high = ~clamp_low & (high < 0) & (high + margin > 0)
    zero = F.when(margin > 0, F.lit(0.0))
    return (
        F.when(clamp_low, zero).otherwise(lower),
        F.when(clamp_high, zero).otherwise(upper),
    )


def hash_number(*parts: Column) -> Column:
    """A 32-bit number from the MD5 of the parts: the same on every engine and run."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_bucket(buckets: int | Column, *parts: Column) -> Column:
    size = buckets if isinstance(buckets, Column) else F.lit(buckets)
    return F.pmod(hash_number(*parts), size.cast("bigint")).cast("int")
