"""Ratios, rounding and number labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """`num` as a percentage of `den`, rounded; null where `den` is zero."""
    return F.round(F.try_divide(num, den) * 100, digits)


def nan_to_null(col: Column) -> Column:
    return F.nanvl(col, F.lit(None).cast("double"))


def star_label(stars: Column) -> Column:
    """A chart label such as `5★`."""
    return F.concat(stars.cast("int").cast("string"), F.lit("★"))


def _fixed(num: Column, digits: int) -> Column:
    """A number with fixed decimals and no grouping; an exact half goes to the even digit."""
    return F.replace(F.format_number(num, digits), F.lit(","), F.lit(""))


def human_format(num: Column) -> Column:
    """Short form of a count: `3.4M`, `1.2K`, `950`."""
    size = F.abs(num)
    return (
        F.when(size >= 1_000_000, F.concat(_fixed(num / F.lit(1_000_000.0), 1), F.lit("M")))
        .when(size >= 1_000, F.concat(_fixed(num / F.lit(1_000.0), 1), F.lit("K")))
        .otherwise(num.cast("bigint").cast("string"))
    )


def axis_format(num: Column) -> Column:
    """Bar label: millions with one decimal (`3.4M`), everything else in whole thousands (`12k`)."""
    return F.when(
        num >= 1_000_000, F.concat(_fixed(num / F.lit(1_000_000.0), 1), F.lit("M"))
    ).otherwise(F.concat(_fixed(num / F.lit(1_000.0), 0), F.lit("k")))
