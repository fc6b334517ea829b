"""Timestamps and their parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PARTS = {"year": F.year, "month": F.month, "hour": F.hour}


def parse_ts(df: DataFrame, *cols: str) -> DataFrame:
    """Turn string columns into timestamps; a malformed value becomes null, under ANSI mode too."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in cols})


def date_parts(df: DataFrame, col: str, parts: tuple[str, ...] = ("year", "month", "hour")) -> DataFrame:
    """Add the chosen parts of a timestamp column, each under its own name."""
    return df.withColumns({part: _PARTS[part](col) for part in parts})
