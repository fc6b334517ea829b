"""Projection, filters, cleaning and imputation: row-local, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.FloatType, T.DoubleType)


def select_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def drop_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def replace_sentinel(df: DataFrame, cols: list[str], sentinel: int = -1, value: int = 0) -> DataFrame:
    """Replace exactly `sentinel` by `value`; other negatives and null stay."""
    return df.withColumns({c: F.when(F.col(c) == sentinel, value).otherwise(F.col(c)) for c in cols})


def drop_invalid_strings(df: DataFrame, col: str, bad: tuple[str, ...] = ("", "None")) -> DataFrame:
    """Keep rows whose string is neither null nor one of `bad`."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*bad))


def require_nonempty(df: DataFrame, cols: list[str], nan: bool = False) -> DataFrame:
    """Keep rows in which every column is neither null nor empty; with `nan`, nor reads as NaN."""
    for name in cols:
        col = F.col(name)
        df = df.filter(col.isNotNull() & (col.cast("string") != ""))
        if nan:
            kind = df.schema[name].dataType
            number = col if isinstance(kind, _FLOATS) else F.coalesce(col.try_cast("double"), F.lit(0.0))
            df = df.filter(~F.isnan(number))
    return df


def impute_concat(df: DataFrame, target: str, parts: list[str], sep: str = ", ") -> DataFrame:
    """Fill a null or empty `target` with the non-null `parts`, joined."""
    col = F.col(target)
    filled = F.concat_ws(sep, *[F.col(p) for p in parts])
    return df.withColumn(target, F.when(col.isNull() | (col == ""), filled).otherwise(col))


def fill_defaults(df: DataFrame, defaults: dict[str, int | float | str]) -> DataFrame:
    """Fill nulls by a constant per column."""
    return df.fillna(defaults)


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.fillna(0, subset=cols)


def fill_empty_array(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.array().cast(df.schema[col].dataType)))


def prefix_columns(df: DataFrame, cols: list[str], prefix: str) -> DataFrame:
    """Prefix the listed columns that exist, so that a join has no name clash."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in cols})


def name_like(df: DataFrame, pattern: str, col: str = "name") -> DataFrame:
    return df.filter(F.col(col).like(pattern))


def min_volume(df: DataFrame, col: str, n: int) -> DataFrame:
    """Keep groups with at least `n`."""
    return df.filter(F.col(col) >= n)
