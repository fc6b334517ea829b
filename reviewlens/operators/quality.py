"""Profiling and data-quality checks. Every check is one pass and returns a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATS = ("count", "mean", "stddev", "min", "p25", "p50", "p75", "max")


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Number of rows of each named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _missing(field: T.StructField, nan: bool, empty: bool, text_nan: bool) -> Column:
    col = F.col(f"`{field.name}`")
    test = col.isNull()
    if nan and isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        test = test | F.isnan(col)
    if text_nan and isinstance(field.dataType, T.StringType):
        test = test | F.isnan(F.coalesce(col.try_cast("double"), F.lit(0.0)))
    if empty:
        test = test | (F.coalesce(col.cast("string"), F.lit("")) == "")
    return test


def missing_counts(
    df: DataFrame,
    cols: list[str] | None = None,
    nan: bool = True,
    empty: bool = False,
    text_nan: bool = False,
) -> DataFrame:
    """One row: per column the number of missing values.

    Missing is null, NaN in a float column (`nan`), the empty string in any column's text form
    (`empty`), and a string that reads as NaN (`text_nan`).
    """
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    return df.agg(*[F.count_if(_missing(f, nan, empty, text_nan)).alias(f.name) for f in fields])


def blank_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows whose text is empty or made of spaces only."""
    return df.filter(F.trim(F.col(col)) == "")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: total rows, distinct keys and surplus rows; null counts as a key value."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("unique_keys")
    ).withColumn("duplicates", F.col("total") - F.col("unique_keys"))


def distinct_count(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: number of distinct combinations of `cols`, null counting as a value."""
    return df.select(*cols).distinct().agg(F.count(F.lit(1)).alias("n_distinct"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value of a discrete column, by value ascending."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(col)


def summarize(df: DataFrame, cols: list[str] | None = None, stats: tuple[str, ...] = STATS) -> DataFrame:
    """One row per column with the chosen statistics, all columns in a single pass.

    Numbers get every statistic; strings and timestamps get count, min and max; columns of other types
    have no order and are left out. `min`, the quartiles and `max` are text, so that columns of
    different types share a table. Quartiles are approximate.
    """
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    atoms = (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType)
    fields = [f for f in fields if isinstance(f.dataType, (T.NumericType, *atoms))]
    rank = {"p25": 0, "p50": 1, "p75": 2}
    none = {"mean": F.lit(None).cast("double"), "stddev": F.lit(None).cast("double")}

    aggs: list[Column] = []
    rows: list[Column] = []
    for i, field in enumerate(fields):
        col = F.col(f"`{field.name}`")
        numeric = isinstance(field.dataType, T.NumericType)
        aggs += [F.count(col).alias(f"count_{i}"), F.min(col).alias(f"min_{i}"), F.max(col).alias(f"max_{i}")]
        if numeric:
            aggs += [F.mean(col).alias(f"mean_{i}"), F.stddev(col).alias(f"stddev_{i}")]
            if set(stats) & set(rank):
                aggs.append(F.percentile_approx(col, [0.25, 0.5, 0.75]).alias(f"quartiles_{i}"))
        entry = [F.lit(field.name).alias("column")]
        for stat in stats:
            if stat in rank:
                value = F.get(F.col(f"quartiles_{i}"), F.lit(rank[stat])) if numeric else F.lit(None)
            elif stat in none and not numeric:
                value = none[stat]
            else:
                value = F.col(f"{stat}_{i}")
            if stat not in ("count", *none):
                value = value.cast("string")
            entry.append(value.alias(stat))
        rows.append(F.struct(*entry))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def valid_rate(df: DataFrame, col: str) -> DataFrame:
    """One row: valid and total rows and the null-or-NaN rate of `col` in percent, to two decimals."""
    field = next(f for f in df.schema.fields if f.name == col)
    counts = df.agg(
        F.count_if(~_missing(field, True, False, False)).alias("n_valid"),
        F.count(F.lit(1)).alias("n_total"),
    )
    invalid = F.col("n_total") - F.col("n_valid")
    return counts.withColumn("invalid_pct", F.round(F.try_divide(invalid, F.col("n_total")) * 100, 2))
