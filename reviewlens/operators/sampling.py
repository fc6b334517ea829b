"""Sampling and splitting.

With `key` (columns that identify a row) a row's fate is a hash of its key and the seed: it does not
depend on partitioning, and a task that is run again takes the same rows. Without `key` Spark's own
samplers are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DIGITS = 13  # hexadecimal digits of the hash in use: 52 bits, exact in a double


def hash_uniform(key: list[str], seed: int, purpose: str) -> Column:
    """A number in [0, 1) from a row's key. Different purposes give independent numbers."""
    text = F.concat_ws(":", F.lit(purpose), F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    digits = F.substring(F.md5(text), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(16**_DIGITS))


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name, keeping duplicates."""
    return reduce(DataFrame.unionByName, frames)


def sample_fraction(df: DataFrame, fraction: float, seed: int, key: list[str] | None = None) -> DataFrame:
    if key is None:
        return df.sample(fraction=fraction, seed=seed)
    return df.filter(hash_uniform(key, seed, "sample") < fraction)


def split(df: DataFrame, weights: list[float], seed: int = 25, key: list[str] | None = None) -> list[DataFrame]:
    """Disjoint parts that together make up `df`, their sizes in proportion to `weights`."""
    if key is None:
        return df.randomSplit(weights, seed=seed)
    u = hash_uniform(key, seed, "split")
    total = float(sum(weights))
    bounds = [0.0, *[sum(weights[: i + 1]) / total for i in range(len(weights) - 1)], 1.0]
    return [df.filter((u >= lo) & (u < hi)) for lo, hi in zip(bounds, bounds[1:])]


def class_counts(df: DataFrame, label: str, classes: tuple[int, ...]) -> DataFrame:
    """Rows per listed class: at most one row for each of `classes`."""
    return df.filter(F.col(label).isin(*classes)).groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))


def balance_classes(
    df: DataFrame,
    label: str = "label",
    anchor: int = 1,
    seed: int = 42,
    key: list[str] | None = None,
    classes: tuple[int, ...] = (0, 1, 2),
) -> DataFrame:
    """Undersample every class to about the size of the `anchor` class, which is kept whole.

    A class smaller than the anchor is kept whole too; rows of no listed class are left out. The fractions
    are a table of one row per class.
    """
    counts = class_counts(df, label, classes)
    anchor_n = counts.agg(F.max(F.when(F.col(label) == anchor, F.col("n_class")))).scalar()
    fractions = counts.select(
        label, F.least(F.lit(1.0), F.try_divide(anchor_n, F.col("n_class"))).alias("_fraction")
    )
    u = F.rand(seed) if key is None else hash_uniform(key, seed, "balance")
    kept = df.withColumn("_u", u).join(F.broadcast(fractions), label)
    return kept.filter((F.col(label) == anchor) | (F.col("_u") < F.col("_fraction"))).select(*df.columns)
