"""Tables stored by a key, so that later jobs join them without moving their rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.operators import joins
from reviewlens.operators.joins import (
    business_dimensions,
    hot_keys,
    hot_keys_scanned,
    repeat_rows,
    row_parts,
    skew_join,
    user_dimensions,
    with_piece,
)

PIECE = "_piece"


def row_buckets(df: DataFrame, least: int = 8) -> int:
    """Buckets of at most `ROWS_PER_TASK` rows each to store `df` in, `least` or more.

    Counts the rows, so `df` should be a stored table, where that reads no column. One task sorts a bucket whenever it is
    written or joined, so a fixed number of buckets would make tasks spill once the table is large.
    """
    return max(least, math.ceil(df.count() / joins.ROWS_PER_TASK))


@dataclass(frozen=True)
class Layout:
    """A large table stored by (`key`, piece) in `buckets`, and under which names its dimensions are stored alike.

    All tables of a layout are named `<name>_<table>` in the session's catalog and lie under `folder`, which every
    executor must reach.
    """

    spark: SparkSession
    folder: str
    name: str
    key: str
    buckets: int

    def table(self, name: str) -> str:
        return f"{self.name}_{name}"

    def _path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{self.table(name)}"

    def _write(self, df: DataFrame, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.table(name)}`")
        # Rows are dealt by the same hash as the buckets, so each bucket is one file.
        (df.repartition(self.buckets, self.key, PIECE).write.mode("overwrite")
         .bucketBy(self.buckets, self.key, PIECE).sortBy(self.key, PIECE)
         .option("path", self._path(name)).saveAsTable(self.table(name)))

    def _hot(self) -> DataFrame:
        return F.broadcast(self.spark.read.parquet(self._path("hot")))

    def store_fact(
        self, df: DataFrame, name: str, spread: list[str] | None = None, hot: DataFrame | None = None
    ) -> None:
        """Store the large table, replacing an earlier one.

        A key that holds more than a bucket's share of the rows is spread over as many pieces as it fills buckets, by a
        hash of the row (of `spread`, by default of every simple column); null keys, which match nothing, are spread
        over all. There are fewer hot keys than buckets, and their pieces add up to less than twice as many. They are
        stored beside the table: every dimension must be stored after it. `hot` may hand in the hot keys for `buckets`
        pieces found on a cheaper table, where `df` is a join that would run once more to count them.
        """
        hot = hot_keys(df, self.key, self.buckets) if hot is None else hot
        hot.write.mode("overwrite").parquet(self._path("hot"))
        self._write(with_piece(df, self.key, self._hot(), spread, self.buckets), name)

    def store_dimension(self, df: DataFrame, name: str) -> None:
        """Store a table joined by the key: rows of a hot key once for each of its pieces, the others once."""
        self._write(repeat_rows(df, self.key, self._hot()), name)

    def join(self, fact: str, dims: list[str], how: str = "left") -> DataFrame:
        """Equi-join of stored tables. No row of the large table is shuffled, nor one of a dimension.

        The result equals the join of the tables as they were given. `how` is `left` or `inner`.
        """
        if how not in ("left", "inner"):
            raise ValueError("dimension rows of hot keys are repeated, so only left and inner joins are exact")
        joined = self.read(fact)
        for dim in dims:
            joined = joined.join(self.read(dim), [self.key, PIECE], how)
        return joined.drop(PIECE)

    def read(self, name: str) -> DataFrame:
        """A stored table as it lies, with the piece of each row; a dimension has its repeats."""
        return self.spark.table(self.table(name))


def store_star(
    layout: Layout,
    review: DataFrame,
    business: DataFrame,
    checkin: DataFrame,
    tip: DataFrame,
    spread: list[str] | None = None,
    hot: DataFrame | None = None,
) -> None:
    """Store reviews and what joins them by their business; `layout.key` is `business_id`. `hot` as in `store_fact`."""
    layout.store_fact(review, "review", spread, hot)
    for name, dim in business_dimensions(business, checkin, tip).items():
        layout.store_dimension(dim, name)


def wide_from_star(layout: Layout, user: DataFrame, tip: DataFrame, spread: list[str] | None = None) -> DataFrame:
    """The rows of `build_wide` from a stored star: the join by business moves no review, the one by user moves them once."""
    of_business = layout.join("review", ["business", "checkin", "business_tip"])
    review = layout.read("review")
    hot = hot_keys_scanned(review, "user_id")
    dims, parts = list(user_dimensions(user, tip).values()), row_parts(review)
    return skew_join(of_business, dims, "user_id", hot=hot, spread=spread, dim_parts=parts)
