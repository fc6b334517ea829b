"""Joins between the review table and its dimensions.

No side is broadcast because it is believed to be small. A hint is given only where the number of rows
is bounded by construction (the hot keys, the class table); everything else is left to Spark, which
compares measured sizes with its broadcast threshold.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.functions import item_count
from reviewlens.operators.clean import prefix_columns

def default_pieces(spark: SparkSession) -> int:
    """How finely a skewed table is cut: four pieces per shuffle partition."""
    setting = spark.conf.get("spark.sql.shuffle.partitions", "200")
    return 4 * (int(setting) if setting.isdigit() else 200)


#: Rows of a large table that one task sorts or groups. Sizes of shuffled files say little of it: well compressed
#: rows grow tenfold and more in memory.
ROWS_PER_TASK = 500_000


def row_parts(df: DataFrame) -> int | None:
    """Parts of at most `ROWS_PER_TASK` rows to deal `df` over, or None where there is one or less for each core.

    Counts the rows, so `df` should be a stored table, where that reads no column. There are never fewer parts than
    shuffle partitions: Spark would shuffle those again before a join.
    """
    spark = df.sparkSession
    parts = math.ceil(df.count() / ROWS_PER_TASK)
    return max(parts, default_pieces(spark) // 4) if parts > spark.sparkContext.defaultParallelism else None


def join_in_parts(left: DataFrame, right: DataFrame, key: str, parts: int | None) -> DataFrame:
    """Inner join in `parts` parts by the key, so that a task's share does not grow with the tables; None leaves it to Spark."""
    if parts is None:
        return left.join(right, key)
    return left.repartition(parts, key).join(right.repartition(parts, key), key)


def hot_keys(df: DataFrame, key: str, pieces: int | None = None, weight: str | None = None) -> DataFrame:
    """Keys that hold more than 1/`pieces` of the rows, with the number of such pieces each one fills.

    By counting there are fewer than `pieces` hot keys, and their pieces add up to less than twice
    `pieces`; both bounds hold whatever the data. `weight` names a column that says for how many rows a row stands.
    """
    pieces = pieces or default_pieces(df.sparkSession)
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(rows.alias("_n"))
    filled = F.col("_n") * F.lit(pieces) / counts.agg(F.sum("_n")).scalar()
    return counts.filter(filled > 1).select(key, F.ceil(filled).cast("int").alias("_pieces"))


def collected(hot: DataFrame) -> DataFrame:
    """Hot keys as a table that is already there, whose size Spark knows; it is bounded, so it passes through the driver."""
    return hot.sparkSession.createDataFrame(hot.collect(), hot.schema)


#: Slots that keys are counted in before they are counted one by one, for each piece.
SLOTS_PER_PIECE = 16


def hot_keys_scanned(table: DataFrame, key: str, pieces: int | None = None) -> DataFrame:
    """`hot_keys` of a table that is cheap to read: it may be read twice, but hardly a row of it is shuffled.

    Rows are first counted in slots by a hash of their key. A key with more than 1/`pieces` of the rows makes its slot as
    large, so keys are counted only in the slots that are. Slots and hot keys are bounded by `pieces`, whatever the
    data, and pass through the driver.
    """
    pieces = pieces or default_pieces(table.sparkSession)
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS_PER_PIECE * pieces))
    rows = table.select(key).filter(F.col(key).isNotNull()).withColumn("_slot", slot)
    slots = rows.groupBy("_slot").count().collect()
    total = sum(s["count"] for s in slots)
    large = [s["_slot"] for s in slots if s["count"] * pieces > total]
    counts = rows.filter(F.col("_slot").isin(large)).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    filled = F.col("_n") * F.lit(pieces) / F.lit(total)
    return collected(counts.filter(filled > 1).select(key, F.ceil(filled).cast("int").alias("_pieces")))


def hot_keys_together(df: DataFrame, keys: list[str], pieces: int | None = None) -> dict[str, DataFrame]:
    """`hot_keys` of several columns, counted in one scan of `df`, as tables that are already there.

    There are fewer than `pieces` of each, whatever the data, so they pass through the driver.
    """
    spark = df.sparkSession
    pieces = pieces or default_pieces(spark)
    sets = [[F.col(k)] for k in keys]
    counts = df.groupingSets(sets, *keys).agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"))
    # Bit i from the left is 0 for the column that a row counts.
    which = {(1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i)): k for i, k in enumerate(keys)}
    of = {number: (F.col("_set") == number) & F.col(k).isNotNull() for number, k in which.items()}
    totals = counts.agg(F.struct(*[F.sum(F.when(own, F.col("_n"))).alias(f"t{n}") for n, own in of.items()])).scalar()
    filled = F.coalesce(*[
        F.when(own, F.col("_n") * F.lit(pieces) / totals.getField(f"t{n}")) for n, own in of.items()])
    found = counts.withColumn("_filled", filled).filter("_filled > 1").collect()
    return {
        k: spark.createDataFrame(
            [(r[k], math.ceil(r["_filled"])) for r in found if r["_set"] == number],
            T.StructType([T.StructField(k, df.schema[k].dataType), T.StructField("_pieces", T.IntegerType())]),
        )
        for number, k in which.items()
    }


def _spread(df: DataFrame, key: str) -> list[Column]:
    simple = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.StructType))]
    return [F.col(c) for c in simple if c != key]


def with_piece(fact: DataFrame, key: str, hot: DataFrame, spread: list[str] | None, pieces: int) -> DataFrame:
    """Add `_piece`: the sub-key of a row of a hot key or a null one, by a hash of the row, and 0 elsewhere."""
    by = [F.col(c) for c in spread] if spread else _spread(fact, key)
    width = F.when(F.col(key).isNull(), F.lit(pieces)).otherwise(F.col("_pieces"))
    piece = F.when(width.isNotNull(), F.pmod(F.xxhash64(*by), width).cast("int")).otherwise(F.lit(0))
    return fact.join(hot, key, "left").withColumn("_piece", piece).drop("_pieces")


def repeat_rows(dim: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Each row of a hot key once for every `_piece` of the key, every other row once with piece 0."""
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)
    return dim.join(hot, key, "left").withColumn("_piece", F.explode(copies)).drop("_pieces")


def skew_join(
    fact: DataFrame,
    dims: DataFrame | list[DataFrame],
    key: str,
    how: str = "left",
    hot: DataFrame | None = None,
    spread: list[str] | None = None,
    pieces: int | None = None,
    parts: int | None = None,
    dim_parts: int | None = None,
) -> DataFrame:
    """Equi-join of a large table with one or more dimensions on a key of which some values are very frequent.

    Rows of a hot key are spread over as many sub-keys as the key fills pieces, and the dimension's rows of
    just those keys are repeated once per sub-key; null keys, which match nothing, are spread as well. So no
    sub-key is larger than about a piece, and the repeats stay below twice the number of pieces. The result
    equals the plain joins. All dimensions of one call share the large table's partitioning, so it is
    shuffled once, and not at all where Spark finds every dimension small enough to broadcast.

    The sub-key is a hash of the row itself (of `spread`, by default of every simple column), so a task that
    runs again after a lost executor puts each row where it was before. `hot` may hand in the hot keys found
    on a cheaper table than `fact`; it must come from a `hot_keys...` function here, whose size is bounded. `how` is `left` or `inner`.
    `parts` (of `row_parts`) deals the large table over that many parts by key and sub-key even where the dimensions are
    broadcast: worth its shuffle if the result is grouped by the key, since a task then meets its own keys alone.
    `dim_parts` (of `row_parts`) deals the dimensions instead: the large table follows where it is shuffled anyway, in parts
    that adaptive execution does not merge by their compressed bytes, and stays where it is if they are broadcast.
    """
    if how not in ("left", "inner"):
        raise ValueError("skew_join repeats dimension rows, so only left and inner joins are exact")
    pieces = pieces or default_pieces(fact.sparkSession)
    hot = F.broadcast(hot_keys(fact, key, pieces) if hot is None else hot)
    joined = with_piece(fact, key, hot, spread, pieces)
    if parts is not None:
        joined = joined.repartition(parts, key, "_piece")
    for dim in dims if isinstance(dims, list) else [dims]:
        repeated = repeat_rows(dim, key, hot)
        if dim_parts is not None:
            repeated = repeated.repartition(dim_parts, key, "_piece")
        joined = joined.join(repeated, [key, "_piece"], how)
    return joined.drop("_piece")


def checkin_counts(checkin: DataFrame) -> DataFrame:
    """Check-ins per row of the check-in table."""
    return checkin.select("business_id", item_count(F.col("date")).alias("checkin_count"))


def tip_counts(tips: DataFrame, key: str, out: str = "tip_count") -> DataFrame:
    """Tips per business or per user."""
    return tips.groupBy(key).agg(F.count(F.lit(1)).alias(out))


# Columns that reviews, businesses and users all have.
_SHARED = ["review_count", "name", "stars", "useful", "funny", "cool"]


def business_dimensions(business: DataFrame, checkin: DataFrame, tip: DataFrame) -> dict[str, DataFrame]:
    """What joins a review by its business."""
    return {
        "business": prefix_columns(business, _SHARED, "business_"),
        "checkin": checkin_counts(checkin),
        "business_tip": tip_counts(tip, "business_id", "business_tip_count"),
    }


def user_dimensions(user: DataFrame, tip: DataFrame) -> dict[str, DataFrame]:
    """What joins a review by its user."""
    return {
        "user": prefix_columns(user, _SHARED, "user_"),
        "user_tip": tip_counts(tip, "user_id", "user_tip_count"),
    }


def build_wide(
    review: DataFrame,
    business: DataFrame,
    user: DataFrame,
    checkin: DataFrame,
    tip: DataFrame,
    spread: list[str] | None = None,
    hot: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Review-grain wide table: every review with its business, its user, check-ins and tip counts.

    Tips are counted before the join, so they do not multiply reviews. The three business-keyed tables
    are joined in one go and the two user-keyed ones in another, so that the reviews are shuffled at most
    twice. `spread` names review columns that tell apart reviews of one business (`review_id` if unique). `hot` may
    hand in the `hot_keys` of `business_id` and `user_id` found on cheaper tables, where `review` is itself a join.
    """
    of_business, of_user = business_dimensions(business, checkin, tip), user_dimensions(user, tip)
    hot = hot or hot_keys_together(review, ["business_id", "user_id"])
    wide = skew_join(review, list(of_business.values()), "business_id", hot=hot["business_id"], spread=spread)
    return skew_join(wide, list(of_user.values()), "user_id", hot=hot["user_id"], spread=spread)


def restrict_to_keys(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in `ids`. Spark broadcasts a top-k list by itself: a limit bounds its size."""
    return df.join(ids.select(key), key, "left_semi")


def label_grid(spark: SparkSession, dims: dict[str, list]) -> DataFrame:
    """Every combination of the listed labels, one row each."""
    names = list(dims)
    return spark.createDataFrame([tuple(combo) for combo in product(*dims.values())], names)


def densify(counts: DataFrame, dims: dict[str, list], fill: int = 0) -> DataFrame:
    """Give every combination of the listed labels a row; missing measures become `fill`."""
    grid = label_grid(counts.sparkSession, dims)
    for name in dims:
        grid = grid.withColumn(name, F.col(name).cast(counts.schema[name].dataType))
    return grid.join(counts, list(dims), "left").fillna(fill)
