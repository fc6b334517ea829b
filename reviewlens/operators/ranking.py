"""Top-k reports. Each has a total order, so that ties do not change the answer between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlens.operators.aggregates import group_count


def top_groups(df: DataFrame, by: str, k: int = 10, out: str = "n") -> DataFrame:
    """The `k` most frequent values of a column."""
    return group_count(df, [by], out).orderBy(F.desc(out), by).limit(k)


def _of_category(business: DataFrame, category: str, extra: tuple[str, ...] = ()) -> DataFrame:
    cols = ["business_id", "name", *extra, "city", "review_count", F.col("stars").alias("avg_rating")]
    return business.filter(F.col("main_category") == category).select(*cols)


def top_businesses(
    business: DataFrame, category: str, k: int = 10, extra: tuple[str, ...] = ()
) -> DataFrame:
    """Most reviewed businesses of a category, better rated first among equals; `extra` adds columns."""
    order = (F.desc("review_count"), F.desc("avg_rating"), "business_id")
    return _of_category(business, category, extra).orderBy(*order).limit(k)


def bottom_businesses(business: DataFrame, category: str, k: int = 10) -> DataFrame:
    """Least reviewed businesses of a category, worse rated first among equals."""
    order = (F.asc("review_count"), F.asc("avg_rating"), "business_id")
    return _of_category(business, category).orderBy(*order).limit(k)


def top_businesses_sql(
    spark: SparkSession, category: str, k: int = 10, businesses: str = "businesses"
) -> DataFrame:
    """Most reviewed businesses of a category in SQL over a registered view."""
    return spark.sql(
        f"""
        SELECT name, city, review_count, stars AS avg_rating
        FROM {businesses}
        WHERE main_category = :category
        ORDER BY review_count DESC, avg_rating DESC, business_id
        LIMIT {int(k)}
        """,
        args={"category": category},
    )


def top_users(users: DataFrame, k: int = 10, cols: tuple[str, ...] = ("name", "review_count")) -> DataFrame:
    """Users with the most reviews; `cols` are the columns to show."""
    return users.orderBy(F.desc("review_count"), "user_id").limit(k).select(*cols)


def top_words(words: DataFrame, by: str = "sentiment", k: int = 20) -> DataFrame:
    """The `k` most frequent words of each class.

    Spark cuts each partition to `k` rows per class before the ranking shuffle, so the vocabulary
    itself never gathers in one task.
    """
    counts = group_count(words, [by, "word"], "count")
    order = Window.partitionBy(by).orderBy(F.desc("count"), "word")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
