"""Grouped aggregates. Anything that joins reviews to businesses aggregates per business first."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions import pct, sentiment_label

SENTIMENTS = ("Negative", "Neutral", "Positive")


def group_count(df: DataFrame, keys: list[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def share_of_total(counts: DataFrame, measure: str = "n", digits: int = 1, out: str = "pct") -> DataFrame:
    """Add each group's share of the grand total, in percent.

    The total is a scalar subquery over the grouped rows, so groups never gather in one task.
    """
    total = counts.agg(F.sum(measure)).scalar()
    return counts.withColumn(out, pct(F.col(measure), total, digits))


def tag_counts(df: DataFrame, col: str = "categories", sep: str = ",", out: str = "category_word") -> DataFrame:
    """Businesses per trimmed tag of a delimited column, most frequent first."""
    tags = df.select(F.explode(F.split(F.col(col), sep)).alias(out)).withColumn(out, F.trim(F.col(out)))
    return group_count(tags, [out], "count").orderBy(F.desc("count"), out)


def reviews_by_category(reviews: DataFrame, business: DataFrame, k: int = 10) -> DataFrame:
    """Main categories with the most reviews.

    Reviews are counted per business before the join, so a business with very many reviews reaches
    the join as a single row.
    """
    per_business = group_count(reviews, ["business_id"], "_n")
    return (
        per_business.join(business.select("business_id", "main_category"), "business_id")
        .groupBy("main_category")
        .agg(F.sum("_n").alias("review_count"))
        .orderBy(F.desc("review_count"), "main_category")
        .limit(k)
    )


def reviews_by_category_sql(
    spark: SparkSession, k: int = 10, reviews: str = "reviews", businesses: str = "businesses"
) -> DataFrame:
    """The same table in SQL over two registered views."""
    return spark.sql(
        f"""
        WITH per_business AS (
            SELECT business_id, COUNT(review_id) AS n FROM {reviews} GROUP BY business_id
        )
        SELECT main_category, SUM(n) AS review_count
        FROM per_business JOIN {businesses} USING (business_id)
        GROUP BY main_category
        ORDER BY review_count DESC, main_category
        LIMIT {int(k)}
        """
    )


def category_sentiment_counts(reviews: DataFrame, business: DataFrame) -> DataFrame:
    """Reviews per main category and three-way sentiment.

    The three sentiments are counted side by side per business, so the counts are already partitioned
    by the join's key and meet the businesses without another shuffle.
    """
    label = sentiment_label(F.col("stars"))
    per_business = reviews.groupBy("business_id").agg(*[F.count_if(label == s).alias(s) for s in SENTIMENTS])
    per_category = (
        per_business.join(business.select("business_id", "main_category"), "business_id")
        .groupBy("main_category")
        .agg(*[F.sum(s).alias(s) for s in SENTIMENTS])
    )
    return per_category.unpivot(
        "main_category", list(SENTIMENTS), "sentiment_label", "count"
    ).filter(F.col("count") > 0)


def category_sentiment(counts: DataFrame, min_total: int = 500) -> DataFrame:
    """One row per main category: reviews of each sentiment, total, and the three percentages.

    Only categories with at least `min_total` reviews; most positive first.
    """
    wide = (
        counts.groupBy("main_category").pivot("sentiment_label", list(SENTIMENTS)).sum("count").fillna(0)
    )
    total = sum((F.col(s) for s in SENTIMENTS[1:]), F.col(SENTIMENTS[0]))
    wide = wide.withColumn("total", total)
    shares = {f"{s.lower()}_pct": pct(F.col(s), F.col("total"), 1) for s in SENTIMENTS}
    return (
        wide.withColumns(shares)
        .filter(F.col("total") >= min_total)
        .orderBy(F.desc("positive_pct"), "main_category")
    )


def extreme_categories(table: DataFrame, by: str = "negative_pct", k: int = 10) -> DataFrame:
    """The `k` categories with the highest `positive_pct` or `negative_pct`."""
    return (
        table.select("main_category", "total", "positive_pct", "negative_pct")
        .orderBy(F.desc(by), "main_category")
        .limit(k)
    )


def city_stats(business: DataFrame, category: str) -> DataFrame:
    """Businesses, mean rating and reviews per city within one main category."""
    return (
        business.filter(F.col("main_category") == category)
        .groupBy("city")
        .agg(
            F.count("business_id").alias("total_businesses"),
            F.avg("stars").alias("avg_rating"),
            F.sum("review_count").alias("total_reviews"),
        )
        .orderBy(F.desc("total_businesses"), F.desc("avg_rating"), F.desc("total_reviews"), "city")
    )


def length_by_group(df: DataFrame, by: str = "stars", length: str = "review_length") -> DataFrame:
    """Mean and approximate median length per group."""
    return (
        df.groupBy(by)
        .agg(
            F.avg(length).alias("avg_length"),
            F.percentile_approx(length, 0.5).alias("median_length"),
        )
        .orderBy(by)
    )


def avg_by_group(df: DataFrame, by: str = "main_category", measure: str = "stars") -> DataFrame:
    """Mean of `measure` per group, highest first, beside the plain mean of the group means."""
    means = df.groupBy(by).agg(F.avg(measure).alias(f"avg_{measure}"))
    overall = means.agg(F.avg(f"avg_{measure}")).scalar()
    return means.withColumn("overall_mean", overall).orderBy(F.desc(f"avg_{measure}"), by)


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows that have both values; null where either is constant.

    Spark's own `corr` fails on a constant column in ANSI mode.
    """
    x_used, y_used = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x_used) * F.stddev_pop(y_used))


def correlation(df: DataFrame, x: str, y: str, out: str = "correlation") -> DataFrame:
    """Pearson correlation of two columns over the rows that have both, and how many rows those are."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    return df.agg(
        pearson(F.col(x), F.col(y)).alias(out),
        F.count_if(both).alias("n_used"),
        F.count_if(~both).alias("n_excluded"),
    )


def correlation_matrix(
    df: DataFrame, cols: list[str], fraction: float | None = None, seed: int = 42
) -> DataFrame:
    """Pearson correlation of every pair of columns in long form (`x`, `y`, `r`), in one pass.

    Each pair uses the rows that have both values, of the whole table unless a sample is asked for. All pairs are
    aggregates of one scan; their single row of results is then unfolded, each pair both ways.
    """
    rows = df if fraction is None else df.sample(fraction=fraction, seed=seed)
    pairs = list(combinations_with_replacement(cols, 2))
    values = rows.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys(cols)])
    found = values.agg(*[pearson(F.col(x), F.col(y)).alias(f"r{i}") for i, (x, y) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("r"))
        for i, (x, y) in enumerate(pairs)
        for a, b in dict.fromkeys([(x, y), (y, x)])
    ]
    return found.select(F.inline(F.array(*entries)))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins between the smallest and the largest value, empty bins included.

    The last bin includes its upper edge; a constant column gets a range of one around its value.
    `mean` repeats the column's mean on every row, for a reference line. Null and NaN are left out.
    """
    values = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    edges = values.agg(F.min("v").alias("a"), F.max("v").alias("b"), F.avg("v").alias("mean")).select(
        F.struct(
            F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
            F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
            "mean",
        )
    ).scalar()
    lo, hi, mean = (edges.getField(c) for c in ("lo", "hi", "mean"))
    width = (hi - lo) / F.lit(float(bins))
    counts = (
        values.select(F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1)).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return (
        grid.join(counts, "bin", "left")
        .fillna(0, ["n"])
        .withColumn("bin_start", lo + F.col("bin") * width)
        .withColumn("mean", mean)
    )


def grid_density(df: DataFrame, lat: str = "latitude", lon: str = "longitude", step: float = 1.0) -> DataFrame:
    """Rows per cell of a regular grid; each cell is named by its lower corner."""
    cell = {c: F.floor(F.col(c) / F.lit(step)) * F.lit(step) for c in (lat, lon)}
    return (
        df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .select(cell[lat].alias(f"{lat}_cell"), cell[lon].alias(f"{lon}_cell"))
        .groupBy(f"{lat}_cell", f"{lon}_cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )
