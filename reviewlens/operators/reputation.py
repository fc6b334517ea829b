"""Business reputation and sentiment trends over scored reviews.

A scored review has `pos_prob`, `neg_prob` and `sentiment_score` (null where the score is invalid),
`prediction`, `label`, and its business's `categories`, `business_stars`, `is_open` and `state`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import pct
from reviewlens.operators.aggregates import correlation
from reviewlens.operators.sampling import sample_fraction

_MEASURES = ("sentiment_score", "pos_prob", "neg_prob", "label")


def business_reputation(scored: DataFrame, min_reviews: int = 20) -> DataFrame:
    """One row per business and tag list with at least `min_reviews` reviews.

    Predictions count as positive or negative only where the score is valid. The first aggregate keeps
    sums and counts in a hash table and takes the business's own attributes as further keys; the second,
    over one row per business, merges attributes should they differ between reviews.
    """
    valid = F.col("sentiment_score").isNotNull()
    partial = scored.groupBy("business_id", "categories", "business_stars", "is_open", "state").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(valid & (F.col("prediction") == 2)).alias("_pos"),
        F.count_if(valid & (F.col("prediction") == 0)).alias("_neg"),
        *[F.sum(F.col(m).cast("double")).alias(f"_sum_{m}") for m in _MEASURES],
        *[F.count(m).alias(f"_n_{m}") for m in _MEASURES],
    )

    def mean(measure: str):
        return F.try_divide(F.sum(f"_sum_{measure}"), F.sum(f"_n_{measure}"))

    return (
        partial.groupBy("business_id", "categories")
        .agg(
            F.sum("_rows").alias("total_reviews"),
            mean("sentiment_score").alias("avg_sentiment_score"),
            mean("pos_prob").alias("avg_pos_prob"),
            mean("neg_prob").alias("avg_neg_prob"),
            mean("label").alias("avg_label"),
            F.sum("_pos").alias("n_positive"),
            F.sum("_neg").alias("n_negative"),
            F.max("business_stars").alias("avg_stars"),
            F.max("is_open").alias("is_open"),
            F.max("state").alias("state"),
        )
        .withColumn("positive_pct", pct(F.col("n_positive"), F.col("total_reviews"), 1))
        .withColumn("negative_pct", pct(F.col("n_negative"), F.col("total_reviews"), 1))
        .filter(F.col("total_reviews") >= min_reviews)
    )


def score_star_corr(reputation: DataFrame) -> DataFrame:
    """Correlation of mean score and stars over the businesses that have both, and how many those are."""
    return correlation(reputation, "avg_sentiment_score", "avg_stars")


def reputation_sample(
    reputation: DataFrame, volume: tuple[int, int] = (20, 500), fraction: float = 0.05, seed: int = 42
) -> DataFrame:
    """A random sample of the scored businesses within a range of review volume, for a scatter plot."""
    scored = reputation.filter(F.col("avg_sentiment_score").isNotNull())
    within = scored.filter(F.col("total_reviews").between(*volume))
    return sample_fraction(within, fraction, seed, ["business_id"])


def rank_reputation(
    reputation: DataFrame, min_reviews: int = 100, k: int = 10, best: bool = True
) -> DataFrame:
    """The `k` best or worst businesses by mean score among those with at least `min_reviews` reviews.

    Scores are compared to nine decimals: the last bits of a mean depend on the order of its sum, which
    differs between runs.
    """
    score = F.col("avg_sentiment_score")
    share = "positive_pct" if best else "negative_pct"
    return (
        reputation.filter(score.isNotNull() & (F.col("total_reviews") >= min_reviews))
        .select("business_id", "categories", "total_reviews", "avg_sentiment_score", share, "avg_stars")
        .orderBy(F.round(score, 9).desc() if best else F.round(score, 9).asc(), "business_id")
        .limit(k)
    )


def sentiment_by_year(
    scored: DataFrame,
    years: tuple[int, int] = (2005, 2022),
    min_n: int = 500,
    marked: tuple[int, ...] = (2020, 2021),
) -> DataFrame:
    """Mean score per year with enough reviews, the plain mean of those years, and a flag for `marked`."""
    by_year = (
        scored.filter(F.col("sentiment_score").isNotNull() & F.col("year").between(*years))
        .groupBy("year")
        .agg(
            F.avg("sentiment_score").alias("avg_sentiment"),
            F.count(F.lit(1)).alias("review_count"),
            F.avg("pos_prob").alias("avg_pos_prob"),
        )
        .filter(F.col("review_count") >= min_n)
    )
    overall = by_year.agg(F.avg("avg_sentiment")).scalar()
    return by_year.withColumns(
        {"mean_of_years": overall, "is_marked": F.col("year").isin(*marked)}
    ).orderBy("year")


def sentiment_by_state(scored: DataFrame, min_n: int = 5000) -> DataFrame:
    """Mean score per state with enough reviews, highest first, flagged against the mean of those states."""
    by_state = (
        scored.filter(F.col("state").isNotNull() & F.col("sentiment_score").isNotNull())
        .groupBy("state")
        .agg(
            F.count(F.lit(1)).alias("review_count"),
            F.avg("sentiment_score").alias("avg_sentiment"),
            F.avg("pos_prob").alias("pct_positive"),
        )
        .filter(F.col("review_count") >= min_n)
    )
    overall = by_state.agg(F.avg("avg_sentiment")).scalar()
    return by_state.withColumn("above_mean", F.col("avg_sentiment") >= overall).orderBy(
        F.desc("avg_sentiment"), "state"
    )


def open_closed(reputation: DataFrame) -> DataFrame:
    """Open against closed businesses: how many, mean score, mean stars, mean share of positives."""
    known = F.col("avg_sentiment_score").isNotNull() & F.col("is_open").isNotNull()
    return (
        reputation.filter(known)
        .groupBy("is_open")
        .agg(
            F.count(F.lit(1)).alias("n_businesses"),
            F.avg("avg_sentiment_score").alias("mean_sentiment"),
            F.avg("avg_stars").alias("mean_stars"),
            F.avg("positive_pct").alias("mean_positive_pct"),
        )
        .orderBy("is_open")
    )
