"""Sentiment models from raw tables to business reputation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import parse_ts, split_list
from reviewlens.operators import evaluate as ev
from reviewlens.operators import reputation as rep
from reviewlens.operators.aggregates import correlation_matrix, group_count, histogram, share_of_total
from reviewlens.operators.clean import impute_concat, replace_sentinel
from reviewlens.operators.features import NUMERIC_FEATURES, feature_table, model_columns
from reviewlens.operators.joins import build_wide
from reviewlens.operators.model import (
    ModelConfig,
    add_class_weights,
    build_feature_pipeline,
    featurize,
    score,
    sentiment_scores,
    train_lr,
    train_mlp,
    train_rf,
    vector_size,
)
from reviewlens.operators.quality import valid_rate
from reviewlens.operators.sampling import balance_classes, sample_fraction, split
from reviewlens.plans.eda import VOTES
from reviewlens.sources import cut_lineage, training_rows


@dataclass(frozen=True)
class TrainingConfig:
    """How the training rows are chosen. `key` names columns that identify a review.

    `fit_sample` and `mlp_fit_sample` bound the rows that models are fitted on, as fractions of the training rows; by
    default all are used. Every held-out row is scored and compared, whatever they say. `partitions` is the number of
    parts that training rows are dealt over.
    """

    key: list[str] = field(default_factory=lambda: ["review_id"])
    split_weights: tuple[float, float] = (0.8, 0.2)
    split_seed: int = 25
    fit_sample: float | None = None
    mlp_fit_sample: float | None = None
    balance_seed: int = 42
    partitions: int = 64
    models: ModelConfig = ModelConfig()


def prepare_wide(
    review: DataFrame,
    business: DataFrame,
    user: DataFrame,
    checkin: DataFrame,
    tip: DataFrame,
    since_field: str | None = None,
    spread: list[str] | None = None,
) -> DataFrame:
    """The wide feature table from the five raw tables; write it once and start from it afterwards."""
    review = parse_ts(replace_sentinel(review, VOTES), "date")
    business = business.withColumn("categories", split_list(F.col("categories")))
    business = impute_concat(business, "address", ["postal_code", "city"])
    user = user.withColumns({c: split_list(F.col(c)) for c in ("friends", "elite") if c in user.columns})
    user = parse_ts(user, since_field) if since_field else user
    return feature_table(build_wide(review, business, user, checkin, parse_ts(tip, "date"), spread))


def training_sets(wide: DataFrame, cfg: TrainingConfig = TrainingConfig()) -> tuple[DataFrame, DataFrame]:
    """Balanced and split rows: those to fit on, sampled if asked for, and all held-out ones."""
    rows = model_columns(wide, keep=(*cfg.key, "business_id", "state"))
    balanced = balance_classes(rows, seed=cfg.balance_seed, key=cfg.key)
    train, test = split(balanced, list(cfg.split_weights), cfg.split_seed, cfg.key)
    if cfg.fit_sample is not None:
        train = sample_fraction(train, cfg.fit_sample, cfg.split_seed, cfg.key)
    return train, test


def train_models(
    train: DataFrame, test: DataFrame, cfg: TrainingConfig = TrainingConfig(), checkpoint_dir: str | None = None
) -> tuple[dict, dict[str, DataFrame], DataFrame]:
    """Fit the pipeline and three classifiers: (models, test predictions, comparison table).

    The training rows are checkpointed before the iterative fits, so that a lost executor costs a read
    of the checkpoint and not the joins again. Class weights are for fitting: test rows have none.
    The test features stay cached for the reports on the predictions; `spark.catalog.clearCache()` frees them.
    """
    train = add_class_weights(training_rows(train, cfg.key, cfg.partitions, checkpoint_dir))
    pipeline = build_feature_pipeline(cfg.models).fit(train)
    train_x = featurize(pipeline, train).persist(StorageLevel.MEMORY_AND_DISK)
    test_x = featurize(pipeline, cut_lineage(test, checkpoint_dir)).persist(StorageLevel.MEMORY_AND_DISK)
    small = train_x
    if cfg.mlp_fit_sample is not None:
        small = sample_fraction(train_x, cfg.mlp_fit_sample, cfg.balance_seed, cfg.key)
    models = {
        "features": pipeline,
        "lr": train_lr(train_x, cfg.models),
        "rf": train_rf(train_x, cfg.models),
        "mlp": train_mlp(small, vector_size(pipeline), cfg.models),
    }
    train_x.unpersist()
    predictions = {
        "Logistic Regression": score(models["lr"], test_x),
        "Random Forest": score(models["rf"], test_x),
        "MLP": score(models["mlp"], test_x),
    }
    return models, predictions, ev.compare_models(predictions)


def model_reports(
    models: dict, predictions: dict[str, DataFrame], comparison: DataFrame
) -> dict[str, DataFrame]:
    """Comparison, recall and confusion matrix per model, important features and sentiment drivers, by name."""
    spark, pipeline, lr = comparison.sparkSession, models["features"], models["lr"]
    reports = {
        "model_comparison": comparison,
        "lr_importance": ev.lr_importance(spark, pipeline, lr),
        "rf_importance": ev.rf_importance(spark, pipeline, models["rf"]),
        "negative_drivers": ev.class_drivers(spark, pipeline, lr, 0),
        "positive_drivers": ev.class_drivers(spark, pipeline, lr, 2),
    }
    for name, preds in predictions.items():
        folder = name.lower().replace(" ", "_")
        reports[f"recall_{folder}"] = ev.per_class_recall(preds)
        reports[f"confusion_{folder}"] = ev.confusion_matrix(preds)
    return reports


def wide_reports(wide: DataFrame) -> dict[str, DataFrame]:
    """Class distribution and the two correlation matrices of the wide table, by name."""
    votes = ["user_useful", "user_funny", "user_cool"]
    of_review = ["stars", *votes, "review_length", "user_review_count", "fans"]
    return {
        "label_distribution": share_of_total(group_count(wide, ["label"]), digits=2).orderBy("label"),
        "review_correlations": correlation_matrix(wide, of_review),
        "feature_correlations": correlation_matrix(wide, ["label", *NUMERIC_FEATURES]),
    }


def score_all(models: dict, wide: DataFrame) -> DataFrame:
    """Sentiment score of every review by the logistic model, without the text."""
    return sentiment_scores(models["features"], models["lr"], wide).drop("text")


def reputation_tables(
    scored: DataFrame,
    reputation: DataFrame,
    min_ranked: int = 100,
    min_year: int = 500,
    min_state: int = 5000,
    years: tuple[int, int] = (2005, 2022),
    k: int = 10,
) -> dict[str, DataFrame]:
    """Every table on the scored reviews and on `reputation`, their `business_reputation`, by name.

    Write both out first: each table reads one of them again.
    """
    valid = reputation.filter(F.col("avg_sentiment_score").isNotNull())
    return {
        "valid_rate": valid_rate(scored, "sentiment_score"),
        "score_star_corr": rep.score_star_corr(reputation),
        "score_sample": rep.reputation_sample(reputation),
        "score_histogram": histogram(valid, "avg_sentiment_score"),
        "best": rep.rank_reputation(reputation, min_ranked, k, best=True),
        "worst": rep.rank_reputation(reputation, min_ranked, k, best=False),
        "by_year": rep.sentiment_by_year(scored, years, min_year),
        "by_state": rep.sentiment_by_state(scored, min_state),
        "open_closed": rep.open_closed(reputation),
    }
