"""Models for the registered queries, trained on the labelled documents of the given tables."""

from __future__ import annotations

import os
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions import split_list
from reviewlens.operators.features import feature_table, model_columns
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
from reviewlens.operators.modeltables import feature_table as vector_table
from reviewlens.operators.modeltables import forest_table, linear_table, network_table
from reviewlens.plans.sentiment import TrainingConfig, training_sets
from reviewlens.sources import cut_lineage, save_models, training_rows
from workloads import standins as st


def wide_table(
    spark: SparkSession, sf: str, review: DataFrame, spread: list[str], hot: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Feature table of `review` over the stand-in dimensions."""
    shops = st.businesses(spark, sf).withColumn("categories", split_list(F.col("categories")))
    users, checkins, tips = st.users(spark, sf), st.checkins(spark, sf), st.tips(spark, sf)
    return feature_table(build_wide(review, shops, users, checkins, tips, spread=spread, hot=hot))


def text_wide(spark: SparkSession, sf: str) -> DataFrame:
    return wide_table(spark, sf, st.text_reviews(spark, sf), ["review_id"])


PARTITIONS = 8
PLAN = TrainingConfig(partitions=PARTITIONS)


def checkpoint_folder(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


_LABELLED: dict[tuple[str, str], DataFrame] = {}


def parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Balanced labelled documents, split into those to fit on and those held out.

    The labelled rows are joined once in a session and checkpointed: the class counts, both parts and whoever asks
    again read them from there.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LABELLED:
        labelled = text_wide(spark, sf).filter(F.col("stars").isNotNull())
        columns = model_columns(labelled, keep=(*PLAN.key, "business_id", "state"))
        _LABELLED[key] = cut_lineage(columns, checkpoint_folder(spark))
    return training_sets(_LABELLED[key], PLAN)


def shared_folder(spark: SparkSession, sf: str, name: str) -> str:
    """A folder of this query and scale that every executor reaches: beside the checkpoints, or else in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/_tables/{os.path.basename(sf.rstrip('/'))}/{name}"


def model_folder() -> str:
    """The folder of the tables of the models fitted last, under the session's warehouse; SQL reads them from there."""
    spark = SparkSession.getActiveSession()
    warehouse = spark.conf.get("spark.sql.warehouse.dir") if spark else os.path.abspath("spark-warehouse")
    return warehouse.removeprefix("file:").rstrip("/") + "/_models"


class Trained:
    """Fitted once per session and scale; each model is fitted when first asked for, on the training rows alone.

    Training and test features are checkpointed tables: nothing is held in memory between queries.
    """

    def __init__(self, spark: SparkSession, sf: str, cfg: ModelConfig = ModelConfig()):
        folder = checkpoint_folder(spark)
        train, test = parts(spark, sf)
        self.cfg = cfg
        self.rows = add_class_weights(training_rows(train, PLAN.key, PLAN.partitions, folder))
        self.pipeline = build_feature_pipeline(cfg).fit(self.rows)
        self.features = cut_lineage(featurize(self.pipeline, self.rows), folder)
        self.test = cut_lineage(featurize(self.pipeline, test), folder)
        self.spark = spark
        self._publish("feature", vector_table(spark, self.pipeline))

    def _publish(self, name: str, table: DataFrame) -> None:
        """Write a model's table for SQL; one file, since it is as small as the model."""
        table.coalesce(1).write.mode("overwrite").parquet(f"{model_folder()}/{name}")

    @cache
    def lr(self):
        model = train_lr(self.features, self.cfg)
        self._publish("linear", linear_table(self.spark, model))
        return model

    @cache
    def rf(self):
        model = train_rf(self.features, self.cfg)
        save_models({"rf": model}, model_folder())
        self._publish("forest", forest_table(self.spark, f"{model_folder()}/rf_model"))
        return model

    @cache
    def mlp(self):
        model = train_mlp(self.features, vector_size(self.pipeline), self.cfg)
        self._publish("network", network_table(self.spark, model))
        return model


_TRAINED: dict[tuple[str, str], Trained] = {}


def trained(spark: SparkSession, sf: str) -> Trained:
    """The models of a scale in this session. The first query that asks pays for the fit; `bench.py` times it apart."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = Trained(spark, sf)
    return _TRAINED[key]


def held_out_predictions(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Prediction and class probabilities of each held-out document by one model."""
    fit = trained(spark, sf)
    return score(getattr(fit, name)(), fit.test)


def scored_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Sentiment score of every document by the logistic model."""
    fit = trained(spark, sf)
    return sentiment_scores(fit.pipeline, fit.lr(), text_wide(spark, sf))
