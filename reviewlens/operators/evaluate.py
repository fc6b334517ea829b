"""Evaluation of predictions and interpretation of models."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlens.functions import pct
from reviewlens.operators.features import NUMERIC_FEATURES
from reviewlens.operators.joins import densify
from reviewlens.operators.model import CLASSES

METRICS = ("accuracy", "f1", "weighted_precision", "weighted_recall")
CLASS_NAMES = {0: "Negative", 1: "Neutral", 2: "Positive"}


def evaluate(preds: DataFrame, classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """One row: rows scored, accuracy, and F1, precision and recall weighted by class size.

    All four come from the per-class counts of a single aggregate.
    """
    label, guess = F.col("label"), F.col("prediction")
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in classes:
        aggs += [
            F.count_if((label == c) & (guess == c)).alias(f"hit_{c}"),
            F.count_if(label == c).alias(f"true_{c}"),
            F.count_if(guess == c).alias(f"said_{c}"),
        ]
    zero = F.lit(0.0)

    def ratio(num: Column, den: Column) -> Column:
        return F.coalesce(F.try_divide(num, den), zero)

    def weighted(measure) -> Column:
        parts = [ratio(F.col(f"true_{c}"), F.col("n_rows")) * measure(c) for c in classes]
        return reduce(lambda a, b: a + b, parts)

    def precision(c: int) -> Column:
        return ratio(F.col(f"hit_{c}"), F.col(f"said_{c}"))

    def recall(c: int) -> Column:
        return ratio(F.col(f"hit_{c}"), F.col(f"true_{c}"))

    def f1(c: int) -> Column:
        return ratio(F.lit(2.0) * precision(c) * recall(c), precision(c) + recall(c))

    hits = reduce(lambda a, b: a + b, [F.col(f"hit_{c}") for c in classes])
    return preds.agg(*aggs).select(
        "n_rows",
        ratio(hits, F.col("n_rows")).alias("accuracy"),
        weighted(f1).alias("f1"),
        weighted(precision).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
    )


def per_class_recall(preds: DataFrame) -> DataFrame:
    """Recall of each class that occurs, with its correct and total rows."""
    hit = F.col("label") == F.col("prediction")
    return (
        preds.groupBy("label")
        .agg(F.count_if(hit).alias("correct"), F.count(F.lit(1)).alias("total"))
        .withColumn("recall", F.col("correct") / F.col("total"))
    )


def confusion_matrix(preds: DataFrame, classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """Every label and prediction pair with its count and its share of the label's rows in percent."""
    counts = (
        preds.select("label", F.col("prediction").cast("int").alias("prediction"))
        .groupBy("label", "prediction")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = densify(counts, {"label": list(classes), "prediction": list(classes)})
    of_label = Window.partitionBy("label")
    return grid.withColumn("row_pct", pct(F.col("n"), F.sum("n").over(of_label), 1))


def confusion_table(matrix: DataFrame, classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """The confusion matrix in wide form: one row per label, one count column per prediction."""
    wide = matrix.groupBy("label").pivot("prediction", list(classes)).sum("n").fillna(0)
    return wide.withColumnsRenamed({str(c): f"predicted_{c}" for c in classes}).orderBy("label")


def compare_models(predictions: dict[str, DataFrame], digits: int = 4) -> DataFrame:
    """One row per model with its four metrics and the number of rows they rest on."""
    rows = [
        evaluate(preds).select(
            F.lit(name).alias("model"), "n_rows", *[F.round(m, digits).alias(m) for m in METRICS]
        )
        for name, preds in predictions.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def feature_names(pipeline: PipelineModel) -> list[tuple[str, str]]:
    """(name, kind) of every vector position: text terms, category tags, then the scalars."""
    text, tags = pipeline.stages[2].vocabulary, pipeline.stages[4].vocabulary
    return (
        [(term, "text") for term in text]
        + [(tag, "category") for tag in tags]
        + [(name, "scalar") for name in NUMERIC_FEATURES]
    )


def _ranked(spark: SparkSession, names, values, out: str, n: int) -> DataFrame:
    """The `n` largest of one number per vector position; the model already holds them on the driver."""
    rows = [(i, name, kind, float(v)) for i, ((name, kind), v) in enumerate(zip(names, values))]
    table = spark.createDataFrame(rows, f"position int, feature string, kind string, {out} double")
    return table.orderBy(F.desc(out), "position").limit(n)


def lr_importance(spark: SparkSession, pipeline: PipelineModel, model, n: int = 25) -> DataFrame:
    """Features by mean absolute coefficient over the classes."""
    weights = np.abs(model.coefficientMatrix.toArray()).mean(axis=0)
    return _ranked(spark, feature_names(pipeline), weights, "importance", n)


def rf_importance(spark: SparkSession, pipeline: PipelineModel, model, n: int = 25) -> DataFrame:
    """Features by the forest's impurity importance."""
    return _ranked(spark, feature_names(pipeline), model.featureImportances.toArray(), "importance", n)


def class_drivers(spark: SparkSession, pipeline: PipelineModel, model, cls: int, n: int = 20) -> DataFrame:
    """Features with the largest coefficients for one class (0 negative, 2 positive)."""
    weights = model.coefficientMatrix.toArray()[cls]
    return _ranked(spark, feature_names(pipeline), weights, "weight", n)
