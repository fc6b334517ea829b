"""Fitted models and feature vectors as tables, so that a score can be followed, joined and checked in plain SQL.

A model is as large as its parameters, which the driver holds anyway; vectors stay distributed.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.operators.evaluate import feature_names

#: The position of an intercept or bias, which belongs to no feature.
INTERCEPT = -1


def feature_table(spark: SparkSession, pipeline: PipelineModel) -> DataFrame:
    """`position`, `feature`, `kind`, `scale` of every place of the vector; the scale is what a raw value is multiplied by."""
    deviations = pipeline.stages[-1].std.toArray()
    rows = [(i, name, kind, 1.0 / float(std) if std > 0 else 0.0)
            for i, ((name, kind), std) in enumerate(zip(feature_names(pipeline), deviations))]
    return spark.createDataFrame(rows, "position int, feature string, kind string, scale double")


def linear_table(spark: SparkSession, model) -> DataFrame:
    """`class`, `position`, `weight` of a logistic model; its intercepts stand at position -1."""
    weights, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows = [(c, i, float(w)) for c, row in enumerate(weights) for i, w in enumerate(row)]
    rows += [(c, INTERCEPT, float(w)) for c, w in enumerate(intercepts)]
    return spark.createDataFrame(rows, "class int, position int, weight double")


def network_table(spark: SparkSession, model) -> DataFrame:
    """`layer`, `input`, `output`, `weight` of a perceptron; biases have input -1.

    Between two layers come the weights, output by output for each input, and then the biases.
    """
    values, sizes, rows, at = model.weights.toArray(), list(model.getLayers()), [], 0
    for layer, (n_in, n_out) in enumerate(zip(sizes, sizes[1:])):
        for i in [*range(n_in), INTERCEPT]:
            rows += [(layer, i, o, float(values[at + o])) for o in range(n_out)]
            at += n_out
    return spark.createDataFrame(rows, "layer int, input int, output int, weight double")


def forest_table(spark: SparkSession, saved: str) -> DataFrame:
    """The nodes of a saved forest: `tree`, `node`, `position`, `threshold`, `left`, `right`, `gain` and class `counts`.

    A row goes left where its value is at most the threshold. Leaves have no position, children or gain.
    """
    node, cut = F.col("nodeData"), F.col("nodeData.split")
    inner = node["leftChild"] >= 0

    def only_inner(value):
        return F.when(inner, value)

    return spark.read.parquet(f"{saved}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"),
        only_inner(cut["featureIndex"]).alias("position"),
        only_inner(F.get(cut["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        only_inner(node["leftChild"]).alias("left"), only_inner(node["rightChild"]).alias("right"),
        only_inner(node["gain"]).alias("gain"), node["impurityStats"].alias("counts"))


def feature_rows(featurized: DataFrame, key: list[str], features: str = "features") -> DataFrame:
    """`key`, `position`, `value` of the values of each vector that are not zero; a vector without any has no rows."""
    parts = F.unwrap_udt(features)
    places = F.coalesce(parts["indices"], F.sequence(F.lit(0), F.size(parts["values"]) - 1))
    pairs = F.arrays_zip(places.alias("position"), parts["values"].alias("value"))
    return featurized.select(*key, F.inline(pairs)).filter(F.col("value") != 0)


def linear_scores(rows: DataFrame, weights: DataFrame, key: list[str], classes: int) -> DataFrame:
    """`key`, `prediction` and `probability_0...` by a sparse product of `feature_rows` with a `linear_table`.

    Each task adds up the products of a key before the shuffle. The product is by class, so the join has no more rows
    than values times classes; Spark broadcasts the weights if they are small. A key without rows is not scored.
    """
    by_class = weights.filter(F.col("position") != INTERCEPT).groupBy("position").agg(
        *[F.sum(F.when(F.col("class") == c, F.col("weight"))).alias(f"w{c}") for c in range(classes)])
    start = weights.filter(F.col("position") == INTERCEPT).agg(
        *[F.sum(F.when(F.col("class") == c, F.col("weight"))).alias(f"b{c}") for c in range(classes)])
    intercept = start.select(F.struct("*")).scalar()
    sums = rows.join(by_class, "position").groupBy(*key).agg(
        *[F.sum(F.col("value") * F.col(f"w{c}")).alias(f"m{c}") for c in range(classes)])
    margins = F.array(*[F.col(f"m{c}") + intercept.getField(f"b{c}") for c in range(classes)])
    shifted = F.transform("margins", lambda m: F.exp(m - F.array_max("margins")))
    total = F.aggregate("e", F.lit(0.0), lambda a, b: a + b)
    return sums.select(*key, margins.alias("margins")).select(*key, "margins", shifted.alias("e")).select(
        *key, (F.array_position("margins", F.array_max("margins")) - 1).cast("double").alias("prediction"),
        *[(F.get("e", F.lit(c)) / total).alias(f"probability_{c}") for c in range(classes)])
