from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from reviewlens.operators import evaluate as ev
from reviewlens.operators import model as m
from reviewlens.operators.features import NUMERIC_FEATURES
from reviewlens.operators.reputation import business_reputation
from reviewlens.plans.sentiment import TrainingConfig, reputation_tables, score_all, train_models, training_sets
from reviewlens.sources import load_models, save_models

WORDS = {0: "awful rude cold dirty never", 1: "average okay ordinary fine price", 2: "great loved amazing friendly best"}
SMALL = TrainingConfig(partitions=4, models=m.ModelConfig(
    vocab_size=40, min_doc_freq=1, category_vocab=10, lr_iterations=20, rf_trees=5, rf_depth=4,
    rf_min_instances=1, mlp_hidden=4, mlp_iterations=20))


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        label = int(rng.choice([0, 1, 2], p=[0.25, 0.15, 0.6]))
        words = list(rng.choice(WORDS[label].split(), 6)) + list(rng.choice("the food was and".split(), 4))
        rows.append((f"r{i}", f"b{i % 12}", ["FL", "NV", None][i % 3], " ".join(words), label,
                     *[float(rng.integers(0, 5)) if n == "average_stars" or n == "business_stars"
                       else int(rng.integers(0, 9)) for n in NUMERIC_FEATURES],
                     ["Food", "Bars"] if i % 2 else ["Hotels"]))
    kinds = ", ".join(f"{n} {'double' if n.endswith('_stars') else 'bigint'}" for n in NUMERIC_FEATURES)
    df = spark.createDataFrame(rows, "review_id string, business_id string, state string, text string, "
                                     f"label int, {kinds}, categories array<string>")
    return df.withColumn("year", (F.lit(2015) + F.col("year")).cast("int"))


@pytest.fixture(scope="module")
def fitted(spark, wide, tmp_path_factory):
    train, test = training_sets(wide, SMALL)
    return train_models(train, test, SMALL, str(tmp_path_factory.mktemp("checkpoint")))


def test_training_sets_are_balanced_and_disjoint(wide):
    train, test = training_sets(wide, SMALL)
    assert train.join(test, "review_id").isEmpty()
    n = {r.label: r["count"] for r in train.unionByName(test).groupBy("label").count().collect()}
    assert abs(n[0] - n[1]) < 30 and abs(n[2] - n[1]) < 30


def test_default_config_scores_every_held_out_row(wide, tmp_path):
    """The configuration as it comes: nothing is sampled, and all held-out rows are compared."""
    cfg = TrainingConfig()
    train, test = training_sets(wide, cfg)
    assert train.join(test, "review_id").isEmpty() and cfg.fit_sample is None and cfg.mlp_fit_sample is None
    _, predictions, table = train_models(train, test, cfg, str(tmp_path))
    assert {r.n_rows for r in table.collect()} == {test.count()} == {p.count() for p in predictions.values()}


def test_fit_samples_do_not_touch_the_held_out_rows(wide):
    whole, part = training_sets(wide, SMALL), training_sets(wide, replace(SMALL, fit_sample=0.3))
    assert part[0].count() < 0.6 * whole[0].count() and part[1].count() == whole[1].count()


def test_vector_size_is_the_number_of_names(fitted, wide):
    pipeline = fitted[0]["features"]
    names = ev.feature_names(pipeline)
    assert m.vector_size(pipeline) == len(names)
    assert m.featurize(pipeline, wide).first().features.size == len(names)
    assert [n for n, kind in names if kind == "scalar"] == list(NUMERIC_FEATURES)
    assert {n for n, kind in names if kind == "category"} == {"Food", "Bars", "Hotels"}


def test_pipeline_idf_agrees_with_term_statistics(fitted, wide):
    pipeline = m.build_feature_pipeline(m.ModelConfig(vocab_size=500, min_doc_freq=5)).fit(wide)
    vocabulary, idf = pipeline.stages[2].vocabulary, pipeline.stages[3]
    stats = {r.term: r for r in m.term_statistics(wide).collect()}
    assert set(vocabulary) == set(stats)
    for position, term in enumerate(vocabulary):
        assert stats[term].n_docs == idf.docFreq[position]
        assert stats[term].idf == pytest.approx(idf.idf[position])


def test_term_statistics_min_doc_freq_and_empty_tokens(spark):
    df = spark.createDataFrame([("x x  y ",), ("x",), ("",)], "text string")
    rows = {r.term: (r.n_total, r.n_docs, r.idf) for r in m.term_statistics(df, min_doc_freq=2).collect()}
    assert rows == {"x": (3, 2, pytest.approx(math.log(4 / 3))), "y": (1, 1, 0.0), "": (2, 2, pytest.approx(math.log(4 / 3)))}


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 2 + [(1,)] * 4 + [(9,)], "label int")
    w = {r.label: r.classWeight for r in m.add_class_weights(df).collect()}
    assert w == {0: 1.0, 1: 0.5, 9: 1.0}  # six rows of listed classes over three classes


def test_models_learn_and_probabilities_sum_to_one(fitted):
    _, predictions, table = fitted
    rows = {r.model: r for r in table.collect()}
    assert set(rows) == {"Logistic Regression", "Random Forest", "MLP"}
    assert rows["Logistic Regression"].accuracy > 0.9 and rows["Random Forest"].accuracy > 0.6
    for preds in predictions.values():
        for r in preds.select("probability").collect():
            assert sum(r.probability) == pytest.approx(1.0)


def test_evaluate_matches_sparks_evaluator(fitted):
    for preds in fitted[1].values():
        ours = ev.evaluate(preds).first()
        for name, metric in {"accuracy": "accuracy", "f1": "f1", "weighted_precision": "weightedPrecision",
                             "weighted_recall": "weightedRecall"}.items():
            theirs = MulticlassClassificationEvaluator(labelCol="label", metricName=metric).evaluate(preds)
            assert ours[name] == pytest.approx(theirs)


def test_evaluate_with_a_class_never_predicted(spark):
    preds = spark.createDataFrame([(0, 0.0), (0, 2.0), (1, 0.0), (2, 2.0)], "label int, prediction double")
    ours = ev.evaluate(preds).first()
    for name, metric in {"f1": "f1", "weighted_precision": "weightedPrecision"}.items():
        theirs = MulticlassClassificationEvaluator(labelCol="label", metricName=metric).evaluate(preds)
        assert ours[name] == pytest.approx(theirs)
    assert {tuple(r) for r in ev.per_class_recall(preds).collect()} == {(0, 1, 2, 0.5), (1, 0, 1, 0.0), (2, 1, 1, 1.0)}
    cells = {(r.label, r.prediction): (r.n, r.row_pct) for r in ev.confusion_matrix(preds).collect()}
    assert len(cells) == 9 and cells[(0, 2)] == (1, 50.0) and cells[(1, 1)] == (0, 0.0)
    wide = [tuple(r) for r in ev.confusion_table(ev.confusion_matrix(preds)).collect()]
    assert wide == [(0, 1, 0, 1), (1, 1, 0, 0), (2, 0, 0, 1)]


def test_confusion_matrix_of_an_absent_label(spark):
    preds = spark.createDataFrame([(0, 0.0)], "label int, prediction double")
    assert {r.row_pct for r in ev.confusion_matrix(preds).filter("label = 1").collect()} == {None}


def test_importance_and_drivers(fitted, spark):
    models, _, _ = fitted
    top = ev.lr_importance(spark, models["features"], models["lr"], 25).collect()
    weights = [r.importance for r in top]
    assert len(top) == 25 and weights == sorted(weights, reverse=True)
    positive = {r.feature for r in ev.class_drivers(spark, models["features"], models["lr"], 2, 5).collect()}
    negative = {r.feature for r in ev.class_drivers(spark, models["features"], models["lr"], 0, 5).collect()}
    assert positive & set(WORDS[2].split()) and negative & set(WORDS[0].split()) and not positive & negative
    forest = ev.rf_importance(spark, models["features"], models["rf"], 1000).collect()
    assert sum(r.importance for r in forest) == pytest.approx(1.0)


def test_models_round_trip(fitted, wide, tmp_path):
    models = fitted[0]
    save_models(models, str(tmp_path))
    save_models(models, str(tmp_path))
    loaded = load_models(str(tmp_path))
    for name in ("lr", "rf", "mlp"):
        one, two = (m.score(x[name], m.featurize(x["features"], wide)).select("review_id", "prediction") for x in (models, loaded))
        assert one.exceptAll(two).isEmpty()


def test_score_rows_given_by_hand(fitted, spark):
    models = fitted[0]
    rows = [(text, 50, 0, 0, 3.0, 5, 1, 6, 2, 3.0, 20, 1, 0, 0, 2024, 5, ["None"])
            for text in ("amazing loved best", "awful dirty never", "average okay ordinary price")]
    df = spark.createDataFrame(rows, ["text", *NUMERIC_FEATURES, "categories"])
    out = m.score_rows(models["features"], models["lr"], df).collect()
    assert len(out) == 3
    for r in out:
        assert sum(r.probability) == pytest.approx(1.0, abs=0.02) and r.prediction in (0.0, 1.0, 2.0)
        assert all(round(p, 2) == p for p in r.probability)


def test_sentiment_scores_with_gaps(fitted, wide):
    """A review without a user has null features; it is still scored like any other."""
    gap = wide.withColumn("user_engagement", F.when(F.col("review_id") != "r0", F.col("user_engagement")))
    scored = score_all(fitted[0], gap)
    assert "text" not in scored.columns and scored.count() == 600
    for r in scored.select("pos_prob", "neg_prob", "sentiment_score").collect():
        assert -1.0 <= r.sentiment_score <= 1.0
        assert r.sentiment_score == pytest.approx(r.pos_prob - r.neg_prob)
    zero = score_all(fitted[0], wide.withColumn("user_engagement", F.when(F.col("review_id") != "r0", F.col("user_engagement")).otherwise(0)))
    pick = lambda df: df.filter("review_id = 'r0'").first().sentiment_score
    assert pick(scored) == pytest.approx(pick(zero))


def test_nan_probability_gives_null_score(fitted, spark, wide):
    """Without the fill a gap makes the probability NaN; the score is then null, not NaN."""
    models = fitted[0]
    gap = wide.limit(3).withColumn("fans", F.lit(None).cast("bigint"))
    scored = m.score(models["lr"], m.featurize(models["features"], gap))
    values = scored.select(m.class_probability(2).alias("p"), "prediction").collect()
    assert {r.p for r in values} == {None} and {r.prediction for r in values} == {0.0}


def test_reputation_end_to_end(fitted, wide):
    scored = score_all(fitted[0], wide).cache()
    reputation = business_reputation(scored, 20)
    tables = reputation_tables(scored, reputation, min_ranked=20, min_year=10, min_state=50, years=(2015, 2024))
    rep = reputation.collect()
    # twelve businesses, each with one tag list
    assert len(rep) == 12 and sum(r.total_reviews for r in rep) == 600
    assert tables["best"].first().avg_sentiment_score == pytest.approx(max(r.avg_sentiment_score for r in rep))
    assert tables["worst"].first().avg_sentiment_score == pytest.approx(min(r.avg_sentiment_score for r in rep))
    assert sum(r.n for r in tables["score_histogram"].collect()) == 12
    assert {r.state for r in tables["by_state"].collect()} == {"FL", "NV"}
    assert sum(r.review_count for r in tables["by_year"].collect()) == 600
    corr = tables["score_star_corr"].first()  # every business has four stars here: no correlation
    assert corr.correlation is None and corr.n_used == 12
    assert sum(r.n_businesses for r in tables["open_closed"].collect()) == 12
    scored.unpersist()


def test_models_as_tables(spark, tmp_path):
    """Tables of small models score as the models do."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassifier
    from pyspark.ml.linalg import Vectors

    from reviewlens.operators import modeltables as tables

    data = [(k, k % 3, Vectors.sparse(4, {k % 3: 1.0 + k, 3: 2.0}) if k % 2 else Vectors.dense([k % 3, 0.0, 1.0, k / 9.0]))
            for k in range(60)]
    df = spark.createDataFrame(data, ["id", "label", "features"]).withColumn("classWeight", F.lit(1.0))
    lr = m.train_lr(df)
    rows = tables.feature_rows(df, ["id"])
    assert {(r.id, r.position): r.value for r in rows.collect()} == {
        (k, i): float(v) for k, _, vector in data for i, v in enumerate(vector.toArray()) if v != 0}
    got = {r.id: r for r in tables.linear_scores(rows, tables.linear_table(spark, lr), ["id"], 3).collect()}
    for r in lr.transform(df).collect():
        assert [got[r.id][f"probability_{c}"] for c in range(3)] == pytest.approx(list(r.probability), abs=1e-9)
        assert got[r.id].prediction == r.prediction
    mlp = MultilayerPerceptronClassifier(layers=[4, 5, 3], maxIter=5, seed=1).fit(df)
    weights = {(r.layer, r.input, r.output): r.weight for r in tables.network_table(spark, mlp).collect()}
    assert len(weights) == 4 * 5 + 5 + 5 * 3 + 3

    def layer(n, values, n_out):
        return [sum(v * weights[n, i, o] for i, v in enumerate(values)) + weights[n, -1, o] for o in range(n_out)]

    for k, _, vector in data[:9]:
        hidden = [1 / (1 + np.exp(-x)) for x in layer(0, vector.toArray(), 5)]
        e = np.exp(layer(1, hidden, 3))
        assert list(e / e.sum()) == pytest.approx(list(mlp.predictProbability(vector)), abs=1e-9)
    rf = RandomForestClassifier(numTrees=4, maxDepth=3, seed=1).fit(df)
    rf.write().overwrite().save(str(tmp_path / "rf"))
    nodes = {(r.tree, r.node): r for r in tables.forest_table(spark, str(tmp_path / "rf")).collect()}
    for k, _, vector in data:
        votes = np.zeros(3)
        for tree in range(4):
            node = nodes[tree, 0]
            while node.position is not None:
                node = nodes[tree, node.left if vector[node.position] <= node.threshold else node.right]
            votes += np.array(node.counts) / sum(node.counts)
        assert list(votes / 4) == pytest.approx(list(rf.predictProbability(vector)), abs=1e-9)
