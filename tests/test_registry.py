"""Every registered query against its SQL on the smallest tables, and the plans that matter at scale."""

from __future__ import annotations

import re
import shutil
import subprocess
import sys
from functools import cache
from pathlib import Path

import pytest
from pyspark.ml.feature import StopWordsRemover

import __spark_entry__ as contract
from conftest import SMALL
from reviewlens.operators.words import STOP_WORDS
from workloads import model_sql, registry
from workloads.checking import database, problems

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def db():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, db, name):
    _, found = problems(registry.QUERIES[name](spark, SMALL), db, registry.ORACLE[name])
    assert not found


@pytest.mark.parametrize("name", sorted(model_sql.oracle_sql()))
def test_model_query_equals_sql(spark, db, name):
    """The query fits first: its SQL reads the parameters that the fit has written."""
    result = registry.QUERIES[name](spark, SMALL)
    _, found = problems(result, db, contract.oracle_sql()[name])
    assert not found


def rows(spark, name: str) -> list:
    return registry.QUERIES[name](spark, SMALL).collect()


def test_models_are_judged_on_held_out_rows(spark):
    split = {r.review_id: r.part for r in rows(spark, "training_split")}
    assert {r.review_id for r in rows(spark, "feature_pipeline")} == {d for d, p in split.items() if p == "train"}
    test = {d for d, p in split.items() if p == "test"}
    for name in ("score_lr", "score_rf", "score_mlp"):
        scored = rows(spark, name)
        assert {r.review_id for r in scored} == test and len(scored) == len(test)
        for r in scored:
            assert sum(r[f"probability_{c}"] for c in (0, 1, 2)) == pytest.approx(1, abs=1e-5)
            assert r.prediction in (0, 1, 2)
    compared = rows(spark, "compare_models")
    assert {r.n_rows for r in compared} == {len(test)} and all(0 <= r.accuracy <= 1 for r in compared)


def test_every_text_is_scored(spark, db):
    n = db.execute("SELECT count(*) FROM documents").fetchone()[0]
    scored = rows(spark, "sentiment_scores")
    assert len({r.review_id for r in scored}) == len(scored) == n
    for r in scored:
        assert -1 <= r.sentiment_score <= 1 and r.sentiment_score == pytest.approx(r.pos_prob - r.neg_prob, abs=2e-6)
    assert sum(r.total_reviews for r in rows(spark, "sentiment_reputation")) <= n


def test_features_and_what_drives_the_models(spark):
    names = {r.position: (r.feature, r.kind) for r in rows(spark, "feature_names")}
    assert {r.n_features for r in rows(spark, "feature_pipeline")} == {len(names)}
    assert all(0 < r.n_nonzero <= len(names) and r.classWeight > 0 for r in rows(spark, "feature_pipeline"))
    for name, column in (("lr_importance", "importance"), ("rf_importance", "importance"),
                         ("negative_drivers", "weight"), ("positive_drivers", "weight")):
        ranked = rows(spark, name)
        values = [r[column] for r in ranked]
        assert values == sorted(values, reverse=True) and all(names[r.position] == (r.feature, r.kind) for r in ranked)


def test_texts_given_by_hand(spark):
    scored = rows(spark, "score_given_rows")
    assert [r.text for r in scored] == list(registry._TYPED)
    assert all(sum(r[f"probability_{c}"] for c in (0, 1, 2)) == pytest.approx(1, abs=1e-5) for r in scored)


def test_no_query_without_sql_is_left_out():
    checked = {"sentiment_reputation", "feature_names", "score_given_rows"}
    assert set(registry.QUERIES) - set(registry.ORACLE) - set(model_sql.oracle_sql()) == checked


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "positive_pct" in df.columns
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_stop_words_are_those_of_spark(spark):
    assert list(STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english") and len(STOP_WORDS) == 181


def test_entry_imports_without_the_jars():
    """In a fresh process, from another folder, with no session and no way to open Spark's jars."""
    code = (
        "import sys, zipfile, pathlib\n"
        f"sys.path.insert(0, {str(ROOT)!r})\n"
        "def refuse(*a, **k): raise RuntimeError('no jar access on import')\n"
        "zipfile.ZipFile = refuse\n"
        "pathlib.Path.glob = refuse\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), len(e.oracle_sql()))\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[-2]) >= 95


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    """In a fresh process, on a copy without the corpus folders: with and without the pipeline's module."""
    ignore = shutil.ignore_patterns("llm", ".git", "spark-warehouse", "__pycache__")
    for k, gone in enumerate((ignore, shutil.ignore_patterns("llm", ".git", "spark-warehouse", "__pycache__", "corpus_pipeline.py"))):
        copy = tmp_path / str(k)
        shutil.copytree(ROOT, copy, ignore=gone)
        code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
        assert done.stdout.split() == [str(len(registry.QUERIES)), "False"]


@cache
def plan(spark, name: str) -> str:
    return registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_python_and_no_cross_join_in_the_plan(spark, name):
    text = plan(spark, name)
    assert not re.search("Python|MapInPandas|MapInArrow|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_ranking_is_cut_before_its_shuffle(spark):
    assert re.search(r"WindowGroupLimit .*Partial", plan(spark, "top_words"))


def test_reviews_are_counted_before_the_join(spark):
    text = plan(spark, "top_reviewed_categories")
    assert text.index("Join") < text.index("partial_count(1)")


def test_scans_read_only_the_columns_in_use(spark):
    text = plan(spark, "reviews_by_year")
    # Of each table its key for the join, and of the lines the date.
    schemas = sorted(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert len(schemas) == 2 and schemas[1] == "o_orderkey:bigint"
    assert re.fullmatch(r"l_orderkey:bigint,l_shipdate:timestamp(_ntz)?", schemas[0])


def test_filters_reach_the_scan(spark):
    text = plan(spark, "valid_names")
    assert "DataFilters" in text and text.count("FileScan") == 1


def test_top_k_does_not_sort_everything(spark):
    for name in ("top_cities", "top_businesses", "bottom_businesses", "reputation_top", "top_users"):
        assert "TakeOrderedAndProject" in plan(spark, name), name
