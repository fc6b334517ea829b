from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from reviewlens.operators.joins import build_wide
from reviewlens.sources import Layout, store_star, wide_from_star

BUCKETS = 4


@pytest.fixture(scope="module")
def tables(spark):
    """A third of the rows under one key, some under none, one key without a partner."""
    row = F.col("id")
    key = F.when(row % 3 == 0, F.lit(7)).when(row % 10 == 1, F.lit(None)).otherwise(row % 50).cast("bigint")
    fact = spark.range(3000).select(row.alias("row"), key.alias("key"), F.lit("x").alias("_note"))
    dim = spark.range(1, 50).select(row.alias("key"), (row * 2).alias("twice"))
    more = dim.select("key", (F.col("key") % 5).alias("rest")).filter("key % 2 = 1")
    return fact, dim, more.union(more.filter("key = 7"))  # the hot key has two partners here


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    layout = Layout(spark, str(tmp_path_factory.mktemp("layout")), "test_layout", "key", BUCKETS)
    for _ in range(2):  # the second replaces the first
        layout.store_fact(tables[0], "fact", ["row"])
        layout.store_dimension(tables[1], "dim")
        layout.store_dimension(tables[2], "more")
    return layout


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_equals_that_of_the_given_tables(tables, stored, how):
    fact, dim, more = tables
    want = fact.join(dim, "key", how).join(more, "key", how)
    got = stored.join("fact", ["dim", "more"], how)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_join_moves_no_row(spark, stored):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stored.join("fact", ["dim", "more"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Join" in plan and not re.search("Exchange", plan)


def test_a_hot_key_fills_no_bucket_alone(stored, tables):
    pieces = stored.read("fact").groupBy("key", "_piece").count()
    most = pieces.agg(F.max("count")).first()[0]
    assert most < 0.6 * tables[0].filter("key = 7").count()
    assert pieces.filter("key is null").count() == BUCKETS


def test_only_joins_that_repeats_leave_exact(stored):
    with pytest.raises(ValueError):
        stored.join("fact", ["dim"], "full")


def test_empty_tables(spark, tables, tmp_path):
    layout = Layout(spark, str(tmp_path), "empty_layout", "key", BUCKETS)
    layout.store_fact(tables[0].filter("row < 0"), "fact")
    layout.store_dimension(tables[1], "dim")
    assert layout.join("fact", ["dim"]).isEmpty()


def test_wide_table_from_a_stored_star(spark, raw, tmp_path):
    review, business, user, checkin, tip = (raw[t] for t in ("review", "business", "user", "checkin", "tip"))
    layout = Layout(spark, str(tmp_path), "star_test", "business_id", BUCKETS)
    store_star(layout, review, business, checkin, tip, ["review_id"])
    want = build_wide(review, business, user, checkin, tip, ["review_id"]).drop("attributes")
    got = wide_from_star(layout, user, tip, ["review_id"]).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
