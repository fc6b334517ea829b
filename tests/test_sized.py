"""Large joins are dealt over parts and buckets by their rows, and joins are not repeated to count keys or classes."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows_of
from reviewlens.operators import joins
from reviewlens.sources import layout
from workloads import models, registry
from workloads import standins as st

DAY = datetime.datetime(1997, 1, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Order lines of which one business and one user have most, with a line without order."""
    to = str(tmp_path_factory.mktemp("tables"))
    lines = [(o, 1 if o < 30 else o, 1, n, 5.0, 0.05, "R", DAY) for o in range(40) for n in range(1, 4)]
    lines.append((99, 1, 1, 1, 5.0, 0.05, "N", DAY))
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_discount double, l_returnflag string, l_shipdate timestamp").write.parquet(f"{to}/lineitem.parquet")
    orders = [(o, 7 if o < 25 else o, "1-URGENT" if o % 2 else "5-LOW") for o in range(40)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(
        f"{to}/orders.parquet")
    parts = [(p, f"red {p}", "Brand", "ring", p % 50, 10.0) for p in range(1, 40)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
                          "p_retailprice double").write.parquet(f"{to}/part.parquet")
    return to


@pytest.mark.parametrize("table", [st.reviews, st.scored_reviews])
def test_parts_follow_the_rows(spark, folder, monkeypatch, table):
    few = table(spark, folder)
    want = sorted(map(repr, few.collect()))
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 5)
    many = table(spark, folder)
    assert many.rdd.getNumPartitions() == 25  # 121 lines
    assert sorted(map(repr, many.collect())) == want and len(want) == 120


def test_small_tables_are_left_to_spark(spark, folder):
    assert joins.row_parts(spark.read.parquet(f"{folder}/lineitem.parquet")) is None


def test_hot_keys_need_no_join(spark, folder):
    found = st.review_hot_keys(spark, folder)
    together = joins.hot_keys_together(st.reviews(spark, folder), ["business_id", "user_id"])
    for key in ("business_id", "user_id"):
        assert {r[0] for r in found[key].collect()} == {r[0] for r in together[key].collect()}
    assert rows_of(found["user_id"]) == rows_of(together["user_id"])


@pytest.fixture(scope="module")
def star(spark, folder):
    """The same folder with users, tips and check-ins."""
    users = [(u, f"user {u}", "MACHINERY" if u % 3 else "FURNITURE", 100.0 * u) for u in range(30)]
    spark.createDataFrame(users, "c_custkey long, c_name string, c_mktsegment string, c_acctbal double").write.parquet(
        f"{folder}/customer.parquet")
    tips = [(e, e % 9, DAY, "view", 1.5) for e in range(50)]
    spark.createDataFrame(tips, "event_id long, user_id long, ts timestamp, event_type string, value double").write.parquet(
        f"{folder}/events.parquet")
    spark.createDataFrame([(b, "a, b") for b in range(5)], "doc_id long, text string").write.parquet(
        f"{folder}/documents.parquet")
    return folder


def test_stored_reviews_fill_buckets_by_rows(spark, star, monkeypatch):
    want = sorted(map(repr, registry.QUERIES["wide_features"](spark, star).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = registry.QUERIES["wide_features_stored"](spark, star)
        assert _buckets(spark) == 8 and sorted(map(repr, few.collect())) == want
        monkeypatch.setattr(joins, "ROWS_PER_TASK", 5)
        many = registry.QUERIES["wide_features_stored"](spark, star)
        assert _buckets(spark) == 25  # 121 lines
        assert many.rdd.getNumPartitions() == 24  # 120 reviews, dealt by rows for their users
        assert sorted(map(repr, many.collect())) == want and len(want) == 120
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_stored_reviews_are_not_joined_to_count_keys(spark, star, monkeypatch):
    def counted(*given):
        raise AssertionError("the joined reviews are counted")

    monkeypatch.setattr(layout, "hot_keys", counted)
    assert registry.QUERIES["wide_features_stored"](spark, star).count() == 120


def _buckets(spark) -> int:
    described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED star_review").collect()}
    return int(described["Num Buckets"])


@pytest.mark.parametrize("pieces", [2, 4, 40, None])
def test_scanned_hot_keys_are_the_hot_keys(spark, pieces):
    row = F.col("id")
    key = F.when(row % 3 == 0, 7).when(row % 10 == 1, None).when(row % 4 == 1, 9).otherwise(row % 500)
    rows = spark.range(3000).select(key.cast("bigint").alias("key"))
    for table in (rows, rows.select(F.concat(F.lit("k"), "key").alias("key")), rows.filter("key < 0")):
        want, got = joins.hot_keys(table, "key", pieces), joins.hot_keys_scanned(table, "key", pieces)
        assert rows_of(got) == rows_of(want) and got.dtypes == want.dtypes


def test_labelled_rows_are_joined_once(spark, monkeypatch):
    joined = []
    whole = models.text_wide
    monkeypatch.setattr(models, "_LABELLED", {})
    monkeypatch.setattr(models, "text_wide", lambda *given: joined.append(1) or whole(*given))
    train, test = models.parts(spark, SMALL)
    again = models.parts(spark, SMALL)
    assert rows_of(train.select("review_id")) == rows_of(again[0].select("review_id"))
    assert test.count() == again[1].count() and len(joined) == 1
    assert "text" in train.columns and not any("Join" in line for line in _plan(models._LABELLED).splitlines())


def _plan(kept) -> str:
    (df,) = kept.values()
    return df._jdf.queryExecution().executedPlan().toString()
