from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import joins as j
from reviewlens.operators.features import feature_table
from reviewlens.plans.sentiment import prepare_wide


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on one key, some null keys, some keys without a match."""
    n = F.col("id")
    fact = spark.range(3000, numPartitions=4).select(
        n.alias("row"),
        F.when(n % 3 == 0, "hot").when(n % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), n % 700)).alias("key"),
    )
    dim = spark.range(500).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").alias("v"))
    return fact, dim.unionAll(spark.createDataFrame([("hot", -1)], "key string, v bigint"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_join_equals_plain_join(skewed, how):
    fact, dim = skewed
    got, want = j.skew_join(fact, dim, "key", how), fact.join(dim, "key", how)
    assert sorted(got.columns) == sorted(want.columns)
    want = want.select(got.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_skew_join_keeps_duplicate_dimension_rows(spark, skewed):
    fact, dim = skewed
    twice = dim.unionAll(dim.filter("key = 'hot'"))
    assert j.skew_join(fact, twice, "key").count() == fact.join(twice, "key", "left").count()


def test_skew_join_refuses_inexact_kinds(skewed):
    with pytest.raises(ValueError):
        j.skew_join(*skewed, "key", "full")


def test_hot_keys_and_their_pieces(skewed):
    fact, _ = skewed  # 1,000 of the 2,960 rows with a key belong to "hot"
    assert [tuple(r) for r in j.hot_keys(fact, "key", 8).collect()] == [("hot", 3)]
    assert [tuple(r) for r in j.hot_keys(fact, "key", 64).collect()] == [("hot", 22)]
    assert j.hot_keys(fact.limit(0), "key").isEmpty()
    assert j.hot_keys(fact, "key", 1).isEmpty()


@pytest.mark.parametrize("pieces", [2, 50, 1000])
def test_pieces_stay_bounded(skewed, pieces):
    found = j.hot_keys(skewed[0], "key", pieces).collect()
    assert len(found) < pieces and sum(r._pieces for r in found) < 2 * pieces


@pytest.mark.parametrize("pieces", [1, 5, 3000])
def test_any_number_of_pieces_gives_the_same_join(skewed, pieces):
    fact, dim = skewed
    got, want = j.skew_join(fact, dim, "key", pieces=pieces), fact.join(dim, "key", "left")
    want = want.select(got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_hot_rows_spread_over_partitions(skewed, spark):
    """With broadcasts off, no shuffle partition receives the hot key's rows whole."""
    fact, dim = skewed
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = j.skew_join(fact, [dim, dim.withColumnRenamed("v", "w")], "key", pieces=96).filter("key = 'hot'")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 1000 and len(sizes) >= 6 and max(sizes) < 400


def naive_wide(raw):
    """The star join written out one table at a time, in Python."""
    t = {name: [r.asDict() for r in df.collect()] for name, df in raw.items()}
    out = []
    for r in t["review"]:
        b = next((x for x in t["business"] if x["business_id"] == r["business_id"]), None)
        u = next((x for x in t["user"] if x["user_id"] == r["user_id"]), None)
        c = next((x for x in t["checkin"] if x["business_id"] == r["business_id"]), None)
        out.append((
            r["review_id"], r["business_id"], r["user_id"],
            b and b["stars"], u and u["review_count"],
            len(c["date"].split(", ")) if c and c["date"] is not None else None,
            sum(x["user_id"] == r["user_id"] for x in t["tip"]) or None,
            sum(x["business_id"] == r["business_id"] for x in t["tip"]) or None,
        ))
    return out


def test_build_wide_equals_one_by_one(raw):
    wide = j.build_wide(*(raw[t] for t in ("review", "business", "user", "checkin", "tip")))
    got = wide.select("review_id", "business_id", "user_id", "business_stars", "user_review_count",
                      "checkin_count", "user_tip_count", "business_tip_count").collect()
    assert sorted(map(tuple, got), key=str) == sorted(naive_wide(raw), key=str)


def test_prepare_wide_fills_and_derives(raw):
    wide = prepare_wide(*(raw[t] for t in ("review", "business", "user", "checkin", "tip")), since_field="member_since")
    rows = {(r.review_id, r.business_id): r for r in wide.collect()}
    assert len(rows) == 6
    lost = rows[("r5", "b9")]  # business missing from its table, but checked in and tipped
    assert lost.business_stars == 0 and lost.checkin_count == 1 and lost.business_tip_count == 1
    assert lost.categories == [] and lost.text == "" and lost.year is None and lost.label == 2
    gone = rows[("r4", "b2")]  # user missing from its table, but tipped
    assert gone.user_tip_count == 1 and gone.user_review_count == 0 and gone.user_engagement is None
    first = rows[("r1", "b1")]
    assert first.categories == ["Restaurants", "Seafood"] and first.checkin_count == 3
    assert (first.useful, first.num_exclamations, first.user_activity, first.user_engagement) == (0, 2, 12, 7)
    assert first.friends == ["u2", "u3"] and first.address == "33602, Tampa" and first.year == 2018


def test_wide_round_trip_keeps_feature_types(raw):
    types = dict(feature_table(j.build_wide(*(raw[t] for t in ("review", "business", "user", "checkin", "tip")))
                               .withColumn("categories", F.split("categories", ", "))
                               .withColumn("date", F.try_to_timestamp("date"))).dtypes)
    assert types["label"] == "int" and types["categories"] == "array<string>" and types["average_stars"] == "double"


def test_restrict_to_keys(raw, spark):
    ids = spark.createDataFrame([("b1",), ("b2",)], "business_id string")
    assert j.restrict_to_keys(raw["review"], ids, "business_id").count() == 5


def test_densify(spark):
    counts = spark.createDataFrame([(0, 0, 5), (2, 1, 1)], "label int, prediction int, n bigint")
    full = {tuple(r) for r in j.densify(counts, {"label": [0, 1, 2], "prediction": [0, 1]}).collect()}
    assert full == {(0, 0, 5), (0, 1, 0), (1, 0, 0), (1, 1, 0), (2, 0, 0), (2, 1, 1)}


def test_tip_counts(raw):
    assert {tuple(r) for r in j.tip_counts(raw["tip"], "user_id").collect()} == {("u1", 2), ("u9", 1)}


def test_hot_keys_together_equal_one_by_one(skewed):
    fact = skewed[0].withColumn("other", F.when(F.col("row") % 5 == 0, F.lit(7)).otherwise(F.col("row")))
    together = j.hot_keys_together(fact, ["key", "other"], 20)
    for key in ("key", "other"):
        assert {tuple(r) for r in together[key].collect()} == {tuple(r) for r in j.hot_keys(fact, key, 20).collect()}
    empty = j.hot_keys_together(fact.filter("row < 0"), ["key", "other"], 20)
    assert all(t.isEmpty() for t in empty.values())
