from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import sampling as s


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    return spark.range(20000, numPartitions=5).select(
        n, F.when(n % 10 < 2, 0).when(n % 10 == 2, 1).otherwise(2).alias("label"))


def test_union_keeps_duplicates(rows):
    assert s.union_all(rows, rows, rows.select("label", "id")).count() == 60000


def test_sample_size_and_repartitioning(rows):
    taken = s.sample_fraction(rows, 0.25, 7, ["id"])
    assert abs(taken.count() - 5000) < 300
    again = s.sample_fraction(rows.repartition(3), 0.25, 7, ["id"])
    assert taken.exceptAll(again).isEmpty() and again.exceptAll(taken).isEmpty()
    assert abs(s.sample_fraction(rows, 0.25, 7).count() - 5000) < 300


def test_seeds_differ(rows):
    one, two = (s.sample_fraction(rows, 0.5, seed, ["id"]) for seed in (1, 2))
    assert abs(one.intersect(two).count() - 5000) < 400


def test_split_is_a_partition(rows):
    train, test = s.split(rows, [0.8, 0.2], 25, ["id"])
    assert train.intersect(test).isEmpty()
    assert train.count() + test.count() == 20000 and abs(test.count() - 4000) < 300
    parts = s.split(rows, [1, 1, 2], 25, ["id"])
    assert sum(p.count() for p in parts) == 20000


def test_split_and_sample_are_independent(rows):
    """The same seed for both must not put the whole sample on one side of the split."""
    train, test = s.split(rows, [0.8, 0.2], 25, ["id"])
    share = s.sample_fraction(test, 0.25, 25, ["id"]).count() / test.count()
    assert 0.2 < share < 0.3


def test_balance(rows):
    for key in (["id"], None):
        out = {x.label: x["count"] for x in s.balance_classes(rows, key=key).groupBy("label").count().collect()}
        assert out[1] == 2000
        assert abs(out[0] - 2000) < 200 and abs(out[2] - 2000) < 200


def test_balance_keeps_small_classes_whole(rows):
    out = {x.label: x["count"] for x in s.balance_classes(rows, anchor=0, key=["id"]).groupBy("label").count().collect()}
    assert out[0] == 4000 and out[1] == 2000
    assert s.balance_classes(rows, key=["id"]).columns == rows.columns


def test_native_split(rows):
    assert sum(p.count() for p in s.split(rows, [0.8, 0.2])) == 20000
