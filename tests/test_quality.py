from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewlens.functions import parse_ts
from reviewlens.operators import quality as q


def test_row_counts(raw):
    assert {tuple(r) for r in q.row_counts(raw).collect()} == {
        ("review", 6), ("business", 8), ("user", 5), ("checkin", 4), ("tip", 3)}


def test_missing_counts_kinds(spark):
    df = spark.createDataFrame(
        [("", 1.0, 1), ("NaN", float("nan"), None), (None, None, 3)], "s string, d double, i int")
    assert tuple(q.missing_counts(df).first()) == (1, 2, 1)
    assert tuple(q.missing_counts(df, nan=False).first()) == (1, 1, 1)
    assert tuple(q.missing_counts(df, empty=True).first()) == (2, 2, 1)
    assert tuple(q.missing_counts(df, text_nan=True).first()) == (2, 2, 1)
    assert q.missing_counts(df, cols=["i"]).columns == ["i"]


def test_missing_counts_nested(raw):
    row = q.missing_counts(raw["business"], empty=True).first()
    assert row.attributes == 7 and row.hours == 8 and row.categories == 2 and row.address == 2


def test_blank_rows(raw):
    assert {r.review_id for r in q.blank_rows(raw["review"], "text").collect()} == {"r3", "r4"}


def test_duplicate_keys_counts_null_as_key(raw, spark):
    assert tuple(q.duplicate_keys(raw["review"], ["review_id"]).first()) == (6, 5, 1)
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    assert tuple(q.duplicate_keys(df, ["k"]).first()) == (3, 2, 1)
    assert tuple(q.duplicate_keys(df.limit(0), ["k"]).first()) == (0, 0, 0)


def test_distinct(raw):
    assert q.distinct_count(raw["review"], ["funny", "cool"]).first()[0] == 5
    assert {r[0] for r in q.distinct_values(raw["review"], "stars").collect()} == {1.0, 2.0, 3.0, 4.0, 5.0, None}


def test_value_counts_order(raw):
    assert [tuple(r) for r in q.value_counts(raw["review"], "useful").collect()] == [
        (-2, 1), (-1, 1), (0, 2), (1, 1), (2, 1)]


def test_summarize_agrees_with_sparks_summary(raw):
    cols = ["stars", "review_count", "latitude"]
    ours = {r["column"]: r for r in q.summarize(raw["business"], cols).collect()}
    theirs = {r["summary"]: r for r in raw["business"].select(*cols).summary().collect()}
    names = {"mean": "mean", "stddev": "stddev", "min": "min", "p25": "25%", "p50": "50%", "p75": "75%", "max": "max"}
    for col in cols:
        assert ours[col]["count"] == int(theirs["count"][col])
        for mine, other in names.items():
            assert float(ours[col][mine]) == pytest.approx(float(theirs[other][col]))


def test_summarize_keeps_timestamps_and_drops_structs(raw):
    df = parse_ts(raw["review"], "date").select("date", "text", F.struct("stars").alias("s"))
    out = {r["column"]: r for r in q.summarize(df).collect()}
    assert set(out) == {"date", "text"}
    assert out["date"]["min"] == "2018-01-01 00:00:00" and out["date"]["count"] == 5
    assert out["date"]["mean"] is None and out["date"]["p50"] is None


def test_summarize_chosen_stat(raw):
    out = q.summarize(raw["review"], ["useful", "funny", "cool"], ("min",))
    assert {tuple(r) for r in out.collect()} == {("useful", "-2"), ("funny", "-1"), ("cool", "0")}


def test_valid_rate(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert tuple(q.valid_rate(df, "x").first()) == (1, 3, 66.67)
    assert q.valid_rate(df.limit(0), "x").first().invalid_pct is None
