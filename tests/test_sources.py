from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.functions import parse_ts
from reviewlens.operators.aggregates import tag_counts
from reviewlens.plans.eda import clean_businesses
from reviewlens.sources import (
    cut_lineage,
    training_rows,
    export_counts,
    from_rows,
    read_counts,
    read_features,
    register_views,
    write_features,
)


def test_read_five_tables(raw):
    counts = {name: df.count() for name, df in raw.items()}
    assert counts == {"review": 6, "business": 8, "user": 5, "checkin": 4, "tip": 3}
    assert dict(raw["review"].dtypes)["useful"] == "bigint"
    assert dict(raw["user"].dtypes)["member_since"] == "string"
    assert dict(raw["business"].dtypes)["attributes"] == "map<string,string>"


def test_nested_access(raw):
    dogs = raw["business"].select("attributes.DogsAllowed").collect()
    assert [r[0] for r in dogs].count("True") == 1


def test_malformed_line_keeps_the_rest(spark, tmp_path):
    from reviewlens.sources import read_table

    path = tmp_path / "tip.json"
    path.write_text('{"business_id": "b", "compliment_count": 1}\nnot json\n')
    rows = read_table(spark, str(path), "tip").collect()
    assert sorted((r.business_id or "") for r in rows) == ["", "b"]


def test_features_round_trip(raw, spark, tmp_path):
    path = str(tmp_path / "wide")
    df = parse_ts(raw["review"], "date")
    write_features(df, path)
    write_features(df, path)
    back = read_features(spark, path)
    assert back.schema == df.schema and back.exceptAll(df).isEmpty() and back.count() == df.count()


def test_export_counts_round_trip_keeps_order(raw, spark, tmp_path):
    path = str(tmp_path / "tags")
    counts = tag_counts(clean_businesses(raw["business"]))
    export_counts(counts, path)
    back = read_counts(spark, path, "category_word string, count bigint")
    rows = [tuple(r) for r in counts.collect()]
    assert {tuple(r) for r in back.collect()} == set(rows)
    assert [n for _, n in rows] == sorted((n for _, n in rows), reverse=True)
    assert len({tag for tag, _ in rows}) == len(rows)


def test_views_and_literal_rows(spark):
    register_views(spark, some_rows=from_rows(spark, [("a", 1), ("b", None)], "k string, n int"))
    assert spark.sql("SELECT count(n) FROM some_rows").first()[0] == 1


def test_cut_lineage(spark, tmp_path):
    df = cut_lineage(spark.range(10).filter("id % 2 = 0"), str(tmp_path))
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 5


def test_training_rows_follow_the_parameter_and_the_key(spark, tmp_path):
    rows = training_rows(spark.range(1000).repartition(3), ["id"], 5, str(tmp_path))
    assert rows.rdd.getNumPartitions() == 5 and rows.count() == 1000
    where = lambda df: {r.id: r.p for r in df.withColumn("p", F.spark_partition_id()).collect()}
    assert where(rows) == where(training_rows(spark.range(1000).repartition(7), ["id"], 5, str(tmp_path)))
