from __future__ import annotations

import os

from reviewlens.llm import common


def test_stored_tables_are_read_back_and_can_be_dropped(spark):
    df = common.stored(spark.range(5).selectExpr("id", "CAST(NULL AS STRING) AS s"), "few")
    path = common._WRITTEN[-1].removeprefix("file:")
    assert sorted(r.id for r in df.collect()) == [0, 1, 2, 3, 4] and df.columns == ["id", "s"]
    assert os.path.isdir(path)
    common.drop_stored(spark)
    assert not os.path.exists(path) and not common._WRITTEN


def test_names_that_are_free(spark):
    df = spark.createDataFrame([(1, 2)], "Mark int, _mark int")
    assert common.free_name(df, "mark") == "__mark" and common.free_name(df, "other") == "other"
