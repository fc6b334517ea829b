"""Comparing a registered query's Spark result with its SQL on DuckDB, by type and by value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "timestamp_ntz": "TIMESTAMP"}


def local_session() -> SparkSession:
    """A local session for checks and tests."""
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf: str) -> duckdb.DuckDBPyConnection:
    """An in-process DuckDB with one view per table file."""
    db = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def _ordered(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def problems(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Number of Spark rows, and every way in which the result differs from the SQL's."""
    types = {row[0]: row[1] for row in db.execute(f"DESCRIBE {sql}").fetchall()}
    cols = list(df.columns)
    if cols != list(types):
        return 0, [f"columns {cols} against {list(types)}"]
    found = [f"type of {c}: {t} against {types[c]}" for c, t in df.dtypes if _KINDS.get(t, t) != types[c]]
    got = _ordered([tuple(row) for row in df.select(*[f"`{c}`" for c in cols]).collect()])
    listed = ", ".join(f'"{c}"' for c in cols)
    want = _ordered(db.execute(f"SELECT {listed} FROM ({sql})").fetchall())
    if len(got) != len(want):
        found.append(f"{len(got)} rows against {len(want)}")
    differing = [(g, w) for g, w in zip(got, want) if not all(map(_same, g, w))]
    if differing:
        found.append(f"{len(differing)} rows differ, the first {differing[0]}")
    return len(got), found
