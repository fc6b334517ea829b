"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewlens.schemas import table_schema


def read_table(
    spark: SparkSession, path: str, name: str, fmt: str = "json", since_field: str | None = None
) -> DataFrame:
    """One of the five input tables (`review business user checkin tip`) under its fixed schema."""
    reader = spark.read.schema(table_schema(name, since_field))
    if fmt == "json":
        reader = reader.option("mode", "PERMISSIVE")
    return reader.format(fmt).load(path)


def write_features(df: DataFrame, path: str) -> None:
    """Persist the wide review table as Parquet, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def export_counts(df: DataFrame, path: str) -> None:
    """Write a counts table as CSV with a header.

    A sorted table keeps its order across the part files; a small one is a single file because AQE
    merges its partitions. Nothing is forced through one task.
    """
    df.write.mode("overwrite").option("header", True).csv(path)


def read_counts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def register_views(spark: SparkSession, **frames: DataFrame) -> None:
    """Register each frame as a temporary view under its keyword."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def from_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A DataFrame from a few literal rows, typed by a DDL schema."""
    return spark.createDataFrame(rows, schema)
