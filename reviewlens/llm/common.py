"""Helpers shared by the corpus operators: whole tables in, tables cut from their lineage, batches of rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_ROWS = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: `spark.checkpoint.dir`, or where it is unset the warehouse.

    Both are reached by the driver and by every executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stored"


_WRITTEN: list[str] = []


def drop_stored(spark: SparkSession) -> None:
    """Delete the intermediate tables that this process has written; results that read them must be written first."""
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: computed once, and whole after a lost executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(nullable(df.schema)).parquet(path)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo `modulus`; the crc of an empty text for a null key."""
    text = F.coalesce(key.cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % F.lit(modulus)


def free_name(df: DataFrame, wish: str) -> str:
    """`wish`, or a variant of it that no column of `df` has, whatever the case of its letters."""
    taken, name = {c.lower() for c in df.columns}, wish
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut record batches into short ones, so that a run of very long texts stays small in memory."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
