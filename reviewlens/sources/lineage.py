"""Cutting lineage so that long iterative jobs survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame


def cut_lineage(df: DataFrame, fallback_dir: str | None = None) -> DataFrame:
    """Write `df` to the cluster's reliable checkpoint folder and return it with its lineage cut.

    The folder is the session's `spark.checkpoint.dir`; `fallback_dir` serves only where none is set. It must be a
    folder that the driver and every executor reach, so none is made up here.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or fallback_dir
        if folder is None:
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def training_rows(df: DataFrame, key: list[str], partitions: int, fallback_dir: str | None = None) -> DataFrame:
    """Checkpointed rows in `partitions` parts by a hash of their key.

    Iterative fits cost far more computing than reading, and forests and sums depend on the partitioning, so it is a
    parameter and never follows the machine. The rows are dealt before they are written: no pass shuffles them again.
    """
    return cut_lineage(df.repartition(partitions, *key), fallback_dir)
