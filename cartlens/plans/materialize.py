"""Cutting lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartlens.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the checkpoint root and return a
    DataFrame over the files: one job, durable across executor loss, and no
    recomputation of an expensive (or lazily re-mined) lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
