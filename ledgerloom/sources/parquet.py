"""Parquet sink and scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write ``df`` as Parquet (default: replace whatever is at ``path``).

    Never point this at a path the same plan reads: Spark removes the old files
    before the new ones exist.  Keyed tables avoid that with version folders.
    """
    df.write.mode(mode).parquet(path)
    return path


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)
