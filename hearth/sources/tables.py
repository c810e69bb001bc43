"""Readers for the driver tables (one parquet file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import compiled

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read one driver table; selecting columns here lets the scan prune them."""
    compiled(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df
