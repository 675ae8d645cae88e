"""Readers for the driver's parquet tables.

Reads are plain ``spark.read.parquet``; callers select the columns they
need so Catalyst prunes the scan (``ReadSchema``) and pushes filters.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as planned by Spark's own file splits."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str) -> list[str]:
    """Expose every driver table as a temp view of the same name."""
    for t in TABLES:
        read_table(spark, sf_dir, t).createOrReplaceTempView(t)
    return list(TABLES)
