"""Source tables kept as one parquet table each below a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.registry import SOURCES, conform


def load_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        name: conform(spark.read.parquet(f"{folder}/{name}"), table)
        for name, table in SOURCES.items()
    }


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Make every table a SQL name of the session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
