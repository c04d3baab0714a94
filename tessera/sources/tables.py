"""Table access by name over a directory of Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(data_dir: str, name: str) -> str:
    return f"{data_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; projections and filters applied later are pushed
    into the scan by Catalyst (``ReadSchema`` / ``PushedFilters``)."""
    return spark.read.parquet(table_path(data_dir, name))


def register_views(spark: SparkSession, data_dir: str, names=TABLE_NAMES) -> None:
    """Register each table as a temp view so reports can be written in SQL."""
    for name in names:
        read_table(spark, data_dir, name).createOrReplaceTempView(name)
