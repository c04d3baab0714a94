"""Catalog helpers: typed table definitions, existence checks, profiles,
named-dataset loads and feature/label separation.

These are metadata operations over the Spark catalog (or Parquet
locations); row counts run as Spark aggregates (a Parquet ``count(*)`` reads
no column data).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import constraints
from tessera.sources.tables import TABLE_NAMES, read_table


def tables_exist(spark: SparkSession, expected: Sequence[str]) -> bool:
    """True when every expected table is in the catalog."""
    return all(spark.catalog.tableExists(t) for t in expected)


def create_tables(spark: SparkSession, schemas: Mapping[str, T.StructType],
                  force: bool = False, drop_order: Sequence[str] | None = None,
                  declared: Mapping[str, constraints.Constraints] | None = None) -> list[str]:
    """Create each table with its declared schema if absent; with ``force``,
    drop (children first, ``drop_order``) and recreate. Without ``force`` it
    is a no-op when all tables exist. Returns the tables created.

    NOT NULL of the schema and the ``declared`` keys and references are kept
    with the table; ``constraints.insert_rows`` refuses a load against them."""
    names = list(schemas)
    if not force and tables_exist(spark, names):
        return []
    if force:
        for t in (drop_order or list(reversed(names))):
            spark.sql(f"DROP TABLE IF EXISTS `{t}`")
    created = []
    for t, schema in schemas.items():
        if spark.catalog.tableExists(t):
            continue
        rules = constraints.of_schema(schema, (declared or {}).get(t))
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(t)
        constraints.keep(spark, t, rules)
        created.append(t)
    return created


def row_count(df: DataFrame) -> DataFrame:
    """``SELECT COUNT(*) AS n`` as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def table_profile(spark: SparkSession, data_dir: str, names: Sequence[str] = TABLE_NAMES) -> DataFrame:
    """``(table, n)``: row count of every table in one aggregate. Each table
    contributes only its name per row, so the scans read no column data
    (Parquet row counts come from the footers); partial counts per task, one
    small shuffle for all tables."""
    rows = None
    for t in names:
        part = read_table(spark, data_dir, t).select(F.lit(t).alias("table"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("table").agg(F.count(F.lit(1)).alias("n"))


def table_columns(spark: SparkSession, data_dir: str, names: Sequence[str] = TABLE_NAMES) -> DataFrame:
    """``(table, position, column, type)`` from each table's schema (metadata only)."""
    rows = []
    for t in names:
        for i, f in enumerate(read_table(spark, data_dir, t).schema.fields, start=1):
            rows.append((t, i, f.name, f.dataType.simpleString()))
    return spark.createDataFrame(rows, "table string, position int, column string, type string")


def load_named(spark: SparkSession, name_or_id, data_dir: str | None = None,
               version: int = 1) -> DataFrame:
    """Load a dataset by name or numeric id: a catalog table of that name, or
    Parquet under ``data_dir`` (``<name>.parquet``, or ``<name>/v<version>``)."""
    if isinstance(name_or_id, str):
        # a name such as breast-cancer needs quotes in the catalog
        quoted = ".".join(f"`{part.replace('`', '``')}`" for part in name_or_id.split("."))
        if spark.catalog.tableExists(quoted):
            return spark.table(quoted)
    if data_dir is None:
        raise ValueError(f"dataset {name_or_id!r} not in the catalog and no data_dir given")
    key = f"id={name_or_id}" if isinstance(name_or_id, int) else str(name_or_id)
    base = data_dir.rstrip("/")
    for path in (f"{base}/{key}.parquet", f"{base}/{key}/v{version}"):
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":        # only then try the next layout
                raise
    raise FileNotFoundError(f"dataset {name_or_id!r} (version {version}) not found under {data_dir}")


def with_label(df: DataFrame, target: str, label: str = "label") -> DataFrame:
    """Feature/target separation without splitting the frame: the target
    becomes ``label`` and stays on the same rows as its features."""
    return df.withColumnRenamed(target, label)


def feature_columns(df: DataFrame, target: str) -> list[str]:
    """Every column except the target (``df.drop(columns=[target])``)."""
    return [c for c in df.columns if c != target]
