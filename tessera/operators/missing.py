"""Missing-value profile: per-column gaps and whole-table totals.

Everything comes from one aggregate over all columns (one scan); only that
single row reaches the driver, and the per-column table is an unpivot of it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import is_missing, percent


def _floating(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))}


def _profile_row(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    fl = _floating(df)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(is_missing(c, c in fl)).alias(c) for c in cols]
    return df.agg(*aggs)


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, total, pct)``: NULL (or NaN) count per column and its share
    of the rows; pct is 0 on an empty table."""
    cols = list(cols or df.columns)
    wide = _profile_row(df, cols)
    long = wide.unpivot(["_rows"], cols, "column", "total")
    return long.select("column", F.col("total").cast("long").alias("total"),
                       F.round(percent("total", "_rows"), 6).alias("pct"))


def missing_bars(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Only the columns that have gaps (the data of the missing-count chart)."""
    return missing_counts(df, cols).where(F.col("total") > 0)


def missing_totals(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: ``total_cells`` (rows x columns), ``total_missing``,
    ``missing_pct`` (0 when there are no cells) and ``columns_with_gaps``."""
    cols = list(cols or df.columns)
    wide = _profile_row(df, cols)
    missing = sum((F.col(c) for c in cols), F.lit(0)).cast("long")
    with_gaps = sum(((F.col(c) > 0).cast("long") for c in cols), F.lit(0)).cast("long")
    cells = (F.col("_rows") * F.lit(len(cols))).cast("long")
    return wide.select(cells.alias("total_cells"), missing.alias("total_missing"),
                       with_gaps.alias("columns_with_gaps")) \
        .withColumn("missing_pct", F.round(percent("total_missing", "total_cells"), 6))
