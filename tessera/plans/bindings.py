"""Bindings: the driver tables shaped into the inputs the operators expect.

The reference's own data is not available and no driver table contains a
NULL, so inputs with gaps come from natural outer pivots of ``lineitem``
(an order without line ``k`` has no value for it). These functions only
reshape rows; the operators do the work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import read_table

SHEET_ITEMS = 7
# Item-sheet score bands used by the bound reports (inclusive bounds).
SHEET_BANDS = [
    (0, 49, "low"),
    (50, 99, "medium"),
    (100, 149, "high"),
    (150, 350, "very high"),
]
SHEET_UNKNOWN = "unknown"
# Two loads of the keyed order table: rows before the cutoff, then the rest.
LOAD_CUTOFF = "1998-01-01 00:00:00"
ORDER_KEY = ["o_custkey", "o_orderpriority"]
ORDER_BY = ["o_orderdate", "o_orderkey"]


def item_sheet(lineitem: DataFrame, items: int = SHEET_ITEMS) -> DataFrame:
    """One row per order, ``item_k`` = quantity of line ``k`` (NULL when the
    order has no such line)."""
    aggs = [F.max(F.when(F.col("l_linenumber") == k, F.col("l_quantity"))).alias(f"item_{k}")
            for k in range(1, items + 1)]
    return lineitem.groupBy(F.col("l_orderkey").alias("subject_id")).agg(*aggs)


def sparse_lines(lineitem: DataFrame) -> DataFrame:
    """One row per order with naturally missing fields: ``value`` (quantity
    of line 1), ``category`` (return flag of line 2), ``note`` (line status
    of line 3), and complete ``n_lines``, ``total_qty``."""
    ln = F.col("l_linenumber")
    return lineitem.groupBy(F.col("l_orderkey").alias("row_id")).agg(
        F.max(F.when(ln == 1, F.col("l_quantity"))).alias("value"),
        F.max(F.when(ln == 2, F.col("l_returnflag"))).alias("category"),
        F.max(F.when(ln == 3, F.col("l_linestatus"))).alias("note"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("total_qty"))


def scored_labels(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """Labelled documents with truth ``y`` (quality), a rule prediction
    ``yhat`` (long document) and a ``score`` (length)."""
    d = documents.select("doc_id", "n_chars")
    return labels.join(d, "doc_id").select(
        "doc_id", F.col("quality").alias("y"),
        (F.col("n_chars") > 500).cast("int").alias("yhat"),
        F.col("n_chars").cast("double").alias("score"))


def order_loads(orders: DataFrame, cutoff: str = LOAD_CUTOFF):
    """The order table as two successive loads, split at ``cutoff``."""
    ts = F.lit(cutoff).cast("timestamp_ntz")
    return orders.where(F.col("o_orderdate") < ts), orders.where(F.col("o_orderdate") >= ts)


def tables(spark: SparkSession, d: str, *names: str):
    out = [read_table(spark, d, n) for n in names]
    return out[0] if len(out) == 1 else out
