"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import scratch_dir

#: Bytes to blanks except digits, a-z and everything above ASCII; A-Z to a-z.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_TABLE).split() if text else []


def cut_lineage(df: DataFrame) -> DataFrame:
    """An eager checkpoint in the shared folder: computed once, survives lost
    executors, removed when no DataFrame refers to it any more."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_points(df: DataFrame, col: Column, pieces: int) -> list:
    """About even cut points of a numeric column (fewer when values repeat).
    They only deal rows out to tasks; no result depends on where they lie."""
    if pieces < 2:
        return []
    at = [k / pieces for k in range(1, pieces)]
    got = df.agg(F.percentile_approx(col, at, 10 * pieces).alias("p")).first()["p"]
    return sorted({v for v in got or [] if v is not None})


def bucket_of(col: Column, cuts: list) -> Column:
    """Number of cut points at or below the value; 0 for NULL (NULLs sort first)."""
    if not cuts:
        return F.lit(0)
    # the points are numbers taken from the column itself, so an array literal is exact
    array = F.array(*[F.lit(c) for c in cuts])
    return F.coalesce(F.size(F.filter(array, lambda c: c <= col)), F.lit(0))


def ranked(df: DataFrame, group: list[str], order: list[str], spread: str, cuts: list,
           out: str) -> DataFrame:
    """``out`` = 0-based rank of each row by ``order`` within ``group``.

    ``order`` starts with columns of few values, then the numeric column
    ``spread``, whose ``cuts`` split any large group into buckets. Buckets are
    counted (with map-side combine), the counts summed up within the group,
    and rows ranked within one bucket only, so a group holding a third of all
    rows is still dealt to many tasks. NULLs sort first."""
    lead = order[:order.index(spread)]
    part, at, n = f"{out}__part", f"{out}__at", f"{out}__n"
    rows = df.withColumn(part, bucket_of(F.col(spread), cuts))
    counts = rows.groupBy(*group, *lead, part).agg(F.count(F.lit(1)).alias(n))
    offsets = _running(counts, [*group, *lead], [part], n, at)
    if lead:
        totals = _running(counts.groupBy(*group, *lead).agg(F.sum(n).alias(n)), group, lead, n, f"{at}2").drop(n)
        offsets = _join_same(offsets, totals, [*group, *lead]).withColumn(at, F.col(at) + F.col(f"{at}2")).drop(f"{at}2")
    key = [*group, *lead, part]
    within = Window.partitionBy(*key).orderBy(*[F.asc_nulls_first(c) for c in order])
    rows = rows.withColumn(f"{out}__r", F.row_number().over(within))
    return (_join_same(rows, offsets.drop(n), key)
            .withColumn(out, F.col(at) + F.col(f"{out}__r") - 1)
            .drop(part, f"{out}__r", at))


def _running(counts: DataFrame, group: list[str], order: list[str], n: str, out: str) -> DataFrame:
    """Sum of the counts before each row of a table of counts."""
    w = Window.partitionBy(*(group or [F.lit(0)])).orderBy(*[F.asc_nulls_first(c) for c in order])
    return counts.withColumn(out, F.sum(n).over(w) - F.col(n))


def _join_same(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Inner join on equal keys, NULL equal to NULL; the key columns of ``left`` stay."""
    right = right.select(*[F.col(c).alias(f"{c}__j") if c in key else F.col(c) for c in right.columns])
    on = F.lit(True)
    for c in key:
        on = on & F.col(c).eqNullSafe(F.col(f"{c}__j"))
    return left.join(right, on).drop(*[f"{c}__j" for c in key])


def for_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, in
    sessions started without it on the path (on a cluster it is installed or
    sent along with ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [root])


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with this package importable in the workers."""
    for_workers(df.sparkSession)
    return df.mapInArrow(run, schema)
