"""Data-quality checks and key-set comparison.

Spark declares no keys; uniqueness, NOT NULL and foreign-key relationships
are explicit, distributed checks that return the offending rows or counts.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.strategy import join_small, keys_present, null_safe_full_outer


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_set_compare(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: ``only_left``, ``only_right``, ``both`` distinct keys and
    ``equal`` (both one-sided counts are 0). The key sets are de-duplicated
    (map-side) before a full outer join, so hot keys do not skew it."""
    keys = _keys(key)
    lk = left.select(*keys).distinct().withColumn("_l", F.lit(1))
    rk = right.select(*keys).distinct().withColumn("_r", F.lit(1))
    j = null_safe_full_outer(lk, rk, keys)     # NULL matches NULL, as in a set
    return j.agg(
        F.count_if(F.col("_r").isNull()).alias("only_left"),
        F.count_if(F.col("_l").isNull()).alias("only_right"),
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("both"),
    ).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def is_subset(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> bool:
    """True when every key of ``left`` occurs in ``right``."""
    keys = _keys(key)
    return orphan_rows(left.select(*keys), right, keys).limit(1).count() == 0


def orphan_rows(child: DataFrame, parent: DataFrame, key: str | Sequence[str],
                parent_key: str | Sequence[str] | None = None) -> DataFrame:
    """Child rows whose key has no parent row (foreign-key violations).

    As in SQL foreign keys, a child row with a NULL in its key references
    nothing and is not a violation. Keys are settled first, key-only: the
    child's distinct keys (map-side combined, so a hot key costs one row per
    task) anti-joined with the parent's distinct keys. The child rows then
    meet that orphan-key set through a size-checked broadcast semi join, so
    they are not shuffled; past the bound it is a shuffle semi join on a
    checkpointed key set, where AQE splits a skewed key."""
    keys = _keys(key)
    pkeys = _keys(parent_key) if parent_key else keys
    pk = parent.select(*[F.col(p).alias(k) for p, k in zip(pkeys, keys)]).distinct()
    referencing = child.where(keys_present(keys))
    orphan_keys = referencing.select(*keys).distinct().join(pk, keys, "left_anti")
    return join_small(referencing, orphan_keys, keys, "left_semi")


def duplicate_keys(df: DataFrame, key: str | Sequence[str], alias: str = "count") -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    keys = _keys(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
            .where(F.col(alias) > 1))


def null_violations(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column, how many rows are NULL (NaN counts as missing in floating
    columns). One aggregate over all columns, unpivoted to ``(column, nulls)``."""
    cols = list(cols or df.columns)
    floating = {f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    aggs = []
    for c in cols:
        miss = F.col(c).isNull() | F.isnan(c) if c in floating else F.col(c).isNull()
        aggs.append(F.count_if(miss).alias(c))
    wide = df.agg(*aggs)
    return wide.unpivot([], cols, "column", "nulls")


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    """Raise when a key occurs twice (primary-key constraint)."""
    bad = duplicate_keys(df, key).limit(5).collect()
    if bad:
        raise ValueError(f"duplicate keys: {[tuple(r) for r in bad]}")


def assert_not_null(df: DataFrame, cols: Sequence[str]) -> None:
    """Raise when a NOT NULL column holds a NULL."""
    bad = [r["column"] for r in null_violations(df, cols).where("nulls > 0").collect()]
    if bad:
        raise ValueError(f"NULL in NOT NULL columns: {bad}")


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """Schema guard: raise naming the absent columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
