"""Physical-strategy helpers: derived tables computed once, size-checked
broadcasts, key joins that keep partitioning, scalable running sums and exact
order statistics.

They avoid the shapes that do not scale: broadcasting a side whose size is
not known, recomputing an aggregate when it turns out to be large, and a
window with no partition key (``Exchange SinglePartition``), which runs in
one task.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Largest row count of a derived side that is shipped to every executor.
BROADCAST_MAX_ROWS = 100_000
# ... and its largest size in bytes.
BROADCAST_MAX_BYTES = 64 * 1024 ** 2
# Target size of one running-sum bucket.
ROWS_PER_BUCKET = 1_000_000
# Upper bound on the number of running-sum buckets (size of the offsets table).
MAX_BUCKETS = 10_000
# A per-value count table up to this many rows is small enough to read once.
SMALL_DISTINCT = 100_000


def _row_bytes(df: DataFrame) -> Column:
    """About the size of a row: text and binary columns by length, others 16 bytes."""
    total = F.lit(16 * len(df.columns))
    for f in df.schema.fields:
        if f.dataType.simpleString() in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
        elif f.dataType.simpleString().startswith(("array", "map", "struct")):
            total = total + F.octet_length(F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit("")))
    return total


def is_small(stored: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """Whether a computed table has at most ``max_rows`` rows and ``max_bytes``
    bytes; at most ``max_rows + 1`` rows are looked at."""
    head = stored.limit(max_rows + 1)
    got = head.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(stored)).alias("b")).first()
    return got["n"] <= max_rows and (got["b"] or 0) <= (max_bytes or BROADCAST_MAX_BYTES)


def read_once(df: DataFrame, max_rows: int) -> tuple[bool, DataFrame]:
    """Compute ``df`` exactly once, as an eager checkpoint in the shared
    folder. Returns ``(small, stored)``; the values are never rebuilt outside
    Spark, so NULL, NaN and 64-bit keys stay what they are at every size."""
    stored = checkpointed(df)
    return is_small(stored, max_rows), stored


def materialize(df: DataFrame) -> DataFrame:
    """A derived table that is read several times, computed once."""
    return checkpointed(df)


def checkpointed(df: DataFrame) -> DataFrame:
    from tessera.session import scratch_dir
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner",
                   broadcast_right: bool = False) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``), so rows with a
    NULL key keep their group. Spark still plans ``<=>`` keys as a hash or
    sort-merge equi-join. The right side's key columns are dropped."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    if broadcast_right:
        r = F.broadcast(r)
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def keys_present(keys) -> Column:
    """Every key column is non-NULL."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return cond


def null_safe_anti(left: DataFrame, right_keys: DataFrame, keys) -> DataFrame:
    """Rows of ``left`` whose key is not among ``right_keys``, NULL matching
    NULL. Rows with complete keys take a plain equi anti join, which keeps
    existing hash partitioning and bucketing (no shuffle of a bucketed
    ``left``). Rows with a NULL in the key meet the right side's NULL-keyed
    rows in a null-safe join, where AQE splits a hot key. Nothing runs before
    the result is asked for."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    ok = keys_present(keys)
    main = left.where(ok).join(right_keys.where(ok), keys, "left_anti")
    rest = null_safe_join(left.where(~ok), right_keys.where(~ok).select(*keys).distinct(), keys, "left_anti")
    return main.unionByName(rest)


def null_safe_full_outer(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Full outer join on ``keys`` with NULL matching NULL: complete keys by a
    plain equi-join (partitioning and bucketing kept), NULL-keyed rows (a
    handful once the sides are de-duplicated by key) by a null-safe join."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    ok = keys_present(keys)
    main = left.where(ok).join(right.where(ok), keys, "full_outer")
    rest = null_safe_join(left.where(~ok), right.where(~ok), keys, "full_outer")
    return main.unionByName(rest)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = BROADCAST_MAX_ROWS, null_safe: bool = False) -> DataFrame:
    """Join ``big`` with a side that is usually small (per-group statistics,
    category lists, offsets).

    The small side is computed once and measured: within ``max_rows`` rows and
    ``BROADCAST_MAX_BYTES`` it is broadcast (no shuffle of ``big``); beyond,
    the join falls back to a shuffle join where AQE splits skewed keys. With
    ``null_safe`` a NULL key matches a NULL key.
    """
    small_enough, side = read_once(small, max_rows)
    if null_safe:
        return null_safe_join(big, side, on, how, broadcast_right=small_enough)
    return big.join(F.broadcast(side) if small_enough else side, on, how)


def running_sums(df: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str],
                 descending: bool = False, prefix: str = "cum_",
                 rows_per_bucket: int | None = None) -> DataFrame:
    """Add ``cum_<c>``: the running sum of each ``c`` in ``sum_cols`` in the
    (unique) order of ``order_cols``, inclusive of the current row.

    Two-level prefix sum: rows are cut into range buckets on the first order
    column (approximate quantile bounds, one mergeable aggregate), each
    bucket's totals form a small table whose offsets are computed once and
    broadcast, and the running sum within a bucket is a partitioned window.
    An input of at most ``SMALL_DISTINCT`` rows (typically an already
    aggregated table) is one bucket. The order is Spark's at every size: NULL
    below all values, NaN above.
    """
    lead = order_cols[0]
    rows_per_bucket = rows_per_bucket or ROWS_PER_BUCKET
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    small, df = read_once(df, min(SMALL_DISTINCT, rows_per_bucket))
    if small:
        # one bucket of at most SMALL_DISTINCT rows
        w = (Window.partitionBy(F.lit(0)).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return df.coalesce(1).withColumns({f"{prefix}{c}": F.sum(c).over(w) for c in sum_cols})
    buckets = min(MAX_BUCKETS, max(2, math.ceil(df.count() / rows_per_bucket)))
    value = F.col(lead).cast("double")
    finite = ~F.isnan(value) & (F.abs(value) != math.inf)
    probs = [i / buckets for i in range(1, buckets)]
    bounds = df.where(finite).agg(F.percentile_approx(value, probs, 10_000).alias("q")).first()["q"]
    # bucket = index of the range holding the value (binary search in the JVM)
    splits = [-math.inf] + sorted(set(bounds or [0.0])) + [math.inf]
    placed = F.when(value.isNull(), -math.inf).when(F.isnan(value), math.inf).otherwise(value)
    keyed = Bucketizer(splits=splits, inputCol="_lead", outputCol="_bucket",
                       handleInvalid="keep").transform(df.withColumn("_lead", placed))
    keyed = keyed.withColumn("_bucket", F.col("_bucket").cast("int")).drop("_lead")
    if descending:
        keyed = keyed.withColumn("_bucket", F.lit(len(splits)) - F.col("_bucket"))

    # at most MAX_BUCKETS rows: one task sums the totals up
    totals = checkpointed(keyed.groupBy("_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols]).coalesce(1))
    before = (Window.partitionBy(F.lit(0)).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.coalesce(1).select("_bucket", *[
        F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols])

    w = (Window.partitionBy("_bucket").orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = keyed.withColumns({f"_w_{c}": F.sum(c).over(w) for c in sum_cols})
    out = out.join(F.broadcast(offsets), "_bucket")
    out = out.withColumns({f"{prefix}{c}": F.coalesce(F.col(f"_w_{c}"), F.lit(0)) + F.col(f"_o_{c}")
                           for c in sum_cols})
    return out.drop("_bucket", *[f"_w_{c}" for c in sum_cols], *[f"_o_{c}" for c in sum_cols])


def quantiles_from_counts(counts: DataFrame, col: str, n_col: str, ranks) -> dict:
    """Order statistics from a table of (distinct value, count).

    The count total comes from the table. It gets a scalable running sum, and
    each rank is located where the running count first reaches it; only those
    rows reach the driver."""
    counts = counts.select(F.col(col), F.col(n_col).alias("_n"))
    table = checkpointed(counts)
    n = table.agg(F.sum("_n")).first()[0] or 0
    wanted = sorted(set(ranks(n) if callable(ranks) else ranks))
    out = {}
    if n == 0 or not wanted:
        return out
    cum = running_sums(table, [col], ["_n"])
    conds = None
    for k in wanted:
        c = (F.col("cum__n") - F.col("_n") <= F.lit(k)) & (F.col("cum__n") > F.lit(k))
        conds = c if conds is None else conds | c
    rows = cum.where(conds).select(col, "cum__n", "_n").collect()
    for k in wanted:
        for r in rows:
            if r["cum__n"] - r["_n"] <= k < r["cum__n"]:
                out[k] = r[col]
    return out
