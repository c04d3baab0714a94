"""Exact stratified train/test split.

``sampleBy`` is Bernoulli sampling, so class sizes drift from the requested
share. Here the test set has exactly ``ceil(test_size * n)`` rows, divided
among classes by integer quotas (largest remainder), and membership is the
rank of a keyed md5 hash within each class -- deterministic, reproducible in
SQL, and independent of partitioning and retries.

Rank without a global sort: rows are bucketed by the leading hex digits of
their hash; one aggregate of counts per (class, bucket) gives the class sizes
and every bucket's offset in the class order (more digits, in a second pass,
only when a class is so large that a bucket would exceed
``ROWS_PER_HASH_BUCKET`` rows). Buckets entirely inside or outside the
quota are decided without ranking; only the single boundary bucket per class is ranked by a
window partitioned on (class, bucket).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.expressions import md5_rank_key
from tessera.plans.strategy import checkpointed, join_small, null_safe_join

ROWS_PER_HASH_BUCKET = 1_000_000


def class_quotas(class_counts: dict, test_size: float) -> dict:
    """The quota rule on a plain dict (``_quotas`` is the same on a table).

    Test rows per class: ``n_test = ceil(test_size * n)``; each class gets
    the integer part of ``n_c * n_test / n`` and the leftovers go to the
    largest remainders ``(n_c * n_test) mod n``, ties by class."""
    n = sum(class_counts.values())
    if n == 0:
        return {c: 0 for c in class_counts}
    n_test = math.ceil(test_size * n)
    base = {c: (nc * n_test) // n for c, nc in class_counts.items()}
    rem = {c: (nc * n_test) % n for c, nc in class_counts.items()}
    left = n_test - sum(base.values())
    # ties by class; a NULL class sorts last
    order = sorted(class_counts, key=lambda c: (-rem[c], c is None, c if c is not None else 0))
    for c in order[:left]:
        base[c] += 1
    return base


def _quotas(sizes: DataFrame, n: int, label: str, test_size: float) -> DataFrame:
    """``(label, _q)``: :func:`class_quotas` as a table, for any number of
    classes; ``n`` is their total."""
    n_test = math.ceil(test_size * n)
    whole = F.col("_n").cast("decimal(38,0)") * F.lit(n_test).cast("decimal(20,0)")
    parts = (sizes.withColumn("_q", F.floor(whole / max(n, 1)).cast("long"))
             .withColumn("_rem", (whole % F.lit(max(n, 1))).cast("long")))
    left = n_test - (parts.agg(F.sum("_q")).first()[0] or 0)
    more = (parts.orderBy(F.col("_rem").desc(), F.col(label).asc_nulls_last()).limit(left)
            .select(label, F.lit(1).alias("_more")))
    return null_safe_join(parts, more, label, "left").select(
        label, (F.col("_q") + F.coalesce("_more", F.lit(0))).alias("_q"))


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """Add ``out`` = 'test' / 'train' to every row of ``df``."""
    hashed = df.withColumn("_h", md5_rank_key(key, seed))
    digits = 2
    while True:
        # one pass: rows per (class, hash bucket); class sizes are its sums
        per_bucket = checkpointed(hashed.groupBy(label, F.substring("_h", 1, digits).alias("_b"))
                                  .agg(F.count(F.lit(1)).alias("_c")))
        sizes = per_bucket.groupBy(label).agg(F.sum("_c").alias("_n"))
        biggest, n = (v or 0 for v in sizes.agg(F.max("_n"), F.sum("_n")).first())
        need = digits
        while need < 6 and biggest / (16 ** need) > ROWS_PER_HASH_BUCKET:
            need += 1
        if need == digits:
            break
        digits = need        # a class too large for these buckets: split finer
    quotas = _quotas(sizes, n, label, test_size)

    w = (Window.partitionBy(label).orderBy("_b")
         .rowsBetween(Window.unboundedPreceding, -1))
    with_before = per_bucket.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    # one row per class: the bucket that holds the quota's end (none: all rows are test rows)
    edge = (null_safe_join(with_before, quotas, label)
            .where((F.col("_before") <= F.col("_q")) & (F.col("_q") < F.col("_before") + F.col("_c")))
            .select(label, F.col("_b").alias("_edge"), "_before"))
    decided = null_safe_join(quotas, edge, label, "left")

    # null-safe: rows whose class is NULL form their own class, none are dropped
    tagged = join_small(hashed.withColumn("_b", F.substring("_h", 1, digits)), decided,
                        on=label, how="inner", null_safe=True)
    tagged = tagged.withColumn("_state", F.when(F.col("_edge").isNull() | (F.col("_b") < F.col("_edge")), "test")
                               .when(F.col("_b") > F.col("_edge"), "train").otherwise("edge"))
    settled = (tagged.where(F.col("_state") != "edge")
               .withColumn(out, F.col("_state")))
    rank_w = Window.partitionBy(label, "_b").orderBy("_h", key)
    edge = (tagged.where(F.col("_state") == "edge")
            .withColumn("_rn", F.row_number().over(rank_w))
            .withColumn(out, F.when(F.col("_before") + F.col("_rn") <= F.col("_q"), F.lit("test"))
                        .otherwise(F.lit("train")))
            .drop("_rn"))
    cols = df.columns + [out]
    return settled.select(*cols).unionByName(edge.select(*cols))
