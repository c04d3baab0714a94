"""Parameterised reports: filtered and conditional group counts, group means
on every row, ordered columns, top-k, row scores with bands, band counts,
share tables and a generic SQL call.

Each report is a function of DataFrames, column names and parameters, so it
runs unchanged on any table of the right shape.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.expressions import answered_count, band, band_position, percent, row_sum
from tessera.plans.strategy import join_small, materialize


def run_sql(spark: SparkSession, sql: str, params: Sequence = ()) -> DataFrame:
    """Generic SQL call with positional ``?`` parameters bound by Spark.

    Write identifiers with backticks: double-quoted aliases are string
    literals in Spark SQL.
    """
    return spark.sql(sql, args=list(params)) if params else spark.sql(sql)


def squares(df: DataFrame, col: str) -> DataFrame:
    """``(n, square)`` of a column: a per-element expression (64-bit; ANSI
    raises on overflow past about 3.03e9). ``spark.range`` gives 1..n."""
    n = F.col(col).cast("long")
    return df.select(n.alias("n"), (n * n).alias("square"))


def sorted_desc(df: DataFrame, col: str) -> DataFrame:
    """One column ordered from largest to smallest, NULLs last."""
    return df.select(col).orderBy(F.col(col).desc_nulls_last())


def top_k(df: DataFrame, order: Sequence[Column], k: int, cols: Sequence[str] | None = None) -> DataFrame:
    """First ``k`` rows of an ordering (include a unique key for a stable
    tie-break). Planned as ``TakeOrderedAndProject``: each task keeps its own
    top ``k``, no full sort."""
    out = df.select(*cols) if cols else df
    return out.orderBy(*order).limit(k)


def filtered_group_count(df: DataFrame, group: str | Sequence[str], predicate: Column,
                         alias: str = "count") -> DataFrame:
    """``SELECT g, COUNT(*) FROM t WHERE pred GROUP BY g``; the predicate is
    pushed into the scan, the count is a partial + final aggregate."""
    groups = [group] if isinstance(group, str) else list(group)
    return df.where(predicate).groupBy(*groups).agg(F.count(F.lit(1)).alias(alias))


def conditional_counts(df: DataFrame, group: str | Sequence[str],
                       conditions: Mapping[str, Column], total: str = "total") -> DataFrame:
    """Per group: total rows and, for each named condition, how many rows
    satisfy it (``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``), all in one scan.
    A NULL in a condition counts toward ``total`` but not toward the condition."""
    groups = [group] if isinstance(group, str) else list(group)
    aggs = [F.count(F.lit(1)).alias(total)]
    aggs += [F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long").alias(name)
             for name, cond in conditions.items()]
    return df.groupBy(*groups).agg(*aggs)


def group_means(df: DataFrame, group: str, value: str, alias: str = "group_avg") -> DataFrame:
    """Mean of ``value`` per group over its non-NULL rows (partial + final aggregate)."""
    return (df.where(F.col(value).isNotNull()).groupBy(group)
            .agg(F.avg(value).alias(alias)))


def group_mean_rows(df: DataFrame, group: str, value: str, alias: str = "group_avg") -> DataFrame:
    """``SELECT g, x, AVG(x) OVER (PARTITION BY g) FROM t WHERE x IS NOT NULL
    ORDER BY x DESC``.

    Written as aggregate + join instead of a window: a window partitioned by a
    few-valued group puts each group in one task, while the aggregate combines
    map-side and its per-group table (size checked) is broadcast back.
    """
    rows = df.where(F.col(value).isNotNull()).select(group, value)
    means = group_means(df, group, value, alias)
    return (join_small(rows, means, on=group, how="left", null_safe=True)
            .select(group, value, alias)
            .orderBy(F.col(value).desc()))


def group_mean_of(means: DataFrame, group: str, key, alias: str = "group_avg"):
    """The mean of one group, or None when the group is absent."""
    row = means.where(F.col(group) == F.lit(key)).select(alias).first()
    return None if row is None else row[0]


def item_scores(df: DataFrame, key: str, items: Sequence[str], bands: Sequence[tuple],
                default: str, score: str = "total_score", category: str = "category",
                min_answered: int | None = None) -> DataFrame:
    """Row score = sum of the item columns with missing as 0, plus its band;
    ordered by score descending. With ``min_answered`` a row answering fewer
    items gets a NULL score (and the default band) instead of a low score."""
    s = row_sum(items)
    if min_answered is not None:
        s = F.when(answered_count(items) >= F.lit(min_answered), s)
    scored = df.select(F.col(key), s.alias(score))
    return (scored.withColumn(category, band(score, bands, default))
            .orderBy(F.col(score).desc_nulls_last()))


def band_counts(scored: DataFrame, category: str = "category", alias: str = "count") -> DataFrame:
    """Rows per band, largest first."""
    return (scored.groupBy(category).agg(F.count(F.lit(1)).alias(alias))
            .orderBy(F.col(alias).desc()))


def band_order(scored: DataFrame, score: str, bands: Sequence[tuple],
               category: str = "category", alias: str = "count") -> DataFrame:
    """The bands present in the data, in their declared order, with their
    sizes (facet N): the distinct labels intersected with the ordered list."""
    return (scored.where(band_position(score, bands).isNotNull())
            .groupBy(category)
            .agg(F.count(F.lit(1)).alias(alias), F.min(band_position(score, bands)).alias("position"))
            .orderBy("position"))


def share_table(df: DataFrame, group: str, predicate: Column | None = None,
                alias: str = "count") -> DataFrame:
    """Donut data: count per group, its percentage of the total and the total.
    The total is one aggregate over the (small) per-group table, used as a literal."""
    src = df.where(predicate) if predicate is not None else df
    return shares(src.groupBy(group).agg(F.count(F.lit(1)).alias(alias)), alias)


def shares(counts: DataFrame, count_col: str = "count") -> DataFrame:
    """Add ``total`` (sum of ``count_col``) and ``pct`` to a per-group count table.
    The table is computed once (a checkpoint)."""
    counts = materialize(counts)
    total = counts.agg(F.sum(count_col)).first()[0] or 0
    return (counts.withColumn("total", F.lit(int(total)).cast("long"))
            .withColumn("pct", F.round(percent(count_col, "total"), 6)))
