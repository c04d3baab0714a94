"""Distribution tables: the numbers every chart is drawn from.

Only bins, cells and aggregates leave the cluster. NULL and NaN values are
missing and fall in no bin. Equal-width binning uses
``lo + (hi - lo) * k / n`` edges; every bin is half-open except the last,
which is closed; a constant column (``lo == hi``) widens to ``lo - 0.5 ..
hi + 0.5``. ``width_bucket`` is not used: it returns ``n + 1`` at the maximum
and NULL when ``lo == hi``.
"""

from __future__ import annotations

import math
from itertools import combinations
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import md5_rank_key
from tessera.plans.strategy import BROADCAST_MAX_ROWS, join_small, materialize, read_once


def present(df: DataFrame, col: str) -> Column:
    """The value exists: not NULL and, for floating columns, not NaN (Spark
    sorts NaN above every number, so one NaN would become the maximum)."""
    c = F.col(col)
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def _edges(lo, hi):
    if lo is None or hi is None:
        return None, None
    lo, hi = float(lo), float(hi)
    if lo == hi:
        return lo - 0.5, hi + 0.5
    return lo, hi


def bin_index(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """The bin whose edges ``lo + k * ((hi - lo) / bins)`` hold the value: the
    quotient's floor, moved by one where rounding put it beyond an edge."""
    k = F.least(F.lit(bins - 1), F.floor((x - lo) * F.lit(bins) / (hi - lo)).cast("int"))
    step = (hi - lo) / F.lit(bins)
    below = (x < lo + k * step).cast("int")
    above = ((k < bins - 1) & (x >= lo + (k + 1) * step)).cast("int")
    return k - below + above


def _edge(lo: Column, hi: Column, k: Column, bins: int, digits: int) -> Column:
    return F.round(lo + (hi - lo) * k / F.lit(bins), digits) + F.lit(0.0)


def value_range(df: DataFrame, col: str):
    row = df.where(present(df, col)).agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return _edges(row["lo"], row["hi"])


def histogram(df: DataFrame, col: str, bins: int = 30, digits: int = 6) -> DataFrame:
    """Dense equal-width histogram ``(bin, lo_edge, hi_edge, n)`` of the
    non-NULL values; empty bins are rows with 0. Pass 1 finds the range,
    pass 2 counts per bin (partial + final aggregate of at most ``bins`` keys)."""
    lo, hi = value_range(df, col)
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, lo_edge double, hi_edge double, n long")
    L, H = F.lit(lo), F.lit(hi)
    counts = (df.where(present(df, col))
              .select(bin_index(F.col(col).cast("double"), L, H, bins).alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (frame.join(counts, "bin", "left")
            .select("bin", _edge(L, H, F.col("bin"), bins, digits).alias("lo_edge"),
                    _edge(L, H, F.col("bin") + 1, bins, digits).alias("hi_edge"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def _group_ranges(df: DataFrame, group: str, col: str) -> DataFrame:
    r = df.where(present(df, col)).groupBy(group).agg(
        F.min(col).cast("double").alias("_lo"), F.max(col).cast("double").alias("_hi"))
    same = F.col("_lo") == F.col("_hi")
    return r.select(group, F.when(same, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                    F.when(same, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))


def histogram_by_group(df: DataFrame, group: str, col: str, bins: int = 30,
                       digits: int = 6) -> DataFrame:
    """One dense histogram per group, each with its **own** edges:
    ``(group, bin, lo_edge, hi_edge, n)``. Group ranges are a small table
    joined back (size-checked broadcast); the dense frame is generated from
    it with ``sequence``, not by a cross join. Rows with a NULL group belong
    to no panel and are left out, as a per-group chart leaves them out."""
    df = df.where(F.col(group).isNotNull())
    small, ranges = read_once(_group_ranges(df, group, col), BROADCAST_MAX_ROWS)    # used twice below
    rows = df.where(present(df, col)).select(group, F.col(col).cast("double").alias("_x"))
    joined = rows.join(F.broadcast(ranges) if small else ranges, group)
    counts = (joined
              .select(group, bin_index(F.col("_x"), F.col("_lo"), F.col("_hi"), bins).alias("bin"))
              .groupBy(group, "bin").agg(F.count(F.lit(1)).alias("n")))
    frame = ranges.select(group, "_lo", "_hi",
                          F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (frame.join(counts, [group, "bin"], "left")
            .select(group, "bin", _edge(F.col("_lo"), F.col("_hi"), F.col("bin"), bins, digits).alias("lo_edge"),
                    _edge(F.col("_lo"), F.col("_hi"), F.col("bin") + 1, bins, digits).alias("hi_edge"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def histogram_stacked(df: DataFrame, category: str, col: str, bins: int = 30,
                      digits: int = 6) -> DataFrame:
    """Stacked histogram: **common** edges for all categories, dense per
    category present: ``(category, bin, lo_edge, hi_edge, n)``. Rows with a
    NULL category have no layer and are left out, as the chart leaves them out."""
    df = df.where(F.col(category).isNotNull())
    lo, hi = value_range(df, col)
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], f"{category} string, bin int, lo_edge double, hi_edge double, n long")
    L, H = F.lit(lo), F.lit(hi)
    rows = df.where(present(df, col))
    counts = (rows.select(category, bin_index(F.col(col).cast("double"), L, H, bins).alias("bin"))
              .groupBy(category, "bin").agg(F.count(F.lit(1)).alias("n")))
    cats = counts.select(category).distinct()      # from the (small) aggregate, not the rows
    frame = cats.select(category, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (frame.join(counts, [category, "bin"], "left")
            .select(category, "bin", _edge(L, H, F.col("bin"), bins, digits).alias("lo_edge"),
                    _edge(L, H, F.col("bin") + 1, bins, digits).alias("hi_edge"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def histogram_facets(df: DataFrame, category: str, col: str, order: Sequence[str],
                     bins: int = 15, digits: int = 6) -> DataFrame:
    """Faceted histogram: one panel per category present, in the declared
    ``order``, own edges per panel, with the panel size ``facet_n`` (its rows,
    those without a value included)."""
    spark = df.sparkSession
    pos = spark.createDataFrame([(v, i) for i, v in enumerate(order, start=1)],
                                f"{category} string, position int")
    present = df.join(F.broadcast(pos), category, "left_semi")
    hist = materialize(histogram_by_group(present, category, col, bins, digits))
    sizes = present.groupBy(category).agg(F.count(F.lit(1)).alias("facet_n"))
    return (hist.join(sizes, category).join(F.broadcast(pos), category)
            .select("position", category, "facet_n", "bin", "lo_edge", "hi_edge", "n"))


def density_2d(df: DataFrame, x: str, y: str, hue: str, nx: int = 20, ny: int = 20,
               digits: int = 6) -> DataFrame:
    """Scatter re-aimed for big data: exact counts on an ``nx`` x ``ny`` grid
    per hue (non-empty cells), with common edges. Output size is bounded by
    the grid, not by the rows."""
    rows = df.where(present(df, x) & present(df, y))
    r = rows.agg(F.min(x).alias("xlo"), F.max(x).alias("xhi"),
                 F.min(y).alias("ylo"), F.max(y).alias("yhi")).first()
    xlo, xhi = _edges(r["xlo"], r["xhi"])
    ylo, yhi = _edges(r["ylo"], r["yhi"])
    if xlo is None:
        return df.sparkSession.createDataFrame([], f"{hue} string, bx int, by int, n long")
    return (rows.select(hue, bin_index(F.col(x).cast("double"), F.lit(xlo), F.lit(xhi), nx).alias("bx"),
                        bin_index(F.col(y).cast("double"), F.lit(ylo), F.lit(yhi), ny).alias("by"))
            .groupBy(hue, "bx", "by").agg(F.count(F.lit(1)).alias("n")))


def hash_sample(df: DataFrame, key: str, k: int = 100, seed: int = 42) -> DataFrame:
    """A deterministic sample of ``k`` rows: smallest ``md5('<seed>:' || key)``.
    Planned as a per-task top-k merge (``TakeOrderedAndProject``)."""
    h = md5_rank_key(key, seed)
    return df.withColumn("sample_hash", h).orderBy("sample_hash", key).limit(k)


def hash_sample_by_group(df: DataFrame, group: str, key: str, k: int = 100, seed: int = 42) -> DataFrame:
    """A deterministic sample of ``k`` rows per group (NULL is one): those with
    the smallest ``md5('<seed>:' || key)``, ties by ``key``; a smaller group whole.

    One aggregate counts the rows of each group by the leading zero bits of the
    hash (at most 61 counts a group, combined map-side). The k smallest hashes lie
    among the rows with at least as many zeros as the k-th, about 2k rows whatever
    the group's size; only these are ranked. Keys should be unique."""
    zeros = F.lit(60) - F.length(F.bin(F.conv(F.substring("sample_hash", 1, 15), 16, 10).cast("long")))
    # bin(0) is one digit long, like bin(1): both count as 59
    rows = df.withColumn("sample_hash", md5_rank_key(key, seed)).withColumn("_zeros", zeros)
    counts = rows.groupBy(group, "_zeros").agg(F.count(F.lit(1)).alias("_n"))
    # per group, from its counts: the largest number of zeros that k rows reach
    listed = counts.groupBy(group).agg(F.collect_list(F.struct("_zeros", "_n")).alias("_all"))
    reach = lambda z: F.aggregate("_all", F.lit(0).cast("long"), lambda acc, e: acc + F.when(e["_zeros"] >= z, e["_n"]).otherwise(0))
    least = F.coalesce(F.array_max(F.filter(F.transform("_all", lambda e: e["_zeros"]), lambda z: reach(z) >= k)), F.lit(0))
    cut = listed.select(group, least.alias("_least"))
    near = join_small(rows, cut, group, null_safe=True).where(F.col("_zeros") >= F.col("_least"))
    place = F.row_number().over(Window.partitionBy(group).orderBy("sample_hash", key))
    return near.withColumn("_place", place).where(F.col("_place") <= k).drop("_place", "_zeros", "_least")


def pairwise_corr(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation for every pair of columns, one aggregate:
    ``(x, y, corr)``. NaN counts as missing, as everywhere."""
    value = lambda c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double"))
    rows = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.corr(value(a), value(b)).alias("corr"))
            for a, b in combinations(cols, 2)]
    return (df.agg(F.array(*rows).alias("all")).select(F.explode("all").alias("p"))
            .select("p.x", "p.y", (F.round("p.corr", digits) + F.lit(0.0)).alias("corr")))


def share_by_label(df: DataFrame, label: str, features: Sequence[str], bins: int = 30,
                   digits: int = 6) -> DataFrame:
    """Pair-plot diagonal re-aimed: per feature, a stacked histogram by label
    (common edges per feature). Two scans for any number of features: all
    ranges in one aggregate, all counts per (feature, label, bin) in another."""
    df = df.where(F.col(label).isNotNull())
    value = {f: F.when(present(df, f), F.col(f).cast("double")) for f in features}
    row = df.agg(*[g(value[f]).alias(f"{g.__name__}_{i}") for i, f in enumerate(features) for g in (F.min, F.max)]).first()
    edges = {f: _edges(row[f"min_{i}"], row[f"max_{i}"]) for i, f in enumerate(features)}
    used = [f for f in features if edges[f][0] is not None]
    spark = df.sparkSession
    if not used:
        return spark.createDataFrame([], f"{label} string, bin int, lo_edge double, hi_edge double, n long, feature string")
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), bin_index(value[f], *map(F.lit, edges[f]), bins).alias("bin"))
                      for f in used])
    counts = (df.select(label, F.inline(cells)).where(F.col("bin").isNotNull())
              .groupBy("feature", label, "bin").agg(F.count(F.lit(1)).alias("n")))
    ranges = spark.createDataFrame([(f, *edges[f]) for f in used], "feature string, lo double, hi double")
    frame = (counts.select("feature", label).distinct()
             .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))))
    return (frame.join(counts, ["feature", label, "bin"], "left").join(F.broadcast(ranges), "feature")
            .select(label, "bin", _edge(F.col("lo"), F.col("hi"), F.col("bin"), bins, digits).alias("lo_edge"),
                    _edge(F.col("lo"), F.col("hi"), F.col("bin") + 1, bins, digits).alias("hi_edge"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n"), "feature"))


def pair_density(df: DataFrame, label: str, features: Sequence[str], bins: int = 20) -> DataFrame:
    """The off-diagonal panels of a pair plot: exact counts on a ``bins`` x
    ``bins`` grid for every pair of features by label (non-empty cells):
    ``(x, y, label, bx, by, n)``. Two scans for any number of features: all
    ranges in one aggregate, and one in which each row becomes a cell per pair;
    counts are combined before the shuffle, so at most the grids travel."""
    df = df.where(F.col(label).isNotNull())
    value = {f: F.when(present(df, f), F.col(f).cast("double")) for f in features}
    row = df.agg(*[g(value[f]).alias(f"{g.__name__}_{i}") for i, f in enumerate(features) for g in (F.min, F.max)]).first()
    edges = {f: _edges(row[f"min_{i}"], row[f"max_{i}"]) for i, f in enumerate(features)}
    used = [f for f in features if edges[f][0] is not None]
    kind = df.schema[label].dataType.simpleString()
    if len(used) < 2:
        return df.sparkSession.createDataFrame([], f"x string, y string, label {kind}, bx int, by int, n long")
    at = {f: f"_bin{i}" for i, f in enumerate(used)}
    binned = df.select(F.col(label).alias("label"), *[bin_index(value[f], *map(F.lit, edges[f]), bins).alias(at[f]) for f in used])
    cells = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(at[a]).alias("bx"), F.col(at[b]).alias("by"))
                      for a, b in combinations(used, 2)])
    return (binned.select("label", F.inline(cells)).where("bx IS NOT NULL AND by IS NOT NULL")
            .groupBy("x", "y", "label", "bx", "by").agg(F.count(F.lit(1)).alias("n")))


def kde_by_label(df: DataFrame, label: str, features: Sequence[str], grid: int = 64, digits: int = 6) -> DataFrame:
    """The diagonal of a pair plot: a Gaussian density per feature and label on
    ``grid`` points, ``(feature, label, point, x, density)``.

    Counts on a fine histogram (common edges per feature, points at the bin
    centres) stand for the rows and are convolved with the kernel, whose width
    is Scott's: the label's standard deviation times ``n ** -0.2``. Rows are
    scanned twice, for the ranges, and for the counts, from which the moments
    come too; the rest is ``grid`` numbers per feature and label. A label
    without spread, or with one value, has no density."""
    df = df.where(F.col(label).isNotNull())
    value = {f: F.when(present(df, f), F.col(f).cast("double")) for f in features}
    row = df.agg(*[g(value[f]).alias(f"{g.__name__}_{i}") for i, f in enumerate(features) for g in (F.min, F.max)]).first()
    edges = {f: _edges(row[f"min_{i}"], row[f"max_{i}"]) for i, f in enumerate(features)}
    used = [f for f in features if edges[f][0] is not None]
    spark, kind = df.sparkSession, df.schema[label].dataType.simpleString()
    if not used:
        return spark.createDataFrame([], f"feature string, label {kind}, point int, x double, density double")
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), bin_index(value[f], *map(F.lit, edges[f]), grid).alias("bin")) for f in used])
    counts = (df.select(F.col(label).alias("label"), F.inline(cells)).where("bin IS NOT NULL")
              .groupBy("feature", "label", "bin").agg(F.count(F.lit(1)).alias("n")))
    step = F.create_map(*[F.lit(x) for f in used for x in (f, (edges[f][1] - edges[f][0]) / grid)])
    low = F.create_map(*[F.lit(x) for f in used for x in (f, edges[f][0])])
    centre = low[F.col("feature")] + (F.col("bin") + 0.5) * step[F.col("feature")]
    per = counts.select("feature", "label", "n", centre.alias("c")).groupBy("feature", "label").agg(
        F.collect_list(F.struct("c", "n")).alias("cells"), F.sum("n").alias("total"),
        (F.sum(F.col("n") * F.col("c")) / F.sum("n")).alias("mean"))            # at most `grid` cells each
    spread = F.aggregate("cells", F.lit(0.0), lambda acc, b: acc + b["n"] * (b["c"] - F.col("mean")) * (b["c"] - F.col("mean")))
    per = per.where("total > 1").withColumn("h", F.sqrt(spread / (F.col("total") - 1)) * F.pow(F.col("total"), F.lit(-0.2))).where("h > 0")
    points = per.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    points = points.withColumn("_at", low[F.col("feature")] + (F.col("point") + 0.5) * step[F.col("feature")])
    total = F.aggregate(F.array_sort("cells"), F.lit(0.0), lambda acc, b: acc + b["n"] * F.exp(
        -0.5 * ((F.col("_at") - b["c"]) / F.col("h")) * ((F.col("_at") - b["c"]) / F.col("h"))))
    density = total / (F.col("total") * F.col("h") * F.lit((2 * math.pi) ** 0.5))
    return points.select("feature", "label", "point", (F.round("_at", digits) + F.lit(0.0)).alias("x"),
                         (F.round(density, digits) + F.lit(0.0)).alias("density"))
