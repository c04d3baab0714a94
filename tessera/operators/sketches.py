"""Column statistics from mergeable sketches.

Heavy hitters: one pass keeps a frequent-items sketch of each column (bounded
by ``items``, merged between tasks), a second pass counts only the values the
sketch proposes. A near-unique column so shuffles candidates, not values. The
sketch's error is known, so the winner is either proven, ties included, or the
column falls back to counting every value.

Quantiles: a sketch per load and column is stored beside the load; the median of
all loads so far merges stored sketches and reads no old rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import nan_to_null

ITEMS, TOP = 10_000, 1_000
#: Size of a quantile sketch.
SKETCH_K = 800


def _value(df: DataFrame, c: str) -> Column:
    floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
    return nan_to_null(c) if floating else F.col(c)


def heavy_hitters(df: DataFrame, cols: Sequence[str], items: int = ITEMS, top: int = TOP) -> DataFrame:
    """(column, value as text, n, proven_above) for the values of each column
    that the sketches propose, with exact counts. No value counted more than
    ``proven_above`` times is missing."""
    held = df.select(*[_value(df, c).alias(f"_v{i}") for i, c in enumerate(cols)])
    found = held.agg(*[x for i in range(len(cols)) for x in (
        F.expr(f"approx_top_k(_v{i}, {min(top, items)}, {items})").alias(f"t{i}"), F.count(F.lit(1)).alias(f"n{i}"))]).first()
    pairs, limits = [], {}
    for i, c in enumerate(cols):
        got = [(r["item"], r["count"]) for r in found[f"t{i}"] or [] if r["item"] is not None]
        full = len(found[f"t{i}"] or []) >= min(top, items)
        # the sketch misses no value of more than twice its error; a full list none above its last estimate
        limits[c] = max(7 * found[f"n{i}"] // items, min((n for _, n in got), default=0) if full else 0)
        here = F.col(f"_v{i}").isin([v for v, _ in got]) if got else F.lit(False)
        pairs.append(F.struct(F.lit(c).alias("column"), F.when(here, F.col(f"_v{i}").cast("string")).alias("value")))
    counts = held.select(F.inline(F.array(*pairs))).where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    limit = F.create_map(*[F.lit(x) for c, n in limits.items() for x in (c, int(n))])
    return counts.select("column", "value", "n", limit[F.col("column")].cast("bigint").alias("proven_above"))


def modes(df: DataFrame, cols: Sequence[str], items: int = ITEMS, top: int = TOP) -> dict:
    """The most frequent value of each column, ties to the smallest, as
    :func:`features.most_frequent`; columns that no sketch can prove are counted."""
    from tessera.operators.features import most_frequent
    cols = list(dict.fromkeys(cols))
    out, kinds = {}, {c: df.schema[c].dataType for c in cols}
    rows = heavy_hitters(df, cols, items, top).collect()      # at most `top` rows a column
    for c in cols:
        mine = [(r["value"], r["n"]) for r in rows if r["column"] == c]
        best = max((n for _, n in mine), default=0)
        limit = next((r["proven_above"] for r in rows if r["column"] == c), 0)
        if not mine or best <= limit:
            out[c] = most_frequent(df, c)
            continue
        tied = df.sparkSession.createDataFrame([(v,) for v, n in mine if n == best], "v string")
        out[c] = tied.select(F.col("v").cast(kinds[c]).alias("v")).agg(F.min("v")).first()[0]
    return out


def quantile_sketches(df: DataFrame, load: str | Column, cols: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """(load, column, n, sketch): one mergeable sketch per load and column, one pass."""
    load = F.col(load) if isinstance(load, str) else load
    held = df.select(load.alias("load"), *[_value(df, c).cast("double").alias(f"_v{i}") for i, c in enumerate(cols)])
    per = held.groupBy("load").agg(*[x for i in range(len(cols)) for x in (
        F.kll_sketch_agg_double(f"_v{i}", F.lit(k)).alias(f"s{i}"), F.count(f"_v{i}").alias(f"n{i}"))])
    return per.select("load", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)])))


def rank_error(k: int = SKETCH_K) -> float:
    """Share of the rows by which a quantile's rank may be off: twice the
    sketch's own bound (99 % of the time), which is far beyond what occurs."""
    return 2 * 2.296 / k ** 0.9021


def merged_quantiles(sketches: DataFrame, q: float = 0.5, k: int = SKETCH_K) -> DataFrame:
    """(column, n, value, rank_error) over all stored sketches; NULL for a column without values."""
    merged = sketches.where("n > 0").groupBy("column").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    return merged.select("column", "n", F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("value"),
                         F.lit(rank_error(k)).alias("rank_error"))
