"""Chained imputation: every numeric column with gaps is regressed on all others.

Gaps start at the column's mean. In each round one pass over the rows sums the
products of all pairs of features (an intercept, the numeric columns as filled
so far, and a 0/1 column per category), restricted per target to the rows that
have it. All regressions of the round are solved from these sums, and all gaps
are filled anew from the values of the round before. A row sends only its
non-zero features, one a categorical column, so a pass costs the square of the
number of columns, not of categories, and its result is combined map-side.

Defined results: values that are there never change; NULL and NaN are gaps; a
missing category is a category of its own, the last; collinear features share
their weight (least norm); a column without any value stays empty and predicts
nothing; categories not seen in the fit weigh nothing, like the first one.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.models import _least_norm, balanced_sum
from tessera.plans.strategy import checkpointed

#: Features the solver accepts; the sums that reach the driver are their square.
MAX_FEATURES = 500


def _number(c: str) -> Column:
    value = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(value), value)


@dataclass
class ChainedFit:
    numeric: list                 # columns with at least one value
    means: dict
    levels: dict                  # categorical column -> its categories, the first weighing nothing
    rounds: list = field(default_factory=list)     # per round: target -> (intercept, weights by feature)

    def features(self) -> list[tuple[str, str | None]]:
        """(column, category) by position; position 0 is the intercept."""
        return [(c, None) for c in self.numeric] + [(c, v) for c, vs in self.levels.items() for v in vs[1:]]

    def _filled(self, df: DataFrame, values: dict) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in values], *[v.alias(c) for c, v in values.items()])

    def start(self, df: DataFrame) -> DataFrame:
        """Working columns: ``_have<i>`` what was there, ``_now<i>`` the fill so far,
        ``_cat<i>`` the category (never NULL)."""
        return df.select("*", *[_number(c).alias(f"_have{i}") for i, c in enumerate(self.numeric)],
                         *[F.coalesce(_number(c), F.lit(self.means[c])).alias(f"_now{i}") for i, c in enumerate(self.numeric)],
                         *[_category(c).alias(f"_cat{i}") for i, c in enumerate(self.levels)])

    def step(self, df: DataFrame, solved: dict) -> DataFrame:
        """One round's fills, all from the values before it."""
        values = {}
        names = self.features()
        for i, c in enumerate(self.numeric):
            if c not in solved:
                continue
            intercept, weights = solved[c]
            terms = [F.lit(intercept + self.means[c])]
            for k, other in enumerate(self.numeric):
                if weights[k]:
                    terms.append(F.lit(weights[k]) * (F.col(f"_now{k}") - F.lit(self.means[other])))
            for k, cat in enumerate(self.levels):
                mine = [(v, w) for (col, v), w in zip(names, weights, strict=True) if col == cat and v is not None and w]
                if mine:
                    by = F.map_from_arrays(F.array(*[F.lit(v) for v, _ in mine]), F.array(*[F.lit(w) for _, w in mine]))
                    terms.append(F.coalesce(F.try_element_at(by, F.col(f"_cat{k}")), F.lit(0.0)))
            values[f"_now{i}"] = F.coalesce(F.col(f"_have{i}"), balanced_sum(terms))
        return self._filled(df, values)

    def transform(self, df: DataFrame) -> DataFrame:
        """All columns, gaps of the numeric ones filled (as doubles)."""
        rows = self.start(df)
        for solved in self.rounds:
            rows = self.step(rows, solved)
        now = {c: f"_now{i}" for i, c in enumerate(self.numeric)}
        return rows.select(*[F.col(now[c]).alias(c) if c in now else F.col(f"`{c}`") for c in df.columns])


def _category(c: str) -> Column:
    """Text that tells a missing value from every present one."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit(""))


def _products(rows: DataFrame, fit: ChainedFit, gaps: list[int]) -> DataFrame:
    """(i, j, sum per target) for i <= j, over the rows that have the target."""
    one = lambda i, v: F.struct(F.lit(i).cast("int").alias("i"), v.alias("v"))
    entries = [one(0, F.lit(1.0))]
    entries += [one(k + 1, F.col(f"_now{k}") - F.lit(fit.means[c])) for k, c in enumerate(fit.numeric)]
    at = len(entries)
    cats = []
    for k, (c, levels) in enumerate(fit.levels.items()):
        if len(levels) > 1:
            place = F.map_from_arrays(F.array(*[F.lit(v) for v in levels[1:]]),
                                      F.array(*[F.lit(at + n) for n in range(len(levels) - 1)]))
            cats.append(F.struct(F.try_element_at(place, F.col(f"_cat{k}")).cast("int").alias("i"), F.lit(1.0).alias("v")))
            at += len(levels) - 1
    there = [F.col(f"_have{t}").isNotNull().alias(f"_is{t}") for t in gaps]
    # a column of its own, as the functions below read it once per entry
    rows = rows.select(*there, F.filter(F.array(*entries, *cats), lambda e: e["i"].isNotNull()).alias("_held"))
    held = F.col("_held")
    # positions ascend, so a later entry has the larger number
    pairs = F.flatten(F.transform(held, lambda x, n: F.transform(
        F.slice(held, n + 1, F.size(held)), lambda y: F.struct(
            x["i"].alias("i"), y["i"].alias("j"), (x["v"] * y["v"]).alias("v")))))
    flags = [f"_is{t}" for t in gaps]
    long = rows.select(*flags, F.explode(pairs).alias("p")).select(*flags, "p.*")
    return long.groupBy("i", "j").agg(*[F.sum(F.when(F.col(f"_is{t}"), F.col("v"))).alias(f"s{t}") for t in gaps])


def fit_chained(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), rounds: int = 5,
                max_features: int = MAX_FEATURES) -> ChainedFit:
    """Regressions of ``rounds`` rounds for every column of ``numeric`` that has
    gaps, on all other columns of ``numeric`` and ``categorical``."""
    numeric, categorical = list(numeric), list(categorical)
    rows = checkpointed(df.select(*[_number(c).alias(c) for c in numeric], *[F.col(f"`{c}`") for c in categorical]))
    stats = rows.agg(F.count(F.lit(1)).alias("n"), *[f(F.col(f"`{c}`")).alias(f"{f.__name__}_{i}")
                                                    for i, c in enumerate(numeric) for f in (F.avg, F.count)]).first()
    means = {c: stats[f"avg_{i}"] for i, c in enumerate(numeric) if stats[f"count_{i}"]}
    levels: dict = {c: [] for c in categorical}
    if categorical:
        found = rows.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), _category(c).alias("value"))
                                               for c in categorical]))).distinct().limit(max_features + 1).collect()
        if len(found) > max_features:
            raise ValueError(f"more than {max_features} categories")
        # byte order, the missing category last
        for r in sorted(found, key=lambda r: (r["value"] == "", r["value"].encode())):
            levels[r["column"]].append(r["value"])
    fit = ChainedFit([c for c in numeric if c in means], means, levels)
    size = len(fit.features()) + 1
    if size > max_features:
        raise ValueError(f"{size} features, at most {max_features}")
    gaps = [i for i, c in enumerate(fit.numeric) if stats[f"count_{numeric.index(c)}"] < stats["n"]]
    now = fit.start(rows)
    for _ in range(rounds if gaps else 0):
        sums = {t: np.zeros((size, size)) for t in gaps}
        for r in _products(now, fit, gaps).collect():
            for t in gaps:
                sums[t][r["i"], r["j"]] = sums[t][r["j"], r["i"]] = r[f"s{t}"] or 0.0
        solved = {}
        for t, G in sums.items():
            use = [k for k in range(1, size) if k != t + 1]
            m, my = G[0, use] / G[0, 0], G[0, t + 1] / G[0, 0]
            w = np.zeros(size)
            w[use] = _least_norm(G[np.ix_(use, use)] / G[0, 0] - np.outer(m, m), G[use, t + 1] / G[0, 0] - m * my)
            solved[fit.numeric[t]] = (float(my - w[use] @ m), [float(x) for x in w[1:]])
        fit.rounds.append(solved)
        now = fit.step(now, solved)
    return fit


def chained_impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), rounds: int = 5) -> DataFrame:
    """``df`` with the gaps of ``numeric`` filled; other columns as they are."""
    return fit_chained(df, numeric, categorical, rounds).transform(df)
