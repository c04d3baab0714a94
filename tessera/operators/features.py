"""Feature preparation with a fit/transform split.

``fit_*`` runs aggregates and returns a small state object (medians, means,
modes, standard deviations, category lists); ``transform`` is a lazy
projection with that state as literals, so it stays inside whole-stage
codegen and needs no join. State size depends on columns and categories,
never on rows.

Semantics follow the column-transformer the reference uses: exact median
(interpolated), most frequent value with ties to the smallest, population
standard deviation with divisor 1 for a constant column, one-hot with the
first category (byte order) dropped.
"""

from __future__ import annotations

import math

from dataclasses import dataclass, field
from typing import Mapping, Sequence


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import nan_to_null
from tessera.plans import strategy
from tessera.plans.strategy import checkpointed, is_small, quantiles_from_counts

ROWS_ENTRY = "\u0000rows"


def _floating(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def _clean(df: DataFrame, c: str) -> Column:
    return nan_to_null(c) if _floating(df, c) else F.col(c)


# ------------------------------------------------------------ column profile

def _numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


def _integral(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.IntegralType)


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, int, num, str, n)``: rows per distinct non-missing value of
    every listed column, in **one pass** for all of them. Each row becomes one
    (column, value) pair per column (integers in ``int``, other numbers in
    ``num``, the rest as text in ``str``), then a partial + final aggregate counts them, so the shuffle
    carries distinct values per task, not rows."""
    pairs = F.array(*([
        F.struct(F.lit(c).alias("column"),
                 (F.col(c) if _integral(df, c) else F.lit(None)).cast("long").alias("int"),
                 (_clean(df, c) if _numeric(df, c) and not _integral(df, c) else F.lit(None)).cast("double").alias("num"),
                 (F.lit(None).cast("string") if _numeric(df, c) else F.col(c).cast("string")).alias("str"))
        for c in cols] + [
        # one entry per row: its count is the row count
        F.struct(F.lit(ROWS_ENTRY).alias("column"), F.lit(0).cast("long").alias("int"), F.lit(None).cast("double").alias("num"),
                 F.lit(None).cast("string").alias("str"))]))
    long = df.select(F.inline(pairs)).where(
        F.col("int").isNotNull() | F.col("num").isNotNull() | F.col("str").isNotNull())
    return long.groupBy("column", "int", "num", "str").agg(F.count(F.lit(1)).alias("n"))


def _value_field(schema: T.StructType, c: str) -> str:
    kind = schema[c].dataType
    return "int" if isinstance(kind, T.IntegralType) else "num" if isinstance(kind, T.NumericType) else "str"


def _sort_key(v):
    return v.encode("utf-8") if isinstance(v, str) else v


@dataclass
class ColumnProfile:
    """What the fits need: per-value counts of the counted columns, the row
    count, and count, mean and population variance of the present values of
    the measured columns. The per-value table is checkpointed; with at most
    ``SMALL_DISTINCT`` rows its rows are also held here, sorted by value for
    each column, and the lookups need no further job."""
    df_schema: T.StructType
    local: dict | None            # column -> sorted [(value, n)] when small
    counts: DataFrame | None      # checkpointed table
    rows: int
    present: dict
    mean: dict
    var: dict
    medians: dict

    def _val(self, c: str) -> str:
        return _value_field(self.df_schema, c)

    def median(self, c: str):
        """Exact median (mean of the middle pair) of the present values."""
        return self.medians[c]

    def mode(self, c: str):
        """Most frequent present value, ties to the smallest."""
        if self.local is not None:
            best = max((n for _, n in self.local.get(c, [])), default=None)
            return next((v for v, n in self.local.get(c, []) if n == best), None)
        v = self._val(c)
        row = (self.counts.where(F.col("column") == F.lit(c))
               .orderBy(F.col("n").desc(), F.col(v).asc()).select(v).limit(1).first())
        return None if row is None else row[0]

    def categories(self, c: str, max_categories: int = 0) -> list:
        """Distinct present values, sorted (numbers numerically, text by code
        point). A category is a column of the result, so more than
        ``max_categories`` (0: no limit) raise."""
        if self.local is not None:
            vals = [v for v, _ in self.local.get(c, [])]
        else:
            vals = [r[0] for r in self.counts.where(F.col("column") == F.lit(c)).select(self._val(c)).collect()]
        if max_categories and len(vals) > max_categories:
            raise ValueError(f"{c}: more than {max_categories} categories")
        return sorted(vals, key=_sort_key)

    def missing(self, c: str) -> int:
        return self.rows - self.present[c]

    def filled_moments(self, c: str, fill) -> tuple:
        """Mean and population std after ``missing(c)`` copies of ``fill`` join
        the present values (exact merge of moments, no pass over the data)."""
        n_a, mean_a, var_a = self.present[c], self.mean[c], self.var[c]
        m = self.missing(c) if fill is not None else 0
        if n_a == 0:
            return (float(fill), 0.0) if m else (None, None)
        if m == 0:
            return mean_a, math.sqrt(var_a)
        n = n_a + m
        delta = float(fill) - mean_a
        mean = mean_a + delta * m / n
        m2 = var_a * n_a + delta * delta * n_a * m / n
        return mean, math.sqrt(max(m2 / n, 0.0))


# Brackets around a median, tried one after the other: shares of the values
# (their approximate quantiles come with the moments), at last everything.
MEDIAN_BRACKETS = ((0.4995, 0.5005), (0.25, 0.75))


def _at_ranks(pairs: list, ranks: list) -> dict:
    """The value at each rank of sorted (value, count) pairs."""
    at, before = {}, 0
    for v, n in pairs:
        at.update({r: v for r in ranks if before <= r < before + n})
        before += n
    return at


def _medians(df: DataFrame, found: dict) -> dict:
    """Exact medians of several columns from ``found``: column -> (present
    values, approximate quantiles at ``MEDIAN_BRACKETS``).

    One pass for all columns counts the values below each bracket and, per
    distinct value, those inside it: a small share of the rows, however many
    distinct values a column has. The middle ranks are located among them. A
    column whose middle lies outside its bracket takes part in another pass
    with the next one."""
    out = {c: None for c, (n, _) in found.items() if not n}
    todo, k = [c for c in found if c not in out], 0
    while todo:
        last = k >= len(MEDIAN_BRACKETS)
        parts = []
        for i, c in enumerate(todo):
            x = _clean(df, c).cast("double")
            lo, hi = (-math.inf, math.inf) if last else found[c][1][2 * k:2 * k + 2]
            parts.append(F.struct(F.lit(i).alias("i"), F.when(x <= hi, F.coalesce(x < lo, F.lit(False))).alias("below"),
                                  F.when(x >= lo, x).alias("v")))
        counts = checkpointed(df.select(F.inline(F.array(*parts))).where(F.col("below").isNotNull())
                              .groupBy("i", "below", "v").agg(F.count(F.lit(1)).alias("n")))
        size = {(r["i"], r["below"]): r["n"] for r in
                counts.groupBy("i", "below").agg(F.sum("n").alias("n")).collect()}      # two rows a column
        # few values near the middles: read once; many: located by running counts
        local = None
        if is_small(counts, strategy.SMALL_DISTINCT):
            local = sorted((r["i"], r["v"], r["n"]) for r in counts.where(~F.col("below")).collect())
        again = []
        for i, c in enumerate(todo):
            n, before, inside = found[c][0], size.get((i, True), 0), size.get((i, False), 0)
            ranks = [(n - 1) // 2 - before, n // 2 - before]
            if ranks[0] < 0 or ranks[1] >= inside:
                again.append(c)
                continue
            if local is not None:
                at = _at_ranks([(v, k) for j, v, k in local if j == i], ranks)
            else:
                at = quantiles_from_counts(counts.where((F.col("i") == i) & ~F.col("below")), "v", "n", ranks)
            out[c] = (at[ranks[0]] + at[ranks[1]]) / 2.0
        todo, k = again, k + 1
    return out


def profile_columns(df: DataFrame, counted: Sequence[str] = (), measured: Sequence[str] = (),
                    medians: Sequence[str] = ()) -> ColumnProfile:
    """Pass 1 (when anything is counted): :func:`value_counts` of ``counted``
    plus the row count, checkpointed. The present count, mean and population variance of a
    counted column come from that per-value table (centred, so stable), not
    from the rows. Pass 2 runs only for ``measured`` columns that are not
    counted: one aggregate."""
    counted, measured = list(dict.fromkeys(counted)), list(dict.fromkeys(measured))
    present, mean, var, rows = {}, {}, {}, None
    local = counts = None
    if counted:
        raw = value_counts(df, counted)
        counts = checkpointed(raw)
        if strategy.SMALL_DISTINCT > 0 and is_small(counts, strategy.SMALL_DISTINCT):
            local = {}
            for r in counts.collect():
                if r["column"] != ROWS_ENTRY:
                    local.setdefault(r["column"], []).append((r[_value_field(df.schema, r["column"])], r["n"]))
                else:
                    rows = r["n"]
            for pairs in local.values():
                pairs.sort(key=lambda p: _sort_key(p[0]))
            rows = rows or 0
            for c in counted:
                n = present[c] = sum(k for _, k in local.get(c, []))
                if c in measured:
                    mean[c] = math.fsum(float(v) * k for v, k in local.get(c, [])) / n if n else None
                    var[c] = math.fsum(k * (float(v) - mean[c]) ** 2 for v, k in local[c]) / n if n else None
        else:
            value = F.coalesce(F.col("num"), F.col("int").cast("double"))
            per = {r["column"]: r for r in counts.groupBy("column").agg(
                F.sum("n").alias("n"), (F.sum(F.col("n") * value) / F.sum("n")).alias("mean")).collect()}
            rows = per[ROWS_ENTRY]["n"] if ROWS_ENTRY in per else 0
            for c in counted:
                present[c] = per[c]["n"] if c in per else 0
            num_counted = [c for c in counted if c in measured and c in per]
            if num_counted:
                centre = F.lit(None).cast("double")
                for c in num_counted:
                    centre = F.when(F.col("column") == F.lit(c), F.lit(per[c]["mean"])).otherwise(centre)
                dev = value - centre
                m2 = {r["column"]: r["m2"] for r in counts.where(F.col("column").isin(num_counted))
                      .groupBy("column").agg(F.sum(F.col("n") * dev * dev).alias("m2")).collect()}
                for c in num_counted:
                    mean[c] = per[c]["mean"]
                    var[c] = m2[c] / per[c]["n"]
            for c in measured:
                if c in counted and c not in per:
                    mean[c], var[c] = None, None
    rest = [c for c in dict.fromkeys([*measured, *medians]) if c not in counted or c in medians]
    if rest or rows is None:
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for i, c in enumerate(rest):
            x = _clean(df, c).cast("double")
            aggs += [F.count(x).alias(f"p{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
            if c in medians:
                ends = [p for pair in MEDIAN_BRACKETS for p in pair]
                aggs.append(F.percentile_approx(x, ends, 10_000).alias(f"q{i}"))
        row = df.agg(*aggs).first()
        rows = row["_rows"]
        for i, c in enumerate(rest):
            present[c], mean[c], var[c] = row[f"p{i}"], row[f"m{i}"], row[f"v{i}"]
    middle = _medians(df, {c: (row[f"p{i}"], row[f"q{i}"]) for i, c in enumerate(rest) if c in medians})
    return ColumnProfile(df.schema, local, counts, rows, present, mean, var, middle)


# ---------------------------------------------------------------- statistics

def exact_median(df: DataFrame, c: str):
    """Exact median of the non-missing values (mean of the middle pair).

    A global ``median`` aggregate merges every distinct value in one task;
    here only values near the middle are counted (see :func:`_medians`)."""
    return profile_columns(df, medians=[c]).median(c)


def most_frequent(df: DataFrame, c: str):
    """Most frequent non-missing value, ties to the smallest. Counted per
    value with map-side combine; only the winner reaches the driver."""
    return profile_columns(df, counted=[c]).mode(c)


# ---------------------------------------------------------------- imputation

@dataclass
class FittedImputer:
    fills: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        todo = {}
        for c, v in self.fills.items():
            if v is None:
                todo[c] = _clean(df, c)
            elif isinstance(v, float) and _integral(df, c) and not v.is_integer():
                # a fractional fill (median 2.5) widens an integer column instead of truncating
                todo[c] = F.coalesce(F.col(c).cast("double"), F.lit(v))
            else:
                todo[c] = F.coalesce(_clean(df, c), F.lit(v).cast(df.schema[c].dataType))
        return df.withColumns(todo) if todo else df


def _fills(profile: ColumnProfile, median, mean, most_frequent_cols, constant) -> dict:
    fills: dict = {}
    for c in median:
        fills[c] = profile.median(c)
    for c in mean:
        fills[c] = profile.mean.get(c)
    for c in most_frequent_cols:
        fills[c] = profile.mode(c)
    for c, v in (constant or {}).items():
        fills[c] = v
    return fills


def fit_imputer(df: DataFrame, median: Sequence[str] = (), mean: Sequence[str] = (),
                most_frequent_cols: Sequence[str] = (),
                constant: Mapping[str, object] | None = None) -> FittedImputer:
    """Learn fill values: median / mean / most frequent / constant per column,
    from one value-count pass (modes), one moments pass (means, median
    brackets) and one pass around the medians, whatever the number of columns."""
    profile = profile_columns(df, counted=list(most_frequent_cols), measured=list(mean), medians=list(median))
    return FittedImputer(_fills(profile, median, mean, most_frequent_cols, constant))


# ------------------------------------------------------------------- scaling

@dataclass
class FittedScaler:
    stats: dict = field(default_factory=dict)   # col -> (mean, population std)

    def column(self, c: str) -> Column:
        mean, std = self.stats[c]
        scale = std if std not in (None, 0.0) else 1.0
        return (F.col(c) - F.lit(mean)) / F.lit(scale)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.column(c) for c in self.stats})


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> FittedScaler:
    """Mean and population standard deviation of every column, one aggregate."""
    if not cols:
        return FittedScaler({})
    aggs = []
    for c in cols:
        x = _clean(df, c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return FittedScaler({c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols})


# ------------------------------------------------------------------- one-hot

@dataclass
class FittedOneHot:
    categories: dict = field(default_factory=dict)   # col -> sorted category list
    prefix: str = ""
    drop_first: bool = True
    strict: bool = False

    def output_names(self) -> list[str]:
        names = []
        for c, cats in self.categories.items():
            kept = cats[1:] if self.drop_first else cats
            names += [f"{self.prefix}{c}_{v}" for v in kept]
        return names

    def columns(self) -> list[Column]:
        cols = []
        for c, cats in self.categories.items():
            kept = cats[1:] if self.drop_first else cats
            for v in kept:
                same = F.col(c).isNull() if v is None else F.coalesce(F.col(c) == F.lit(v), F.lit(False))
                cols.append(same.cast("double").alias(f"{self.prefix}{c}_{v}"))
        return cols

    def unseen(self, df: DataFrame) -> DataFrame:
        """Values present in ``df`` but not learned in fit: ``(column, value)``."""
        spark = df.sparkSession
        out = spark.createDataFrame([], "column string, value string")
        for c, cats in self.categories.items():
            known = spark.createDataFrame([(None if v is None else str(v),) for v in cats], "known string")
            vals = (df.select(F.col(c).cast("string").alias("value")).distinct()
                    .join(F.broadcast(known), F.col("value").eqNullSafe(F.col("known")), "left_anti")
                    .select(F.lit(c).alias("column"), "value"))
            if not self.strict:
                vals = vals.where("value IS NOT NULL")
            out = out.unionByName(vals)
        return out

    def check(self, df: DataFrame) -> None:
        if not self.strict or not self.categories:
            return
        bad = self.unseen(df).limit(20).collect()
        if bad:
            raise ValueError(f"unknown categories: {[tuple(r) for r in bad]}")

    def transform(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        self.check(df)
        keep = [c for c in (keep if keep is not None else df.columns) if c not in self.categories]
        return df.select(*keep, *self.columns())


def fit_one_hot(df: DataFrame, cols: Sequence[str], prefix: str = "", drop_first: bool = True,
                strict: bool = False, max_categories: int = 0) -> FittedOneHot:
    """Sorted distinct values per column (byte order for text, numeric order
    for numbers, as the reference's encoder sorts them), all columns from one
    value-count pass. ``max_categories`` (0: none) is a guard on the width of the result."""
    if not cols:
        return FittedOneHot({}, prefix, drop_first, strict)
    profile = profile_columns(df, counted=list(cols))
    cats = {c: profile.categories(c, max_categories) + _missing_category(profile, c, strict) for c in cols}
    return FittedOneHot(cats, prefix, drop_first, strict)


def _missing_category(profile: ColumnProfile, c: str, strict: bool) -> list:
    """The strict encoder takes a missing value as a category of its own, the last."""
    return [None] if strict and profile.missing(c) else []


# -------------------------------------------------------- combined preprocess

@dataclass
class Preprocessor:
    """Per-column-group preparation with named outputs, in this order:
    ``num__<col>`` (imputed, scaled), ``cat_f__<col>_<cat>`` (most frequent
    fill, one-hot), ``cat_c__<col>_<cat>`` (constant fill, one-hot). Other
    columns are dropped except ``keep``."""
    imputer: FittedImputer
    scaler: FittedScaler
    onehot_f: FittedOneHot
    onehot_c: FittedOneHot
    numeric: list
    keep: list
    reg_target: str | None = None
    reg_fit: object | None = None          # models.LinearFit for the regression fill

    def feature_names(self) -> list[str]:
        return ([f"num__{c}" for c in self.numeric] + self.onehot_f.output_names()
                + self.onehot_c.output_names())

    def fill(self, df: DataFrame) -> DataFrame:
        """Imputation only: strategy fills, then the regression fill of ``reg_target``."""
        imp = self.imputer.transform(df)
        if self.reg_fit is not None:
            t = self.reg_target
            imp = imp.withColumn(t, F.coalesce(F.col(t).cast("double"), self.reg_fit.linear_term()))
        return imp

    def transform(self, df: DataFrame) -> DataFrame:
        imp = self.fill(df)
        self.onehot_f.check(imp)
        self.onehot_c.check(imp)
        cols = [F.col(c) for c in self.keep]
        cols += [self.scaler.column(c).alias(f"num__{c}") for c in self.numeric]
        cols += self.onehot_f.columns() + self.onehot_c.columns()
        return imp.select(*cols)


def fit_preprocessor(df: DataFrame, numeric: Sequence[str], cat_freq: Sequence[str] = (),
                     cat_const: Sequence[str] = (), fill_value: str = "Unknown",
                     keep: Sequence[str] = (), impute: bool = True,
                     strict: bool = False, reg_target: str | None = None,
                     reg_predictors: Sequence[str] = ()) -> Preprocessor:
    """Fit all steps; ``impute=False`` with ``strict=True`` is the scale +
    strict one-hot preset (no imputation, unseen category raises).

    With ``reg_target`` (a numeric column) and ``reg_predictors`` (numeric
    columns), the target's gaps are filled by a linear model fitted where the
    target is present, on the already imputed predictors; nothing is fitted
    when the target has no gaps."""
    from tessera.operators.models import fit_linear
    if reg_target and reg_target not in numeric:
        raise ValueError("reg_target must be one of the numeric columns")
    numeric, cat_freq, cat_const = list(numeric), list(cat_freq), list(cat_const)
    median_cols = [c for c in numeric if c != reg_target] if impute else []
    counted = cat_freq + cat_const
    # three passes over the rows for all columns: value counts, moments, around the medians
    profile = profile_columns(df, counted=counted, measured=numeric, medians=median_cols)
    if impute:
        fills = _fills(profile, median_cols, (), cat_freq, {c: fill_value for c in cat_const})
    else:
        fills = {}
    imputer = FittedImputer(fills)
    stats = {c: profile.filled_moments(c, fills.get(c)) for c in numeric if c != reg_target}

    def cats(c):
        present = profile.categories(c)
        fill = fills.get(c)
        if fill is not None and profile.missing(c) and fill not in present:
            present = sorted(present + [fill], key=_sort_key)
        return present + _missing_category(profile, c, strict and fill is None)

    oh_f = FittedOneHot({c: cats(c) for c in cat_freq}, "cat_f__" if impute else "cat__", True, strict)
    oh_c = FittedOneHot({c: cats(c) for c in cat_const}, "cat_c__", True, strict)
    reg_fit = None
    if reg_target:
        # the target's fill depends on a model: fit it, then measure the filled column
        imp = imputer.transform(df)
        if imp.where(F.col(reg_target).isNull()).limit(1).count():
            reg_fit = fit_linear(imp.where(F.col(reg_target).isNotNull()), list(reg_predictors), reg_target)
            imp = imp.withColumn(reg_target, F.coalesce(F.col(reg_target).cast("double"),
                                                        reg_fit.linear_term()))
        stats.update(fit_scaler(imp, [reg_target]).stats)
    scaler = FittedScaler({c: stats[c] for c in numeric})
    return Preprocessor(imputer, scaler, oh_f, oh_c, numeric, list(keep), reg_target, reg_fit)


def prepare_label(c: str | Column, default: int = 0) -> Column:
    """Missing label -> ``default``, then integer."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(default)).cast("int")
