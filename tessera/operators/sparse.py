"""One-hot features as index arrays into a category table.

The dense encoder writes a column per category and keeps the categories on the
driver. Here the categories are a table ``(column, value, index)`` that Spark
numbers and joins, a row is the array of its indices, and linear scores are
sums of joined weights, so a column of a hundred thousand categories costs no
wider plan than one of five. Numbering, dropped first category and unknown
values follow the dense encoder.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.strategy import checkpointed, join_small

#: monotonically_increasing_id: the partition above these bits, the row below.
_ROW_BITS = 33


def numbered(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """``out`` = 0-based position of each row in ``order``: sorted ranges, their
    sizes summed up, and the row's place in its range; no window over the rows."""
    rows = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order)
                        .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row a range
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(out, F.col("_before") + F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1))
            .drop("_part", "_at", "_before"))


def _text(df: DataFrame, c: str) -> Column:
    """The value as text; NULL and NaN are missing."""
    value = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    return value.cast("string")


def _order(df: DataFrame, c: str) -> Column:
    """Numbers order by value, anything else by its text alone."""
    kind = df.schema[c].dataType
    return F.col(f"`{c}`").cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")


@dataclass
class SparseOneHot:
    columns: list
    table: DataFrame          # (column, value, local, index); NULL index: the dropped first category
    kept: dict                # column -> categories that have an index
    width: int

    def _categories(self, c: str) -> DataFrame:
        return self.table.where(F.col("column") == c)

    def _joined(self, df: DataFrame, side, out: str) -> DataFrame:
        """``side(c)`` = (value, x) met by each column's value as ``<out><number>``."""
        for i, c in enumerate(self.columns):
            values = side(c).toDF("_value", f"{out}{i}").where("_value IS NOT NULL")
            df = join_small(df.withColumn("_value", _text(df, c)), values, "_value", "left").drop("_value")
        return df

    def transform(self, df: DataFrame, keep: Sequence[str] | None = None, out: str = "indices") -> DataFrame:
        """``keep`` and the ascending indices of the row's categories; the first
        category, unknown values and missing values have none."""
        keep = [c for c in (keep if keep is not None else df.columns) if keep is not None or c not in self.columns]
        found = self._joined(df, lambda c: self._categories(c).select("value", "index"), "_index")
        return found.select(*[F.col(f"`{c}`") for c in keep], F.array_compact(
            F.array(*[f"_index{i}" for i in range(len(self.columns))])).alias(out))

    def unseen(self, df: DataFrame) -> DataFrame:
        """Values of ``df`` that are not in the category table: ``(column, value)``."""
        values = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), _text(df, c).alias("value")) for c in self.columns])))
        return values.where("value IS NOT NULL").distinct().join(self.table, ["column", "value"], "left_anti")

    def score(self, df: DataFrame, weights: DataFrame, intercept: float = 0.0, out: str = "score") -> DataFrame:
        """``intercept`` plus the weights ``(index, weight)`` of the row's categories."""
        weighted = checkpointed(self.table.join(weights, "index").select("column", "value", "weight"))
        found = self._joined(df, lambda c: weighted.where(F.col("column") == c).select("value", "weight"), "_weight")
        total = F.lit(float(intercept))
        for i in range(len(self.columns)):
            total = total + F.coalesce(F.col(f"_weight{i}"), F.lit(0.0))
        return found.withColumn(out, total).drop(*[f"_weight{i}" for i in range(len(self.columns))])

    def vectors(self, df: DataFrame, out: str = "_features") -> DataFrame:
        """Sparse vectors for ``pyspark.ml``, position = index. The dropped
        category of its encoder, the last, stands for all values without an index."""
        used = [i for i, c in enumerate(self.columns) if self.kept[c]]
        found = self._joined(df, lambda c: self._categories(c).where("index IS NOT NULL").select("value", "local"), "_local")
        for i in used:
            last = float(self.kept[self.columns[i]])
            found = found.withColumn(f"_local{i}", F.coalesce(F.col(f"_local{i}").cast("double"), F.lit(last)))
            sizes = df.sparkSession.createDataFrame([(last,)], f"_local{i} double")
            found = OneHotEncoder(inputCols=[f"_local{i}"], outputCols=[f"_vector{i}"], dropLast=True).fit(sizes).transform(found)
        found = VectorAssembler(inputCols=[f"_vector{i}" for i in used], outputCol=out).transform(found)
        return found.drop(*[f"_local{i}" for i in range(len(self.columns))], *[f"_vector{i}" for i in used])

    def fit_logistic(self, df: DataFrame, label: str, C: float = 1.0, max_iter: int = 1000,
                     tol: float = 1e-10) -> tuple[DataFrame, float]:
        """Weights ``(index, weight)`` and intercept of the objective of
        ``models.fit_logistic`` on the one-hot features alone."""
        spark = df.sparkSession
        if not self.width:
            raise ValueError("no category to fit on")
        data = checkpointed(self.vectors(df.where(F.col(label).isNotNull())).select(
            "_features", F.col(label).cast("double").alias("_label")))
        n = data.count()
        fit = LogisticRegression(featuresCol="_features", labelCol="_label", family="binomial", maxIter=max_iter, tol=tol,
                                 regParam=1.0 / (C * max(n, 1)), standardization=False).fit(data)
        weights = spark.createDataFrame(enumerate(fit.coefficients.toArray().tolist()), "index long, weight double")
        return weights, float(fit.intercept)


def fit_sparse_one_hot(df: DataFrame, cols: Sequence[str], drop_first: bool = True) -> SparseOneHot:
    """The category table of ``cols``: distinct values met with map-side combine,
    numbered by column, then value. Missing values are no category. Numbers
    beyond 2^53 that agree as doubles order by their text."""
    cols = list(cols)
    long = df.select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("_col"), _order(df, c).alias("_num"), _text(df, c).alias("value")) for i, c in enumerate(cols)])))
    found = numbered(long.where("value IS NOT NULL").distinct(), ["_col", "_num", "value"], "_rank")
    # one row a column
    spans = {r["_col"]: (r["first"], r["n"]) for r in found.groupBy("_col").agg(
        F.min("_rank").alias("first"), F.count(F.lit(1)).alias("n")).collect()}
    first, skipped = F.lit(None).cast("long"), F.lit(0)
    for i, (at, _) in sorted(spans.items()):
        first = F.when(F.col("_col") == i, F.lit(at)).otherwise(first)
        if drop_first:
            skipped = skipped + (F.col("_col") >= i).cast("int")
    index = F.col("_rank") - skipped
    if drop_first:
        index = F.when(F.col("_rank") != first, index)
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_col") + 1)
    table = checkpointed(found.select(name.alias("column"), "value", index.cast("long").alias("index"),
                                      (F.col("_rank") - first - int(drop_first)).alias("local")))
    kept = {c: max(spans.get(i, (0, 0))[1] - int(drop_first), 0) for i, c in enumerate(cols)}
    return SparseOneHot(cols, table, kept, sum(kept.values()))
