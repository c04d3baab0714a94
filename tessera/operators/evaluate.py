"""Evaluation tables: confusion matrix, classification report, ROC points,
AUC, MSE and R^2.

Classification metrics are derived from the confusion table (classes^2
rows), never from rows again. ROC uses one row per distinct score and a
two-level running sum, so it is exact with ties and never runs in a single
task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.strategy import MAX_BUCKETS, ROWS_PER_BUCKET, checkpointed, null_safe_join, running_sums


def confusion_matrix(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """``(y, yhat, n)`` for every pair of classes seen in truth or prediction;
    empty cells are 0. The matrix has classes^2 cells at every size.

    The rows are aggregated once. The class list is one aggregate of the cell
    table; each class is paired with it by ``explode``."""
    counts = checkpointed(df.groupBy(F.col(y).alias("y"), F.col(yhat).alias("yhat"))
                          .agg(F.count(F.lit(1)).cast("long").alias("n")))
    classes = counts.select(F.col("y").alias("c")).union(counts.select(F.col("yhat").alias("c"))).distinct()
    # a struct keeps the NULL class, which collect_list would leave out
    every = classes.agg(F.collect_list(F.struct("c")).alias("all"))
    pairs = (every.select(F.explode("all").alias("a"), "all")
             .select(F.col("a.c").alias("y"), F.explode("all").alias("b")).select("y", F.col("b.c").alias("yhat")))
    dense = null_safe_join(pairs, counts, ["y", "yhat"], "left")
    return checkpointed(dense.select("y", "yhat", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def _div(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def classification_report(confusion: DataFrame, digits: int = 6) -> DataFrame:
    """Per class precision, recall, F1 and support, then ``accuracy`` (F1
    column holds it), ``macro avg`` and ``weighted avg`` rows. A metric with a
    zero denominator is 0."""
    tp = confusion.where(F.col("y") == F.col("yhat")).select(F.col("y").alias("c"), F.col("n").alias("tp"))
    support = confusion.groupBy(F.col("y").alias("c")).agg(F.sum("n").alias("support"))
    predicted = confusion.groupBy(F.col("yhat").alias("c")).agg(F.sum("n").alias("predicted"))
    per = (null_safe_join(null_safe_join(support, predicted, "c", "full_outer"), tp, "c", "left")
           .select("c", F.coalesce("tp", F.lit(0)).alias("tp"),
                   F.coalesce("support", F.lit(0)).alias("support"),
                   F.coalesce("predicted", F.lit(0)).alias("predicted")))
    per = (per.withColumn("precision", _div(F.col("tp").cast("double"), F.col("predicted")))
           .withColumn("recall", _div(F.col("tp").cast("double"), F.col("support")))
           .withColumn("f1", _div(2 * F.col("precision") * F.col("recall"),
                                  F.col("precision") + F.col("recall"))))
    per = checkpointed(per)      # one row per class, read by the four parts below
    classes = per.select(F.col("c").cast("string").alias("label"), "precision", "recall", "f1",
                         F.col("support").cast("long").alias("support"))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  _div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("wp"),
                  _div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("wr"),
                  _div(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"),
                     _div(F.col("tp").cast("double"), F.col("n")).alias("f1"),
                     F.col("n").cast("long").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"),
                       F.col("n").cast("long").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"),
                          F.col("wr").alias("recall"), F.col("wf").alias("f1"),
                          F.col("n").cast("long").alias("support"))
    out = classes.unionByName(acc).unionByName(macro).unionByName(weighted)
    return out.select("label", *[(F.round(c, digits) + F.lit(0.0)).alias(c)
                                 for c in ("precision", "recall", "f1")], "support")


def score_counts(df: DataFrame, y: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score (map-side combined)."""
    yy = F.col(y).cast("long")
    return df.where(F.col(y).isNotNull()).groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(yy).alias("tp"), F.sum(F.lit(1) - yy).alias("fp"))


def roc_points(df: DataFrame, y: str, score: str, digits: int = 6) -> DataFrame:
    """One ROC point per distinct score, descending: cumulative true and
    false positives at ``score >= threshold`` and their rates."""
    cum = running_sums(score_counts(df, y, score), ["threshold"], ["tp", "fp"], descending=True)
    # running counts never decrease: their maxima are the class totals
    tot = cum.agg(F.max("cum_tp").alias("pos"), F.max("cum_fp").alias("neg")).first()
    pos, neg = tot["pos"] or 0, tot["neg"] or 0
    return cum.select(
        "threshold",
        F.col("cum_tp").cast("long").alias("tp"),
        F.col("cum_fp").cast("long").alias("fp"),
        (F.round(_div(F.col("cum_tp").cast("double"), F.lit(pos)), digits) + F.lit(0.0)).alias("tpr"),
        (F.round(_div(F.col("cum_fp").cast("double"), F.lit(neg)), digits) + F.lit(0.0)).alias("fpr"))


def roc_vertices(df: DataFrame, y: str, score: str, digits: int = 6,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The ROC curve by its corners: the start (0, 0) with a NULL threshold, then
    the points where the curve turns, and its end. Same curve and area as
    ``roc_points``; a point on the line between its neighbours is left out.

    A point is left out if its own step and the next one are parallel. The next
    step is looked up within ranges of the running count; each range hands its
    first step to the range before."""
    cum = running_sums(score_counts(df, y, score), ["threshold"], ["tp", "fp"], descending=True)
    cum = checkpointed(cum.select("threshold", *[F.col(c).cast("long").alias(c) for c in ("tp", "fp", "cum_tp", "cum_fp")]))
    tot = cum.agg(F.count(F.lit(1)).alias("n"), F.max("cum_tp").alias("pos"), F.max("cum_fp").alias("neg")).first()
    pos, neg = tot["pos"] or 0, tot["neg"] or 0
    ranges = min(MAX_BUCKETS, max(1, math.ceil(tot["n"] / rows_per_bucket)))
    start = F.col("cum_tp") + F.col("cum_fp") - F.col("tp") - F.col("fp")
    width = max(1, math.ceil((pos + neg) / ranges))
    placed = cum.withColumn("_start", start).withColumn("_range", F.floor(F.col("_start") / width))
    # one row a range
    firsts = placed.groupBy("_range").agg(F.min_by(F.struct("tp", "fp"), "_start").alias("_first"))
    firsts = firsts.select("_range", F.lead("_first").over(Window.partitionBy(F.lit(0)).orderBy("_range")).alias("_edge"))
    within = Window.partitionBy("_range").orderBy("_start")
    steps = (placed.withColumn("_next", F.lead(F.struct("tp", "fp")).over(within))
             .join(F.broadcast(firsts), "_range").withColumn("_next", F.coalesce("_next", "_edge")))
    exact = lambda c: F.col(c).cast("decimal(18,0)")  # noqa: E731  products pass 64 bits
    turns = exact("tp") * exact("_next.fp") != exact("_next.tp") * exact("fp")
    corners = steps.where(F.col("_next").isNull() | turns).select("threshold", F.col("cum_tp").alias("tp"), F.col("cum_fp").alias("fp"))
    origin = df.sparkSession.createDataFrame([(None, 0, 0)], "threshold double, tp long, fp long")
    return origin.unionByName(corners).select(
        "threshold", "tp", "fp",
        (F.round(_div(F.col("tp").cast("double"), F.lit(pos)), digits) + F.lit(0.0)).alias("tpr"),
        (F.round(_div(F.col("fp").cast("double"), F.lit(neg)), digits) + F.lit(0.0)).alias("fpr"))


def roc_auc(df: DataFrame, y: str, score: str, digits: int = 6) -> DataFrame:
    """Exact area under the ROC curve with ties (trapezoids between
    consecutive distinct scores): ``sum(fp * (2*ctp - tp)) / (2 * pos * neg)``."""
    cum = running_sums(score_counts(df, y, score), ["threshold"], ["tp"], descending=True)
    return cum.agg(
        (F.round(_div(F.sum(F.col("fp") * (2 * F.col("cum_tp") - F.col("tp"))).cast("double"),
                      (2 * F.sum("tp") * F.sum("fp")).cast("double")), digits) + F.lit(0.0))
        .alias("auc"))


def regression_metrics(df: DataFrame, y: str, p: str, digits: int = 6) -> DataFrame:
    """One row: MSE and R^2 (``1 - SSE / SST``) over the rows that have both
    values. With SST = 0, R^2 is 1 when SSE = 0 and else 0."""
    yy, pp = F.col(y).cast("double"), F.col(p).cast("double")
    both = df.where(yy.isNotNull() & pp.isNotNull() & ~F.isnan(yy) & ~F.isnan(pp))
    err = yy - pp
    sse, sst = F.sum(err * err), F.var_pop(yy) * F.count(F.lit(1))
    r2 = F.when(sst > 0, F.lit(1.0) - F.try_divide(sse, sst)).when(sse == 0, 1.0).when(sse > 0, 0.0)
    return both.agg((F.round(F.avg(err * err), digits) + F.lit(0.0)).alias("mse"),
                    (F.round(r2, digits) + F.lit(0.0)).alias("r2"))


def predictions_head(df: DataFrame, key: str, y: str, p: str, k: int = 20, digits: int = 6) -> DataFrame:
    """First ``k`` predictions beside the truth in key order."""
    return (df.orderBy(key).limit(k)
            .select(key, (F.round(F.col(y).cast("double"), digits) + F.lit(0.0)).alias("y_true"),
                    (F.round(F.col(p), digits) + F.lit(0.0)).alias("y_pred")))
