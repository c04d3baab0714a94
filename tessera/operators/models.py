"""Linear and logistic models on ``pyspark.ml``, with fitted state exposed as
column expressions.

Fitting is distributed (normal equations as one tree aggregate for linear
regression; L-BFGS with one aggregate per iteration for logistic
regression). The fitted coefficients are a handful of numbers, so prediction
is a projection with them as literals -- it stays in whole-stage codegen and
needs no vector column.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_dir


def balanced_sum(terms: Sequence[Column]) -> Column:
    """The sum as a balanced tree: its depth grows with the logarithm of the
    number of terms, so wide models neither overflow the parser's stack nor
    Catalyst's."""
    terms = list(terms)
    while len(terms) > 1:
        terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + terms[len(terms) - len(terms) % 2:]
    return terms[0]


@dataclass
class LinearFit:
    features: list
    coefficients: list
    intercept: float

    def linear_term(self) -> Column:
        terms = [F.col(f).cast("double") * F.lit(float(w))
                 for f, w in zip(self.features, self.coefficients)]
        return balanced_sum([F.lit(float(self.intercept)), *terms])

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.linear_term())

    def coefficient_table(self, spark) -> DataFrame:
        """``(feature, coefficient)`` ordered by absolute weight (chart order)."""
        rows = [(f, float(w)) for f, w in zip(self.features, self.coefficients)]
        return (spark.createDataFrame(rows, "feature string, coefficient double")
                .orderBy(F.abs("coefficient"), "feature"))


def _least_norm(S, b):
    """The minimum-norm solution of ``S w = b`` for a covariance matrix, on
    columns scaled to one variance so that units do not decide its rank."""
    import numpy as np
    if not len(b):
        return np.zeros(0)
    scale = np.sqrt(np.maximum(np.diag(S), 0))
    use = scale > 1e-12 * max(scale.max(), 1e-300)
    w = np.zeros(len(b))
    if use.any():
        d = scale[use]
        # least norm in the columns' own units: solve the scaled system's pseudo-inverse for its rank,
        # then project on the row space of the unscaled one
        R = S[np.ix_(use, use)] / np.outer(d, d)
        values, vectors = np.linalg.eigh(R)
        keep = values > 1e-10 * values.max()
        if keep.all():
            w[use] = np.linalg.solve(R, b[use] / d) / d
        else:
            rows = (vectors[:, keep].T * d)                     # spans the row space of the data
            z = vectors[:, keep].T @ (b[use] / d) / values[keep]
            w[use] = np.linalg.pinv(rows) @ z
    return w


def _fit_linear_moments(df: DataFrame, feats: list, label: str) -> tuple:
    """OLS on the rows where the label and every feature are present, from
    one aggregate of centred moments; also returns how many rows lack the
    label (same pass)."""
    import numpy as np
    y0 = F.col(label).cast("double")
    x0 = [F.col(c).cast("double") for c in feats]
    complete = y0.isNotNull()
    for x in x0:
        complete = complete & x.isNotNull()
    data = df.select(*[F.when(complete, x).alias(f"_x{i}") for i, x in enumerate(x0)],
                     F.when(complete, y0).alias("_y"), y0.isNull().alias("_gap"))
    xs = [F.col(f"_x{i}") for i in range(len(feats))]
    aggs = [F.avg("_y").alias("my"), F.count_if(F.col("_gap")).alias("gaps")]
    aggs += [F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)]
    aggs += [F.covar_pop(xs[i], xs[j]).alias(f"c{i}_{j}")
             for i in range(len(xs)) for j in range(i, len(xs))]
    aggs += [F.covar_pop(xs[i], F.col("_y")).alias(f"cy{i}") for i in range(len(xs))]
    row = data.agg(*aggs).first()
    k = len(xs)
    if row["my"] is None:
        return LinearFit(feats, [0.0] * k, 0.0), row["gaps"]
    S = np.empty((k, k))
    for i in range(k):
        for j in range(i, k):
            S[i, j] = S[j, i] = row[f"c{i}_{j}"]
    b = np.array([row[f"cy{i}"] for i in range(k)])
    # least norm: collinear and constant columns share or get no weight
    w = _least_norm(S, b)
    intercept = row["my"] - float(sum(w[i] * row[f"m{i}"] for i in range(k)))
    return LinearFit(feats, [float(v) for v in w], float(intercept)), row["gaps"]


@dataclass
class LogisticFit(LinearFit):
    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.linear_term()))

    def predict(self, df: DataFrame, out: str = "prediction", prob: str = "probability") -> DataFrame:
        return (df.withColumn(prob, self.probability())
                .withColumn(out, (self.linear_term() > F.lit(0.0)).cast("int")))


@dataclass
class MultinomialFit:
    """One coefficient row and intercept per class ``0..k-1``."""
    features: list
    classes: list                  # one LinearFit per class

    def predict(self, df: DataFrame, out: str = "prediction", prob: str = "probability") -> DataFrame:
        """The class with the largest score (ties: the smallest) and its probability."""
        best = F.array_max("_scores")
        share = F.aggregate("_scores", F.lit(0.0), lambda acc, s: acc + F.exp(s - best))
        return (df.withColumn("_scores", F.array(*[c.linear_term() for c in self.classes]))
                .withColumn(prob, F.lit(1.0) / share)
                .withColumn(out, (F.array_position("_scores", best) - 1).cast("int")).drop("_scores"))

    def coefficient_table(self, spark) -> DataFrame:
        rows = [(k, f, float(w)) for k, c in enumerate(self.classes) for f, w in zip(self.features, c.coefficients)]
        return (spark.createDataFrame(rows, "class int, feature string, coefficient double")
                .orderBy("class", F.abs("coefficient"), "feature"))


def _assembled(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Complete rows only, as in the closed form."""
    va = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="skip")
    return va.transform(df.where(F.col(label).isNotNull())
                        .select(*[F.col(c).cast("double") for c in features],
                                F.col(label).cast("double").alias("_label")))


# Up to this many features OLS is one covariance aggregate; beyond, pyspark.ml.
CLOSED_FORM_MAX_FEATURES = 32


def fit_linear(df: DataFrame, features: Sequence[str], label: str) -> LinearFit:
    """Ordinary least squares (no penalty) by the normal equations.

    With few features the centred moments (``covar_pop``/``var_pop``, one
    pass, numerically stable) are gathered in a single aggregate and the
    k x k system is solved on the driver (least norm if it is singular);
    otherwise ``pyspark.ml``'s normal-equation solver (tree aggregate of the
    Gram matrix, iterative if singular) is used. Rows with a missing feature or
    label are left out either way."""
    feats = list(features)
    if len(feats) <= CLOSED_FORM_MAX_FEATURES:
        return _fit_linear_moments(df, feats, label)[0]
    lr = LinearRegression(featuresCol="_features", labelCol="_label", solver="normal",
                          regParam=0.0, elasticNetParam=0.0, standardization=False,
                          fitIntercept=True)
    m = lr.fit(_assembled(df, features, label))
    return LinearFit(list(features), [float(x) for x in m.coefficients], float(m.intercept))


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, C: float = 1.0,
                 max_iter: int = 1000, tol: float = 1e-10, cut_lineage: bool = True) -> LogisticFit | MultinomialFit:
    """Logistic regression (multinomial for labels ``0..k-1`` with k > 2) with
    the L2 objective ``C * sum(logloss) + ||w||^2 / 2`` (intercept not penalised).

    Spark minimises ``mean(logloss) + regParam/2 * ||w||^2``, so
    ``regParam = 1 / (C * n)`` gives the same optimum. The training frame is
    checkpointed to the shared folder first, in as many tasks as it has, so the
    iterations re-read a short lineage and survive executor loss.
    """
    data = _assembled(df, features, label)
    if cut_lineage:
        scratch_dir(df.sparkSession)
        data = data.checkpoint(eager=True)
    n, top = data.agg(F.count(F.lit(1)), F.max("_label")).first()
    lr = LogisticRegression(featuresCol="_features", labelCol="_label",
                            family="multinomial" if top and top > 1 else "binomial",
                            maxIter=max_iter, tol=tol, regParam=1.0 / (C * max(n, 1)),
                            elasticNetParam=0.0, standardization=False, fitIntercept=True)
    m = lr.fit(data)
    if top and top > 1:
        return MultinomialFit(list(features), [
            LinearFit(list(features), [float(x) for x in row], float(b))
            for row, b in zip(m.coefficientMatrix.toArray(), m.interceptVector.toArray())])
    return LogisticFit(list(features), [float(x) for x in m.coefficients], float(m.intercept))


def logistic_gradient(df: DataFrame, fit: LogisticFit, label: str, C: float = 1.0) -> list:
    """Gradient of ``C * sum(logloss) + ||w||^2 / 2`` at the fitted point
    (intercept first). One aggregate; near 0 at the optimum."""
    p = fit.probability()
    r = p - F.col(label).cast("double")
    aggs = [F.sum(r).alias("g0")] + [F.sum(r * F.col(f).cast("double")).alias(f"g{i + 1}")
                                      for i, f in enumerate(fit.features)]
    row = df.agg(*aggs).first()
    grad = [C * row["g0"]]
    grad += [C * row[f"g{i + 1}"] + w for i, w in enumerate(fit.coefficients)]
    return grad


def regression_impute(df: DataFrame, target: str, predictors: Sequence[str]) -> DataFrame:
    """Fill ``target`` where it is NULL with a linear model fitted on the rows
    where it is present; rows with a value keep it. No-op when nothing is
    missing (known from the fit's own pass). Predictors must already be
    complete (impute them first)."""
    feats = list(predictors)
    if len(feats) <= CLOSED_FORM_MAX_FEATURES:
        fit, gaps = _fit_linear_moments(df, feats, target)
        if gaps == 0:
            return df
    else:
        if df.where(F.col(target).isNull()).limit(1).count() == 0:
            return df
        fit = fit_linear(df.where(F.col(target).isNotNull()), feats, target)
    return df.withColumn(target, F.coalesce(F.col(target).cast("double"), fit.linear_term()))
