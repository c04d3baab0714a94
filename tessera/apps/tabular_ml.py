"""Model flows: load -> missing profile -> split -> preprocess (fitted on the
train rows) -> model -> evaluation tables, and the regression module
(scale + strict one-hot -> least squares -> MSE / R^2).

Each step is an operator; the flow keeps label and features on one frame
with a key, so nothing has to be re-joined after splitting.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import distributions, evaluate, features, missing, models, quality, split
from tessera.session import scratch_dir
from tessera.sources import catalog, files

# The regression module's default feature lists.
REGRESSION_NUMERIC = ["age", "bmi", "children"]
REGRESSION_CATEGORICAL = ["sex", "smoker", "region"]


def load_csv(spark: SparkSession, path: str, schema, target: str | None = None) -> DataFrame:
    """CSV by name with declared types; with ``target`` the target column
    becomes ``label`` on the same rows."""
    df = files.read_csv_typed(spark, path, schema)
    return catalog.with_label(df, target) if target else df


def load_json(spark: SparkSession, path: str, schema, target: str | None = None,
              multiline: bool = False) -> DataFrame:
    df = files.read_json_typed(spark, path, schema, multiline=multiline)
    return catalog.with_label(df, target) if target else df


def load_named(spark: SparkSession, name_or_id, data_dir: str | None = None, version: int = 1,
               target: str | None = None) -> DataFrame:
    df = catalog.load_named(spark, name_or_id, data_dir, version)
    return catalog.with_label(df, target) if target else df


@dataclass
class ClassificationResult:
    preprocessor: features.Preprocessor
    model: models.LogisticFit
    predictions: DataFrame      # test rows: key, label, prediction, probability
    confusion: DataFrame
    report: DataFrame
    coefficients: DataFrame
    missing: DataFrame
    head: DataFrame             # first predictions beside the truth, in key order
    scatter: DataFrame | None   # 2-D density of (x, y) by label, when asked for
    missing_summary: DataFrame  # cells, missing cells and their share over the feature columns
    label: str = "label"

    # the ROC tables run their running sums when first asked for, not before
    @cached_property
    def roc(self) -> DataFrame:
        return evaluate.roc_points(self.predictions, self.label, "probability")

    @cached_property
    def auc(self) -> DataFrame:
        return evaluate.roc_auc(self.predictions, self.label, "probability")


def classification_flow(df: DataFrame, key: str, label: str, numeric: Sequence[str],
                        cat_freq: Sequence[str] = (), cat_const: Sequence[str] = (),
                        test_size: float = 0.2, seed: int = 42, C: float = 1.0,
                        max_iter: int = 1000, label_default: int = 0,
                        fit_on_all_rows: bool = False, scatter: tuple | None = None,
                        head_rows: int = 20, reg_target: str | None = None,
                        reg_predictors: Sequence[str] = ()) -> ClassificationResult:
    """Logistic regression on prepared features with an exact stratified split.

    The preprocessor is fitted on the train rows (no leak); ``fit_on_all_rows``
    reproduces fitting it before the split. ``reg_target`` / ``reg_predictors``
    select the regression fill of one numeric column.
    """
    spark = df.sparkSession
    used = list(dict.fromkeys([key, label, *numeric, *cat_freq, *cat_const, *reg_predictors]))
    quality.require_columns(df, used)
    data = df.withColumn(label, features.prepare_label(label, label_default))
    feature_cols = [c for c in data.columns if c not in (key, label)]
    profile = missing.missing_counts(data, feature_cols)
    summary = missing.missing_totals(data, feature_cols)
    # the split, its checkpoint and the fits read only the columns they need
    parts = split.stratified_split(data.select(*used), label, key, test_size, seed)
    scratch_dir(spark)
    parts = parts.checkpoint(eager=True)          # many passes follow
    train = parts.where(F.col("split") == "train")
    test = parts.where(F.col("split") == "test")
    pre = features.fit_preprocessor(parts if fit_on_all_rows else train, numeric, cat_freq, cat_const,
                                    keep=[key, label], reg_target=reg_target,
                                    reg_predictors=reg_predictors)
    names = pre.feature_names()
    fit = models.fit_logistic(pre.transform(train), names, label, C=C, max_iter=max_iter,
                              cut_lineage=False)
    pred = fit.predict(pre.transform(test)).select(key, label, "prediction", "probability")
    confusion = evaluate.confusion_matrix(pred, label, "prediction")
    head = (pred.orderBy(key).limit(head_rows)
            .select(key, F.col(label).alias("y_true"), F.col("prediction").alias("y_pred")))
    density = (distributions.density_2d(data, scatter[0], scatter[1], label)
               if scatter else None)
    return ClassificationResult(
        pre, fit, pred, confusion, evaluate.classification_report(confusion),
        fit.coefficient_table(spark), profile, head, density, summary, label)


@dataclass
class RegressionResult:
    preprocessor: features.Preprocessor
    model: models.LinearFit
    predictions: DataFrame
    metrics: DataFrame


def preprocess_data(df: DataFrame, target: str, numeric: Sequence[str] = REGRESSION_NUMERIC,
                    categorical: Sequence[str] = REGRESSION_CATEGORICAL, key: str | None = None):
    """Scale numeric columns and one-hot the categorical ones (first category
    dropped, unseen category raises); returns ``(prepared, preprocessor)``."""
    keep = ([key] if key else []) + [target]
    pre = features.fit_preprocessor(df, numeric, cat_freq=categorical, keep=keep, impute=False, strict=True)
    return pre.transform(df), pre


def regression_flow(df: DataFrame, target: str, numeric: Sequence[str] = REGRESSION_NUMERIC,
                    categorical: Sequence[str] = REGRESSION_CATEGORICAL,
                    key: str | None = None) -> RegressionResult:
    prepared, pre = preprocess_data(df, target, numeric, categorical, key)
    fit = models.fit_linear(prepared, pre.feature_names(), target)
    pred = fit.predict(prepared)
    return RegressionResult(pre, fit, pred, evaluate.regression_metrics(pred, target, "prediction"))


def main(argv=None) -> None:
    """``classify`` or ``regress`` a named dataset (catalog table or Parquet
    under ``--data-dir``) and print the evaluation tables."""
    import argparse
    p = argparse.ArgumentParser(description="model flows on a named dataset")
    p.add_argument("mode", choices=["classify", "regress"])
    p.add_argument("name")
    p.add_argument("--data-dir", default=None)
    p.add_argument("--target", required=True)
    p.add_argument("--key", required=True)
    p.add_argument("--numeric", default="")
    p.add_argument("--cat-freq", default="")
    p.add_argument("--cat-const", default="")
    p.add_argument("--master", default=None, help="local[N] for a local run; omit on a cluster")
    a = p.parse_args(argv)
    from tessera.session import local_session
    spark = local_session(a.master[6:-1]) if a.master else SparkSession.builder.getOrCreate()
    split_list = lambda s: [x for x in s.split(",") if x]
    df = catalog.load_named(spark, a.name, a.data_dir)
    if a.mode == "classify":
        res = classification_flow(df, a.key, a.target, split_list(a.numeric), split_list(a.cat_freq),
                                  split_list(a.cat_const))
        for name in ("missing", "report", "confusion", "auc", "coefficients", "head"):
            print(name)
            getattr(res, name).show(50, truncate=False)
    else:
        res = regression_flow(df, a.target, split_list(a.numeric), split_list(a.cat_freq), a.key)
        res.metrics.show()


if __name__ == "__main__":
    main()
