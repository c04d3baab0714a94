"""Sparse one-hot features, chained imputation, ROC corners, samples by group."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import chained, distributions, evaluate, features, models, sparse


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_indices_are_the_dense_columns(spark):
    df = spark.createDataFrame([(1, "b", 10, 1.5), (2, "a", 9, float("nan")), (3, None, 100, 2.5), (4, "c", None, 1.5),
                                (5, "ä", 9, None), (6, "b", 10, 2.5)], "id int, s string, n int, x double")
    for drop in (True, False):
        dense = features.fit_one_hot(df, ["s", "n"], drop_first=drop)
        fit = sparse.fit_sparse_one_hot(df, ["s", "n"], drop_first=drop)
        names = dense.output_names()
        assert fit.width == len(names)
        want = {r["id"]: [i for i, c in enumerate(names) if r[c]] for r in dense.transform(df, keep=["id"]).collect()}
        assert {r["id"]: r["indices"] for r in fit.transform(df, keep=["id"]).collect()} == want
    fit = sparse.fit_sparse_one_hot(df, ["s", "x"])
    other = spark.createDataFrame([(7, "new", 1.5), (8, "c", 9.0), (9, None, None)], "id int, s string, x double")
    assert {r["id"]: r["indices"] for r in fit.transform(other).collect()} == {7: [], 8: [1], 9: []}
    assert rows_of(fit.unseen(other), "column") == [("s", "new"), ("x", "9.0")]
    empty = sparse.fit_sparse_one_hot(df.where("id < 0"), ["s", "n"])
    assert empty.width == 0 and [r["indices"] for r in empty.transform(df).collect()] == [[]] * 6


def test_many_categories_make_no_wide_plan(spark):
    df = spark.range(200_000).select("id", F.concat(F.lit("c"), F.col("id") % 100_000).alias("c"),
                                     ((F.col("id") * 7919) % 3 == 0).cast("int").alias("y"))
    fit = sparse.fit_sparse_one_hot(df, ["c"])
    out = fit.transform(df, keep=["id"])
    assert fit.width == 99_999 and out.columns == ["id", "indices"]
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 5_000
    first = out.select(F.get("indices", 0).alias("i"))
    got = first.agg(F.count("i"), F.count_distinct("i"), F.max("i")).first()
    assert tuple(got) == (199_998, 99_999, 99_998)
    weights, intercept = fit.fit_logistic(df, "y", max_iter=3)
    assert weights.count() == 99_999
    assert fit.score(df, weights, intercept).where("score IS NULL").count() == 0


def test_sparse_fit_equals_dense_fit(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("abcd"), rng.choice([None, 1, 2, 3])) for i in range(400)]
    df = spark.createDataFrame([(*r, int(rng.random() < (0.8 if r[1] == "b" else 0.3))) for r in rows], "id int, s string, n int, y int")
    fit = sparse.fit_sparse_one_hot(df, ["s", "n"])
    weights, intercept = fit.fit_logistic(df, "y")
    dense = features.fit_one_hot(df, ["s", "n"])
    want = models.fit_logistic(dense.transform(df, keep=["id", "y"]), dense.output_names(), "y")
    got = [r["weight"] for r in weights.orderBy("index").collect()]
    assert np.allclose(got, want.coefficients, atol=1e-4) and math.isclose(intercept, want.intercept, abs_tol=1e-4)
    score = {r["id"]: r["score"] for r in fit.score(df, weights, intercept).collect()}
    plain = want.predict(dense.transform(df, keep=["id", "y"])).collect()
    assert all(math.isclose(score[r["id"]], math.log(r["probability"] / (1 - r["probability"])), abs_tol=1e-3) for r in plain)


def brute_chained(rows, rounds):
    """Columns a, b, c and the category s: least squares on dense matrices."""
    have = np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows], float)
    cats = sorted({r[4] for r in rows if r[4] is not None}) + ([None] if any(r[4] is None for r in rows) else [])
    hot = np.array([[float(r[4] == v) for v in cats[1:]] for r in rows])
    now = np.where(np.isnan(have), np.nanmean(have, axis=0), have)
    for _ in range(rounds):
        new = now.copy()
        for t in range(3):
            gap = np.isnan(have[:, t])
            if gap.any():
                X = np.hstack([np.ones((len(rows), 1)), np.delete(now, t, 1), hot])
                w = np.linalg.lstsq(X[~gap], have[~gap, t], rcond=None)[0]
                new[gap, t] = X[gap] @ w
        now = new
    return now


def test_chained_rounds_against_least_squares(spark):
    rng = random.Random(11)
    rows = []
    for i in range(300):
        s, a = rng.choice(["x", "y", "z", None]), rng.gauss(50, 10)
        b, c = 2 * a + (7 if s == "y" else 0) + rng.gauss(0, 3), rng.gauss(1e6, 5) - a
        rows.append((i, *[None if rng.random() < 0.3 else v for v in (a, b)], c, s))
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, s string")
    for rounds in (1, 4):
        got = chained.chained_impute(df, ["a", "b", "c"], ["s"], rounds).orderBy("id").collect()
        assert [r["s"] for r in got] == [r[4] for r in rows]
        assert np.allclose([[r["a"], r["b"], r["c"]] for r in got], brute_chained(rows, rounds), rtol=1e-7)
        assert all(r["a"] == o[1] for r, o in zip(got, rows) if o[1] is not None)


def test_chained_edges(spark):
    df = spark.createDataFrame([(1, 1.0, None, None), (2, float("nan"), None, "k"), (3, 3.0, None, "k")],
                               "id int, a double, none double, s string")
    fit = chained.fit_chained(df, ["a", "none"], ["s"], 2)
    got = {r["id"]: (r["a"], r["none"]) for r in fit.transform(df).collect()}
    # only rows 1 (no category) and 3 (k) have a: the regression meets both
    assert got[1] == (1.0, None) and got[3] == (3.0, None) and math.isclose(got[2][0], 3.0)
    other = spark.createDataFrame([(9, None, None, "never seen")], df.schema)
    assert math.isclose(fit.transform(other).first()["a"], 3.0)      # like the first category
    assert chained.chained_impute(df.where("id < 0"), ["a", "none"], ["s"]).count() == 0


def test_corners_keep_the_curve(spark):
    rng = random.Random(3)
    rows = [(int(rng.random() < s / 60), float(s)) for s in (rng.randrange(60) for _ in range(3000))] + [(0, -float(k)) for k in range(1, 400)]
    df = spark.createDataFrame(rows, "y int, score double")
    every = [(0, 0)] + [(r["fp"], r["tp"]) for r in evaluate.roc_points(df, "y", "score").orderBy(F.desc("threshold")).collect()]
    want = [p for i, p in enumerate(every) if i in (0, len(every) - 1) or (p[1] - every[i - 1][1]) * (every[i + 1][0] - p[0])
            != (every[i + 1][1] - p[1]) * (p[0] - every[i - 1][0])]
    for size in (1_000_000, 7):
        got = evaluate.roc_vertices(df, "y", "score", rows_per_bucket=size).collect()
        assert sorted((r["fp"], r["tp"]) for r in got) == sorted(want) and len(want) < len(every) - 390
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(want, want[1:])) / (every[-1][0] * every[-1][1])
    assert math.isclose(area, evaluate.roc_auc(df, "y", "score").first()["auc"], abs_tol=1e-6)
    assert [tuple(r) for r in evaluate.roc_vertices(df.where("y > 5"), "y", "score").collect()] == [(None, 0, 0, 0.0, 0.0)]


def test_sample_of_a_hot_group(spark):
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("g"), F.col("id") % 50))
                                    .otherwise(F.when(F.col("id") > 29_990, None).otherwise("other")).alias("g"))
    got = distributions.hash_sample_by_group(df, "g", "id", 20)
    by = {}
    for r in df.withColumn("h", F.md5(F.concat(F.lit("42:"), F.col("id").cast("string")))).collect():
        by.setdefault(r["g"], []).append((r["h"], r["id"]))
    assert sorted((r["sample_hash"], r["id"]) for r in got.collect()) == sorted(x for v in by.values() for x in sorted(v)[:20])
    assert distributions.hash_sample_by_group(df.where("id < 0"), "g", "id", 20).count() == 0
