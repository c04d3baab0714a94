import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import distributions, features, sketches
from tessera.sources import files


@pytest.fixture(scope="module")
def skewed(spark):
    """A near-unique column with two heavy values that tie, and a small column."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 20 == 0, "heavy b").when(F.col("id") % 20 == 1, "heavy a").otherwise(F.concat(F.lit("v"), "id")).alias("wide"),
        (F.col("id") % 7).alias("small"), F.lit(None).cast("string").alias("none"),
        F.when(F.col("id") % 3 == 0, float("nan")).otherwise((F.col("id") % 5).cast("double")).alias("num"))
    return rows.cache()


def test_modes_are_those_of_a_full_count(skewed):
    want = {c: features.most_frequent(skewed, c) for c in ("wide", "small", "none", "num")}
    assert sketches.modes(skewed, ["wide", "small", "none", "num"]) == want and want["wide"] == "heavy a"


def test_near_unique_column_shuffles_candidates_only(skewed):
    found = sketches.heavy_hitters(skewed, ["wide"], items=1000, top=50)
    rows = found.collect()
    assert len(rows) <= 50 and {r["n"] for r in rows if r["value"].startswith("heavy")} == {3000}
    assert all(r["proven_above"] < 3000 for r in rows)
    # every value counted: one row each
    assert features.value_counts(skewed, ["wide"]).count() > 50_000


def test_unproven_columns_are_counted(spark):
    unique = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
    assert sketches.modes(unique, ["v"], items=64, top=16) == {"v": 0}
    empty = unique.where("v < 0")
    assert sketches.modes(empty, ["v"]) == {"v": None}


def test_quantiles_of_merged_loads(spark):
    rng = random.Random(2)
    rows = [(k % 5, rng.gauss(0, 1) if k % 3 else None, float("nan") if k % 2 else 1.0 * k) for k in range(20_000)]
    df = spark.createDataFrame(rows, "load int, a double, b double")
    got = {r["column"]: r for r in sketches.merged_quantiles(sketches.quantile_sketches(df, "load", ["a", "b"])).collect()}
    for c, i in (("a", 1), ("b", 2)):
        held = sorted(r[i] for r in rows if r[i] is not None and not math.isnan(r[i]))
        below = sum(v < got[c]["value"] for v in held)
        assert got[c]["n"] == len(held) and abs(below / len(held) - 0.5) <= got[c]["rank_error"] < 0.02
    none = sketches.quantile_sketches(df.where("load = 9"), "load", ["a"])
    assert sketches.merged_quantiles(none).count() == 0


def test_pair_density_counts_every_pair(spark):
    nan = float("nan")
    rows = [("p", 0.0, 1.0, 5.0), ("p", 1.0, 2.0, nan), ("q", 0.5, None, 7.0), (None, 1.0, 1.0, 1.0), ("q", 1.0, 3.0, 9.0)]
    df = spark.createDataFrame(rows, "label string, a double, b double, c double")
    got = {tuple(r) for r in distributions.pair_density(df, "label", ["a", "b", "c"], 2).collect()}
    assert got == {("a", "b", "p", 0, 0, 1), ("a", "b", "p", 1, 1, 1), ("a", "b", "q", 1, 1, 1), ("a", "c", "p", 0, 0, 1),
                   ("a", "c", "q", 1, 1, 2), ("b", "c", "p", 0, 0, 1), ("b", "c", "q", 1, 1, 1)}
    assert distributions.pair_density(df, "label", ["a"], 2).count() == 0


def test_density_is_one_under_the_curve_and_near_the_rows_own(spark):
    rng = random.Random(1)
    rows = [("p", rng.gauss(0, 1)) for _ in range(2000)] + [("q", rng.gauss(3, 0.5)) for _ in range(500)] + [("alone", 1.0)]
    df = spark.createDataFrame(rows, "label string, v double")
    got = distributions.kde_by_label(df, "label", ["v"], 256).collect()
    assert {r.label for r in got} == {"p", "q"}
    xs = sorted({r.x for r in got})
    for lab in ("p", "q"):
        mine = [v for k, v in rows if k == lab]
        curve = {r.x: r.density for r in got if r.label == lab}
        assert abs(sum(curve.values()) * (xs[1] - xs[0]) - 1) < 0.02
        mean = sum(mine) / len(mine)
        h = math.sqrt(sum((v - mean) ** 2 for v in mine) / (len(mine) - 1)) * len(mine) ** -0.2
        for x in xs[::32]:
            exact = sum(math.exp(-0.5 * ((x - v) / h) ** 2) for v in mine) / (len(mine) * h * math.sqrt(2 * math.pi))
            assert abs(curve[x] - exact) < 0.01


def test_column_oriented_json(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType()), T.StructField("gone", T.DoubleType())])
    (tmp_path / "a.json").write_text('{"t": {"0": "x", "1": null, "7": "z"},\n "k": {"0": 1, "7": 3, "1": 2}, "other": {"0": 5}}')
    (tmp_path / "b.json").write_text('{"k": {"0": 9}}')
    got = files.read_json_columns(spark, str(tmp_path), schema, required=["k"])
    assert sorted(map(tuple, got.collect())) == [(1, "x", None), (2, None, None), (3, "z", None), (9, None, None)]
