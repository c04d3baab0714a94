"""Hand-worked edge tables (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions.expressions import (BDI_BANDS, BDI_UNKNOWN, band, decode_codes,
                                           strip_lower, value_map)
from tessera.operators import (distributions, evaluate, features, keyed, missing, quality,
                               reports, split)


def test_threshold_is_strict_and_null_counts_in_total(spark):
    df = spark.createDataFrame([("g", 5.0), ("g", 5.1), ("g", None), ("g", 4.9)], "sex string, hours double")
    r = reports.conditional_counts(df, "sex", {"over": F.col("hours") > 5}).first()
    assert (r["total"], r["over"]) == (4, 1)


def test_bands_inclusive_with_unknown(spark):
    scores = [-1, 0, 13, 14, 19, 20, 28, 29, 63, 64]
    df = spark.createDataFrame([(i, float(s)) for i, s in enumerate(scores)], "i int, s double")
    got = [r[0] for r in df.orderBy("i").select(band("s", BDI_BANDS, BDI_UNKNOWN)).collect()]
    labels = [b[2] for b in BDI_BANDS]
    assert got == [BDI_UNKNOWN, labels[0], labels[0], labels[1], labels[1], labels[2], labels[2],
                   labels[3], labels[3], BDI_UNKNOWN]


def test_band_gap_falls_to_unknown(spark):
    df = spark.createDataFrame([(13.5,)], "s double")
    assert df.select(band("s", BDI_BANDS, BDI_UNKNOWN)).first()[0] == BDI_UNKNOWN


def test_all_missing_items(spark):
    df = spark.createDataFrame([(1, None, None)], "k long, a int, b int")
    r = reports.item_scores(df, "k", ["a", "b"], BDI_BANDS, BDI_UNKNOWN).first()
    assert r["total_score"] == 0 and r["category"] == BDI_BANDS[0][2]
    r = reports.item_scores(df, "k", ["a", "b"], BDI_BANDS, BDI_UNKNOWN, min_answered=1).first()
    assert r["total_score"] is None and r["category"] == BDI_UNKNOWN


def test_group_mean_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", None)], "g string, x double")
    got = sorted(tuple(r) for r in reports.group_mean_rows(df, "g", "x").collect())
    assert got == [("a", 1.0, 2.0), ("a", 3.0, 2.0), ("b", 5.0, 5.0)]
    means = reports.group_means(df, "g", "x")
    assert reports.group_mean_of(means, "g", "a") == 2.0
    assert reports.group_mean_of(means, "g", "zzz") is None


def test_keep_last(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z")], "k long, o long, v string")
    got = sorted((r["k"], r["v"]) for r in keyed.dedup_keep_last(df, "k", "o").collect())
    assert got == [(1, "y"), (2, "z")]
    assert df.count() - keyed.dedup_keep_last(df, "k", "o").count() == 1


def test_upsert_and_counters(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    inc = spark.createDataFrame([(2, None), (3, "c")], "k long, v string")
    out = keyed.upsert(base, inc, "k")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (2, None), (3, "c")]
    c = keyed.upsert_counters(inc, base, "k").first()
    assert (c["inserted"], c["updated"], c["total"]) == (1, 1, 3)
    # the same incoming again: same rows, nothing inserted
    again = keyed.upsert(out, inc, "k")
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in out.collect())
    c2 = keyed.upsert_counters(inc, out, "k").first()
    assert (c2["inserted"], c2["updated"], c2["total"]) == (0, 2, 3)


def test_orphans_and_key_sets(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    child = spark.createDataFrame([(2,), (3,)], "k long")
    assert [r[0] for r in quality.orphan_rows(child, parent, "k").collect()] == [3]
    r = quality.key_set_compare(parent, child, "k").first()
    assert (r["only_left"], r["only_right"], r["both"], r["equal"]) == (1, 1, 1, False)
    assert quality.is_subset(parent.where("k = 2"), child, "k")


def test_missing_profile(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (float("nan"), "b"), (4.0, "c")], "x double, s string")
    got = {r["column"]: (r["total"], r["pct"]) for r in missing.missing_counts(df).collect()}
    assert got == {"x": (2, 50.0), "s": (1, 25.0)}
    t = missing.missing_totals(df).first()
    assert (t["total_cells"], t["total_missing"], t["missing_pct"]) == (8, 3, 37.5)


def test_missing_profile_empty(spark):
    df = spark.createDataFrame([], "x double, s string")
    t = missing.missing_totals(df).first()
    assert (t["total_cells"], t["total_missing"], t["missing_pct"]) == (0, 0, 0.0)


def test_median_and_mode(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert features.exact_median(df, "x") == 2.5
    m = spark.createDataFrame([(v,) for v in ["b", "a", "b", "a", "c", None]], "s string")
    assert features.most_frequent(m, "s") == "a"


def test_scaling(spark):
    const = spark.createDataFrame([(7.0,), (7.0,), (7.0,)], "x double")
    sc = features.fit_scaler(const, ["x"])
    assert [r[0] for r in sc.transform(const).collect()] == [0.0, 0.0, 0.0]
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    got = sorted(round(r[0], 6) for r in features.fit_scaler(df, ["x"]).transform(df).collect())
    assert got == [-1.224745, 0.0, 1.224745]


def test_one_hot_drop_first_and_unknown(spark):
    fit_df = spark.createDataFrame([("C",), ("Q",), ("S",)], "e string")
    oh = features.fit_one_hot(fit_df, ["e"])
    assert oh.output_names() == ["e_Q", "e_S"]
    test = spark.createDataFrame([(1, "C"), (2, "Z"), (3, "S")], "k int, e string")
    got = {r["k"]: (r["e_Q"], r["e_S"]) for r in oh.transform(test).collect()}
    assert got == {1: (0.0, 0.0), 2: (0.0, 0.0), 3: (0.0, 1.0)}
    strict = features.fit_one_hot(fit_df, ["e"], strict=True)
    with pytest.raises(ValueError, match="unknown categories"):
        strict.transform(test)


def test_string_clean_and_map(spark):
    df = spark.createDataFrame([("\t Boy \n",), ("GIRL",), ("other",)], "s string")
    got = [r[0] for r in df.select(value_map(strip_lower("s"), {"boy": "B", "girl": "G"})).collect()]
    assert got == ["B", "G", "other"]


def test_decode_codes(spark):
    df = spark.createDataFrame([(0,), (1,)], "y int")
    assert [r[0] for r in df.select(decode_codes("y", ["Died", "Survived"])).collect()] == ["Died", "Survived"]


def test_split_quotas():
    assert split.class_quotas({"a": 7, "b": 3}, 0.2) == {"a": 1, "b": 1}


def test_histogram(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (10.0,)], "x double")
    h = distributions.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in h] == [2, 1, 0, 0, 1]
    one = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    h = distributions.histogram(one, "x", 2).orderBy("bin").collect()
    assert [(r["lo_edge"], r["hi_edge"], r["n"]) for r in h] == [(3.5, 4.0, 0), (4.0, 4.5, 2)]


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "y int, p int")
    cm = {(r["y"], r["yhat"]): r["n"] for r in evaluate.confusion_matrix(df, "y", "p").collect()}
    assert cm == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 1}
    rep = {r["label"]: r for r in evaluate.classification_report(evaluate.confusion_matrix(df, "y", "p")).collect()}
    assert (rep["1"]["precision"], rep["1"]["recall"], rep["1"]["f1"]) == (1.0, 0.5, 0.666667)
    assert (rep["0"]["precision"], rep["0"]["recall"], rep["0"]["f1"]) == (0.666667, 1.0, 0.8)
    assert rep["accuracy"]["f1"] == 0.75 and rep["accuracy"]["support"] == 4


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "y int, s double")
    assert evaluate.roc_auc(df, "y", "s").first()["auc"] == 0.625


def test_mse_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 4.0)], "y double, p double")
    r = evaluate.regression_metrics(df, "y", "p").first()
    assert (r["mse"], r["r2"]) == (0.333333, 0.5)


def test_sequence(spark):
    from tessera.operators.reports import run_sql
    assert [r["square"] for r in reports.squares(spark.range(1, 11), "id").orderBy("n").collect()] == \
        [n * n for n in range(1, 11)]
    got = [r[0] for r in run_sql(spark, "SELECT id * id FROM range(1, ? + 1) ORDER BY id", (10,)).collect()]
    assert got == [n * n for n in range(1, 11)]
    assert math.isclose(sum(got), 385)


def test_preprocess_regression_fill(spark):
    rows = [(1, 1.0, 3.0, "a"), (2, 2.0, 5.0, "b"), (3, 3.0, None, "a"), (4, None, 9.0, "b")]
    df = spark.createDataFrame(rows, "k int, x double, y double, c string")
    pre = features.fit_preprocessor(df, numeric=["x", "y"], cat_freq=["c"], keep=["k"],
                                    reg_target="y", reg_predictors=["x"])
    filled = {r["k"]: (r["x"], r["y"]) for r in pre.fill(df).collect()}
    # x gap -> median of x (2.0); y gap -> OLS on rows with y (x = 1, 2, 2 -> y = 3, 5, 9):
    # slope 4, intercept -1, so y(3) = 11
    assert filled[4][0] == 2.0
    assert filled[3][1] == pytest.approx(11.0)
    out = pre.transform(df)
    assert out.columns == ["k", "num__x", "num__y", "cat_f__c_b"]


def test_split_quotas_with_null_class():
    q = split.class_quotas({"a": 5, None: 5}, 0.2)
    assert q == {"a": 1, None: 1}
    q = split.class_quotas({"a": 3, None: 3}, 0.5)
    assert sum(q.values()) == 3 and q["a"] == 2


def test_null_keys(spark):
    base = spark.createDataFrame([(None, "a"), (1, "b")], "k long, v string")
    inc = spark.createDataFrame([(None, "z")], "k long, v string")
    assert sorted(map(tuple, keyed.upsert(base, inc, "k").collect()), key=repr) == [(1, "b"), (None, "z")]
    c = keyed.upsert_counters(inc, base, "k").first()
    assert (c["inserted"], c["updated"], c["total"]) == (0, 1, 2)
    r = quality.key_set_compare(base, inc, "k").first()
    assert (r["only_left"], r["only_right"], r["both"]) == (1, 0, 1)
    parent = spark.createDataFrame([(1,)], "k long")
    child = spark.createDataFrame([(None,), (1,), (2,)], "k long")
    assert [r[0] for r in quality.orphan_rows(child, parent, "k").collect()] == [2]


def test_histogram_ignores_nan(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (float("nan"),), (None,), (10.0,)], "x double")
    h = distributions.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in h] == [2, 0, 0, 0, 1] and h[-1]["hi_edge"] == 10.0


def test_filled_moments_equal_direct_pass(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,), (float("nan"),), (10.0,)], "x double")
    pre = features.fit_preprocessor(df, numeric=["x"])
    mean, std = pre.scaler.stats["x"]
    filled = pre.imputer.transform(df)
    r = filled.agg(F.avg("x"), F.stddev_pop("x")).first()
    assert mean == pytest.approx(r[0], abs=1e-12) and std == pytest.approx(r[1], abs=1e-12)
    assert pre.imputer.fills["x"] == 4.0


def test_integer_categories_sort_numerically(spark):
    df = spark.createDataFrame([(10,), (9,), (2,), (None,)], "p int")
    oh = features.fit_one_hot(df, ["p"])
    assert oh.categories["p"] == [2, 9, 10] and oh.output_names() == ["p_9", "p_10"]
    pre = features.fit_preprocessor(df, numeric=[], cat_freq=["p"])
    assert pre.onehot_f.categories["p"] == [2, 9, 10]


def test_fractional_fill_widens_integer_column(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "x int")
    out = features.fit_imputer(df, median=["x"]).transform(df)
    assert sorted(r[0] for r in out.collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]


@pytest.mark.parametrize("rows,share,test_rows", [([], 0.2, 0), ([(i, "a") for i in range(10)], 0.0, 0),
                                                  ([(i, "a") for i in range(10)], 1.0, 10),
                                                  ([(i, "a") for i in range(7)], 0.2, 2)])
def test_split_edges(spark, rows, share, test_rows):
    df = spark.createDataFrame(rows, "k long, c string")
    out = split.stratified_split(df, "c", "k", share)
    assert out.count() == len(rows)
    assert out.where("split = 'test'").count() == test_rows


def test_empty_inputs_give_empty_tables(spark):
    e = spark.createDataFrame([], "k long, g string, y int, s double, x double")
    assert evaluate.roc_points(e, "y", "s").count() == 0
    assert evaluate.roc_auc(e, "y", "s").first()["auc"] == 0.0
    assert evaluate.confusion_matrix(e, "y", "y").count() == 0
    assert evaluate.classification_report(evaluate.confusion_matrix(e, "y", "y")).count() == 3
    assert distributions.histogram_by_group(e, "g", "x", 5).count() == 0
    pre = features.fit_preprocessor(e, numeric=["x"], cat_freq=["g"], keep=["k"])
    assert pre.transform(e).count() == 0
