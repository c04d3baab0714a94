"""Properties that must hold on any input, checked on the driver tables and on
the scalable code paths forced to their multi-bucket form."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from tessera.operators import distributions, evaluate, features, keyed, models, split
from tessera.plans import registry, strategy
from tessera.plans.bindings import scored_labels
from tessera.sources.tables import read_table


def test_split_disjoint_complete_exact(spark):
    ev = read_table(spark, SF_SMALL, "events").select("event_id", "event_type")
    out = split.stratified_split(ev, "event_type", "event_id", 0.2, 42)
    n = ev.count()
    assert out.count() == n and out.select("event_id").distinct().count() == n
    counts = {r[0]: r[1] for r in ev.groupBy("event_type").count().collect()}
    quotas = split.class_quotas(counts, 0.2)
    got = {r[0]: r[1] for r in out.where("split = 'test'").groupBy("event_type").count().collect()}
    assert got == {k: v for k, v in quotas.items() if v}
    assert sum(got.values()) == int(np.ceil(0.2 * n))


def test_split_multi_bucket_equals_single(spark, monkeypatch):
    ev = read_table(spark, SF_SMALL, "events").select("event_id", "event_type")
    one = {tuple(r) for r in split.stratified_split(ev, "event_type", "event_id").collect()}
    monkeypatch.setattr(split, "ROWS_PER_HASH_BUCKET", 1)
    many = {tuple(r) for r in split.stratified_split(ev, "event_type", "event_id").collect()}
    assert one == many


def test_running_sums_bucketed_equals_single(spark, monkeypatch):
    df = spark.range(0, 500).select((F.col("id") * 7 % 101).cast("double").alias("s"),
                                     F.lit(1).alias("w")).groupBy("s").agg(F.sum("w").alias("w"))
    single = {r["s"]: r["cum_w"] for r in strategy.running_sums(df, ["s"], ["w"], descending=True).collect()}
    many = {r["s"]: r["cum_w"] for r in
            strategy.running_sums(df, ["s"], ["w"], descending=True, rows_per_bucket=7).collect()}
    assert single == many
    asc = {r["s"]: r["cum_w"] for r in strategy.running_sums(df, ["s"], ["w"], rows_per_bucket=9).collect()}
    vals = sorted(single)
    total = sum(r["w"] for r in df.collect())
    assert asc[vals[-1]] == total and single[vals[0]] == total


@pytest.mark.parametrize("distributed", [False, True])
def test_exact_median_matches_numpy(spark, monkeypatch, distributed):
    if distributed:
        monkeypatch.setattr(strategy, "ROWS_PER_BUCKET", 13)
        monkeypatch.setattr(strategy, "SMALL_DISTINCT", 0)
    li = read_table(spark, SF_SMALL, "lineitem").select("l_extendedprice")
    vals = np.array([r[0] for r in li.collect()])
    assert features.exact_median(li, "l_extendedprice") == pytest.approx(float(np.median(vals)), abs=1e-9)


def test_histogram_counts_sum_to_non_null(spark):
    ev = read_table(spark, SF_SMALL, "events")
    h = distributions.histogram(ev, "value", 30)
    assert h.agg(F.sum("n")).first()[0] == ev.where("value IS NOT NULL").count()
    g = distributions.histogram_by_group(ev, "event_type", "value", 30)
    assert g.agg(F.sum("n")).first()[0] == ev.count()


def test_confusion_cells_sum_to_rows(spark):
    p = scored_labels(read_table(spark, SF_SMALL, "labels"), read_table(spark, SF_SMALL, "documents"))
    cm = evaluate.confusion_matrix(p, "y", "yhat")
    assert cm.agg(F.sum("n")).first()[0] == p.count()


def test_scaled_mean_zero_std_one(spark):
    ev = read_table(spark, SF_SMALL, "events")
    out = features.fit_scaler(ev, ["value"]).transform(ev)
    r = out.agg(F.avg("value"), F.stddev_pop("value")).first()
    assert abs(r[0]) < 1e-9 and abs(r[1] - 1) < 1e-9


def test_auc_invariant_under_monotone_transform(spark):
    p = scored_labels(read_table(spark, SF_SMALL, "labels"), read_table(spark, SF_SMALL, "documents"))
    a = evaluate.roc_auc(p, "y", "score").first()[0]
    b = evaluate.roc_auc(p.withColumn("score", F.log1p("score") * 3 + 1), "y", "score").first()[0]
    assert a == b


def test_upsert_idempotent(spark):
    ev = read_table(spark, SF_SMALL, "orders")
    base = keyed.dedup_keep_last(ev.where("o_orderstatus = 'F'"), "o_custkey", ["o_orderdate", "o_orderkey"])
    inc = keyed.dedup_keep_last(ev.where("o_orderstatus <> 'F'"), "o_custkey", ["o_orderdate", "o_orderkey"])
    once = keyed.upsert(base, inc, "o_custkey")
    twice = keyed.upsert(once, inc, "o_custkey")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_logistic_gradient_near_zero(spark):
    labels, docs = read_table(spark, SF_SMALL, "labels"), read_table(spark, SF_SMALL, "documents")
    data = labels.join(docs, "doc_id").select("quality", F.col("n_chars").cast("double").alias("n_chars"), "lang")
    pre = features.fit_preprocessor(data, numeric=["n_chars"], cat_freq=["lang"], keep=["quality"])
    prepared = pre.transform(data)
    fit = models.fit_logistic(prepared, pre.feature_names(), "quality")
    grad = models.logistic_gradient(prepared, fit, "quality")
    assert max(abs(g) for g in grad) < 1e-4


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_results_independent_of_partitioning(spark):
    """Every registered query gives the same rows with 3 and 8 shuffle partitions."""
    keys = sorted(registry.QUERIES)
    before = {k: _rows(registry.QUERIES[k](spark, SF_SMALL)) for k in keys}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        after = {k: _rows(registry.QUERIES[k](spark, SF_SMALL)) for k in keys}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert [k for k in keys if before[k] != after[k]] == []


def test_confusion_is_dense_at_any_size(spark):
    from tessera.operators import evaluate as ev
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (2, 2)], "y int, p int")
    got = {(r["y"], r["yhat"]): r["n"] for r in ev.confusion_matrix(df, "y", "p").collect()}
    assert got == {(a, b): int((a, b) in ((1, 1), (1, 0), (0, 0), (2, 2))) for a in range(3) for b in range(3)}
    rep = {r["label"]: r for r in ev.classification_report(ev.confusion_matrix(df, "y", "p")).collect()}
    assert rep["accuracy"]["f1"] == 0.75 and rep["1"]["recall"] == 0.5
    many = spark.range(0, 700).select(F.col("id").alias("y"), (F.col("id") * 7 % 700).alias("p"))
    cm = ev.confusion_matrix(many, "y", "p")
    assert cm.count() == 700 * 700 and cm.agg(F.sum("n")).first()[0] == 700


def test_skewed_key_results_whole(spark):
    """One key holds a third of the rows: keep-last, upsert, group means,
    split and histograms stay exact."""
    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("g"),
        (F.col("id") * 0.5).alias("x"))
    last = {r["g"]: r["k"] for r in keyed.dedup_keep_last(df, "g", "k").collect()}
    assert last[0] == max(i for i in range(n) if i % 3 == 0) and len(last) == 1 + (n - n // 3)
    from tessera.operators import reports
    means = {r["g"]: r["group_avg"] for r in reports.group_mean_rows(df, "g", "x").where("g = 0").collect()}
    assert means[0] == pytest.approx(np.mean([i * 0.5 for i in range(0, n, 3)]))
    hot = df.withColumn("cls", F.when(F.col("g") == 0, "hot").otherwise("cold"))
    s = split.stratified_split(hot, "cls", "k", 0.2)
    got = {r[0]: r[1] for r in s.where("split = 'test'").groupBy("cls").count().collect()}
    assert got == split.class_quotas({"hot": 1000, "cold": 2000}, 0.2)
    h = distributions.histogram_by_group(hot, "cls", "x", 10)
    assert {r[0]: r[1] for r in h.groupBy("cls").agg(F.sum("n")).collect()} == {"hot": 1000, "cold": 2000}


def test_null_groups_keep_their_rows(spark):
    """NULL class / group rows are neither dropped nor merged into another group."""
    df = spark.createDataFrame([(i, None if i % 4 == 0 else ("a" if i % 2 else "b"), float(i))
                                for i in range(40)], "k long, g string, x double")
    s = split.stratified_split(df, "g", "k", 0.25)
    assert s.count() == 40
    got = {r[0]: r[1] for r in s.where("split = 'test'").groupBy("g").count().collect()}
    assert got == {k: v for k, v in split.class_quotas({None: 10, "a": 20, "b": 10}, 0.25).items() if v}
    from tessera.operators import reports
    rows = reports.group_mean_rows(df, "g", "x").collect()
    assert len(rows) == 40
    assert {r["group_avg"] for r in rows if r["g"] is None} == {float(np.mean(range(0, 40, 4)))}
    cm = evaluate.confusion_matrix(df.select(F.col("g").alias("y"), F.col("g").alias("p")), "y", "p")
    assert cm.agg(F.sum("n")).first()[0] == 40


BIG = 2 ** 53


@pytest.fixture(params=["true", "false"], ids=["arrow", "rows"])
def arrow(spark, request):
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", request.param)
    yield
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffled"])
def both_sizes(request, monkeypatch):
    if not request.param:
        monkeypatch.setattr(strategy, "BROADCAST_MAX_BYTES", 0.5)


def odd_keys(spark):
    """Long keys beyond 2^53 with NULLs, double keys with NaN and NULL."""
    keys = [BIG, BIG + 1, None, BIG + 2]
    return spark.createDataFrame(
        [(i, keys[i % 4], [float("nan"), None, 1.5][i % 3], float(i)) for i in range(48)], "k long, g long, f double, x double")


@pytest.mark.parametrize("label", ["g", "f"])
def test_odd_keys_keep_every_row(spark, arrow, both_sizes, label):
    from tessera.operators import reports
    df = odd_keys(spark)
    s = split.stratified_split(df, label, "k", 0.25)
    assert s.count() == 48 and s.where("split = 'test'").count() == 12
    per = {str(r[0]): r[1] for r in s.where("split = 'test'").groupBy(label).count().collect()}
    assert set(per.values()) == {3 if label == "g" else 4}
    rows = reports.group_mean_rows(df, label, "x").collect()
    assert len(rows) == 48 and all(r["group_avg"] is not None for r in rows)
    assert reports.share_table(df, label).count() == (4 if label == "g" else 3)
    cm = evaluate.confusion_matrix(df.select(F.col(label).alias("y"), F.col(label).alias("p")), "y", "p")
    assert cm.where("n > 0").count() == (4 if label == "g" else 3) and cm.agg(F.sum("n")).first()[0] == 48


def test_upsert_of_composite_keys_with_null_parts(spark, arrow, both_sizes):
    schema = "a long, b string, v int"
    base = spark.createDataFrame([(BIG + 1, None, 1), (BIG, None, 2), (None, "x", 3)], schema)
    new = spark.createDataFrame([(BIG + 1, None, 10), (None, "x", 30)], schema)
    got = sorted(map(tuple, keyed.upsert(base, new, ["a", "b"]).collect()), key=str)
    assert got == sorted([(BIG + 1, None, 10), (BIG, None, 2), (None, "x", 30)], key=str)


def test_categories_beyond_double_precision(spark):
    df = spark.createDataFrame([(BIG,), (BIG + 1,), (BIG + 1,), (None,)], "c long")
    assert features.fit_one_hot(df, ["c"]).categories["c"] == [BIG, BIG + 1]
    assert features.most_frequent(df, "c") == BIG + 1


def test_running_sums_order_null_and_nan_alike_at_every_size(spark):
    rows = [(None, 1), (float("nan"), 2), (float("inf"), 4), (-1.0, 8), (3.0, 16), (2.0, 32)]
    df = spark.createDataFrame(rows, "s double, w long")
    for desc in (True, False):
        one = {str(r["s"]): r["cum_w"] for r in strategy.running_sums(df, ["s"], ["w"], descending=desc).collect()}
        many = {str(r["s"]): r["cum_w"] for r in
                strategy.running_sums(df, ["s"], ["w"], descending=desc, rows_per_bucket=1).collect()}
        assert one == many and len(one) == 6
        assert one["None"] == (63 if desc else 1) and one["nan"] == (2 if desc else 63)


def test_ols_collinear_constant_null_and_wide(spark):
    from tessera.operators import models
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 2))
    X = np.column_stack([x, 2 * x[:, 0], np.full(60, 7.0)])
    y = 1.0 + x @ [2.0, -1.0]
    rows = [(*map(float, r), float(v)) for r, v in zip(X, y)] + [(None, 1.0, 1.0, 7.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y double")
    fit = models.fit_linear(df, ["a", "b", "c", "d"], "y")
    want = np.linalg.lstsq(X - X.mean(0), y - y.mean(), rcond=None)[0]
    assert np.allclose(fit.coefficients, want, atol=1e-8)
    wide = models.LinearFit([f"f{i}" for i in range(2000)], [1.0] * 2000, 0.5)
    one = spark.range(1).select(*[F.lit(float(i)).alias(f"f{i}") for i in range(2000)])
    assert one.select(wide.linear_term().alias("p")).first()["p"] == 0.5 + 1999 * 1000


def test_r2_with_gaps_and_constant_truth(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 2.0), (None, 5.0), (9.0, None)], "y double, p double")
    r = evaluate.regression_metrics(df, "y", "p").first()
    assert (r["mse"], r["r2"]) == (0.5, 0.5)
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0)], "y double, p double")
    assert evaluate.regression_metrics(flat, "y", "p").first()["r2"] == 0.0
    assert evaluate.regression_metrics(flat.limit(1), "y", "p").first()["r2"] == 1.0


def test_corr_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (float("nan"), 1.0)], "`a|b` double, c double")
    assert [tuple(r) for r in distributions.pairwise_corr(df, ["a|b", "c"]).collect()] == [("a|b", "c", 1.0)]


def test_bins_are_those_of_the_library_histogram(spark):
    rng = np.random.default_rng(7)
    for values, bins in ((np.arange(11) / 10, 10), (np.round(rng.random(400), 2), 30), (np.arange(50) * 0.7, 7)):
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        got = [r["n"] for r in distributions.histogram(df, "x", bins).orderBy("bin").collect()]
        assert got == np.histogram(values, bins)[0].tolist()


def test_logistic_with_three_classes(spark):
    from tessera.operators import models
    rng = np.random.default_rng(1)
    rows = [(float(rng.normal(c * 3, 0.3)), float(rng.normal(-c, 0.3)), c) for c in (0, 1, 2) for _ in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    fit = models.fit_logistic(df, ["a", "b"], "y")
    assert fit.predict(df).where("prediction = y").count() == 120
    table = fit.coefficient_table(spark)
    assert table.count() == 6 and table.columns == ["class", "feature", "coefficient"]


def test_split_with_many_classes_shuffles_no_rows_but_the_boundary_ones(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 1000).alias("c"))
    out = split.stratified_split(df, "c", "k", 0.2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 1 and "SortMergeJoin" not in plan
    # the only hash exchange is under the rank of the boundary buckets
    assert plan.count("Exchange hashpartitioning") <= 1
    assert out.where("split = 'test'").count() == 4000 and out.count() == 20_000


def test_medians_of_several_columns_share_passes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4001, 3)).round(2)
    rows = [(float(a), None if b > 1 else float(b), 7.0) for a, b, _ in x]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    want = {"a": np.median(x[:, 0]), "b": np.median([b for _, b, _ in rows if b is not None]), "c": 7.0}
    assert features.fit_imputer(df, median=["a", "b", "c"]).fills == pytest.approx(want, abs=1e-12)
    # brackets that miss the middle are widened until they hold it
    monkeypatch.setattr(features, "MEDIAN_BRACKETS", ((0.9, 0.95), (0.0, 0.1)))
    assert features.fit_imputer(df, median=["a", "b", "c"]).fills == pytest.approx(want, abs=1e-12)
    none = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert features.fit_imputer(none, median=["a", "b"]).fills == {"a": None, "b": 1.0}


def test_strict_encoder_takes_missing_as_a_category(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    hot = features.fit_one_hot(df, ["c"], strict=True)
    got = {tuple(r) for r in hot.transform(df).collect()}
    assert hot.output_names() == ["c_b", "c_None"] and got == {(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)}
    with pytest.raises(ValueError, match="unknown"):
        features.fit_one_hot(df.where("c IS NOT NULL"), ["c"], strict=True).transform(df)
