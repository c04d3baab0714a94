"""Registered queries: every operator bound to the driver tables.

Each entry is ``(spark, data_dir) -> DataFrame``. Computed columns carry the
same names as in ``plans.oracle`` so results can be compared by name;
floating results are rounded (and negative zero cleared) for cross-engine
hashing.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import decode_codes, rounded, strip_lower, value_map
from tessera.operators import (chained, distributions, evaluate, features, keyed, missing, models,
                               quality, reports, sketches, sparse, split)
from tessera.plans.bindings import (ORDER_BY, ORDER_KEY, SHEET_BANDS, SHEET_ITEMS, SHEET_UNKNOWN,
                                    item_sheet, order_loads, scored_labels, sparse_lines, tables)
from tessera.session import scratch_dir, scratch_path
from tessera.sources import catalog, constraints, files
from tessera.sources.tables import register_views

Query = Callable[[SparkSession, str], DataFrame]

PRICE_THRESHOLD = 100000.0
VALUE_THRESHOLD = 50.0
ITEM_COLS = [f"item_{k}" for k in range(1, SHEET_ITEMS + 1)]


# ------------------------------------------------------------- sources, catalog

def q_seq_squares(spark: SparkSession, d: str) -> DataFrame:
    """The order keys and their squares (sequence + per-element expression)."""
    return reports.squares(tables(spark, d, "orders"), "o_orderkey")


CUSTOMER_SCHEMA = T.StructType([
    # declared in another order than the file: binding is by name
    T.StructField("c_name", T.StringType()),
    T.StructField("c_custkey", T.LongType(), False),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_mktsegment", T.StringType()),
])

PART_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType(), False),
    T.StructField("p_retailprice", T.DoubleType()),
    T.StructField("p_name", T.StringType()),
    T.StructField("p_brand", T.StringType()),
    T.StructField("p_type", T.StringType()),
    T.StructField("p_size", T.IntegerType()),
])


def q_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """customer written as CSV, read back by name with declared types."""
    path = scratch_path(spark, "csv-customer")
    files.write_csv(tables(spark, d, "customer"), path)
    return files.read_csv_typed(spark, path, CUSTOMER_SCHEMA, required=["c_custkey", "c_name"])


def q_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """part written as JSON lines, read back by name with declared types."""
    path = scratch_path(spark, "json-part")
    files.write_json(tables(spark, d, "part"), path)
    return files.read_json_typed(spark, path, PART_SCHEMA, required=["p_partkey"])


DOC_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("lang", T.StringType()),
])


def q_csv_split_scan(spark: SparkSession, d: str) -> DataFrame:
    """documents (texts with quotes and line breaks) as quoted CSV, read back by many tasks a file."""
    path = scratch_path(spark, "csv-documents")
    files.write_csv(tables(spark, d, "documents").select("doc_id", "text", "lang", "source"), path, quote_all=True)
    return files.read_csv_typed(spark, path, DOC_SCHEMA, required=["doc_id"], multiline="split", missing=("",))


def q_json_columns(spark: SparkSession, d: str) -> DataFrame:
    """part written as column-oriented JSON, read back by name with declared types."""
    path = scratch_path(spark, "json-columns")
    part = tables(spark, d, "part").select([f.name for f in PART_SCHEMA.fields])
    files.write_json_columns(part.withColumn("row", F.col("p_partkey")), path, "row")
    return files.read_json_columns(spark, path, PART_SCHEMA, required=["p_partkey"])


REJECT_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType(), False),
    T.StructField("c_name", T.IntegerType()),           # text: every value is a reject
    T.StructField("c_acctbal", T.IntegerType()),        # only whole amounts fit
    T.StructField("c_nationkey", T.IntegerType()),
])


def q_csv_rejects(spark: SparkSession, d: str) -> DataFrame:
    """customer written as CSV and read with types that do not fit: rejects per field."""
    path = scratch_path(spark, "csv-rejects")
    files.write_csv(tables(spark, d, "customer"), path)
    return files.cast_rejects(spark, path, REJECT_SCHEMA)


def q_named_load(spark: SparkSession, d: str) -> DataFrame:
    """A dataset resolved by name (catalog table, else Parquet under the data directory)."""
    return catalog.load_named(spark, "nation", d)


def q_table_profile(spark: SparkSession, d: str) -> DataFrame:
    """Every table's row count with its columns, their order and types."""
    return catalog.table_profile(spark, d).join(F.broadcast(catalog.table_columns(spark, d)), "table")


# ----------------------------------------------------------------- keyed loads

def _loads(spark: SparkSession, d: str):
    base_raw, inc_raw = order_loads(tables(spark, d, "orders"))
    base = keyed.dedup_keep_last(base_raw, ORDER_KEY, ORDER_BY)
    inc = keyed.dedup_keep_last(inc_raw, ORDER_KEY, ORDER_BY)
    return base_raw, inc_raw, base, inc


def q_dedup_keep_last(spark: SparkSession, d: str) -> DataFrame:
    return keyed.dedup_keep_last(tables(spark, d, "events"), "user_id", "event_id")


def q_upsert_by_key(spark: SparkSession, d: str) -> DataFrame:
    _, _, base, inc = _loads(spark, d)
    return keyed.upsert(base, inc, ORDER_KEY)


def q_upsert_bloom(spark: SparkSession, d: str) -> DataFrame:
    """The same upsert, shuffling only stored rows that a Bloom filter of the incoming keys lets through."""
    _, _, base, inc = _loads(spark, d)
    return keyed.upsert_bloom(base, inc, ORDER_KEY)


DOC_RULES = constraints.Constraints(not_null=("lang",), key=("source", "n_chars"), references=(
    constraints.Reference(("doc_id",), "labels", ("doc_id",)),))


def q_constraint_violations(spark: SparkSession, d: str) -> DataFrame:
    """Documents in English or of no language as a load against the others: NULL
    languages, taken keys (a source and a length) and documents without a label."""
    docs, labels = tables(spark, d, "documents", "labels")
    english = F.coalesce(F.col("lang") == "en", F.lit(True))
    return constraints.violations(docs.where(english), DOC_RULES, docs.where(~english), {"labels": labels})


def q_upsert_counters(spark: SparkSession, d: str) -> DataFrame:
    _, inc_raw, base, _inc = _loads(spark, d)
    return keyed.upsert_counters(inc_raw, base, ORDER_KEY)


def q_stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The two order loads arrive as files; a Structured Streaming query
    upserts each micro-batch into a versioned table. Equals upsert_by_key."""
    from tessera.streaming.ingest import run_upsert_stream
    base_raw, inc_raw = order_loads(tables(spark, d, "orders"))
    return run_upsert_stream(spark, [base_raw, inc_raw], ORDER_KEY, ORDER_BY)


def _wide_keys(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a 64-bit key past 2^53, NULL where the document has no label."""
    docs, labels = tables(spark, d, "documents", "labels")
    wide = labels.select(F.col("doc_id").alias("id"), (F.col("doc_id") + F.lit(2 ** 53)).alias("wide"))
    return docs.join(wide, F.col("doc_id") == F.col("id"), "left").select("wide", "lang", "n_chars", "doc_id")


def q_upsert_wide_keys(spark: SparkSession, d: str) -> DataFrame:
    """Upsert by a composite key with a part past 2^53 or NULL."""
    rows = _wide_keys(spark, d)
    key = ["wide", "lang"]
    base = keyed.dedup_keep_last(rows.where("n_chars < 2000"), key, "doc_id")
    return keyed.upsert(base, keyed.dedup_keep_last(rows.where("n_chars >= 1000"), key, "doc_id"), key)


def q_group_mean_wide_keys(spark: SparkSession, d: str) -> DataFrame:
    """Group means on every row for a key past 2^53 that may be NULL."""
    return reports.group_mean_rows(_wide_keys(spark, d), "wide", "n_chars")


# -------------------------------------------------------------------- quality

def q_key_set_compare(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = tables(spark, d, "documents", "labels")
    return quality.key_set_compare(docs, labels, "doc_id")


def q_orphan_rows(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = tables(spark, d, "documents", "labels")
    return quality.orphan_rows(docs, labels, "doc_id")


def q_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_keys(tables(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_null_violations(spark: SparkSession, d: str) -> DataFrame:
    return quality.null_violations(sparse_lines(tables(spark, d, "lineitem")),
                                   ["row_id", "value", "category", "note"])


# -------------------------------------------------------------------- reports

def q_sorted_desc(spark: SparkSession, d: str) -> DataFrame:
    return reports.sorted_desc(tables(spark, d, "events"), "value")


def q_topk(spark: SparkSession, d: str) -> DataFrame:
    ev = tables(spark, d, "events")
    return reports.top_k(ev, [F.col("value").desc(), F.col("event_id").asc()], 10,
                         ["event_id", "event_type", "value"])


def q_group_mean_rows(spark: SparkSession, d: str) -> DataFrame:
    out = reports.group_mean_rows(tables(spark, d, "events"), "event_type", "value")
    return out.withColumn("group_avg", rounded("group_avg"))


def q_filtered_group_count(spark: SparkSession, d: str) -> DataFrame:
    return reports.filtered_group_count(tables(spark, d, "events"), "event_type",
                                        F.col("value") > F.lit(VALUE_THRESHOLD))


def q_filtered_group_count2(spark: SparkSession, d: str) -> DataFrame:
    o = tables(spark, d, "orders")
    return reports.filtered_group_count(
        o, "o_orderpriority",
        (F.col("o_totalprice") > F.lit(PRICE_THRESHOLD)) & (F.col("o_orderstatus") == F.lit("F")))


def q_sql_call(spark: SparkSession, d: str) -> DataFrame:
    """Generic SQL call with bound positional parameters."""
    register_views(spark, d, ["orders"])
    return reports.run_sql(
        spark,
        "SELECT o_orderpriority, COUNT(*) AS count FROM orders "
        "WHERE o_totalprice > ? AND o_orderstatus = ? GROUP BY o_orderpriority",
        (PRICE_THRESHOLD, "F"))


def q_conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    o = tables(spark, d, "orders")
    over = F.col("o_totalprice") > F.lit(PRICE_THRESHOLD)
    flagged = F.col("o_orderstatus") == F.lit("F")
    return reports.conditional_counts(o, "o_orderpriority", {
        "price_over": over, "status_f": flagged, "price_over_status_f": over & flagged})


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return reports.item_scores(item_sheet(tables(spark, d, "lineitem")), "subject_id", ITEM_COLS,
                               SHEET_BANDS, SHEET_UNKNOWN)


def q_item_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d)


def q_band_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.band_counts(_scores(spark, d))


def q_band_order(spark: SparkSession, d: str) -> DataFrame:
    return reports.band_order(_scores(spark, d), "total_score", SHEET_BANDS)


def q_share_table(spark: SparkSession, d: str) -> DataFrame:
    return reports.share_table(tables(spark, d, "events"), "event_type",
                               F.col("value") > F.lit(VALUE_THRESHOLD))


# ------------------------------------------------------------ scalar functions

PRIORITY_LABELS = {"1-urgent": "urgent", "2-high": "high"}


def q_value_map(spark: SparkSession, d: str) -> DataFrame:
    o = tables(spark, d, "orders")
    return o.select("o_orderkey", value_map(strip_lower("o_orderpriority"), PRIORITY_LABELS)
                    .alias("priority_label"))


def q_decode_labels(spark: SparkSession, d: str) -> DataFrame:
    lab = tables(spark, d, "labels")
    return lab.select("doc_id", decode_codes("toxic", ["clean", "toxic"]).alias("toxic_label"))


# ------------------------------------------------------------ missing values

GAP_COLS = ["value", "category", "note"]


def _gaps(spark: SparkSession, d: str) -> DataFrame:
    return sparse_lines(tables(spark, d, "lineitem"))


def q_missing_counts(spark: SparkSession, d: str) -> DataFrame:
    return missing.missing_counts(_gaps(spark, d), GAP_COLS)


def q_missing_bars(spark: SparkSession, d: str) -> DataFrame:
    return missing.missing_bars(_gaps(spark, d), GAP_COLS + ["n_lines"])


def q_missing_totals(spark: SparkSession, d: str) -> DataFrame:
    return missing.missing_totals(_gaps(spark, d), GAP_COLS)


def q_impute_all(spark: SparkSession, d: str) -> DataFrame:
    g = _gaps(spark, d).select("row_id", *GAP_COLS)
    imp = features.fit_imputer(g, median=["value"], most_frequent_cols=["category"],
                               constant={"note": "Unknown"})
    return imp.transform(g).withColumn("value", rounded("value"))


def q_impute_mean(spark: SparkSession, d: str) -> DataFrame:
    g = _gaps(spark, d).select("row_id", "value")
    return features.fit_imputer(g, mean=["value"]).transform(g).withColumn("value", rounded("value"))


def q_mode_by_sketch(spark: SparkSession, d: str) -> DataFrame:
    """Most frequent values from frequent-items sketches and an exact count of their candidates."""
    found = sketches.modes(tables(spark, d, "lineitem"), ["l_returnflag", "l_linestatus", "l_quantity", "l_partkey"])
    return spark.createDataFrame([(c, str(v)) for c, v in found.items()], "column string, mode string")


def q_median_from_sketches(spark: SparkSession, d: str) -> DataFrame:
    """Medians merged from sketches stored per load: do their ranks lie within the stated error?"""
    li = tables(spark, d, "lineitem").select("l_linenumber", "l_quantity", "l_extendedprice")
    path = scratch_path(spark, "quantile-sketches")
    cols = ["l_quantity", "l_extendedprice"]
    sketches.quantile_sketches(li, "l_linenumber", cols).write.parquet(path)
    got = {r["column"]: r for r in sketches.merged_quantiles(spark.read.parquet(path)).collect()}
    long = li.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), (F.col(c) < got[c]["value"]).cast("long").alias("below"),
        (F.col(c) <= got[c]["value"]).cast("long").alias("upto")) for c in cols])))
    off = 0.5 * F.count(F.lit(1))
    err = got[cols[0]]["rank_error"] * F.count(F.lit(1))
    return long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), (
        (F.sum("below") <= off + err) & (F.sum("upto") >= off - err)).alias("within_error"))


def q_regression_impute(spark: SparkSession, d: str) -> DataFrame:
    g = _gaps(spark, d).select("row_id", "value", "total_qty")
    out = models.regression_impute(g, "value", ["total_qty"])
    return out.select("row_id", rounded("value").alias("value"))


def q_chained_impute(spark: SparkSession, d: str) -> DataFrame:
    """Quantities of lines 2 and 4 of each order, gaps filled in three rounds of
    regressions on each other and on the return flag of line 3 (which has gaps too)."""
    line = F.col("l_linenumber")
    g = tables(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("row_id")).agg(
        F.max(F.when(line == 2, F.col("l_quantity"))).alias("second"),
        F.max(F.when(line == 4, F.col("l_quantity"))).alias("fourth"),
        F.max(F.when(line == 3, F.col("l_returnflag"))).alias("flag"))
    out = chained.chained_impute(g, ["second", "fourth"], ["flag"], rounds=3)
    return out.select("row_id", rounded("second", 4).alias("second"), rounded("fourth", 4).alias("fourth"), "flag")


def q_label_cast(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = tables(spark, d, "documents", "labels")
    j = docs.select("doc_id").join(labels.select("doc_id", "quality"), "doc_id", "left")
    return j.select("doc_id", features.prepare_label("quality", 0).alias("label"))


# ------------------------------------------------------------------ features

def q_standard_scale(spark: SparkSession, d: str) -> DataFrame:
    ev = tables(spark, d, "events").select("event_id", "value")
    sc = features.fit_scaler(ev, ["value"])
    return ev.select("event_id", rounded(sc.column("value")).alias("value_scaled"))


def _round_features(df: DataFrame, keep) -> DataFrame:
    return df.select(*keep, *[rounded(c).alias(c) for c in df.columns if c not in keep])


def q_one_hot(spark: SparkSession, d: str) -> DataFrame:
    ev = tables(spark, d, "events").select("event_id", "event_type")
    oh = features.fit_one_hot(ev, ["event_type"])
    return oh.transform(ev, keep=["event_id"])


def q_one_hot_sparse(spark: SparkSession, d: str) -> DataFrame:
    """Index arrays of the customer (a category a customer) and the priority of every order."""
    orders = tables(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    out = sparse.fit_sparse_one_hot(orders, ["o_custkey", "o_orderpriority"]).transform(orders, keep=["o_orderkey"])
    return out.select("o_orderkey", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"))


def _fit_without_view(ev: DataFrame, strict: bool):
    return features.fit_one_hot(ev.where(F.col("event_type") != F.lit("view")), ["event_type"],
                                strict=strict)


def q_one_hot_unknown(spark: SparkSession, d: str) -> DataFrame:
    ev = tables(spark, d, "events").select("event_id", "event_type")
    return _fit_without_view(ev, strict=False).transform(ev, keep=["event_id"])


def q_one_hot_strict(spark: SparkSession, d: str) -> DataFrame:
    """The strict encoder refuses this input; these are the values that make it raise."""
    ev = tables(spark, d, "events").select("event_id", "event_type")
    return _fit_without_view(ev, strict=True).unseen(ev)


def q_preprocess(spark: SparkSession, d: str) -> DataFrame:
    g = _gaps(spark, d).select("row_id", *GAP_COLS)
    pre = features.fit_preprocessor(g, numeric=["value"], cat_freq=["category"], cat_const=["note"],
                                    keep=["row_id"])
    return _round_features(pre.transform(g), ["row_id"])


def q_preprocess_strict(spark: SparkSession, d: str) -> DataFrame:
    p = tables(spark, d, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    pre = features.fit_preprocessor(p, numeric=["p_size", "p_retailprice"], cat_freq=["p_type"],
                                    keep=["p_partkey"], impute=False, strict=True)
    return _round_features(pre.transform(p), ["p_partkey"])


def q_stratified_split(spark: SparkSession, d: str) -> DataFrame:
    ev = tables(spark, d, "events").select("event_id", "event_type")
    return split.stratified_split(ev, "event_type", "event_id", test_size=0.2, seed=42)


# --------------------------------------------------------- models, evaluation

def _scored(spark: SparkSession, d: str) -> DataFrame:
    labels, docs = tables(spark, d, "labels", "documents")
    return scored_labels(labels, docs)


def q_confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.confusion_matrix(_scored(spark, d), "y", "yhat")


def q_classification_report(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.classification_report(evaluate.confusion_matrix(_scored(spark, d), "y", "yhat"))


def q_roc_points(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.roc_points(_scored(spark, d), "y", "score")


def q_roc_vertices(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.roc_vertices(_scored(spark, d), "y", "score")


def q_roc_auc(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.roc_auc(_scored(spark, d), "y", "score")


def q_linreg_fit(spark: SparkSession, d: str) -> DataFrame:
    li = tables(spark, d, "lineitem")
    fit = models.fit_linear(li, ["l_quantity", "l_discount"], "l_extendedprice")
    row = [(round(fit.intercept, 3) + 0.0, round(fit.coefficients[0], 4) + 0.0,
            round(fit.coefficients[1], 3) + 0.0)]
    return spark.createDataFrame(row, "intercept double, coef_quantity double, coef_discount double")


def q_linreg_metrics(spark: SparkSession, d: str) -> DataFrame:
    li = tables(spark, d, "lineitem").select("l_quantity", "l_extendedprice")
    fit = models.fit_linear(li, ["l_quantity"], "l_extendedprice")
    pred = fit.predict(li)
    m = evaluate.regression_metrics(pred, "l_extendedprice", "prediction", digits=12)
    return m.select(rounded("mse", 2).alias("mse"), rounded("r2", 6).alias("r2"))


def q_predictions_head(spark: SparkSession, d: str) -> DataFrame:
    p = tables(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    fit = models.fit_linear(p, ["p_size"], "p_retailprice")
    return evaluate.predictions_head(fit.predict(p), "p_partkey", "p_retailprice", "prediction", 20)


def q_logreg_fit(spark: SparkSession, d: str) -> DataFrame:
    """Documents' quality from length, language and source: split on the
    label, preprocess fitted on the train rows only, logistic regression on
    the train rows; coefficient table ordered by magnitude."""
    labels, docs = tables(spark, d, "labels", "documents")
    data = labels.select("doc_id", "quality").join(docs.select("doc_id", "n_chars", "lang", "source"),
                                                   "doc_id")
    data = data.withColumn("n_chars", F.col("n_chars").cast("double"))
    parts = split.stratified_split(data, "quality", "doc_id", test_size=0.2, seed=42)
    # several fit passes follow: cut the lineage once (shared checkpoint folder)
    scratch_dir(spark)
    train = parts.where(F.col("split") == "train").checkpoint(eager=True)
    pre = features.fit_preprocessor(train, numeric=["n_chars"], cat_freq=["lang"],
                                    cat_const=["source"], keep=["doc_id", "quality"])
    prepared = pre.transform(train)
    fit = models.fit_logistic(prepared, pre.feature_names(), "quality", cut_lineage=False)
    rows = [(f, float(w)) for f, w in zip(fit.features, fit.coefficients)] + \
           [("intercept", float(fit.intercept))]
    return (spark.createDataFrame(rows, "feature string, coefficient double")
            .select("feature", rounded("coefficient", 6).alias("coefficient"))
            .orderBy(F.abs("coefficient"), "feature"))


def q_logreg_coefficients(spark: SparkSession, d: str) -> DataFrame:
    """Quality from the standardised length: the fitted coefficients by magnitude."""
    labels, docs = tables(spark, d, "labels", "documents")
    data = labels.select("doc_id", "quality").join(docs.select("doc_id", F.col("n_chars").cast("double")), "doc_id")
    fit = models.fit_logistic(features.fit_scaler(data, ["n_chars"]).transform(data), ["n_chars"], "quality")
    rows = fit.coefficient_table(spark).unionByName(
        spark.createDataFrame([("intercept", fit.intercept)], "feature string, coefficient double"))
    return rows.select("feature", rounded("coefficient", 5).alias("coefficient")).orderBy(F.abs("coefficient"), "feature")


def q_logreg_report(spark: SparkSession, d: str) -> DataFrame:
    """The model script end to end on labelled documents: exact stratified
    split, preprocessing fitted on the train rows, logistic regression,
    predictions on the test rows, and their classification report."""
    from tessera.apps.tabular_ml import classification_flow
    labels, docs = tables(spark, d, "labels", "documents")
    data = docs.join(labels.select("doc_id", "quality"), "doc_id").select(
        "doc_id", "quality", F.col("n_chars").cast("double").alias("n_chars"), "lang", "source")
    return classification_flow(data, "doc_id", "quality", ["n_chars"], ["lang"], ["source"]).report


# -------------------------------------------------------------- distributions

def q_histogram(spark: SparkSession, d: str) -> DataFrame:
    return distributions.histogram(tables(spark, d, "events"), "value", 30)


def q_histogram_by_group(spark: SparkSession, d: str) -> DataFrame:
    return distributions.histogram_by_group(tables(spark, d, "events"), "event_type", "value", 30)


def q_histogram_stacked(spark: SparkSession, d: str) -> DataFrame:
    return distributions.histogram_stacked(tables(spark, d, "events"), "event_type", "value", 30)


def q_histogram_facets(spark: SparkSession, d: str) -> DataFrame:
    order = [label for _lo, _hi, label in SHEET_BANDS]
    return distributions.histogram_facets(_scores(spark, d), "category", "total_score", order, 15)


def q_label_histograms(spark: SparkSession, d: str) -> DataFrame:
    """Pair-plot diagonal: per feature, a stacked histogram by decoded label."""
    labels, docs = tables(spark, d, "labels", "documents")
    data = labels.join(docs.select("doc_id", "n_chars"), "doc_id").select(
        decode_codes("quality", ["low", "high"]).alias("label"),
        F.col("n_chars").cast("double").alias("n_chars"))
    return distributions.share_by_label(data, "label", ["n_chars"], 30)


def q_density_2d(spark: SparkSession, d: str) -> DataFrame:
    return distributions.density_2d(tables(spark, d, "lineitem"), "l_quantity", "l_extendedprice",
                                    "l_returnflag", 20, 20)


def _line_features(spark: SparkSession, d: str) -> DataFrame:
    return tables(spark, d, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice", "l_discount")


def q_pair_density(spark: SparkSession, d: str) -> DataFrame:
    """Pair-plot panels: every pair of features binned by label in one scan."""
    return distributions.pair_density(_line_features(spark, d), "l_returnflag", ["l_quantity", "l_extendedprice", "l_discount"], 20)


def q_kde_by_label(spark: SparkSession, d: str) -> DataFrame:
    """Pair-plot diagonal as Gaussian densities per label."""
    return distributions.kde_by_label(_line_features(spark, d), "l_returnflag", ["l_quantity", "l_discount"], 32, 4)


def q_hash_sample(spark: SparkSession, d: str) -> DataFrame:
    ev = tables(spark, d, "events").select("event_id", "event_type", "value")
    return distributions.hash_sample(ev, "event_id", 100, 42)


def q_hash_sample_by_group(spark: SparkSession, d: str) -> DataFrame:
    ev = tables(spark, d, "events").select("event_id", "event_type", "value")
    return distributions.hash_sample_by_group(ev, "event_type", "event_id", 25, 42)


def q_pairwise_corr(spark: SparkSession, d: str) -> DataFrame:
    return distributions.pairwise_corr(tables(spark, d, "lineitem"),
                                       ["l_quantity", "l_extendedprice", "l_discount"])


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
