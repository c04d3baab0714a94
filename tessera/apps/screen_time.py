"""The survey application: two CSV files -> typed keyed tables with upsert ->
fixed reports -> chart tables.

Tables live as versioned Parquet folders (``<root>/<table>/v<n>`` plus a
manifest of committed versions): a load writes a new version and never
overwrites the one it reads. Every step
is an operator from ``tessera.operators``; this module binds them to the
survey's column names and thresholds.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import BDI_BANDS, BDI_UNKNOWN, strip_lower, value_map
from tessera.operators import distributions, keyed, quality, reports
from tessera.plans.strategy import checkpointed
from tessera.sources import files

# Table names, declared columns and types of the two survey tables.
SCREEN_TIME = "screen_time"
BDI_ITEMS = "bdi_screen_items"
SCREEN_TIME_SCHEMA = T.StructType([
    T.StructField("subject_id", T.LongType(), False),
    T.StructField("sex", T.StringType(), False),
    T.StructField("screen_time_index", T.DoubleType()),
    T.StructField("est_leisure_screen_hours", T.DoubleType()),
    T.StructField("sleep_quality_index", T.DoubleType()),
    T.StructField("avg_sleep_hours", T.DoubleType()),
    T.StructField("midsleep_weekend_hours", T.DoubleType()),
    T.StructField("social_jetlag_hours", T.DoubleType()),
    T.StructField("bdi_total", T.IntegerType()),
    T.StructField("depressed", T.IntegerType()),
])
SCREEN_ITEMS = ["screen_normal_day_1to6", "screen_weekday_1to6", "screen_weekend_1to6",
                "sqi_fall_asleep_1to6", "sqi_repeated_awake_1to6", "sqi_disturbed_1to6",
                "sqi_early_awake_1to6"]
BDI_ITEM_COLS = [f"bdi_item_{k:02d}" for k in range(1, 22)]
BDI_ITEMS_SCHEMA = T.StructType(
    [T.StructField("subject_id", T.LongType(), False)]
    + [T.StructField(c, T.IntegerType()) for c in SCREEN_ITEMS + BDI_ITEM_COLS])
# Report parameters and chart labels.
SCREEN_HOURS = 5
DEPRESSED_FLAG = 1
SLEEP_REFERENCE_HOURS = 9
SEX_LABELS = {"girl": "Дзяўчаты", "boy": "Хлопцы"}


# ---------------------------------------------------------------- storage

def read_current(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """Latest committed version of a table, or an empty typed table."""
    from tessera.streaming.ingest import latest_version
    return latest_version(spark, f"{root.rstrip('/')}/{table}", schema)


def tables_exist(spark: SparkSession, root: str) -> bool:
    from tessera.streaming.ingest import newest_version
    return all(newest_version(spark, f"{root.rstrip('/')}/{t}") is not None for t in (SCREEN_TIME, BDI_ITEMS))


def _write_next(spark: SparkSession, root: str, table: str, df: DataFrame) -> int:
    from tessera.streaming.ingest import commit_version
    return commit_version(spark, f"{root.rstrip('/')}/{table}", df, ["subject_id"])


# ------------------------------------------------------------------- load

def _with_order(df: DataFrame, order_col: str | None) -> tuple[DataFrame, str]:
    return (df, order_col) if order_col else (df, "_row")


def _read(spark, path, schema, required, order_col):
    """The typed rows, parsed once (a checkpoint), and the reject counts."""
    ext = schema
    if order_col:
        ext = T.StructType(schema.fields + [T.StructField(order_col, T.LongType(), False)])
        required = list(required) + [order_col]
    df = files.read_csv_typed(spark, path, ext, required=required, rejects="_rejects")
    if not order_col:
        # file order of a single input file: row ids grow with the byte offset
        if len(spark.read.text(path).inputFiles()) > 1:          # file listing only, no scan
            raise ValueError("several input files: pass order_col to define which row is last")
        df = df.withColumn("_row", F.monotonically_increasing_id())
    df = checkpointed(df)
    bad = df.select(F.explode("_rejects").alias("c")).groupBy("c").count().collect()     # one row a column
    return df.drop("_rejects"), {r["c"]: r["count"] for r in bad}


def _prepare(spark, root, table, schema, raw, key, order_col, force):
    """The upserted next version of one table (lazy) and its load counters.
    Raises on a NULL in a column declared NOT NULL; afterwards keys are unique
    by construction (keep-last, then upsert)."""
    raw, order = _with_order(raw, order_col)
    quality.assert_not_null(raw, [f.name for f in schema.fields if not f.nullable])
    incoming = keyed.dedup_keep_last(raw, key, order).select(*schema.fieldNames())
    base = spark.createDataFrame([], schema) if force else read_current(spark, root, table, schema)
    counters = keyed.upsert_counters(raw, base, key).first().asDict()
    return keyed.upsert(base, incoming, key), counters


def import_csv(spark: SparkSession, screen_csv: str, items_csv: str, root: str,
               order_col: str | None = None, force: bool = False,
               check_foreign_key: bool = True) -> dict:
    """Load both CSV files into the keyed tables under ``root``.

    Columns bind by name with the declared types; duplicates keep the last
    row per ``subject_id``; each table is upserted (an incoming NULL replaces a
    stored value) into a new version; ``force`` starts from empty tables.
    Item rows whose subject has no ``screen_time`` row violate the foreign
    key: this is checked on the would-be versions, before anything is
    written, and raises. So does a NULL in a NOT NULL column. Labels of ``sex``
    are normalised here (white space, letter case), once. Each file is parsed
    once, into a checkpoint. Returns the key-set comparison, the counters of
    both tables, and how many present values each optional column rejected.
    """
    screen_raw, screen_rejects = _read(spark, screen_csv, SCREEN_TIME_SCHEMA, ["subject_id", "sex"], order_col)
    items_raw, items_rejects = _read(spark, items_csv, BDI_ITEMS_SCHEMA, ["subject_id"], order_col)
    screen_raw = screen_raw.withColumn("sex", strip_lower("sex"))
    keys = quality.key_set_compare(screen_raw, items_raw, "subject_id").first().asDict()
    out = {"key_sets": keys, "rejects": {SCREEN_TIME: screen_rejects, BDI_ITEMS: items_rejects}}
    new_screen, out[SCREEN_TIME] = _prepare(spark, root, SCREEN_TIME, SCREEN_TIME_SCHEMA, screen_raw,
                                            "subject_id", order_col, force)
    new_items, out[BDI_ITEMS] = _prepare(spark, root, BDI_ITEMS, BDI_ITEMS_SCHEMA, items_raw,
                                         "subject_id", order_col, force)
    for df in (new_screen, new_items):
        quality.assert_unique(df, "subject_id")
    if check_foreign_key:
        orphans = quality.orphan_rows(new_items.select("subject_id"), new_screen, "subject_id") \
            .limit(5).collect()
        if orphans:
            raise ValueError(f"foreign key violated by subject_id {[r[0] for r in orphans]}")
    _write_next(spark, root, SCREEN_TIME, new_screen)
    _write_next(spark, root, BDI_ITEMS, new_items)
    return out


def table_info(spark: SparkSession, root: str) -> DataFrame:
    """``(table, rows, columns)`` of the two current tables."""
    parts = []
    for t, schema in ((SCREEN_TIME, SCREEN_TIME_SCHEMA), (BDI_ITEMS, BDI_ITEMS_SCHEMA)):
        df = read_current(spark, root, t, schema)
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(t).alias("table"), "rows", F.lit(cols).alias("columns")))
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------- reports

def screen(st: DataFrame) -> DataFrame:
    return reports.sorted_desc(st, "est_leisure_screen_hours")


def sleep(st: DataFrame) -> DataFrame:
    return reports.sorted_desc(st, "avg_sleep_hours")


def screen_time_by_gender(st: DataFrame) -> DataFrame:
    return reports.group_mean_rows(st, "sex", "est_leisure_screen_hours", "gender_avg")


def _over(hours) -> Column:
    return F.col("est_leisure_screen_hours") > F.lit(hours)


def _flag(flag) -> Column:
    return F.col("depressed") >= F.lit(flag)


def screen_by_sex_over_hours(st: DataFrame, hours=SCREEN_HOURS) -> DataFrame:
    return reports.filtered_group_count(st, "sex", _over(hours))


def screen_by_sex_over_hours_depressed(st: DataFrame, hours=SCREEN_HOURS, flag=DEPRESSED_FLAG) -> DataFrame:
    return reports.filtered_group_count(st, "sex", _over(hours) & _flag(flag))


def screen_and_depression_stats(st: DataFrame, hours=SCREEN_HOURS, flag=DEPRESSED_FLAG) -> DataFrame:
    return reports.conditional_counts(st, "sex", {
        "screen_over_5": _over(hours), "depressed": _flag(flag),
        "depressed_screen_over_5": _over(hours) & _flag(flag)})


def bdi_with_categories(items: DataFrame, min_answered: int | None = None) -> DataFrame:
    return reports.item_scores(items, "subject_id", BDI_ITEM_COLS, BDI_BANDS, BDI_UNKNOWN,
                               score="total_score", category="depression_category",
                               min_answered=min_answered)


def depression_stats(items: DataFrame) -> DataFrame:
    return reports.band_counts(bdi_with_categories(items), "depression_category", "count_teenagers")


def execute(spark: SparkSession, sql: str, params: Sequence = ()) -> DataFrame:
    return reports.run_sql(spark, sql, params)


# ------------------------------------------------------------ chart tables

def sex_label(c: str | Column = "sex") -> Column:
    return value_map(strip_lower(c), SEX_LABELS)


def leisure_histogram(by_gender: DataFrame, bins: int = 30) -> tuple[DataFrame, DataFrame]:
    """Per-sex histograms of leisure screen hours (own edges per sex) and the
    per-sex mean lines."""
    df = by_gender.select(sex_label().alias("sex"), "est_leisure_screen_hours")
    hist = distributions.histogram_by_group(df, "sex", "est_leisure_screen_hours", bins)
    return hist, reports.group_means(df, "sex", "est_leisure_screen_hours", "mean")


def screen_bars(stats: DataFrame) -> DataFrame:
    """Layered bar data: total, over, flagged and both per (relabelled) sex."""
    return stats.withColumn("sex", sex_label())


def screen_donut(counts: DataFrame) -> DataFrame:
    """Share of each sex among those over the threshold, with the total."""
    relabelled = counts.withColumn("sex", sex_label()).groupBy("sex").agg(F.sum("count").alias("count"))
    return reports.shares(relabelled, "count")


def sleep_histogram(st: DataFrame, bins: int = 30) -> DataFrame:
    return distributions.histogram(st, "avg_sleep_hours", bins) \
        .withColumn("reference_hours", F.lit(float(SLEEP_REFERENCE_HOURS)))


def bdi_stacked(scored: DataFrame, bins: int = 30) -> DataFrame:
    order = [b[2] for b in BDI_BANDS]
    pos = scored.sparkSession.createDataFrame([(v, i) for i, v in enumerate(order, 1)],
                                              "depression_category string, position int")
    present = scored.join(F.broadcast(pos), "depression_category", "left_semi")
    return distributions.histogram_stacked(present, "depression_category", "total_score", bins) \
        .join(F.broadcast(pos), "depression_category")


def bdi_facets(scored: DataFrame, bins: int = 15) -> DataFrame:
    return distributions.histogram_facets(scored, "depression_category", "total_score",
                                          [b[2] for b in BDI_BANDS], bins)


# ------------------------------------------------------------------- main

def run(spark: SparkSession, screen_csv: str, items_csv: str, root: str, out_dir: str,
        force: bool = False, heads: int = 3) -> dict:
    """The whole application: load both files, run the reports, print their
    first rows, and write every chart table as Parquet under ``out_dir``."""
    loaded = import_csv(spark, screen_csv, items_csv, root, force=force)
    print("loaded:", loaded)
    table_info(spark, root).show(truncate=False)
    st = read_current(spark, root, SCREEN_TIME, SCREEN_TIME_SCHEMA)
    items = read_current(spark, root, BDI_ITEMS, BDI_ITEMS_SCHEMA)
    by_gender = screen_time_by_gender(st)
    over = screen_by_sex_over_hours(st)
    stats = screen_and_depression_stats(st)
    scored = bdi_with_categories(items)
    for name, df in (("sleep", sleep(st)), ("screen_by_sex_over_5_hours", over),
                     ("screen_time_by_gender", by_gender), ("screen_and_depression_stats", stats),
                     ("depression_stats", depression_stats(items)), ("bdi_with_categories", scored)):
        print(name)
        df.limit(heads).show(truncate=False)
    hist, means = leisure_histogram(by_gender)
    charts = {"leisure_histogram": hist, "leisure_means": means, "screen_bars": screen_bars(stats),
              "screen_donut": screen_donut(over), "sleep_histogram": sleep_histogram(st),
              "bdi_stacked": bdi_stacked(scored), "bdi_facets": bdi_facets(scored)}
    for name, df in charts.items():
        df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}")
    return loaded


def main(argv=None) -> None:
    import argparse
    from tessera.session import local_session
    p = argparse.ArgumentParser(description="survey load, reports and chart tables")
    p.add_argument("screen_csv")
    p.add_argument("items_csv")
    p.add_argument("root", help="folder of the versioned tables")
    p.add_argument("out_dir", help="folder for the chart tables")
    p.add_argument("--force", action="store_true", help="start from empty tables")
    p.add_argument("--master", default=None, help="local[N] for a local run; omit on a cluster")
    a = p.parse_args(argv)
    spark = local_session(a.master[6:-1]) if a.master else SparkSession.builder.getOrCreate()
    run(spark, a.screen_csv, a.items_csv, a.root, a.out_dir, a.force)


if __name__ == "__main__":
    main()
