"""The survey application and the model flows on small hand-made inputs."""

import math

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from tessera.apps import screen_time as st
from tessera.apps import tabular_ml
from tessera.functions.expressions import BDI_BANDS
from tessera.session import scratch_path
from tessera.sources.tables import read_table


def _screen_csv(tmp_path, rows, name="screen.csv"):
    cols = [f.name for f in st.SCREEN_TIME_SCHEMA.fields]
    lines = [",".join(cols)] + [",".join("" if v is None else str(v) for v in r) for r in rows]
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def _items_csv(tmp_path, rows, name="items.csv"):
    # columns deliberately in reverse order: the loader binds by name
    cols = [f.name for f in st.BDI_ITEMS_SCHEMA.fields][::-1]
    lines = [",".join(cols)]
    for sid, score_items in rows:
        vals = {"subject_id": sid, **{c: "" for c in cols if c != "subject_id"}}
        for c, v in score_items.items():
            vals[c] = v
        lines.append(",".join(str(vals[c]) for c in cols))
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n")
    return str(p)


SCREEN_ROWS = [
    (1, "Girl", 1.0, 6.0, 1.0, 8.0, 1.0, 1.0, 10, 1),
    (2, " boy\t", 1.0, 4.0, 1.0, 9.5, 1.0, 1.0, 5, 0),
    (3, "Boy", 1.0, 7.0, 1.0, 7.0, 1.0, 1.0, 30, 1),
    (2, "Boy", 1.0, 5.5, 1.0, None, 1.0, 1.0, 5, 1),   # later duplicate of 2 wins
]


def test_import_reports_and_charts(spark, tmp_path):
    root = scratch_path(spark, "survey")
    s_csv = _screen_csv(tmp_path, SCREEN_ROWS)
    i_csv = _items_csv(tmp_path, [(1, {"bdi_item_01": 3, "bdi_item_21": 12}), (2, {}),
                                  (3, {f"bdi_item_{k:02d}": 2 for k in range(1, 16)})])
    out = st.import_csv(spark, s_csv, i_csv, root)
    assert out["key_sets"]["equal"]
    c = out[st.SCREEN_TIME]
    assert (c["csv_rows"], c["unique"], c["csv_dupes"], c["inserted"], c["updated"], c["total"]) == (4, 3, 1, 3, 0, 3)
    assert st.tables_exist(spark, root)

    screen = st.read_current(spark, root, st.SCREEN_TIME, st.SCREEN_TIME_SCHEMA)
    row2 = screen.where("subject_id = 2").first()
    assert (row2["sex"], row2["est_leisure_screen_hours"], row2["avg_sleep_hours"]) == ("boy", 5.5, None)

    over = {r["sex"]: r["count"] for r in st.screen_by_sex_over_hours(screen).collect()}
    assert over == {"girl": 1, "boy": 2}
    stats = {r["sex"]: tuple(r)[1:] for r in st.screen_and_depression_stats(screen).collect()}
    assert stats["boy"] == (2, 2, 2, 2) and stats["girl"] == (1, 1, 1, 1)
    means = {r["sex"]: r["gender_avg"] for r in st.screen_time_by_gender(screen).collect()}
    assert means == {"girl": 6.0, "boy": 6.25}
    assert [r[0] for r in st.sleep(screen).collect()] == [8.0, 7.0, None]

    items = st.read_current(spark, root, st.BDI_ITEMS, st.BDI_ITEMS_SCHEMA)
    scored = {r["subject_id"]: (r["total_score"], r["depression_category"])
              for r in st.bdi_with_categories(items).collect()}
    assert scored == {1: (15, BDI_BANDS[1][2]), 2: (0, BDI_BANDS[0][2]), 3: (30, BDI_BANDS[3][2])}
    counts = {r["depression_category"]: r["count_teenagers"] for r in st.depression_stats(items).collect()}
    assert sum(counts.values()) == 3

    hist, mean_lines = st.leisure_histogram(st.screen_time_by_gender(screen))
    assert hist.agg(F.sum("n")).first()[0] == 3
    assert set(r["sex"] for r in mean_lines.collect()) == set(st.SEX_LABELS.values())
    donut = {r["sex"]: (r["count"], r["total"]) for r in st.screen_donut(st.screen_by_sex_over_hours(screen)).collect()}
    assert donut[st.SEX_LABELS["boy"]] == (2, 3)
    assert st.sleep_histogram(screen).agg(F.sum("n")).first()[0] == 2
    facets = st.bdi_facets(st.bdi_with_categories(items)).collect()
    assert {r["depression_category"]: r["facet_n"] for r in facets}[BDI_BANDS[0][2]] == 1
    assert st.bdi_stacked(st.bdi_with_categories(items)).agg(F.sum("n")).first()[0] == 3
    info = {r["table"]: r["rows"] for r in st.table_info(spark, root).collect()}
    assert info == {st.SCREEN_TIME: 3, st.BDI_ITEMS: 3}

    # a second load updates stored rows: incoming NULL replaces a value
    s2 = _screen_csv(tmp_path, [(3, "Boy", None, None, None, None, None, None, None, None),
                                (4, "Girl", 1.0, 2.0, 1.0, 9.0, 1.0, 1.0, 1, 0)], "screen2.csv")
    i2 = _items_csv(tmp_path, [(3, {}), (4, {})], "items2.csv")
    out2 = st.import_csv(spark, s2, i2, root)
    c2 = out2[st.SCREEN_TIME]
    assert (c2["inserted"], c2["updated"], c2["total"]) == (1, 1, 4)
    screen = st.read_current(spark, root, st.SCREEN_TIME, st.SCREEN_TIME_SCHEMA)
    assert screen.where("subject_id = 3").first()["est_leisure_screen_hours"] is None


def test_foreign_key_violation_raises(spark, tmp_path):
    root = scratch_path(spark, "survey-fk")
    s_csv = _screen_csv(tmp_path, SCREEN_ROWS[:1], "s.csv")
    i_csv = _items_csv(tmp_path, [(1, {}), (9, {})], "i.csv")
    with pytest.raises(ValueError, match="foreign key"):
        st.import_csv(spark, s_csv, i_csv, root)
    assert not st.tables_exist(spark, root)          # nothing was written


@pytest.mark.parametrize("bad", [("", "Girl"), (7, "")])
def test_missing_key_or_label_stops_the_load(spark, tmp_path, bad):
    root = scratch_path(spark, "survey-null")
    s_csv = _screen_csv(tmp_path, [SCREEN_ROWS[0], (*bad, *SCREEN_ROWS[1][2:])], "s.csv")
    with pytest.raises(Exception, match="required|NULL"):
        st.import_csv(spark, s_csv, _items_csv(tmp_path, [(1, {})], "i.csv"), root)
    assert not st.tables_exist(spark, root)


def test_load_reports_rejects_and_reads_whole_floats(spark, tmp_path):
    root = scratch_path(spark, "survey-rejects")
    s_csv = _screen_csv(tmp_path, [(1, "GIRL ", "x", 6.0, 1.0, 8.0, 1.0, 1.0, "10.0", "1.5")], "s.csv")
    out = st.import_csv(spark, s_csv, _items_csv(tmp_path, [(1, {"bdi_item_01": "2.0"})], "i.csv"), root)
    assert out["rejects"] == {st.SCREEN_TIME: {"screen_time_index": 1, "depressed": 1}, st.BDI_ITEMS: {}}
    row = st.read_current(spark, root, st.SCREEN_TIME, st.SCREEN_TIME_SCHEMA).first()
    assert (row["sex"], row["bdi_total"], row["depressed"]) == ("girl", 10, None)
    assert st.read_current(spark, root, st.BDI_ITEMS, st.BDI_ITEMS_SCHEMA).first()["bdi_item_01"] == 2


def test_import_with_order_column(spark, tmp_path):
    root = scratch_path(spark, "survey-order")
    cols = [f.name for f in st.SCREEN_TIME_SCHEMA.fields] + ["seq"]
    rows = [(5, "Girl", 1.0, 2.0, 1.0, 8.0, 1.0, 1.0, 3, 0, 2),
            (5, "Girl", 1.0, 9.0, 1.0, 8.0, 1.0, 1.0, 3, 1, 1)]   # seq decides: the first line is last
    p = tmp_path / "s.csv"
    p.write_text("\n".join([",".join(cols)] + [",".join(map(str, r)) for r in rows]) + "\n")
    icols = ["seq"] + [f.name for f in st.BDI_ITEMS_SCHEMA.fields]
    q = tmp_path / "i.csv"
    q.write_text(",".join(icols) + "\n" + ",".join(["1", "5"] + [""] * (len(icols) - 2)) + "\n")
    st.import_csv(spark, str(p), str(q), root, order_col="seq")
    r = st.read_current(spark, root, st.SCREEN_TIME, st.SCREEN_TIME_SCHEMA).first()
    assert (r["est_leisure_screen_hours"], r["depressed"]) == (2.0, 0)


def test_classification_flow(spark):
    labels, docs = read_table(spark, SF_SMALL, "labels"), read_table(spark, SF_SMALL, "documents")
    data = docs.join(labels, "doc_id", "left").select(
        "doc_id", "quality", F.col("n_chars").cast("double").alias("n_chars"), "lang", "source")
    res = tabular_ml.classification_flow(data, "doc_id", "quality", ["n_chars"], ["lang"], ["source"],
                                         scatter=("n_chars", "doc_id"))
    assert res.head.count() == 20
    assert res.missing_summary.first()["total_cells"] == 3 * data.count()
    assert res.scatter.agg(F.sum("n")).first()[0] == data.count()
    n = data.count()
    assert res.predictions.count() == math.ceil(0.2 * n)
    assert res.confusion.agg(F.sum("n")).first()[0] == res.predictions.count()
    assert res.report.count() == 5
    assert 0.0 <= res.auc.first()["auc"] <= 1.0
    assert res.coefficients.count() == len(res.preprocessor.feature_names())
    assert {r["column"] for r in res.missing.collect()} == {"n_chars", "lang", "source"}


def test_regression_flow(spark):
    part = read_table(spark, SF_SMALL, "part")
    res = tabular_ml.regression_flow(part, "p_retailprice", numeric=["p_size"], categorical=["p_type"],
                                     key="p_partkey")
    m = res.metrics.first()
    assert m["mse"] >= 0 and m["r2"] <= 1
    assert res.preprocessor.feature_names()[0] == "num__p_size"


def test_mains_run(spark, tmp_path, capsys):
    root = scratch_path(spark, "survey-main")
    out = scratch_path(spark, "charts")
    s_csv = _screen_csv(tmp_path, SCREEN_ROWS, "m1.csv")
    i_csv = _items_csv(tmp_path, [(1, {}), (2, {"bdi_item_05": 20}), (3, {})], "m2.csv")
    st.run(spark, s_csv, i_csv, root, out)
    assert spark.read.parquet(f"{out}/bdi_facets").count() > 0
    tabular_ml.main(["regress", "part", "--data-dir", SF_SMALL, "--target", "p_retailprice",
                     "--key", "p_partkey", "--numeric", "p_size", "--cat-freq", "p_type"])
    assert "mse" in capsys.readouterr().out


def test_flow_loaders_keep_label_on_rows(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("age", T.DoubleType()),
                           T.StructField("y", T.IntegerType())])
    c = tmp_path / "d.csv"
    c.write_text("y,age,id\n1,30.5,1\n0,,2\n")
    df = tabular_ml.load_csv(spark, str(c), schema, target="y")
    assert sorted(map(tuple, df.select("id", "age", "label").collect()), key=repr) == [(1, 30.5, 1), (2, None, 0)]
    j = tmp_path / "d.json"
    j.write_text('{"id": 3, "age": 7, "y": 1}\n')
    assert tabular_ml.load_json(spark, str(j), schema, target="y").first()["label"] == 1
