"""Typed scans bind by name; catalog helpers; streaming upsert."""

import os
import uuid

import pytest
from pyspark.sql import types as T

from paths import SF_SMALL
from tessera.operators import keyed
from tessera.session import scratch_path
from tessera.sources import catalog, files
from tessera.sources.tables import read_table

SCHEMA = T.StructType([
    T.StructField("subject_id", T.LongType(), False),
    T.StructField("sex", T.StringType(), False),
    T.StructField("hours", T.DoubleType()),
    T.StructField("depressed", T.IntegerType()),
])


def _write(tmp_path, text, name="a.csv"):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_csv_binds_by_name_not_position(spark, tmp_path):
    path = _write(tmp_path, "hours,sex,subject_id,extra\n5.5,Girl,1,x\nNaN,Boy,2,y\n")
    df = files.read_csv_typed(spark, path, SCHEMA, required=["subject_id", "sex"])
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(1, "Girl", 5.5, None), (2, "Boy", None, None)]
    assert df.schema["subject_id"].dataType == T.LongType()


def test_csv_required_column_absent_raises(spark, tmp_path):
    path = _write(tmp_path, "sex,hours\nGirl,1.0\n")
    with pytest.raises(ValueError, match="subject_id"):
        files.read_csv_typed(spark, path, SCHEMA, required=["subject_id"])


def test_csv_rejects_counted(spark, tmp_path):
    path = _write(tmp_path, "subject_id,sex,hours,depressed\n1,Girl,abc,1\n2,Boy,3.0,x\n3,Boy,,0\n")
    df = files.read_csv_typed(spark, path, SCHEMA, required=["subject_id"])
    assert sorted(tuple(r) for r in df.collect()) == [(1, "Girl", None, 1), (2, "Boy", 3.0, None),
                                                      (3, "Boy", None, 0)]
    rej = files.cast_rejects(spark, path, SCHEMA).first()
    assert (rej["subject_id"], rej["hours"], rej["depressed"]) == (0, 1, 1)


def test_json_lines_and_array(spark, tmp_path):
    lines = _write(tmp_path, '{"subject_id": 1, "sex": "Girl", "hours": 2.5}\n{"sex": "Boy", "subject_id": 2}\n',
                   "a.json")
    df = files.read_json_typed(spark, lines, SCHEMA)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "Girl", 2.5, None), (2, "Boy", None, None)]
    arr = _write(tmp_path, '[{"subject_id": 3, "sex": "Boy", "depressed": 1}]', "b.json")
    df = files.read_json_typed(spark, arr, SCHEMA, multiline=True)
    assert [tuple(r) for r in df.collect()] == [(3, "Boy", None, 1)]


def test_catalog_create_exists_profile(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    schemas = {name: SCHEMA, name + "_items": T.StructType([T.StructField("subject_id", T.LongType())])}
    assert not catalog.tables_exist(spark, list(schemas))
    assert catalog.create_tables(spark, schemas) == list(schemas)
    assert catalog.tables_exist(spark, list(schemas))
    assert catalog.create_tables(spark, schemas) == []
    assert catalog.create_tables(spark, schemas, force=True) == list(schemas)
    assert spark.table(name).schema.fieldNames() == SCHEMA.fieldNames()
    prof = {r["table"]: r["n"] for r in catalog.table_profile(spark, SF_SMALL).collect()}
    assert prof["region"] == 5 and len(prof) == 14
    cols = catalog.table_columns(spark, SF_SMALL, ["region"]).collect()
    assert [(r["column"], r["type"]) for r in cols] == [("r_regionkey", "int"), ("r_name", "string")]


def test_load_named(spark):
    df = catalog.load_named(spark, "region", SF_SMALL)
    assert df.count() == 5
    with pytest.raises(FileNotFoundError):
        catalog.load_named(spark, "nope", SF_SMALL)


def test_scratch_path_is_under_checkpoint_dir(spark):
    p = scratch_path(spark, "x")
    assert os.path.basename(p).startswith("x-")


def test_stream_upsert_matches_batch(spark):
    from tessera.streaming.ingest import run_upsert_stream
    orders = read_table(spark, SF_SMALL, "orders")
    first, second = orders.where("o_orderdate < '1998-01-01'"), orders.where("o_orderdate >= '1998-01-01'")
    key, order = ["o_custkey"], ["o_orderdate", "o_orderkey"]
    streamed = run_upsert_stream(spark, [first, second], key, order)
    batch = keyed.upsert(keyed.dedup_keep_last(first, key, order), keyed.dedup_keep_last(second, key, order), key)
    assert sorted(map(tuple, streamed.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_stream_upsert_incremental_and_replay_safe(spark):
    """A restarted stream with the same checkpoint applies nothing twice; a
    newly landed file becomes exactly one new version."""
    from tessera.streaming.ingest import latest_version, list_versions, upsert_stream
    orders = read_table(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    key, order = ["o_custkey"], ["o_orderdate", "o_orderkey"]
    landing, table, ckpt = (scratch_path(spark, n) for n in ("land", "tbl", "ck"))
    first = orders.where("o_orderdate < '1997-01-01'")
    second = orders.where("o_orderdate >= '1997-01-01'")
    first.coalesce(1).write.parquet(f"{landing}/a")
    upsert_stream(spark, f"{landing}/*", orders.schema, key, order, table, ckpt).awaitTermination()
    assert len(list_versions(spark, table)) == 1
    upsert_stream(spark, f"{landing}/*", orders.schema, key, order, table, ckpt).awaitTermination()
    assert len(list_versions(spark, table)) == 1          # restart: nothing replayed
    second.coalesce(1).write.parquet(f"{landing}/b")
    upsert_stream(spark, f"{landing}/*", orders.schema, key, order, table, ckpt).awaitTermination()
    assert len(list_versions(spark, table)) == 2
    got = sorted(map(tuple, latest_version(spark, table, orders.schema).collect()))
    want = keyed.upsert(keyed.dedup_keep_last(first, key, order), keyed.dedup_keep_last(second, key, order), key)
    assert got == sorted(map(tuple, want.select(*orders.columns).collect()))


def test_json_column_oriented_rejected(spark, tmp_path):
    path = _write(tmp_path, '{"subject_id": {"0": 1, "1": 2}, "sex": {"0": "Girl", "1": "Boy"}}\n', "c.json")
    with pytest.raises(ValueError, match="column-oriented"):
        files.read_json_typed(spark, path, SCHEMA)


def test_csv_folder_with_reordered_headers(spark, tmp_path):
    _write(tmp_path, "subject_id,sex,hours\n1,Girl,5.5\n")
    _write(tmp_path, "hours,subject_id,sex\n6.5,2,Boy\n", "b.csv")
    got = files.read_csv_typed(spark, str(tmp_path), SCHEMA, required=["subject_id"])
    assert sorted(map(tuple, got.collect())) == [(1, "Girl", 5.5, None), (2, "Boy", 6.5, None)]


def test_csv_quotes_line_breaks_missing_tokens_and_whole_floats(spark, tmp_path):
    text = 'subject_id,sex,hours,depressed\n9007199254740993,"say ""hi"", ok",1.5,3.0\n2,"two\nlines",NA,n/a\n3,NULL,2,3e0\n'
    got = files.read_csv_typed(spark, _write(tmp_path, text), SCHEMA, required=["subject_id"])
    assert sorted(map(tuple, got.collect())) == [
        (2, "two\nlines", None, None), (3, None, 2.0, 3), (9007199254740993, 'say "hi", ok', 1.5, 3)]


def test_csv_required_value_missing_or_malformed_raises(spark, tmp_path):
    for value in ("", "NA", "x", "1.5"):
        path = _write(tmp_path, f"subject_id,sex\n{value},Girl\n", f"r{len(value)}{value[:1]}.csv")
        with pytest.raises(Exception, match="required subject_id"):
            files.read_csv_typed(spark, path, SCHEMA, required=["subject_id"]).collect()


def test_json_required_field_and_malformed_line(spark, tmp_path):
    absent = _write(tmp_path, '{"sex": "Boy"}\n', "d.json")
    with pytest.raises(Exception, match="required subject_id"):
        files.read_json_typed(spark, absent, SCHEMA, required=["subject_id"]).collect()
    broken = _write(tmp_path, '{"subject_id": 1, "sex": "Boy"}\n{"subject_id": 2,\n', "e.json")
    with pytest.raises(Exception, match="malformed JSON"):
        files.read_json_typed(spark, broken, SCHEMA).collect()


def test_load_named_quotes_names(spark, tmp_path):
    # the catalog allows no such table name, but asking for one must not fail to parse
    spark.range(3).write.parquet(f"{tmp_path}/breast-cancer.parquet")
    assert catalog.load_named(spark, "breast-cancer", str(tmp_path)).count() == 3
    with pytest.raises(FileNotFoundError):
        catalog.load_named(spark, "no-such", str(tmp_path))


def _landed(spark, landing, rows, name):
    spark.createDataFrame(rows, "k long, o long, v string").coalesce(1).write.parquet(f"{landing}/{name}")


def test_stream_on_a_table_with_earlier_versions(spark):
    from tessera.streaming import ingest
    landing, table, ckpt = (scratch_path(spark, n) for n in ("land", "tbl", "ck"))
    schema = spark.createDataFrame([], "k long, o long, v string").schema
    for i in range(3):
        ingest.commit_version(spark, table, spark.createDataFrame([(1, 1, f"batch{i}"), (2, 1, "b")], schema), ["k"])
    _landed(spark, landing, [(1, 5, "stream")], "a")
    ingest.upsert_stream(spark, f"{landing}/*", schema, ["k"], ["o"], table, ckpt).awaitTermination()
    want = [(1, 5, "stream"), (2, 1, "b")]
    assert sorted(map(tuple, ingest.latest_version(spark, table, schema).collect())) == want
    # the same epoch again changes nothing; only the touched bucket was rewritten
    again = spark.createDataFrame([(1, 9, "replayed")], schema)
    stream = ingest._manifest(spark, table).where("stream IS NOT NULL").first()
    assert ingest.merge_batch(spark, table, schema, again, ["k"], ["o"], stream["stream"], stream["epoch"]) is None
    assert sorted(map(tuple, ingest.latest_version(spark, table, schema).collect())) == want
    assert ingest._manifest(spark, table).where("version = 3").count() == 1


def test_stream_result_does_not_depend_on_batching(spark):
    from tessera.streaming import ingest
    schema = spark.createDataFrame([], "k long, o long, v string").schema
    results = []
    for per_batch in (None, 1):
        landing, table, ckpt = (scratch_path(spark, n) for n in ("land", "tbl", "ck"))
        _landed(spark, landing, [(1, 10, "late"), (2, 1, "x")], "a")
        _landed(spark, landing, [(1, 5, "early"), (3, 1, "y")], "b")
        ingest.upsert_stream(spark, f"{landing}/*", schema, ["k"], ["o"], table, ckpt, files_per_batch=per_batch).awaitTermination()
        assert len(ingest.list_versions(spark, table)) == (1 if per_batch is None else 2)
        results.append(sorted(map(tuple, ingest.latest_version(spark, table, schema).collect())))
    assert results[0] == results[1] == [(1, 10, "late"), (2, 1, "x"), (3, 1, "y")]


def test_stream_upsert_runs_two_batches(spark, monkeypatch):
    from tessera.plans import registry
    from tessera.streaming import ingest
    made = []
    merge = ingest.merge_batch
    monkeypatch.setattr(ingest, "merge_batch", lambda *a: made.append(merge(*a)))
    registry.QUERIES["stream_upsert"](spark, SF_SMALL).count()
    assert made == [0, 1]


def test_scale_settings():
    from tessera.session import scale_settings
    s = scale_settings(100 * 1024 ** 4)             # 100 TB
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert scale_settings(10)["spark.sql.shuffle.partitions"] == "200"


def test_stream_upsert_from_csv_landing(spark):
    from tessera.streaming.ingest import latest_version, upsert_stream
    landing, table, ckpt = (scratch_path(spark, n) for n in ("csvland", "csvtbl", "csvck"))
    os.makedirs(landing)
    seq = T.StructType(SCHEMA.fields + [T.StructField("seq", T.LongType())])
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write("subject_id,sex,hours,depressed,seq\n1,Girl,5.5,1,1\n2,Boy,abc,0,2\n1,Girl,6.5,0,3\n")
    upsert_stream(spark, landing, seq, ["subject_id"], ["seq"], table, ckpt, fmt="csv",
                  required=["subject_id"]).awaitTermination()
    got = sorted(map(tuple, latest_version(spark, table, seq).collect()))
    assert got == [(1, "Girl", 6.5, 0, 3), (2, "Boy", None, 0, 2)]


def test_stream_csv_reordered_header_fails(spark):
    from tessera.streaming.ingest import upsert_stream
    landing, table, ckpt = (scratch_path(spark, n) for n in ("csvbad", "csvbadtbl", "csvbadck"))
    os.makedirs(landing)
    with open(os.path.join(landing, "b.csv"), "w") as f:
        f.write("sex,subject_id,hours,depressed\nGirl,1,5.5,1\n")
    q = upsert_stream(spark, landing, SCHEMA, ["subject_id"], ["subject_id"], table, ckpt, fmt="csv")
    with pytest.raises(Exception):
        q.awaitTermination()
