import random

import pytest
from pyspark.sql import types as T

from tessera.sources import csv_split, files

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


@pytest.fixture
def small_splits(spark):
    """Splits of 4 KB, so that one file is read by many tasks."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "4096")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def quoted(v):
    return '"' + v.replace('"', '""') + '"'


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def write(path, rng, n, header="id,a,b", end="\n"):
    parts = ["x", "yz", "\n", "\n\n", '"', ",", " ", "é", "word ", "#", "1\n2"]
    lines, rows = [header], []
    for k in range(n):
        long = rng.random() < 0.02
        a, b = ("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4000 if long else 12))).strip(" ") + "." for _ in range(2))
        said = {"id": str(k), "a": quoted(a), "b": quoted(b)}
        lines.append(",".join(said[c] for c in header.split(",")))
        rows.append((k, a, b))
    path.write_text(end.join(lines) + end, newline="")
    return rows


def test_rows_equal_those_of_one_task(spark, tmp_path, small_splits):
    rows = write(tmp_path / "a.csv", random.Random(1), 1500)
    split = files.read_csv_typed(spark, str(tmp_path), SCHEMA, multiline="split", missing=())
    assert split.rdd.getNumPartitions() > 20
    assert rows_of(split) == rows_of(files.read_csv_typed(spark, str(tmp_path), SCHEMA, missing=())) == sorted(rows, key=str)


def test_records_longer_than_several_splits(spark, tmp_path, small_splits):
    long = "line\n" * 8000
    (tmp_path / "a.csv").write_text('id,a,b\n1,"' + long + '",x\n2,"' + long + 'y ""q""","z\n"\n3,p,q\n')
    got = rows_of(files.read_csv_typed(spark, str(tmp_path), SCHEMA, multiline="split", missing=()))
    assert got == [(1, long, "x"), (2, long + 'y "q"', "z\n"), (3, "p", "q")]


def test_headers_by_file_and_windows_line_ends(spark, tmp_path, small_splits):
    rng = random.Random(3)
    rows = write(tmp_path / "a.csv", rng, 200) + write(tmp_path / "b.csv", rng, 200, "b,id,a")
    (tmp_path / "c.csv").write_text('a,"id"\r\n"p\r\nq",7\r\n\r\nr,8', newline="")
    got = rows_of(files.read_csv_typed(spark, str(tmp_path), SCHEMA, multiline="split", missing=()))
    assert got == sorted([*rows, (7, "p\r\nq", None), (8, "r", None)], key=str)


def test_quotes_that_do_not_end_raise(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,a,b\n1,"x,y\n')
    with pytest.raises(ValueError):
        files.read_csv_typed(spark, str(tmp_path), SCHEMA, multiline="split")
    with pytest.raises(Exception):
        csv_split.csv_records(spark, str(tmp_path / "none"))


def test_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,a,b\n")
    assert files.read_csv_typed(spark, str(tmp_path), SCHEMA, multiline="split").count() == 0
