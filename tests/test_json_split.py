"""Column-oriented JSON read by many tasks a file."""
import json
import random

import pytest
from pyspark.sql import types as T

from tessera.sources import files

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("a,{b", T.StringType()), T.StructField("gone", T.DoubleType())])


@pytest.fixture()
def splits(spark):
    """Sets the size of a split; undone afterwards."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    was = {k: spark.conf.get(k) for k in keys}

    def sized(n: int) -> None:
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "1")
    yield sized
    for k, v in was.items():
        spark.conf.set(k, v)


def _read(spark, path):
    return sorted((tuple(r) for r in files.read_json_columns(spark, str(path), SCHEMA, required=["k"]).collect()), key=repr)


def _value(rng):
    text = "".join(rng.choice(['"', "\\", ",", "{", "}", "[", "]", ":", "é", "\n", "'", "x"]) for _ in range(rng.randrange(12)))
    return rng.choice([None, text, text, 5, 1.50, True, {"n": [1, text, {}], text: None}, [text, [1, 2]], []])


@pytest.mark.parametrize("size,array,indent", [(7, False, None), (16, False, 1), (61, True, None), (61, False, None), (400, False, None), (100000, True, 2)])
def test_any_split_gives_the_same_rows(spark, tmp_path, splits, size, array, indent):
    rng = random.Random(size)
    want = {}
    for f in range(2):
        objects = []
        for o in range(3):
            n = rng.randrange(6)
            number = {str(i): 1000 * f + 100 * o + i for i in range(n)}
            text = {i: _value(rng) for i in rng.sample(sorted(number), n // 2)}
            cols = [("k", number), ("a,{b", text), ('other, "{', rng.choice([{"0": {"a": 1}}, [1, {"x": [2]}, "}"], 7, "a,b", None])), ("gone", None)]
            rng.shuffle(cols)
            objects.append(dict(cols))
            want |= {k: text.get(i) for i, k in number.items()}
        parts = [json.dumps(o, indent=indent, ensure_ascii=False) for o in objects]
        (tmp_path / f"{f}.json").write_text("[" + ", ".join(parts) + "]" if array else "\n".join(parts), encoding="utf-8")
    splits(size)
    got = _read(spark, tmp_path)
    assert sorted(k for k, _, _ in got) == sorted(want) and all(gone is None for _, _, gone in got)
    for k, v, _ in got:         # what is no text stays as it is written
        assert v == want[k] if want[k] is None or isinstance(want[k], str) else json.loads(v) == want[k], (k, v)


def test_all_objects_of_a_file_are_read(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": {"0": 1, "1": 2}}\n{}\n{"k": {"0": 3}, "a,{b": {"0": "x"}}\n')
    assert _read(spark, tmp_path) == [(1, None, None), (2, None, None), (3, "x", None)]


def test_one_object_is_read_by_many_tasks(spark, tmp_path, splits):
    n = 4000
    (tmp_path / "a.json").write_text(json.dumps({"k": {str(i): i for i in range(n)}, "a,{b": {str(i): f"t, {i}" for i in range(n)}}))
    splits(8000)
    from tessera.sources.json_split import json_cells
    cells = json_cells(spark, str(tmp_path), SCHEMA.names)
    assert cells.rdd.getNumPartitions() > 8
    assert _read(spark, tmp_path) == sorted([(i, f"t, {i}", None) for i in range(n)], key=repr)


def test_numbers_stay_as_written(spark, tmp_path):
    (tmp_path / "a.json").write_text('\ufeff{"k": {"0": 3e2, "1": 3.0}, "a,{b": {"0": 1.500, "1": 12345678901234567890.10}, "gone": {"0": NaN, "1": -1e-1}}', encoding="utf-8")
    assert _read(spark, tmp_path) == [(3, "12345678901234567890.10", -0.1), (300, "1.500", None)]


@pytest.mark.parametrize("text", ['{"k": {"0": 1}', '{"k": {"0": 1,}}', '{"k": {"0": 1,, "1": 2}}', '{"k": {"0": 1 "1": 2}}', '{"k": {"0": 01}}', '{"k": {"0": x}}',
                                  '{"k": {"0": "a}}', '{"k": {,"0": 1}}', '{"k": 5}', '{"k": [1, 2]}', '{"k": {"0": [1 2]}}', '{"k": {"0"}}', "5", '{,"k": {"0": 1}}',
                                  '{"k": {"0": 1}}}', "{'k': {'0': 1}}", '{"k": {"0": "a\nb"}}'])
def test_what_is_no_such_json_raises(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception):  # noqa: B017 - by the driver or by a task
        _read(spark, tmp_path)


def test_written_objects_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "OBJECT_ROWS", 10)
    rows = [(i, i, f"t{i}" if i % 3 else None) for i in range(95)]
    df = spark.createDataFrame(rows, "row long, k long, `a,{b` string").coalesce(2)
    files.write_json_columns(df.withColumnRenamed("a,{b", "a"), str(tmp_path / "o"), "row")
    lines = spark.read.text(str(tmp_path / "o"))
    sizes = [len(json.loads(r["value"])["k"]) for r in lines.collect()]
    assert sum(sizes) == 95 and len(sizes) > 4 and max(sizes) < 48
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("a", T.StringType())])
    assert sorted(map(tuple, files.read_json_columns(spark, str(tmp_path / "o"), schema).collect())) == [r[1:] for r in rows]


def test_an_index_that_comes_twice_raises(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "OBJECT_ROWS", 3)
    df = spark.createDataFrame([(i % 19, i) for i in range(20)], "row long, k long").coalesce(1)
    with pytest.raises(Exception, match="(?i)duplicate"):
        files.write_json_columns(df, str(tmp_path / "o"), "row")


def test_plain_entries_beside_others(spark, tmp_path):
    n = 500
    text = {str(i): 'a "b"' if i % 97 == 50 else None if i % 5 == 0 else i if i % 5 == 1 else "" if i % 5 == 2 else f"t{i}" for i in range(n)}
    (tmp_path / "a.json").write_text(json.dumps({"k": {str(i): i for i in range(n)}, "a,{b": text}))
    want = [(i, str(text[str(i)]) if isinstance(text[str(i)], int) else text[str(i)], None) for i in range(n)]
    assert _read(spark, tmp_path) == sorted(want, key=repr)
