"""Constraints kept with a table; upsert through a Bloom filter."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paths import SF_SMALL
from tessera.operators import keyed
from tessera.plans.bindings import ORDER_KEY
from tessera.plans.registry import _loads
from tessera.sources import catalog
from tessera.sources.constraints import ConstraintError, Constraints, Reference, insert_rows, kept, violations

SUBJECTS = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("sex", T.StringType(), False),
                         T.StructField("boss", T.LongType())])
ITEMS = T.StructType([T.StructField("subject", T.LongType()), T.StructField("item", T.IntegerType()),
                      T.StructField("note", T.StringType())])


@pytest.fixture
def made(spark):
    a, b = f"s_{uuid.uuid4().hex[:8]}", f"i_{uuid.uuid4().hex[:8]}"
    catalog.create_tables(spark, {a: SUBJECTS, b: ITEMS}, declared={
        a: Constraints(key=("id",), references=(Reference(("boss",), a, ("id",)),)),
        b: Constraints(key=("subject", "item"), references=(Reference(("subject",), a, ("id",)),))})
    yield a, b
    spark.sql(f"DROP TABLE `{b}`")
    spark.sql(f"DROP TABLE `{a}`")


def _rows(spark, table):
    return sorted(map(tuple, spark.table(table).collect()), key=str)


def test_table_refuses_violating_loads(spark, made):
    a, b = made
    assert kept(spark, a).not_null == ("id", "sex") and kept(spark, b).key == ("subject", "item")
    subjects = "boss long, sex string, id long"
    # a load may refer to its own rows; columns bind by name
    insert_rows(spark, a, spark.createDataFrame([(None, "f", 1), (1, "m", 2)], subjects))
    insert_rows(spark, b, spark.createDataFrame([(1, 1, None), (1, 2, "x"), (2, 1, "it's")], ITEMS))
    before = _rows(spark, a), _rows(spark, b)
    for table, schema, rows, said in (
            (a, subjects, [(None, None, 3)], "not null sex: 1 rows"),
            (a, subjects, [(None, "f", None), (None, "f", None)], "not null id: 2 rows"),
            (a, subjects, [(None, "f", 1), (None, "f", 5), (None, "f", 5)], "key id: 2 rows"),
            (a, subjects, [(9, "f", 3)], f"reference boss to {a}: 1 rows"),
            (b, ITEMS, [(1, 1, None), (7, 1, None), (7, 2, None)], f"key subject, item: 1 rows; reference subject to {a}: 2 rows"),
            (b, ITEMS, [(None, 1, None)], "not null subject: 1 rows")):
        with pytest.raises(ConstraintError) as e:
            insert_rows(spark, table, spark.createDataFrame(rows, schema))
        assert str(e.value) == said
    assert (_rows(spark, a), _rows(spark, b)) == before
    insert_rows(spark, b, spark.createDataFrame([], ITEMS))
    insert_rows(spark, b, spark.createDataFrame([(2, 2, "new")], ITEMS))
    assert _rows(spark, b) == sorted([*before[1], (2, 2, "new")], key=str)
    with pytest.raises(ValueError, match="columns differ"):
        insert_rows(spark, b, spark.createDataFrame([(1, 5)], "subject long, item int"))


def test_unknown_columns_and_plain_tables(spark):
    name = f"p_{uuid.uuid4().hex[:8]}"
    with pytest.raises(ValueError, match="unknown"):
        catalog.create_tables(spark, {name: ITEMS}, declared={name: Constraints(key=("nope",))})
    assert not spark.catalog.tableExists(name)
    spark.createDataFrame([(1,)], "x int").write.saveAsTable(name)
    assert kept(spark, name) == Constraints()
    insert_rows(spark, name, spark.createDataFrame([(None,)], "x int"))
    assert spark.table(name).count() == 2
    spark.sql(f"DROP TABLE `{name}`")


def test_large_keys_and_hot_key(spark, monkeypatch):
    """More keys than a broadcast takes, and a key that holds a third of the load: the same counts."""
    load = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit(5)).otherwise(F.col("id")).alias("k"))
    stored = spark.range(2500, 4000).select(F.col("id").alias("k")).unionByName(spark.createDataFrame([(5,)], "k long"))
    rules = Constraints(key=("k",), references=(Reference(("k",), "p", ("id",)),))
    want = {"not null k": 0, "key k": 1000 + 500, "reference k to p": 1000 + 900}
    parents = {"p": spark.range(1000, 2100).union(spark.range(1000, 2100))}
    for bound in (100_000, 10):
        monkeypatch.setattr("tessera.sources.constraints.BROADCAST_MAX_ROWS", bound)
        assert {r[0]: r[1] for r in violations(load, rules, stored, parents).collect()} == want


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bloom_upsert_equals_upsert(spark, monkeypatch):
    _, _, base, inc = _loads(spark, SF_SMALL)
    want = sorted(map(str, keyed.upsert(base, inc, ORDER_KEY).collect()))
    assert sorted(map(str, keyed.upsert_bloom(base, inc, ORDER_KEY).collect())) == want
    assert sorted(map(str, keyed.upsert_bloom(base, inc.limit(0), ORDER_KEY).collect())) == sorted(map(str, base.collect()))
    assert sorted(map(str, keyed.upsert_bloom(base.limit(0), inc, ORDER_KEY).collect())) == sorted(map(str, inc.collect()))
    # a filter beyond the broadcast's bound, and keys of two types
    monkeypatch.setattr(keyed, "BROADCAST_MAX_BYTES", 10)
    assert sorted(map(str, keyed.upsert_bloom(base, inc, ORDER_KEY).collect())) == want
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    got = keyed.upsert_bloom(old, spark.createDataFrame([(2, "B"), (None, "C")], "k long, v string"), "k")
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a"), (2, "B"), (None, "C")]


def test_bloom_upsert_null_keys(spark):
    old = spark.createDataFrame([(1, "x", 0), (None, "x", 0), (None, None, 0), (2, None, 0)], "a long, b string, v int")
    new = spark.createDataFrame([(None, "x", 1), (2, None, 1), (3, "y", 1)], "a long, b string, v int")
    got = sorted(map(tuple, keyed.upsert_bloom(old, new, ["a", "b"]).collect()), key=str)
    assert got == sorted([(1, "x", 0), (None, None, 0), (None, "x", 1), (2, None, 1), (3, "y", 1)], key=str)


def test_bloom_keeps_stored_rows_in_place(spark):
    """Few rows beside the replaced ones pass the filter, and the others are not shuffled."""
    stored = spark.range(200_000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    incoming = spark.range(199_000, 204_000).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    blocks = 5_000 * keyed.BLOOM_BITS // 256 + 1
    stay, maybe = keyed.bloom_split(stored, keyed.bloom_filter(incoming, "k", blocks), "k", blocks)
    n = maybe.count()
    assert 1_000 <= n <= 1_000 + 0.03 * 199_000 and stay.count() == 200_000 - n
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(stay)
        # the only shuffle lies below the broadcast: the filter's own aggregate
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.index("BroadcastExchange") < plan.index("Exchange hashpartitioning")
        assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    got = keyed.upsert_bloom(stored, incoming, "k").groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in got} == {"old": 199_000, "new": 5_000}
