"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

import duckdb

from tessera.plans.registry import QUERIES
from tessera.sources.tables import TABLE_NAMES, table_path

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_runs_on_smallest_scale(spark):
    m = _entry_module()
    df = m.entry(spark)
    first = df.schema.simpleString()
    assert df.count() >= 0 and m.entry(spark).schema.simpleString() == first


def test_queries_and_oracles_line_up():
    m = _entry_module()
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(q)
    assert set(QUERIES) - set(o) == {"logreg_fit", "logreg_report"}
    assert all(callable(f) for f in q.values())


def test_every_oracle_plans_in_duckdb():
    m = _entry_module()
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path('/root/testdata/sf0.001', t)}')")
    for key, sql in m.oracle_sql().items():
        con.execute(f"EXPLAIN {sql}")


def test_readme_lists_every_query():
    readme = open(os.path.join(ROOT, "README.md")).read()
    assert [k for k in QUERIES if f"`{k}`" not in readme] == []
