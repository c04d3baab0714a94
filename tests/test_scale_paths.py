"""The distributed code paths (tables too large to hold locally, several
range buckets) on sf0.1 data, checked against DuckDB on the same files."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.operators import evaluate, features, split
from tessera.plans import strategy
from tessera.sources.tables import read_table, table_path

SF = "/root/testdata/sf0.1"


@pytest.fixture
def distributed(monkeypatch):
    monkeypatch.setattr(strategy, "SMALL_DISTINCT", 1000)
    monkeypatch.setattr(strategy, "ROWS_PER_BUCKET", 40_000)


def _duck(sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{table_path(SF, 'lineitem')}')")
    return con.execute(sql).fetchone()


def test_exact_median_many_distinct(spark, distributed):
    li = read_table(spark, SF, "lineitem")
    got = features.exact_median(li, "l_extendedprice")
    assert got == pytest.approx(_duck("SELECT median(l_extendedprice) FROM lineitem")[0], abs=1e-9)


def test_roc_auc_many_scores(spark, distributed):
    li = read_table(spark, SF, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_extendedprice").alias("s"))
    got = evaluate.roc_auc(li, "y", "s").first()["auc"]
    want = _duck("""WITH g AS (SELECT l_extendedprice s, SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) tp,
                                      SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) fp FROM lineitem GROUP BY 1),
                    w AS (SELECT fp, tp, SUM(tp) OVER (ORDER BY s DESC) ctp, SUM(tp) OVER () P, SUM(fp) OVER () N FROM g)
                    SELECT ROUND(SUM(fp * (2 * ctp - tp)) / (2.0 * MAX(P) * MAX(N)), 6) FROM w""")[0]
    assert got == pytest.approx(float(want), abs=1e-6)


def test_split_exact_on_large_class(spark, monkeypatch):
    monkeypatch.setattr(split, "ROWS_PER_HASH_BUCKET", 500)
    li = read_table(spark, SF, "lineitem").select(
        F.monotonically_increasing_id().alias("k"), "l_returnflag")
    out = split.stratified_split(li, "l_returnflag", "k", 0.2)
    counts = {r[0]: r[1] for r in li.groupBy("l_returnflag").count().collect()}
    got = {r[0]: r[1] for r in out.where("split = 'test'").groupBy("l_returnflag").count().collect()}
    assert got == split.class_quotas(counts, 0.2)
    assert out.count() == li.count()
