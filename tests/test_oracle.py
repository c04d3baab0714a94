"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate, run locally)."""

import os
import sys

import pytest

from paths import SF_ORACLE
from tessera.plans.oracle import ORACLE
from tessera.plans.registry import QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import oracle_compare  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return oracle_compare.duck(SF_ORACLE)


def test_every_query_has_an_oracle_or_is_iterative():
    assert set(QUERIES) - set(ORACLE) == {"logreg_fit", "logreg_report"}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    r = oracle_compare.compare(spark, con, SF_ORACLE, key)
    assert r["ok"], r
