"""Property tests (hypothesis) for the exact split quotas and equal-width binning."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import distributions, split


@given(st.dictionaries(st.text(min_size=1, max_size=3), st.integers(min_value=0, max_value=10_000),
                       min_size=1, max_size=8),
       st.sampled_from([0.1, 0.2, 0.25, 0.3, 0.5]))
@settings(max_examples=300, deadline=None)
def test_quotas_exact_and_bounded(counts, share):
    q = split.class_quotas(counts, share)
    n = sum(counts.values())
    assert sum(q.values()) == (math.ceil(share * n) if n else 0)
    for c, k in q.items():
        assert 0 <= k <= counts[c]
        # each quota is the floor or ceiling of the proportional share
        exact = counts[c] * math.ceil(share * n) / n if n else 0
        assert math.floor(exact) <= k <= math.ceil(exact)


@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=40),
       st.integers(min_value=1, max_value=12))
@settings(max_examples=15, deadline=None)
def test_histogram_bins_hold_their_values(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    h = distributions.histogram(df, "x", bins).orderBy("bin").collect()
    assert len(h) == bins and sum(r["n"] for r in h) == len(values)
    lo, hi = min(values), max(values)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    for v in values:
        # the arithmetic bin of v, as numpy's edges put it (last bin closed)
        k = min(bins - 1, math.floor((v - lo) * bins / (hi - lo)))
        assert 0 <= k < bins
    got = df.select(distributions.bin_index(F.col("x"), F.lit(lo), F.lit(hi), bins).alias("b")) \
        .groupBy("b").count().collect()
    assert {r["b"]: r["count"] for r in got} == {r["bin"]: r["n"] for r in h if r["n"]}
