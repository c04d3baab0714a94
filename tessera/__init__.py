"""tessera: a Spark-native tabular analytics toolkit.

Keyed ingest with data-quality checks, parameterised reports, missing-value
profiling and imputation, feature preparation, exact stratified splitting,
linear and logistic models, evaluation tables and distribution tables, all
expressed as DataFrame / Spark SQL / ``pyspark.ml`` work.

Layout:

* ``sources``    -- table access, typed CSV/JSON scans, catalog helpers
* ``functions``  -- column expressions (banding, row sums, cleaning, decoding)
* ``operators``  -- reports, keyed loads, quality checks, features, split,
                    models, evaluation, distributions
* ``plans``      -- join/prefix-sum strategies, driver-table bindings, the
                    query registry and its SQL oracle
* ``streaming``  -- incremental keyed loads with Structured Streaming
* ``apps``       -- the survey application and the model flows, with
                    command-line entry points
"""

from tessera.session import local_session, scale_settings, scratch_dir

__all__ = ["local_session", "scale_settings", "scratch_dir"]
