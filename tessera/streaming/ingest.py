"""Incremental keyed loads with Structured Streaming.

Loads arrive as files in a landing folder; a streaming query picks them up
(optionally at most ``files_per_batch`` files per micro-batch) and merges each
batch into a versioned table: per key the row with the largest ordering
columns stays, whether it was stored or is incoming. So neither the grouping
of files into batches nor the order of the batches changes the table.

A versioned table is dealt into ``buckets`` by a hash of its key. A version
writes only the buckets its batch touches, each to a new folder
(``v<n>/_bucket=<k>``), never over one that is read; the table is the newest
folder of every bucket. A version becomes visible when its rows are appended
to the manifest (a small Parquet table: version, bucket, filled, buckets,
stream, epoch). Versions count up from the newest one, and the manifest also
records which (stream, epoch) made them, so a replayed epoch applies once and
a new stream on an old table starts with its first epoch.
"""

from __future__ import annotations

import hashlib
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.keyed import dedup_keep_last
from tessera.session import scratch_path
from tessera.sources.files import _string_schema, _typed

BUCKETS = 16
MANIFEST = "version long, bucket int, filled boolean, buckets int, stream string, epoch long"


def _manifest(spark: SparkSession, table_dir: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(_manifest_path(table_dir))
    except AnalysisException as e:      # no manifest yet: no committed version
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MANIFEST)
        raise


def _manifest_path(table_dir: str) -> str:
    return f"{table_dir.rstrip('/')}/manifest"


def version_path(table_dir: str, version: int) -> str:
    return f"{table_dir.rstrip('/')}/v{version:09d}"


def newest_version(spark: SparkSession, table_dir: str) -> int | None:
    return _manifest(spark, table_dir).agg(F.max("version")).first()[0]


def list_versions(spark: SparkSession, table_dir: str) -> list[int]:
    """Committed version numbers, oldest first (for inspection)."""
    return sorted(r[0] for r in _manifest(spark, table_dir).select("version").distinct().collect())


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def latest_version(spark: SparkSession, table_dir: str, schema, only: Sequence[int] | None = None) -> DataFrame:
    """The newest folder of every bucket (or of those in ``only``); an empty
    table of ``schema`` when there is none. Reads one manifest row a bucket."""
    rows = _manifest(spark, table_dir)
    if only is not None:
        rows = rows.where(F.col("bucket").isin(list(only)))
    newest = rows.groupBy("bucket").agg(F.max(F.struct("version", "filled")).alias("at")).select("bucket", "at.*")
    paths = [f"{version_path(table_dir, r['version'])}/_bucket={r['bucket']}" for r in newest.collect() if r["filled"]]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def table_buckets(spark: SparkSession, table_dir: str, default: int = BUCKETS) -> int:
    """The bucket count the table was made with."""
    return _manifest(spark, table_dir).agg(F.max("buckets")).first()[0] or default


def commit_version(spark: SparkSession, table_dir: str, df: DataFrame, key: Sequence[str],
                   only: Sequence[int] | None = None, stream: str | None = None, epoch: int | None = None) -> int:
    """Write ``df`` as the next version of its buckets (of all, unless ``only``
    names those it touches), then record it. A partial earlier attempt is
    replaced; nothing of it was visible."""
    buckets = table_buckets(spark, table_dir)
    newest = newest_version(spark, table_dir)
    version = 0 if newest is None else newest + 1
    path = version_path(table_dir, version)
    df.withColumn("_bucket", _bucket(list(key), buckets)).repartition("_bucket") \
        .write.mode("overwrite").partitionBy("_bucket").parquet(path)
    filled = {r[0] for r in spark.read.schema("_bucket int").parquet(path).distinct().collect()}
    rows = [(version, k, k in filled, buckets, stream, epoch) for k in (range(buckets) if only is None else only)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(_manifest_path(table_dir))
    return version


def merge_batch(spark: SparkSession, table_dir: str, schema, batch: DataFrame, key: Sequence[str], order: Sequence[str],
                stream: str | None = None, epoch: int | None = None) -> int | None:
    """Merge a batch by key into the buckets it touches. Returns the version, or
    None for an empty batch or an epoch that was applied before."""
    key, order = list(key), list(order)
    if stream is not None and not _manifest(spark, table_dir).where(
            (F.col("stream") == stream) & (F.col("epoch") == epoch)).isEmpty():
        return None
    incoming = dedup_keep_last(batch, key, order)
    buckets = table_buckets(spark, table_dir)
    touched = sorted(r[0] for r in batch.select(_bucket(key, buckets).alias("b")).distinct().collect())
    if not touched:
        return None
    stored = latest_version(spark, table_dir, schema, touched)
    return commit_version(spark, table_dir, dedup_keep_last(stored.unionByName(incoming), key, order), key,
                          touched, stream, epoch)


def upsert_stream(spark: SparkSession, landing_dir: str, schema, key: Sequence[str],
                  order: Sequence[str], table_dir: str, checkpoint_dir: str,
                  files_per_batch: int | None = None, available_now: bool = True,
                  fmt: str = "parquet", required: Sequence[str] = ()):
    """Start the streaming upsert; returns the ``StreamingQuery``.

    ``fmt="csv"`` lands CSV files with a header: every declared column is read
    as text, the header is checked against the declared names
    (``enforceSchema=false``, so a file with other or reordered columns fails
    instead of loading wrong values), and each batch is cast by name as the
    batch reader does (malformed optional values become NULL, required ones
    raise)."""
    key, order = list(key), list(order)
    typed_batch = (lambda b: b) if fmt == "parquet" else (
        lambda b: _typed(b, schema, set(required)))

    # a restarted stream keeps its checkpoint folder, and with it this name
    stream = hashlib.sha256(checkpoint_dir.encode()).hexdigest()[:16]

    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        merge_batch(spark, table_dir, schema, typed_batch(batch), key, order, stream, epoch_id)

    if fmt == "parquet":
        reader = spark.readStream.schema(schema)
    elif fmt == "csv":
        reader = (spark.readStream.schema(_string_schema(schema)).option("header", True)
                  .option("enforceSchema", False))
    else:
        raise ValueError(f"unsupported landing format {fmt!r}")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    source = reader.parquet(landing_dir) if fmt == "parquet" else reader.csv(landing_dir)
    writer = (source.writeStream.foreachBatch(apply_batch)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def run_upsert_stream(spark: SparkSession, loads: Sequence[DataFrame], key: Sequence[str],
                      order: Sequence[str]) -> DataFrame:
    """Land the loads one after the other (parallel writes), run the stream on
    each until it has consumed every landed file (so a later load meets a
    stored version), and return the table."""
    schema = loads[0].schema
    landing = scratch_path(spark, "landing")
    table_dir = scratch_path(spark, "table")
    ckpt = scratch_path(spark, "stream-ckpt")
    for i, load in enumerate(loads):
        load.write.parquet(f"{landing}/load-{i:06d}")
        upsert_stream(spark, f"{landing}/*", schema, key, order, table_dir, ckpt).awaitTermination()
    return latest_version(spark, table_dir, schema)
