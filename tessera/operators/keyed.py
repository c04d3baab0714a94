"""Keyed loads: keep-last de-duplication, upsert and load counters.

Files carry no global row order in Spark, so "last" is defined by an explicit
ordering column (or columns). Upsert is a full-row replace: an incoming NULL
overwrites a stored value, as ``ON CONFLICT DO UPDATE SET col = excluded.col``
does. Results are new DataFrames; versions are written by
``streaming.ingest.commit_version``, never over the path being read.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.plans.strategy import BROADCAST_MAX_BYTES, checkpointed, null_safe_anti, null_safe_full_outer

# A Bloom filter block: four 64-bit words, two bits of each set per key.
BLOOM_WORDS = [f"_bloom_{i}" for i in range(4)]
# Bits of the filter per incoming key; about one other key in a hundred passes.
BLOOM_BITS = 12
# Size of a block as a broadcast row.
BLOOM_ROW_BYTES = 80


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def dedup_keep_last(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """One row per key: the row with the largest ``order`` value(s).

    ``max_by(struct(row), struct(order))`` is an aggregate, so each map task
    combines its rows per key before the shuffle: a key holding a third of
    the rows still sends one partial per task, never its whole group.
    """
    keys = _keys(key)
    orders = _keys(order)
    rest = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*[F.col(c) for c in rest]),
                      F.struct(*[F.col(c) for c in orders])).alias("_last")
    return df.groupBy(*keys).agg(picked).select(*keys, "_last.*").select(*df.columns)


def upsert(base: DataFrame, incoming: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Stored rows whose key is not in ``incoming`` plus every incoming row
    (incoming must already be one row per key, see :func:`dedup_keep_last`).

    The anti join sees unique keys on both sides, so it has no skew. Keys
    match null-safely: a NULL key is one key, as it is one group in
    :func:`dedup_keep_last`.
    """
    keys = _keys(key)
    kept = null_safe_anti(base, incoming.select(*keys), keys)
    return incoming.select(*base.columns).unionByName(kept)


def _bloom_block(keys: Sequence[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks)).alias("_bloom_block")


def _bloom_masks(keys: Sequence[str]) -> list[Column]:
    """The bits of a key in each word of its block, from a second hash of it."""
    other = F.xxhash64(*keys, F.lit(1))

    def bit(k: int) -> Column:
        place = F.shiftrightunsigned(other, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)).alias(w) for i, w in enumerate(BLOOM_WORDS)]


def bloom_filter(incoming: DataFrame, key: str | Sequence[str], blocks: int) -> DataFrame:
    """A Bloom filter of the keys as a table of at most ``blocks`` rows: the
    words of a block are the bits of its keys or-ed together, a mergeable
    aggregate. Filters of one ``blocks`` merge the same way."""
    keys = _keys(key)
    bits = incoming.select(_bloom_block(keys, blocks), *_bloom_masks(keys))
    return bits.groupBy("_bloom_block").agg(*[F.bit_or(w).alias(w) for w in BLOOM_WORDS])


def bloom_split(base: DataFrame, bloom: DataFrame, key: str | Sequence[str],
                blocks: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is surely not in the filter, rows whose key may be).
    Each row meets its block by number; ``bloom`` is broadcast, so no row moves."""
    keys = _keys(key)
    met = base.withColumn("_bloom_block", _bloom_block(keys, blocks)).join(F.broadcast(bloom), "_bloom_block", "left")
    hit = F.lit(True)
    for w, mask in zip(BLOOM_WORDS, _bloom_masks(keys), strict=True):
        hit = hit & (F.col(w).bitwiseAND(mask) == mask)
    hit = F.coalesce(hit, F.lit(False))
    return met.where(~hit).select(*base.columns), met.where(hit).select(*base.columns)


def upsert_bloom(base: DataFrame, incoming: DataFrame, key: str | Sequence[str], bits: int = BLOOM_BITS) -> DataFrame:
    """:func:`upsert` against a large store that is not bucketed: a Bloom filter
    of the incoming keys tells most stored rows to stay where they are, and
    only those that may be replaced are shuffled to the anti join, which
    decides exactly. The store is read once for either part.

    The filter has ``bits`` bits a key, known before it is built. Where it
    would not fit a broadcast (some seventeen million keys), or the key's types
    differ between the sides (their hashes would too), all rows are shuffled:
    :func:`upsert`. The result is the same."""
    keys = _keys(key)
    if any(base.schema[k].dataType != incoming.schema[k].dataType for k in keys):
        return upsert(base, incoming, keys)
    incoming = checkpointed(incoming)
    blocks = max(1, math.ceil(incoming.count() * bits / (64 * len(BLOOM_WORDS))))
    if blocks * BLOOM_ROW_BYTES > BROADCAST_MAX_BYTES:
        return upsert(base, incoming, keys)
    stay, maybe = bloom_split(base, bloom_filter(incoming, keys, blocks), keys, blocks)
    return upsert(maybe, incoming, keys).select(*base.columns).unionByName(stay)


def upsert_counters(raw_incoming: DataFrame, base: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: ``csv_rows`` (incoming rows before de-duplication), ``unique``
    keys, ``csv_dupes`` removed, ``inserted`` (new keys), ``updated``
    (``unique - inserted``) and ``total`` rows after the upsert.

    Key-only work: the raw load is aggregated per key (its row count is the
    sum of the per-key counts), the base is reduced to its keys, and one full
    outer join of the two key tables feeds a single aggregate."""
    keys = _keys(key)
    inc = raw_incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    old = base.select(*keys).withColumn("_old", F.lit(1))
    both = null_safe_full_outer(inc, old, keys)
    return both.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("csv_rows"),
        F.count("_rows").alias("unique"),
        F.count_if(F.col("_rows").isNotNull() & F.col("_old").isNull()).alias("inserted"),
        F.count(F.lit(1)).alias("total"),
    ).select("csv_rows", "unique", (F.col("csv_rows") - F.col("unique")).alias("csv_dupes"),
             "inserted", (F.col("unique") - F.col("inserted")).alias("updated"), "total")


def write_bucketed(df: DataFrame, table: str, key: str | Sequence[str], buckets: int,
                   path: str | None = None) -> DataFrame:
    """Store a keyed table bucketed (and sorted) by its key as a catalog table,
    optionally at ``path`` in the shared folder. Later upserts against it
    shuffle only the incoming keys: the anti join reads the stored table
    bucket by bucket (``Bucketed: true``, no exchange on that side) when the
    shuffle partition count equals ``buckets``."""
    keys = _keys(key)
    w = df.write.bucketBy(buckets, *keys).sortBy(*keys).mode("errorifexists").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return df.sparkSession.table(table)
