"""Exact de-duplication by skew-safe combining.

Three stages, each comparing full content because the text itself is part of
the grouping key:

1. rows equal in (digest, salt, text) are combined inside each input task
   (partial aggregation: a hot text leaves a task as one row),
2. the partial rows are merged per (digest, salt, text), so copies of one hot
   text that come from many tasks are dealt over ``salts`` tasks,
3. the salt winners are merged per (digest, text).

The digest spreads and shortens comparisons; it never decides equality. The
map back to all rows goes by digest once stage 3 has shown that the digest
stands for one text; digests that stand for several (a collision) go by text.

Defined results: a NULL text counts as empty; the largest id stays (NULL ids
lose to any other); of rows with the same text and the same id exactly one is
kept; an empty table gives an empty result; other columns are ignored by
``exact_duplicates`` and carried by ``drop_exact_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage

SALTS = 16


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def _combined(rows: DataFrame, best: str, salts: int) -> DataFrame:
    """(digest, text, best, n): stages 1 to 3. ``salt_id`` deals copies out."""
    salt = F.pmod(F.xxhash64("salt_id"), F.lit(salts))
    salted = (rows.groupBy("digest", salt.alias("salt"), "text")
              .agg(F.max(best).alias(best), F.sum("n").alias("n")))
    return salted.groupBy("digest", "text").agg(F.max(best).alias(best), F.sum("n").alias("n"))


def exact_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                     salts: int = SALTS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), F.col(id_col).alias("salt_id"), text.alias("text"),
                     _digest(text).alias("digest"), F.lit(1).cast("bigint").alias("n"))
    winners = _combined(rows, "id", salts)
    by_digest = cut_lineage(
        winners.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.max("id").alias("keep_id"),
                                      F.sum("n").alias("group_size")))
    # repeated (text, id) rows travel as one row with a count
    members = rows.groupBy("digest", "id").agg(F.sum("n").alias("n"))
    one = by_digest.where("texts = 1").select(F.col("digest").alias("d"), "keep_id", "group_size")
    out = members.join(one, F.col("digest") == F.col("d")).drop("d")
    clash = by_digest.where("texts > 1").select(F.col("digest").alias("d"))
    if not clash.isEmpty():
        out = out.unionByName(_by_text(rows, clash, salts))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    return out.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def _by_text(rows: DataFrame, clash: DataFrame, salts: int) -> DataFrame:
    """Members of digests that stand for several texts, matched by text."""
    rows = rows.join(clash, F.col("digest") == F.col("d"), "left_semi")
    best = _combined(rows, "id", salts).select(
        F.col("text").alias("t"), F.col("id").alias("keep_id"), F.col("n").alias("group_size"))
    members = rows.groupBy("digest", "text", "id").agg(F.sum("n").alias("n"))
    return members.join(best, F.col("text") == F.col("t")).drop("t", "text")


def drop_exact_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                          salts: int = SALTS) -> DataFrame:
    """The rows that stay, with all their columns (which must be orderable:
    of rows equal in text and id the largest by the other columns stays)."""
    others = [c for c in df.columns if c not in (text_col, id_col)]
    row = F.struct(F.col(id_col).alias("id"), F.col(text_col).isNotNull().alias("has_text"),
                   *[F.col(c).alias(f"c{i}") for i, c in enumerate(others)])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(row.alias("best"), F.col(id_col).alias("salt_id"), text.alias("text"),
                     _digest(text).alias("digest"), F.lit(1).cast("bigint").alias("n"))
    won = _combined(rows, "best", salts)
    back = {id_col: F.col("best.id"),
            text_col: F.when(F.col("best.has_text"), F.col("text")),
            **{c: F.col(f"best.c{i}") for i, c in enumerate(others)}}
    return won.select(*[back[c].cast(df.schema[c].dataType).alias(c) for c in df.columns])
