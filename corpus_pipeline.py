"""The corpus pipeline: ``run`` applies ``STAGES`` to ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontam, exact, packing, simhash, toxicity
from tessera.llm.queries import toxicity_labels
from tessera.session import scratch_path
from tessera.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    chain = toxicity.train(docs, toxicity_labels(spark, sf_dir), ["low_quality", "toxic"])
    return toxicity.keep(docs, chain, "toxic")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints (3-word shingles, at most 3 bits
    apart) the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window of 10 words go."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, one row per piece."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontaminate), ("packing", pack)]
#: Learnt models, fingerprints and token ids are beyond SQL; tests/llm holds a
#: brute-force version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written as Parquet to the shared folder and
    reread as the next stage's documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
