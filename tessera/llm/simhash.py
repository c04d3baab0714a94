"""SimHash near-duplicates with pigeonring filtering.

Fingerprints: 64 bits over word shingles; a bit is 1 if it is set in over
half of the shingle hashes (XXH64, seed 42), repeats included.

Linking: two fingerprints link at ``max_bits`` (3) or fewer differing bits.
The 64 bits are a ring of 8 segments of 8 bits. By the pigeonring principle,
if the differences sum to at most 3 there is a segment from which every chain
of l consecutive segments has at most floor(3 l / 8) differences: 0, 0, 1, 1,
1, 2, 2, 3 for l = 1..8. A chain of five thus has two equal segments followed
by three of which at least two are equal. Each distinct fingerprint is
therefore filed under 8 starts x 3 choices of the segment left out: 24 keys
of 32 exact bits, on which any linked pair must meet. Pairs that meet go through
the chain of budgets segment by segment, and only those that pass it through the
full Hamming check.

No group emits all its pairs: the members of a key are compared in blocks
inside a task, which emits a spanning forest of the links (at most one row a
member). A key with more than ``block`` members is dealt out as tiles of two
blocks, so it fills many tasks and never more than two blocks of memory.
Exact copies of a fingerprint are merged before, so they meet once.

Components: minimum labels spread over the forest by alternating large-star
and small-star steps, each checkpointed in the shared folder.

Defined results: NULL, empty and blank texts have no words and fingerprint
zero, which links like any other; fewer words than a shingle make one shingle
of all words; NULL ids get a row and never name a component that has other
ids; repeated rows each get a row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tessera.llm.common import cut_lineage, for_workers, map_arrow

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCK = 1024
SEGMENTS = 8
#: Shingles whose bits are counted at once (64 bytes each).
CHUNK = 1 << 14
#: Pairs of a key that are compared at once.
PAIRS = 1 << 17


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text, unsigned."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and blank, \\t..\\r
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(shingle, len(words)) - 1:]
    parts = (line[a:b] for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True))
    hashes = np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        bits = np.unpackbits(hashes[i:i + CHUNK].astype(">u8").view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint as a signed long, one row per input row."""
    kind = df.schema[id_col].dataType

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fp = np.fromiter((fingerprint(t, shingle) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    return map_arrow(df.select(F.col(id_col), F.col(text_col).cast("string")), run, f"id {kind.simpleString()}, fp long")


def _keys(fp: Column) -> Column:
    """The 24 (number, 32 exact bits) keys as longs: number in the high half."""
    seg = [F.shiftrightunsigned(fp, 8 * i).bitwiseAND(255) for i in range(SEGMENTS)]
    keys = []
    for start in range(SEGMENTS):
        for out in range(3):
            chain = [(start + k) % SEGMENTS for k in range(5) if k != 2 + out]
            key = F.lit(start * 3 + out).cast("bigint")
            for s in chain:
                key = F.shiftleft(key, 8).bitwiseOR(seg[s])
            keys.append(key)
    return F.array(*keys)


def chain(x: np.ndarray, start: int, max_bits: int) -> np.ndarray:
    """Numbers of the differences whose chains of 1..7 segments from ``start``
    stay within their proportional budgets; a lane that fails leaves at once."""
    lanes, total = np.arange(len(x)), np.zeros(len(x), np.uint8)
    for length in range(1, SEGMENTS):
        segment = np.uint64(8 * ((start + length - 1) % SEGMENTS))
        total = total + np.bitwise_count((x[lanes] >> segment) & np.uint64(255))
        ok = total <= max_bits * length // SEGMENTS
        if not ok.all():
            lanes, total = lanes[ok], total[ok]
    return lanes


def near_pairs(fp: np.ndarray, start: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(i, j, pairs met, pairs left by the chain) with i > j at most ``max_bits``
    apart, some ``PAIRS`` pairs at a time: the chain first, then the full check."""
    lo = 1
    while lo < len(fp):
        hi = min(len(fp), max(lo + 1, lo + PAIRS // len(fp)))
        size = np.arange(lo, hi)
        i = np.repeat(size, size)
        j = np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size)
        x = fp[i] ^ fp[j]
        left = chain(x, start, max_bits)
        near = left[np.bitwise_count(x[left]) <= max_bits]
        yield i[near], j[near], len(x), len(left)
        lo = hi


def _forest(fp: np.ndarray, start: int, max_bits: int) -> list[tuple[int, int]]:
    """Spanning links of the fingerprints that share a key: (larger, smaller)."""
    root = list(range(len(fp)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i, j, _, _ in near_pairs(fp, start, max_bits):
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                root[max(ra, rb)] = min(ra, rb)
                links.append((a, b))
    return links


def _compare(max_bits: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fp = np.unique(pdf["fp"].to_numpy(np.int64)).view(np.uint64)
        links = _forest(fp, int(key[0] >> 32) // 3, max_bits)
        at = fp.view(np.int64)
        a = np.array([at[i] for i, _ in links], np.int64)
        b = np.array([at[j] for _, j in links], np.int64)
        return pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)})
    return run


def links_between(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a > b) whose components are those of all pairs within
    ``max_bits``; ``fps`` holds distinct fingerprints in ``fp``."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the 24 keys meet for up to 3 differing bits")
    for_workers(fps.sparkSession)
    filed = fps.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    shared = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = filed.join(shared, "key")
    # a key's members in blocks of about `block`; tiles are pairs of blocks
    met = met.withColumn("tiles", F.ceil(F.col("n") / block).cast("int"))
    met = met.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    met = met.select("key", "fp", F.least("own", "other").alias("t1"), F.greatest("own", "other").alias("t2"))
    return met.groupBy("key", "t1", "t2").applyInPandas(_compare(max_bits), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for the nodes on links.

    Links are kept as (node, lower neighbour); each round connects every
    node's larger neighbours to its minimum (large-star), then its smaller
    ones (small-star), until nothing changes. Minima are partial
    aggregates, so a node with very many links is combined map-side, and the
    joins back are skew-split by AQE."""
    edges = cut_lineage(links.select("a", "b").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        new = cut_lineage(small.select("e.a", "e.b").where("a <> b").distinct())
        same = new.select(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        old = edges.select(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        edges = new
        if tuple(same) == tuple(old):
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)


def _named(docs: DataFrame, max_bits: int, block: int) -> DataFrame:
    """(id, fp, label, component_id) of fingerprinted rows; the label is the component's own."""
    classes = cut_lineage(docs.groupBy("fp").agg(F.min("id").alias("least")))
    nodes = components(links_between(classes.select("fp"), max_bits, block))
    named = classes.join(nodes, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    names = named.join(least, "label").select(F.col("fp").alias("f"), "label", "component_id")
    return docs.join(names, F.col("fp") == F.col("f")).drop("f")


def near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(id, fp, component_id) for every row; component_id is the smallest id
    reachable over links."""
    docs = cut_lineage(fingerprints(df, text_col, id_col, shingle))
    return _named(docs, max_bits, block).select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                         shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with all its columns: the one with the
    smallest id, NULL last. Rows whose id is NULL or not theirs alone are
    numbered, and of several with that id any one stays."""
    docs = cut_lineage(fingerprints(df, text_col, id_col, shingle))
    named = _named(docs, max_bits, BLOCK)
    shared = cut_lineage(docs.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("id IS NULL OR n > 1").select(
        F.col("id").alias("shared__id")))
    if shared.isEmpty():
        stay = named.where("id = component_id").select(F.col("component_id").alias("stay__id"))
        return df.join(stay, F.col(id_col) == F.col("stay__id"), "left_semi")
    # NULL ids take no part in the join, so they do not meet in one task
    same = F.col(id_col) == F.col("shared__id")
    rows = cut_lineage(df.where(F.col(id_col).isNull()).unionByName(df.join(shared, same, "left_semi"))
                       .withColumn("stay__row", F.monotonically_increasing_id()))
    named = cut_lineage(named)
    alone = named.where("id = component_id").join(shared, F.col("id") == F.col("shared__id"), "left_anti").select(
        F.col("id").alias("stay__id"))
    labels = named.groupBy("fp").agg(F.first("label").alias("label"), F.first("component_id").alias("component_id"))
    numbered = fingerprints(rows, text_col, "stay__row", shingle).select(F.col("id").alias("row__n"), F.col("fp").alias("f"))
    chosen = (rows.select("stay__row", F.col(id_col).alias("own__id")).join(numbered, F.col("stay__row") == F.col("row__n"))
              .join(labels, F.col("f") == F.col("fp")).where(F.col("own__id").eqNullSafe(F.col("component_id")))
              .groupBy("label").agg(F.min("row__n").alias("row__n")))
    return df.join(alone, F.col(id_col) == F.col("stay__id"), "left_semi").unionByName(
        rows.join(chosen, F.col("stay__row") == F.col("row__n"), "left_semi").drop("stay__row"))


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
