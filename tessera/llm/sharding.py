"""Sharding along a Hilbert curve through several metadata dimensions.

Each dimension is quantised to ``2**bits`` steps by rank: its distinct values
are counted, ordered as whole values, and a value's step is the mean rank of its
rows. The steps are mapped to their index on the Hilbert curve, rows are
ordered by that index and the order is cut into ``shards`` runs. Rows that are
near in *all* dimensions end in the same file, so min/max statistics of the
files prune filters on any of them.

Law ``rows``: shard sizes differ by at most one row. Shard = floor(rank *
shards / n).

Within a cell rows are ordered by a hash of id and carried columns, so ids may
have any type that has a hash, and a cell, an id or a copy that holds a third of
the rows is still ranked by many tasks.

Defined results: NULL in a dimension comes before all its values; NULL ids are
like any other; rows equal in id and carried columns take the ranks among them
in any order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, cut_points, ranked
from tessera.plans.strategy import join_small

BITS = 5
SHARDS = 24
ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 4096


def weight_steps(rows: DataFrame, col: str, bits: int, out: str) -> DataFrame:
    """(value, step): 2**bits times the mean rank of the value's rows as a share of
    all rows, floored, so a frequent value is far from its neighbours.
    Values are ordered in ranges; a range's total is one row of a small table."""
    order = F.asc_nulls_first(col)
    counts = cut_lineage(rows.groupBy(col).agg(F.count(F.lit(1)).alias("n")).repartitionByRange(order)
                         .withColumn("part", F.spark_partition_id()))
    parts = Window.partitionBy(F.lit(0))
    sizes = counts.groupBy("part").agg(F.sum("n").alias("size")).select(
        "part", (F.sum("size").over(parts.orderBy("part")) - F.col("size")).alias("before"),
        F.sum("size").over(parts).alias("total"))
    within = Window.partitionBy("part").orderBy(order)
    # one row a range, as many as shuffle partitions
    placed = counts.join(F.broadcast(sizes), "part").withColumn("at", F.col("before") + F.sum("n").over(within) - F.col("n"))
    return placed.select(col, F.expr(f"(2 * at + n) * {1 << bits} DIV (2 * total)").alias(out))


def size_code(col: Column) -> Column:
    """About twice the binary logarithm: bit length and the second highest bit."""
    bits = F.length(F.bin(col))
    second = F.when(bits > 1, F.substring(F.bin(col), 2, 1).cast("int")).otherwise(0)
    return (2 * bits + second).cast("bigint")


def hilbert_index(steps: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a point with ``bits`` bits per dimension
    (the transposed form of the index, folded from the top bit down)."""
    n = len(steps)
    point = F.array(*[s.cast("bigint") for s in steps])
    at = lambda a, i: F.element_at(a, (i + F.lit(1)).cast("int"))

    def turn(x: Column, bit: Column, i: Column) -> Column:
        """One rotation or reflection, on dimension ``i`` at ``bit``."""
        low = bit - 1
        swap = at(x, F.lit(0)).bitwiseXOR(at(x, i)).bitwiseAND(low)
        flip = at(x, i).bitwiseAND(bit) != 0
        return F.transform(x, lambda v, j: F.when(flip, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
                           .when((j == 0) | (j == i), F.when(i == 0, v).otherwise(v.bitwiseXOR(swap)))
                           .otherwise(v))

    dims = F.array(*[F.lit(i).cast("int") for i in range(n)])
    high = [F.lit(1 << b).cast("bigint") for b in range(bits - 1, 0, -1)]
    if high:
        point = F.aggregate(F.array(*high), point,
                            lambda x, bit: F.aggregate(dims, x, lambda y, i: turn(y, bit, i)))
    # Gray code: running exclusive or over the dimensions
    gray = F.aggregate(point, F.array().cast("array<bigint>"), lambda acc, v: F.concat(
        acc, F.array(v.bitwiseXOR(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0).cast("bigint"))))))
    if high:
        fix = lambda g: F.aggregate(
            F.array(*high), F.lit(0).cast("bigint"),
            lambda t, bit: F.when(F.element_at(g, -1).bitwiseAND(bit) != 0, t.bitwiseXOR(bit - 1)).otherwise(t))
        gray = F.element_at(F.transform(F.array(gray), lambda g: F.transform(g, lambda v: v.bitwiseXOR(fix(g)))), 1)
    # interleave, top bit first
    places = F.array(*[F.lit(1 << b).cast("bigint") for b in range(bits - 1, -1, -1)])
    return F.aggregate(places, F.struct(F.lit(0).cast("bigint").alias("h"), gray.alias("g")),
                       lambda s, bit: F.struct(F.aggregate(
                           s["g"], s["h"], lambda h, v: h * 2 + F.when(v.bitwiseAND(bit) != 0, 1).otherwise(0)).alias("h"),
                           s["g"].alias("g")),
                       lambda s: s["h"])


def hilbert_shards(df: DataFrame, id_col: str, dims: dict[str, Column], carry: dict[str, Column],
                   shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """id, the carried columns, cell (curve index), shard and slot (gapless
    from 0 within the shard). ``dims`` maps names to orderable columns. Only ids,
    dimensions and carried columns are shuffled."""
    codes, ties = [f"dim_{i}" for i in range(len(dims))], [f"carry_{i}" for i in range(len(carry))]
    rows = df.select(F.col(id_col).alias("row_id"), *[c.alias(k) for k, c in zip(codes, dims.values(), strict=True)],
                     *[c.alias(k) for k, c in zip(ties, carry.values(), strict=True)])
    # content in the high bits; the low ones tell equal rows apart, so that they can be dealt out
    low = (1 << 24) - 1
    spread = F.xxhash64("row_id", *ties).bitwiseAND(~low).bitwiseOR(
        F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(low))
    rows = cut_lineage(rows.withColumn("spread", spread))
    n = rows.count()
    placed = rows
    for c in codes:
        placed = join_small(placed, weight_steps(rows, c, bits, f"step_{c}"), c, null_safe=True)
    buckets = min(MAX_BUCKETS, max(64, -(-n // ROWS_PER_BUCKET)))
    cuts = cut_points(rows, F.col("spread"), buckets) if n else []
    cell = hilbert_index([F.col(f"step_{c}") for c in codes], bits)
    placed = placed.select("row_id", *ties, "spread", cell.alias("cell"), F.lit(0).alias("all"))
    placed = ranked(placed, ["all"], ["cell", "spread"], "spread", cuts, "rank")
    shard = F.expr(f"CAST(rank * {shards} DIV {max(n, 1)} AS INT)")
    first = F.expr(f"(CAST(rank * {shards} DIV {max(n, 1)} AS BIGINT) * {n} + {shards - 1}) DIV {shards}")
    return placed.select(
        F.col("row_id").alias(id_col), *[F.col(t).alias(k) for t, k in zip(ties, carry, strict=True)],
        "cell", shard.alias("shard"), (F.col("rank") - first).alias("slot"))
