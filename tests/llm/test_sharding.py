import zlib
from collections import Counter
from itertools import product

from pyspark.sql import functions as F

from tessera.llm import queries, sharding


def curve(point, bits):
    """The same curve by the textbook loop (axes to transposed index)."""
    x, n, q = list(point), len(point), 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    h = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            h = h * 2 + (v >> b & 1)
    return h


def test_curve_visits_neighbours(spark):
    points = spark.createDataFrame(list(product(range(8), repeat=3)), "x int, y int, z int")
    got = points.withColumn("h", sharding.hilbert_index([F.col(c) for c in "xyz"], 3)).collect()
    assert sorted(r.h for r in got) == list(range(512))
    assert all(r.h == curve((r.x, r.y, r.z), 3) for r in got)
    at = {r.h: (r.x, r.y, r.z) for r in got}
    assert all(sum(abs(a - b) for a, b in zip(at[k], at[k + 1])) == 1 for k in range(511))


def brute(spark, rows, shards=24):
    def size_code(n):
        b = n.bit_length()
        return 2 * b + (n >> (b - 2) & 1 if b > 1 else 0)

    def steps(values):
        """2**5 times the mean rank of a value's rows; None first, text by its bytes."""
        key = {v: (v is not None, v.encode() if isinstance(v, str) else v) for v in values}
        count = Counter(values)
        at, out = 0, {}
        for v in sorted(count, key=key.get):
            out[v] = (2 * at + count[v]) * 32 // (2 * len(values))
            at += count[v]
        return [out[v] for v in values]

    data = [(t or "").encode() for _, t, _, _ in rows]
    carried = [(len(d) + 8, zlib.crc32(d)) for d in data]
    dims = zip(steps([r[2] for r in rows]), steps([r[3] for r in rows]), steps([size_code(s) for s, _ in carried]))
    hashed = spark.createDataFrame([(k, r[0], *c) for k, (r, c) in enumerate(zip(rows, carried))], "k int, i long, s long, c long")
    high = {r.k: r.h >> 24 for r in hashed.select("k", F.xxhash64("i", "s", "c").alias("h")).collect()}
    order = sorted((curve(d, 5), high[k], str(rows[k][0]), *carried[k], k) for k, d in enumerate(dims))
    n, out, slot = len(order), [], {}
    for rank, (cell, _, _, size, crc, k) in enumerate(order):
        s = rank * shards // n
        out.append((rows[k][0], size, crc, s, slot.setdefault(s, 0), cell))
        slot[s] += 1
    return sorted(out, key=str)


def shards_of(docs, **kw):
    size = F.octet_length(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")).cast("bigint") + 8
    return sharding.hilbert_shards(docs, "doc_id", {
        "lang": F.col("lang"), "source": F.col("source"), "size": sharding.size_code(size)}, {"size": size, "crc": F.crc32(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8"))}, **kw)


def test_against_brute_force(spark, odd, empty):
    rows = [tuple(r) for r in odd.select("doc_id", "text", "lang", "source").collect()]
    for shards in (3, 24):
        got = shards_of(odd, shards=shards).select("doc_id", "size", "crc", "shard", "slot", "cell").collect()
        assert sorted(map(tuple, got), key=str) == brute(spark, rows, shards)
    assert shards_of(empty).count() == 0


def test_query_against_brute_force(spark, small):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    got = queries.op7_hilbert_shards(spark, d).select("doc_id", "size", "text_crc32", "shard", "slot", "cell").collect()
    assert sorted(map(tuple, got), key=str) == brute(spark, rows)
    sizes = [sum(r.shard == s for r in got) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1


def test_filters_prune_by_every_value(spark):
    """Shards whose min and max of the column hold the value, for each value."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = docs.select("doc_id", "lang", "source").join(shards_of(docs).select("doc_id", "shard"), "doc_id")
    for c in ("lang", "source"):
        spans = rows.groupBy("shard").agg(F.min(c).alias("lo"), F.max(c).alias("hi")).collect()
        kept = {v: sum(s.lo <= v <= s.hi for s in spans) for (v,) in rows.select(c).distinct().collect()}
        share = {r[c]: r["count"] / docs.count() for r in rows.groupBy(c).count().collect()}
        assert all(k <= 12 + 24 * share[v] for v, k in kept.items()), kept


def test_text_ids_and_one_hot_row(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 != 0, F.concat(F.lit("n"), "id")).alias("doc_id"),
                                    F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("text"),
                                    F.lit("en").alias("lang"), F.when(F.col("id") % 2 == 0, "a").alias("source"))
    got = shards_of(docs).collect()
    assert len(got) == 3000 and sorted(Counter(r.shard for r in got).values()) == [125] * 24
    assert {(r.shard, r.slot) for r in got} == {(s, k) for s in range(24) for k in range(125)}
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())
