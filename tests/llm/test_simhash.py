import random
import re

import numpy as np
import xxhash

from tessera.llm import queries, simhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return 0
    parts = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits=3):
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def want(rows):
    fps = [brute_fp(t) for _, t in rows]
    of = brute_components(fps)
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[of[f]] = min(i, least.get(of[f], i))
    return sorted(((i, f"{f:016x}", least.get(of[f])) for (i, _), f in zip(rows, fps)), key=str)


def test_query_against_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    got = queries.op9_simhash(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect()), key=str) == want(rows)


def test_odd_rows(odd, empty):
    from pyspark.sql import functions as F
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = simhash.near_duplicates(odd).select("doc_id", simhash.hex_fingerprint(F.col("fp")), "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == want(rows)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {w[2] for w in want(rows)}


def test_every_pair_within_three_bits_meets():
    rng = random.Random(1)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), rng.randint(1, 3)):
            b ^= 1 << k
        assert any(simhash._forest(np.array([a, b], np.uint64), s, 3) for s in range(8))


def test_links_of_dense_groups_match_all_pairs(spark):
    """A ball of near fingerprints under one key, more than a block of them."""
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(4)]
    fps = {c ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(120)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    for block in (1024, 16):
        links = simhash.links_between(spark.createDataFrame([(f,) for f in signed], "fp long"), 3, block)
        pairs = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in links.collect()]
        assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
        got = {r.node: r.label for r in simhash.components(links).collect()}
        of = brute_components(fps)
        groups, mine = {}, {}
        for f, s in zip(fps, signed):
            groups.setdefault(of[f], set()).add(s)
            mine.setdefault(got.get(s, s), set()).add(s)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_components_of_a_long_path(spark):
    path = spark.range(1, 60).selectExpr("id AS a", "id - 1 AS b")
    got = simhash.components(path)
    assert {r.label for r in got.collect()} == {0} and got.count() == 60


def test_one_row_of_each_component_stays_with_null_and_repeated_ids(spark):
    said = {k: " ".join(f"{k}{j}" for j in range(30)) for k in "abcde"}
    rows = [(1, said["a"], 0), (None, said["a"], 1), (None, said["b"], 2), (None, said["b"], 3), (2, said["c"], 4),
            (2, said["a"], 5), (2, said["c"], 6), (3, said["d"], 7), (3, said["e"], 8), (None, said["d"], 9)]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted(
        [("1", said["a"]), ("None", said["b"]), ("2", said["c"]), ("3", said["d"]), ("3", said["e"])])


def test_the_chain_prunes_before_the_full_check():
    rng = np.random.default_rng(5)
    # a key of start 2 that leaves segment 5 out: segments 2, 3, 4 and 6 are equal
    fixed = sum(255 << 8 * s for s in (2, 3, 4, 6))
    fp = np.unique(rng.integers(0, 1 << 64, 3000, np.uint64) & np.uint64(~fixed & (1 << 64) - 1) | np.uint64(0x5A5A5A5A5A5A5A5A & fixed))
    near = fp[:200] ^ np.uint64(1 << 40)
    fp = np.unique(np.concatenate((fp, near)))
    met = left = 0
    links = set()
    for i, j, m, n in simhash.near_pairs(fp, 2, 3):
        met, left = met + m, left + n
        links |= set(zip(i.tolist(), j.tolist()))
    assert met == len(fp) * (len(fp) - 1) // 2
    # of the pairs that share the key few pass the chain, and nearly all of these are links
    assert left < met / 100 and len(links) <= left and len(links) >= 200
    ints = fp.tolist()
    want = {(i, j) for i, j in links if (ints[i] ^ ints[j]).bit_count() <= 3}
    assert links == want
