import hashlib
import math

import numpy as np
import pytest

from tessera.llm import codes, queries

SCHEMA = "vec_id long, embedding array<double>, label int, code string, id int, error int"


def brute(rows, parts=8, entries=16, rounds=6):
    """{(id, place): (code, error)}, digest of the books; rows of (id, vector)."""
    kept = [(i, [math.floor(4096 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0], kept[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            at = [near(c[p], books[p])[1] for c in cut]
            for e in range(len(books[p])):
                mine = [c[p] for c, k in zip(cut, at) if k == e]
                if mine:
                    books[p] = [*books[p][:e], [sum(col) // len(mine) for col in zip(*mine)], *books[p][e + 1:]]
    out = []
    for (i, _), c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    said = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(out), hashlib.sha256(said.encode()).hexdigest()


@pytest.mark.parametrize("k,dim,n,span", [(16, 8, 400, 20), (1, 3, 9, 5), (5, 1, 200, 3), (16, 8, 400, 2), (7, 2, 50, 1 << 40)])
def test_search_finds_the_nearest_and_ties_to_the_lower_index(k, dim, n, span):
    rng = np.random.default_rng(k)
    points, book = rng.integers(-span, span, (n, dim)), rng.integers(-span, span, (k, dim))
    if span > 1 << 30:
        points, book = points.astype(object), book.astype(object)
    index, best, computed = codes.equal_average(points, book)
    all_ = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    assert index.tolist() == [min(range(k), key=lambda e: (row[e], e)) for row in all_] and best.tolist() == all_.min(axis=1).tolist()
    assert computed <= n * k


def test_search_leaves_entries_out():
    rng = np.random.default_rng(2)
    # sums far apart: only neighbours in the order of sums are looked at
    book = np.arange(64)[:, None] * 100 + rng.integers(0, 3, (64, 8))
    points = book[rng.integers(0, 64, 1000)] + rng.integers(-5, 6, (1000, 8))
    assert codes.equal_average(points, book)[2] < 3 * 1000


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    got = queries.op12_vector_codes(spark, d).collect()
    want, digest = brute(rows)
    assert sorted((r.vec_id, r.code, r.error) for r in got) == want and {r.codebooks_sha256 for r in got} == {digest}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1, 2) for i, v, lab in rows], SCHEMA)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [[0.1 * k + 0.01 * j - 0.3 for j in range(16)] for k in range(6)]
    rows = [(5, v[0], 1), (None, v[1], 1), (3, v[2], None), (3, v[3], None), (3, v[3], None), (9, None, 1), (10, [nan] * 16, 1),
            (11, [inf] * 16, 2), (12, [*v[4][:15], None], 2), (13, v[5], 7)]
    out, books = codes.compress(frame(spark, rows))
    got = out.collect()
    assert sorted(r.vec_id if r.vec_id is not None else 99 for r in got) == [3, 3, 3, 5, 13, 99]
    want, digest = brute([(99 if i is None else i, x) for i, x, _ in rows])
    assert sorted((r.vec_id if r.vec_id is not None else 99, r.code, r.error) for r in got) == want and books.sha256() == digest
    for r in got:
        assert r.label_error == sum(o.error for o in got if o.label == r.label)


def test_few_none_and_uneven(spark):
    out, books = codes.compress(frame(spark, []))
    assert out.count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()
    out, books = codes.compress(frame(spark, [(1, [], 1), (2, [], 1)]))
    assert [(r.code, r.error) for r in out.collect()] == [("00" * 8, 0)] * 2
    out, _ = codes.compress(frame(spark, [(1, [1.0] * 10, 1), (2, [2.0] * 10, None)]))       # filled up to 16
    assert sorted((r.vec_id, r.code) for r in out.collect()) == [(1, "00" * 8), (2, "01" * 5 + "00" * 3)]
    with pytest.raises(ValueError):
        codes.compress(frame(spark, [(1, [1.0] * 8, 1), (2, [2.0] * 16, 1)]))


def test_numbers_beyond_64_bits(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(0, 3e5, 8)], k % 2) for k in range(40)]
    out, books = codes.compress(frame(spark, rows))
    want, digest = brute([(i, v) for i, v, _ in rows])
    assert sorted((r.vec_id, r.code, r.error) for r in out.collect()) == want and books.sha256() == digest
    far, _ = codes.compress(frame(spark, [(1, [1e300] * 8, 1), (2, [-1e300] * 8, 1), (3, [0.5] * 8, 1)]), entries=1)
    assert max(r.error for r in far.collect()) == codes.LONG_MAX
