import random
import re
from itertools import permutations

from tessera.llm import queries, tries

D = "/root/testdata/sf0.001"


def mask(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            re.search(r"[#$%&*|]", text) is not None]


def brute(rows, labels):
    """{(part, order, step): (kept, removed, redundant, unique, good, toxic, shapley)} step by step over the rows."""
    least, docs = {}, []
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, s in rows:
        docs.append((s or "", [*mask(t or ""), i is not None and least[t or ""] < i], (i, 1) in labels["good"], (i, 1) in labels["toxic"]))
    out, taken = {}, {}
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            gone = []
            for k, f in enumerate(order):
                n = "ABCDE".index(f)
                hit = [d for d in left if d[1][n]]
                out[part, "".join(order), k + 1] = (
                    len(left) - len(hit), len(hit), sum(d[1][n] for d in gone),
                    sum(d[0] == part and d[1][n] and sum(d[1]) == 1 for d in docs), sum(d[2] for d in hit), sum(d[3] for d in hit))
                taken[part, f] = taken.get((part, f), 0) + len(hit)
                gone += hit
                left = [d for d in left if not d[1][n]]
    return {k: (*v, taken[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in df.collect()}


def test_trie_holds_the_least_value_of_each_text():
    rng = random.Random(3)
    keys = ["".join(rng.choice("ab\0") for _ in range(rng.randrange(9))).encode() for _ in range(3000)] + [b"a" * 200_000, b"a" * 199_999 + b"b"]
    trie, want = tries.Trie(), {}
    for k in keys:
        v = rng.randrange(1000)
        trie.put(k, v)
        want[k] = min(v, want.get(k, v))
    assert dict(trie.items()) == want


def test_trie_is_compressed():
    trie = tries.Trie()
    for k in (b"romane", b"romanus", b"romulus", b"rubens"):
        trie.put(k, 1)
    edges = []
    todo = [trie.root]
    while todo:
        for label, child in todo.pop()[0].values():
            edges.append(label)
            todo.append(child)
    assert sorted(edges) == sorted([b"r", b"om", b"an", b"e", b"us", b"ulus", b"ubens"])


def test_masks_of_texts():
    rng = random.Random(1)
    bits = ["a", "B", " ", "\t", "\x0b", "\x1c", "é", " ", "#", "word ", "Word ", "x y z ", "\n", "CAPS "]
    for _ in range(2000):
        t = "".join(rng.choice(bits) for _ in range(rng.randrange(120)))
        m = tries.failed(t.encode(), len(t))
        assert [bool(m >> k & 1) for k in range(4)] == mask(t), t


def texts_of(spark, rows):
    return spark.createDataFrame([(bytearray(t.encode()),) for t in rows], "data binary")


def test_adaptive_prefixes_cut_behind_what_texts_share(spark):
    rng = random.Random(7)
    long = "boiler plate " * 300
    rows = [long + "%05d" % rng.randrange(50_000) for _ in range(400)] + ["copy " * 700] * 300 + ["t%05d " % k * 20 for k in range(2000)]
    cuts, salts = tries.adaptive_prefixes(texts_of(spark, rows), 100_000)
    sizes = {}
    for t in rows:
        k = tries.bisect_right(cuts, t.encode())
        sizes.setdefault(k, []).append(t)
    # copies of one text stay together and are salted; everything else fits
    assert cuts == sorted(cuts) and any(len(c) > len(long) for c in cuts)
    for k, got in sizes.items():
        size = sum(len(t) + tries.ROW_BYTES for t in got)
        assert size <= 200_000 or (len(set(got)) == 1 and salts[k] > 1), (k, size)


def test_prefixes_end_with_texts_that_differ_in_length_only(spark):
    rows = ["\0" * (k % 9) for k in range(3000)] + ["\0" * 5000] * 50
    cuts, salts = tries.adaptive_prefixes(texts_of(spark, rows), 10_000)
    assert len(cuts) < 3000 and all(s > 0 for s in salts.values())


def test_ranges_and_salts_change_nothing(spark, small):
    hot = small.selectExpr("doc_id + 1000000 AS doc_id", "'the same text' AS text").unionByName(small.select("doc_id", "text"))
    whole = {tuple(r) for r in tries.first_rows(hot).collect()}
    assert whole == {tuple(r) for r in tries.first_rows(hot, range_bytes=3000).collect()}
    least = {}
    for r in hot.collect():
        least[r.text] = min(r.doc_id, least.get(r.text, r.doc_id))
    assert sorted(i for i, _, _ in whole) == sorted(least.values())


def test_query_against_brute_force(spark, small):
    labels = spark.read.parquet(f"{D}/labels.parquet").collect()
    said = {"good": {(r.doc_id, r.quality) for r in labels}, "toxic": {(r.doc_id, r.toxic) for r in labels}}
    rows = [tuple(r) for r in small.select("doc_id", "text", "source").collect()]
    assert result(queries.op13_filter_audit(spark, D)) == brute(rows, said)


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(9, True, False), (9, False, True), (None, True, True), (8, None, None), (2, True, None)],
                                   "doc_id long, good boolean, toxic boolean")
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    want = brute(rows, {"good": {(9, 1), (2, 1)}, "toxic": {(9, 1)}})
    for size in (tries.RANGE_BYTES, 2000):
        assert result(tries.audit(tries.masks(odd, labels, range_bytes=size))) == want
    assert tries.audit(tries.masks(empty, labels)).count() == 0
