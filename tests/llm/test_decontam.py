import gc
import hashlib
import random
import re
import weakref

import numpy as np

from tessera.llm import decontam, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, bench, window=10):
    """{row number: (words, hit word positions, items)}"""
    windows = {}
    for i, t in bench:
        w = WORD.findall((t or "").translate(LOW))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = {}
    for d, t in docs:
        w = WORD.findall((t or "").translate(LOW))
        hit, items = set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if s := windows.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    items |= s
        out[d] = (len(w), hit, items)
    return out


def positions(spans):
    return {p for a, b in spans for p in range(a, b)}


def test_query_against_brute_force(spark, small):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in small.select("doc_id", "text").collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, bench)
    assert any(h for _, h, _ in want.values())
    for r in queries.op2_decontamination(spark, d).collect():
        n, hit, items = want[r.doc_id]
        said = ",".join(sorted(map(str, items)))
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, len(hit), len(items), bool(hit))
        assert r.items_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_shards_pieces_blocks_and_short_items(spark):
    """Tiny shards (documents in overlapping pieces), several blocks of the
    benchmark, items shorter than a window, overlaps and repeated rows."""
    rng = random.Random(4)
    words = ["a", "b", "c", "d", "É", "zz", "9"]
    docs = [(k, " ".join(rng.choice(words) + rng.choice(["", ",", "-"]) for _ in range(rng.randint(0, 90)))) for k in range(60)]
    bench = [(f"i{k}", " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, 6, 9])))) for k in range(25)]
    bench += [("empty", ""), ("none", None), ("i0", bench[0][1]), (None, "a b")]
    df = spark.createDataFrame(docs + [docs[3]], "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id string, text string")
    want = brute(docs, bench, window=4)
    for shard, block in ((8, 10 ** 6), (1 << 20, 20)):
        got = decontam.find_leaks(df, items, window=4, shard_words=shard, block_words=block).collect()
        assert len(got) == 61
        for r in got:
            n, hit, found = want[r.doc_id]
            assert (r.n_words, positions(r.words), set(r["items"])) == (n, hit, found - {None})
        kept = decontam.drop_contaminated(df, items, window=4, shard_words=shard, block_words=block)
        assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs + [docs[3]] if not want[d][1])


def test_one_block_at_a_time(spark, monkeypatch):
    """Twenty blocks: each is searched by a job of its own, and is let go before the next one is read."""
    docs = [(k, f"w{k} x{k} y{k} z{k} tail") for k in range(60)] + [(0, "w1 x1 y1 z1 w2 x2 y2 z2"), (None, "w3 x3 y3 z3")]
    bench = [(k, f"w{k} x{k} y{k} z{k}") for k in range(0, 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(bench, "item_id long, text string")
    alive, most = weakref.WeakSet(), []
    made = decontam.Phrases.__init__

    def counted(self, *args):
        gc.collect()
        alive.add(self)
        most.append(len(alive))
        made(self, *args)

    monkeypatch.setattr(decontam.Phrases, "__init__", counted)
    words = decontam.block_count(items, "text", 1) // 20 + 1
    assert decontam.block_count(items, "text", words) >= 19
    found = decontam.find_leaks(df, items, window=4, block_words=words)
    kept = decontam.drop_contaminated(df, items, window=4, block_words=words)
    assert len(most) >= 38 and max(most) <= 2              # the one searched for last, and the one being made
    for plan in (found, kept):
        assert plan._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    got = sorted(((r.doc_id, r["items"], positions(r.words)) for r in found.collect() if r.words), key=str)
    want = [(k, [str(k)], {0, 1, 2, 3}) for k in range(40)] + [(0, ["1", "2"], set(range(8))), (None, ["3"], {0, 1, 2, 3})]
    assert got == sorted(want, key=str) and found.count() == 62
    assert sorted(r.doc_id for r in kept.collect()) == list(range(40, 60))


def test_removal_spans(spark):
    item = "one two three four five six seven eight nine ten eleven"
    text = "Before. ONE two-three four, five six seven eight nine ten! eleven twelve"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = decontam.find_leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).first()
    assert got.words == [[1, 12]] and decontam.cut_out(text, [tuple(s) for s in got.chars]) == "Before. \n twelve"


def test_index_against_plain_search():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 4, 3000).astype(np.int32)
    text[-1] = 0
    index = decontam.FMIndex(text)
    for length in (1, 2, 5):
        phrases = rng.integers(1, 6, (40, length)).astype(np.int32)
        lo, hi = index.search(phrases)
        for p, a, b in zip(phrases, lo, hi):
            want = [k for k in range(len(text) - length + 1) if (text[k:k + length] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "same text here"), (2, None)], "item_id long, text string")
    got = decontam.find_leaks(odd, items).collect()
    assert len(got) == odd.count()
    assert sorted(str(r.doc_id) for r in got if r.words) == ["8", "9", "9", "None"]
    assert decontam.find_leaks(empty, items).count() == 0
    none = items.limit(0)
    assert all(not r.words for r in decontam.find_leaks(odd, none).collect())
    kept = decontam.drop_contaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == len(got) - 4
