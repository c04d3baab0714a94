import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


def check(pieces, texts, plain, window=4096):
    """Every id in one piece, checksums, gapless offsets, windows not over-full.
    ``texts`` maps ids to texts (ids that repeat have equal texts)."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, (text, copies) in texts.items():
        ids = np.array(plain(text), "<u4")
        starts = defaultdict(int)
        for r in by_doc[i]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
            starts[(r.start, r.length)] += 1
        assert set(starts.values()) == {copies}
        assert sum(n for _, n in starts) == len(ids)
    for rows in by_seq.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:k]) for k in range(len(rows))]
        assert sum(r.length for r in rows) <= window
    return by_seq


def test_query_round_trip(spark, small, plain):
    texts = {r.doc_id: (r.text, 1) for r in small.select("doc_id", "text").collect()}
    by_seq = check(queries.op6_packing(spark, "/root/testdata/sf0.001").collect(), texts, plain)
    sizes = [sum(r.length for r in rows) for rows in by_seq.values()]
    assert sum(sizes) / (4096 * len(sizes)) > 0.95


def test_odd_rows(odd, empty, plain):
    texts = {}
    for r in odd.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    same = odd.where("doc_id IS NOT NULL")
    for shard in (2, 2048):
        got = packing.pack(same, PATH, shard_docs=shard, window=64).collect()
        check(got, {i: (t[0], len(t)) for i, t in texts.items() if i is not None}, plain, 64)
    assert sum(r.doc_id is None for r in packing.pack(odd, PATH).collect()) == 2
    assert packing.pack(empty, PATH).count() == 0


def test_words_give_the_ids_of_whole_texts(plain):
    texts = ["It's A Test, of U.S.A.'s   odd spaces... and\x1cmore", "<|endoftext|> x <|ENDOFTEXT|>", "é é ́a İI ẞß",
             "a,b.c ,d ..e 12.5 don't DON'T 'll", "\U0001F600, \U0001F600. 漢字.かな,", "K Å \u212A\u212B ǅ ŉ ª º µ ÿŸ ẞ", "tab\tnew\nline\x0bv\x0cf\rr"]
    for raw, text in zip(packing.Encoder(PATH).encode(texts), texts):
        assert np.frombuffer(raw, "<u4").tolist() == plain(text), text


def test_scores_are_bm25():
    rng = np.random.default_rng(2)
    idf = np.maximum(0, rng.normal(1, 1, 50))
    docs = [np.unique(rng.integers(0, 50, 12)) for _ in range(30)]
    tf = [rng.integers(1, 5, len(d)) for d in docs]
    length = np.array([t.sum() for t in tf], float)
    index = packing.Index(docs, tf, length, idf, length.mean())
    for seed in (0, 7, 29):
        want = [sum(idf[t] * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * length[k] / length.mean()))
                    for t, f in zip(docs[k], tf[k]) if t in docs[seed]) for k in range(30)]
        assert np.allclose(index.scores(seed), want)


def test_windows_take_the_best_unused_neighbours_that_fit():
    one = lambda *t: np.array(t)
    docs = [one(1, 2, 3), one(1, 2), one(3), one(9), one(1)]
    index = packing.Index(docs, [np.ones(len(d)) for d in docs], np.ones(5), np.ones(10), 1.0)
    got = packing.fill(index, np.array([60, 30, 30, 5, 20]), 100)
    assert [[d for d, _ in w] for w in got] == [[0, 1, 3], [2, 4]]
