import itertools
import math
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from tessera.llm import langid, queries

SMALL = "/root/testdata/sf0.001"


def test_forward_sums_all_segmentations():
    pieces = sorted([b" ", b"a", b"b", b"c", b"ab", b"bc", b" a", b"abc", b" ab"])
    rng = np.random.default_rng(3)
    p = rng.random((len(pieces), 2))
    lattice = langid.Lattice(pieces)
    for word in ("abc", "aab", "cab", "abcabc", "bb"):
        raw = b" " + word.encode()
        total = np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(raw) - 1):
            parts, at = [], 0
            for k, c in enumerate(cuts, 1):
                if c:
                    parts.append(raw[at:k])
                    at = k
            parts.append(raw[at:])
            if all(s in pieces for s in parts):
                total += np.prod([p[pieces.index(s)] for s in parts], axis=0)
        (m, lens, _), = langid.matrices([word])
        assert np.allclose(np.exp(lattice.forward(m, lens, p)[0]), total)
        # expected uses: every byte of the word is used once
        uses = lattice.expected(m, lens, np.array([2.0]), p[:, 0])
        assert math.isclose(sum(u * len(s) for u, s in zip(uses, pieces)), 2 * len(raw))


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = queries.op8_language_id(spark, d).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r.lang_pred == truth[r.doc_id][0] for r in got if r.held_out]
    assert len(held) > 200 and sum(held) / len(held) > 0.98


def test_odd_rows(spark, odd, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    model = langid.train(odd, F.lit(True), path, rounds=1)
    assert model[0] == ["de", "en", "fr"] or model[0] == ["de", "en"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[6][0] == "en"
    assert langid.identify(odd, model).count() == odd.count() and langid.identify(empty, model).count() == 0
    none = langid.train(empty, F.lit(True), path)
    assert {r.lang_pred for r in langid.identify(odd, none).collect()} == {"und"}


def plain_log(raw, pieces, p):
    """Log of the summed probability of all segmentations, place by place in exact fractions."""
    total = [Fraction(1)] + [Fraction(0)] * len(raw)
    for b in range(1, len(raw) + 1):
        for a in range(b):
            k = pieces.get(raw[a:b])
            if k is not None:
                total[b] += total[a] * p[k]
    return math.log(total[-1].numerator) - math.log(total[-1].denominator)


def test_long_words_are_summed_whole():
    names = sorted([b" ", b"x", b"y", b"xy", b"yxx", b"x" * 40, b" x", b"yx" * 9])
    pieces = {s: k for k, s in enumerate(names)}
    p = [Fraction(1, 3 ** (k + 4)) for k in range(len(names))]
    words = ["x" * 900, "xy" * 333, "y", "x" * 39, "x" * 40, "yx" * 400 + "xxy", "xyyx" * 9]
    lattice = langid.Lattice(names)
    got = {}
    for m, lens, at in langid.matrices(words):
        logs = lattice.forward(m, lens, np.array([[float(v), float(v) / 2] for v in p]))
        got |= {int(i): v for i, v in zip(at, logs)}
        # the whole of each word is used, however small its probability
        uses = lattice.expected(m, lens, np.ones(len(lens)), np.array([float(v) for v in p]))
        assert math.isclose(sum(u * len(s) for u, s in zip(uses, names)), lens.sum(), rel_tol=1e-9)
    for i, w in enumerate(words):
        raw = b" " + w.encode()
        assert math.isclose(got[i][0], plain_log(raw, pieces, p), rel_tol=1e-9)
        assert math.isclose(got[i][1], plain_log(raw, pieces, [v / 2 for v in p]), rel_tol=1e-9)


def test_query_against_plain_sums(spark):
    """Labels and scores of the query from the same probabilities, word by word."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    langs, pieces, p = langid.train(docs, ~held, path)
    assert max(map(len, pieces)) > 12
    number, known = {s: k for k, s in enumerate(pieces)}, {}

    def logs(word):
        raw = b" " + word.encode()
        total = np.zeros((len(raw) + 1, len(langs)))
        total[0] = 1
        for b in range(1, len(raw) + 1):
            for a in range(b):
                if raw[a:b] in number:
                    total[b] += total[a] * p[number[raw[a:b]]]
        return np.log(total[-1])

    got = {r.doc_id: r for r in queries.op8_language_id(spark, SMALL).collect()}
    for doc_id, text in docs.select("doc_id", "text").orderBy("doc_id").collect()[::9]:
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not words:
            assert (got[doc_id].lang_pred, got[doc_id].score) == ("und", 0.0)
            continue
        total = sum(known[w] if w in known else known.setdefault(w, logs(w)) for w in words)
        assert got[doc_id].lang_pred == langs[int(total.argmax())]
        assert math.isclose(got[doc_id].score, 1 / np.exp(total - total.max()).sum(), rel_tol=1e-6)
