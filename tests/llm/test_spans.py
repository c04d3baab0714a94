import random
import re
from collections import Counter

from tessera.llm import spans


def plain_sentences(text):
    """(start, end) of sentences by a character loop; long ones by the operator's word cuts."""
    out, start = [], 0
    for k in range(len(text or "") + 1):
        last = k == len(text)
        if not (last or text[k] == "\n" or text[k] in ".!?" and k + 1 < len(text) and text[k + 1].isspace()):
            continue
        end = k if last else k + 1
        words = [(start + m.start(), start + m.end()) for m in re.finditer(r"\S+", text[start:end])]
        if len(words) > spans.MAX_WORDS:
            at = spans.cuts([text[a:b].lower() for a, b in words])
            out += [(words[a][0], words[b - 1][1]) for a, b in zip([0, *at], at)]
        elif words:
            out.append((words[0][0], words[-1][1]))
        start = end
    return out


def brute(rows, run=2, min_words=8):
    """(id, sentences, removed spans, text) of each row by plain dictionaries."""
    docs, holders = [], {}
    for n, (i, t) in enumerate(rows):
        found = plain_sentences(t) if t else []
        norm = [tuple(t[a:b].lower().split()) for a, b in found]
        keys = {k: tuple(norm[k:k + run]) for k in range(len(found) - run + 1)
                if sum(map(len, norm[k:k + run])) >= min_words}
        docs.append((i, t, found, keys))
        for key in set(keys.values()):
            holders.setdefault(key, set()).add((i is None, i or 0, n))
    out = []
    for n, (i, t, found, keys) in enumerate(docs):
        gone, seen = set(), set()
        for k in sorted(keys):
            if min(holders[keys[k]]) != (i is None, i or 0, n) or keys[k] in seen:
                gone.update(range(k, k + run))
            seen.add(keys[k])
        cut = []
        for j in sorted(gone):
            if j - 1 in gone:
                cut[-1] = (cut[-1][0], found[j][1])
            else:
                cut.append(found[j])
        text = t
        for a, b in reversed(cut):
            text = text[:a] + text[b:]
        out.append((i, len(found), len(gone), tuple(cut), text))
    return out


def check(df, **kw):
    """Spans and texts equal brute force, which must not depend on the order of rows with one id."""
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = Counter((r.doc_id, r.n_sentences, r.n_removed, tuple(map(tuple, r.removed)), r.text)
                  for r in spans.remove_repeats(df, **kw).collect())
    assert got == Counter(brute(rows, **kw))


def test_small_documents(small):
    check(small)


def test_odd_rows(odd, empty):
    check(odd)
    check(odd, run=3, min_words=1)
    check(odd, min_words=1)
    assert spans.remove_repeats(empty).count() == 0
    got = {r.doc_id: r for r in spans.remove_repeats(odd).collect()}
    assert got[1].text is None and got[2].text == "" and got[6].n_removed < got[6].n_sentences
    assert got[7].text.split()[-1] == "end"


def test_rows_that_share_an_id(spark):
    a, b, c, d = ("%s plate of the %s is eight words long." % (w, w) for w in ("Boiler", "Second", "Third", "Fourth"))
    rows = [(1, f"{a} {b} own."), (7, f"{a} {b} alpha."), (7, f"{c} {d} words."), (7, f"{c} {d} words."),
            (None, f"{a} {b}"), (None, f"{c} unique."), (None, f"{c} {d} here."), (None, f"x {b} {c}"), (None, f"x {b} {c}")]
    got = [(r.doc_id, r.text.strip()) for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()]
    want = [(1, f"{a} {b} own."), (7, "alpha."), (7, f"{c} {d} words."), (7, ""), (None, ""), (None, f"{c} unique."),
            (None, "here."), (None, f"x {b} {c}"), (None, "")]
    assert Counter(got) == Counter(want)


def test_shared_passage(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    said = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    passage = " ".join(said(n) for n in (7, 30, 4, 12))
    docs = [(k, f"{said(9)} {said(11)} {passage} {said(10)} {said(8)}") for k in range(1, 40)]
    got = {r.doc_id: r for r in spans.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[1].text == docs[0][1]
    for k, text in docs[1:]:
        assert passage not in got[k].text and "".join(got[k].text.split()) == "".join(text.replace(passage, "").split())


def test_long_sentence_is_cut_alike():
    long = " ".join(f"w{k}" for k in range(60))
    assert [w for _, _, w in spans.sentences("Intro here. " + long + ". End.")] == [2, 24, 24, 12, 1]


def test_passage_inside_long_sentences_at_any_offset(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    some = lambda n: [word() for _ in range(n)]
    passage = some(60)
    docs = [(k, " ".join(some(k) + passage + some(40 - k))) for k in range(30)]
    edited = [*passage[:5], "inserted", *passage[5:]]
    docs += [(30, " ".join(some(30) + edited + some(9))), (31, " ".join(passage))]
    got = {r.doc_id: r.text.split() for r in spans.remove_repeats(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0] == docs[0][1].split()
    left = {k: [w for w in passage if w in set(got[k])] for k in range(1, 32)}
    # only the parts before the first and after the last cut inside the passage stay
    assert max(map(len, left.values())) < 30, {k: len(w) for k, w in left.items()}


def test_long_sentences_without_any_cut_of_their_own():
    for n in (25, 48, 49, 1000):
        cut = spans.cuts(["ha"] * n)
        assert cut[-1] == n and all(0 < b - a <= spans.MAX_WORDS for a, b in zip([0, *cut], cut))
        text = " ".join(["ha"] * n)
        assert sum(w for _, _, w in spans.sentences(text)) == n
