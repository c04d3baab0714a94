import hashlib
from collections import Counter

from pyspark.sql import functions as F

from tessera.llm import exact


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out, kept = Counter(), set()
    for i, t in rows:
        ids = groups[t or ""]
        best = max((x for x in ids if x is not None), default=None)
        stays = i == best and (t or "") not in kept
        if stays:
            kept.add(t or "")
        out[(i, best, len(ids), stays, hashlib.sha256((t or "").encode()).hexdigest())] += 1
    return out


def test_against_brute_force(odd):
    got = Counter(map(tuple, exact.exact_duplicates(odd, salts=3).collect()))
    assert got == brute([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])


def test_digests_that_stand_for_several_texts(odd, monkeypatch):
    monkeypatch.setattr(exact, "_digest", lambda text: F.unhex(F.hex(F.length(text) % 2)))
    got = exact.exact_duplicates(odd).select("doc_id", "keep_id", "group_size", "kept")
    want = Counter({k[:4]: 0 for k in ()})
    for k, n in brute([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]).items():
        want[k[:4]] += n
    assert Counter(map(tuple, got.collect())) == want


def test_survivors_keep_all_columns(odd, empty):
    kept = exact.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r.text or "" for r in odd.select("text").collect()})
    assert {r.doc_id for r in kept.collect()} >= {9, 10, 6, 7}
    assert exact.drop_exact_duplicates(empty).count() == 0 and exact.exact_duplicates(empty).count() == 0


def test_no_python_and_text_in_every_grouping(odd):
    plan = exact.drop_exact_duplicates(odd)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and plan.count("Aggregate [digest") == 2
