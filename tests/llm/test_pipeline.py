"""The pipeline against its stages done by plain Python on the same decisions."""
import corpus_pipeline
from test_decontam import brute as leaks
from test_simhash import brute_components, brute_fp

from tessera.llm import queries, toxicity

D = "/root/testdata/sf0.001"


def test_stages_and_columns(spark, odd, empty):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, D)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, D).count() >= docs.count()


def test_run_against_brute_force(spark, small):
    chain = toxicity.train(small, queries.toxicity_labels(spark, D), ["low_quality", "toxic"])
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    p = chain.predict([[chain.vocabulary[w] for w in toxicity.terms(t) & chain.vocabulary.keys()] for _, t in rows])
    rows = [r for r, s in zip(rows, p[:, 1]) if s < chain.thresholds[1]]
    rows = list({t: (i, t) for i, t in sorted(rows)}.values())
    fps = {i: brute_fp(t) for i, t in rows}
    of, least = brute_components(fps.values()), {}
    for i in sorted(fps):
        least.setdefault(of[fps[i]], i)
    rows = [(i, t) for i, t in rows if least[of[fps[i]]] == i]
    bench = [tuple(r) for r in spark.read.parquet(f"{D}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {d for d, (_, hit, _) in leaks(rows, bench).items() if not hit}
    got = corpus_pipeline.run(spark, D).collect()
    assert {r.doc_id for r in got} == clean and 0 < len(clean) < small.count()
