import numpy as np
from pyspark.sql import functions as F

from tessera.llm import toxicity


def labels_of(spark, d):
    return spark.read.parquet(f"{d}/labels.parquet").select(
        "doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def test_held_out_accuracy(spark):
    """Fitted on even ids, judged on labelled odd ids."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), labels_of(spark, d)
    chain = toxicity.train(docs, labels.where("doc_id % 2 = 0"), ["low_quality", "toxic"])
    scored = toxicity.score(docs, chain).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    tp = ((scored.toxic == 1) & scored.is_toxic).sum()
    assert tp / max(1, scored.is_toxic.sum()) > 0.93 and tp / (scored.toxic == 1).sum() > 0.93
    assert (scored.is_low_quality == (scored.low_quality == 1)).mean() > 0.95


def test_later_model_reads_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    n = 400
    first = rng.integers(0, 2, n)
    x = [[int(f)] + ([2] if rng.random() < 0.5 else []) for f in first]
    y = np.column_stack((first, first)).astype(float)
    chain = toxicity.Chain(["a", "b"], {"u": 0, "v": 1, "w": 2}).fit(x, y)
    assert chain.out_of_fold.shape == (n, 2) and len(chain.models[1].d) == 1 and chain.models[1].d[0] > 0.5
    p = chain.predict(x)
    assert ((p > 0.5) == (y > 0.5)).all()
    # the earlier probability moves the later one
    alone = chain.models[1].scores(np.zeros(0, int), np.zeros(0, int), 2, np.array([[0.0], [1.0]]))
    assert alone[1] > alone[0]


def test_best_threshold():
    assert toxicity.best_threshold(np.array([0.9, 0.8, 0.3, 0.1]), np.array([1, 1, 0, 0])) == 0.55
    assert toxicity.best_threshold(np.array([0.2]), np.array([0])) == 0.5


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(2, 1, 0), (3, 1, 0), (4, 0, 1), (4, 0, 0), (5, 0, None), (None, 1, 1), (99, 1, 1)],
                                   "doc_id long, low int, toxic int")
    chain = toxicity.train(odd, labels, ["low", "toxic"])
    got = toxicity.score(odd, chain).collect()
    assert len(got) == odd.count() and all(0 <= r.p_low <= 1 and 0 <= r.p_toxic <= 1 for r in got)
    none = toxicity.train(odd, labels.limit(0), ["low", "toxic"])
    assert {(r.p_toxic, r.is_toxic) for r in toxicity.score(odd, none).collect()} == {(0.0, False)}
    assert toxicity.keep(odd, none, "toxic").count() == odd.count()
    assert toxicity.keep(odd, none, "toxic").columns == odd.columns
    assert toxicity.score(empty, toxicity.train(empty, labels, ["low", "toxic"])).count() == 0
    kept = toxicity.keep(odd, chain, "toxic").count()
    assert kept == sum(not r.is_toxic for r in got)
