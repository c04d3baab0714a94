"""Toxicity by a classifier chain.

The label columns are predicted one after the other. Each has a linear
(logistic) model over a text's features plus the probabilities of the
categories before it; while fitting, those probabilities are out-of-fold
predictions, so a later model sees earlier ones as it will when scoring.

Fitting reads a bounded sample: the ``train_rows`` labelled rows with the
smallest hash of their id. A category's features are the ``features`` words,
word beginnings of ``STEM`` letters (with how many words have them) and shape
marks (shares of capitals and signs, variety of words) whose presence tells
most about its label, and more than chance would. Spark counts them over the
sample with map-side combine; their 0/1 rows are what the driver fits on, at
most ``train_rows`` x ``features`` bits a category. Scoring reads every whole
text once; a word counts by presence, so a long text is not diluted.

The decision threshold of a category is the one with the best F1 among its
out-of-fold predictions.

Defined results: NULL and empty texts have no words and get the models'
answer for that; rows without a label are scored only; a label row with a NULL
label is left out; several labels of a document count as their largest; without
labelled rows every probability is 0; ties go to the lower hash; repeated rows
each get a row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, map_arrow, words_of

TRAIN_ROWS = 16_000
FEATURES = 1024
MIN_DOCS = 3
#: Chi-squared that a term of no meaning practically never reaches, with 10^5 terms tried.
MIN_CHI2 = 25.0
FOLDS = 4
STEM = 4
#: A beginning is a feature once for each of these numbers of different words it has.
SEVERAL = (1, 2, 3, 5)
STEPS = 300
L2 = 1e-4
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SIGN = re.compile(r"[^\w\s]")
_SPACE = re.compile(r"\s")


def marks(text: str | None, words: set[str], n_words: int) -> list[str]:
    """Shape of a text as words that no text can contain."""
    n = max(1, len(text or ""))
    if not text:
        return ["\x01empty"]
    return [f"\x01capitals{10 * len(_CAPITAL.findall(text)) // n}", f"\x01signs{20 * len(_SIGN.findall(text)) // n}",
            f"\x01variety{10 * len(words) // max(1, n_words)}", f"\x01length{len(text).bit_length()}"]


def terms(text: str | None) -> set[str]:
    """The different words of a whole text, their beginnings, and its marks."""
    words = words_of(text.lower() if text else text)
    found = {w.decode("utf-8", "replace") for w in set(words)}
    stems = Counter(w[:STEM] for w in found if len(w) > STEM)
    several = {f"{s}\x01{k}" for s, n in stems.items() for k in SEVERAL if n >= k}
    return found.union(several, marks(text, found, len(words)))


def _terms(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array([sorted(terms(t)) for t in b.column("text").to_pylist()], pa.list_(pa.string())),
             b.column("y")], ["id", "terms", "y"])


def _numbers(vocabulary: dict[str, int]):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            known = [sorted(vocabulary[w] for w in terms(t) & vocabulary.keys()) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("h"), pa.array(known, pa.list_(pa.int32())), b.column("y")], ["h", "x", "y"])
    return run


class Logistic:
    """Logistic regression on rows of feature numbers and dense columns."""

    def __init__(self, n_features: int, n_dense: int):
        self.w, self.d, self.b = np.zeros(n_features), np.zeros(n_dense), 0.0

    def scores(self, rows: np.ndarray, cols: np.ndarray, n: int, dense: np.ndarray) -> np.ndarray:
        return np.bincount(rows, self.w[cols], n) + dense @ self.d + self.b

    def fit(self, rows, cols, y: np.ndarray, dense: np.ndarray, steps: int = STEPS, l2: float = L2) -> Logistic:
        """Full-batch Adam; deterministic."""
        n, size = len(y), len(self.w) + len(self.d) + 1
        m, v = np.zeros(size), np.zeros(size)
        for t in range(1, steps + 1):
            p = sigmoid(self.scores(rows, cols, n, dense))
            e = (p - y) / max(1, n)
            g = np.concatenate((np.bincount(cols, e[rows], len(self.w)) + l2 * self.w, dense.T @ e + l2 * self.d, [e.sum()]))
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            self.w -= step[:len(self.w)]
            self.d -= step[len(self.w):-1]
            self.b -= step[-1]
        return self


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Midway below the lowest score of the cut with the best F1 (0.5 if there are no positives)."""
    if not y.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    k = int(f1.argmax())
    below = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return float((p[order[k]] + below) / 2)


class Chain:
    """One model per category, in order; later ones see earlier probabilities."""

    def __init__(self, categories: list[str], vocabulary: dict[str, int]):
        self.categories, self.vocabulary = categories, vocabulary
        self.models: list[Logistic] = []
        self.thresholds: list[float] = []
        self.out_of_fold = np.zeros((0, len(categories)))
        #: Which features each category's model uses (all, if not told).
        self.uses: list[np.ndarray] = [np.ones(len(vocabulary), bool) for _ in categories]

    def _pairs(self, x: list[list[int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) numbers of the features that category ``k`` uses."""
        rows = np.repeat(np.arange(len(x)), [len(r) for r in x])
        cols = np.array([c for r in x for c in r], np.int64)
        own = self.uses[k][cols]
        return rows[own], cols[own]

    def fit(self, x: list[list[int]], y: np.ndarray, folds: int = FOLDS) -> Chain:
        """Rows come in hash order, so row number mod ``folds`` is the fold."""
        n = len(x)
        fold = np.arange(n) % folds
        earlier = np.zeros((n, 0))
        for k in range(len(self.categories)):
            rows, cols = self._pairs(x, k)
            held = np.zeros(n)
            for f in range(folds):
                out, own = fold == f, fold[rows] == f
                number = np.cumsum(~out) - 1
                model = Logistic(len(self.vocabulary), k).fit(number[rows[~own]], cols[~own], y[~out, k], earlier[~out])
                held[out] = sigmoid(model.scores(rows[own], cols[own], n, earlier))[out]
            self.models.append(Logistic(len(self.vocabulary), k).fit(rows, cols, y[:, k], earlier))
            self.thresholds.append(best_threshold(held, y[:, k]))
            earlier = np.column_stack((earlier, held))
        self.out_of_fold = earlier
        return self

    def predict(self, x: list[list[int]]) -> np.ndarray:
        n = len(x)
        p = np.zeros((n, 0))
        for k, m in enumerate(self.models):
            rows, cols = self._pairs(x, k)
            p = np.column_stack((p, sigmoid(m.scores(rows, cols, n, p))))
        return p


def train(docs: DataFrame, labels: DataFrame, categories: list[str], text_col: str = "text", id_col: str = "doc_id",
          train_rows: int = TRAIN_ROWS, features: int = FEATURES) -> Chain:
    """The chain fitted on at most ``train_rows`` labelled documents."""
    known = labels.where(F.col(id_col).isNotNull()).dropna(subset=categories)
    known = known.groupBy(F.col(id_col).alias("label_id")).agg(F.array(*[F.max(c).cast("int") for c in categories]).alias("y"))
    # at most train_rows ids: small enough to send to every task
    chosen = known.withColumn("h", F.xxhash64("label_id")).orderBy("h", "label_id").limit(train_rows)
    kind = docs.schema[id_col].dataType.simpleString()
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(chosen), F.col("id") == F.col("label_id")).select("id", "h", "text", "y")
    counted = map_arrow(sample, _terms, f"id {kind}, terms array<string>, y array<int>").select(F.explode("terms").alias("term"), "y")
    n_cat = len(categories)
    df = cut_lineage(counted.groupBy("term").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("y")[k]).alias(f"n{k}") for k in range(n_cat)]))
    total = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("y")[k]).alias(f"n{k}") for k in range(n_cat)]).first()
    chain = Chain(categories, {})
    if not total["n"]:
        return chain
    # chi-squared of presence against each label
    chi = []
    for k in range(n_cat):
        share = (total[f"n{k}"] or 0) / total["n"]
        expected, spread = F.col("n") * share, max(share * (1 - share), 1e-12) * total["n"]
        chi.append((F.col(f"n{k}") - expected) ** 2 / (F.col("n") * (1 - F.col("n") / (total["n"] + 1)) * spread / total["n"]))
    chosen = []
    for k in range(n_cat):
        told = df.where((F.col("n") >= MIN_DOCS) & (chi[k] >= MIN_CHI2)).orderBy(chi[k].desc(), "term")
        chosen.append({r["term"] for r in told.limit(features).select("term").collect()})
    chain.vocabulary = {w: i for i, w in enumerate(sorted(set().union(*chosen)))}
    chain.uses = [np.array([w in c for w in chain.vocabulary], bool) for c in chosen]
    rows = map_arrow(sample, _numbers(chain.vocabulary), "h bigint, x array<int>, y array<int>").toArrow()
    got = sorted(zip(rows["h"].to_pylist(), rows["x"].to_pylist(), rows["y"].to_pylist(), strict=True))
    return chain.fit([x for _, x, _ in got], np.array([y for _, _, y in got], np.float64).reshape(len(got), n_cat))


def _score(chain: Chain):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            known = [[chain.vocabulary[w] for w in terms(t) & chain.vocabulary.keys()] for t in b.column(1).to_pylist()]
            p = chain.predict(known) if chain.models else np.zeros((len(known), len(chain.categories)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p.tolist(), pa.list_(pa.float64()))], ["id", "p"])
    return run


def score(docs: DataFrame, chain: Chain, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, p_<category>..., is_<category>...) of every row's whole text."""
    out = map_arrow(docs.select(F.col(id_col), F.col(text_col).cast("string")), _score(chain),
                    f"id {docs.schema[id_col].dataType.simpleString()}, p array<double>")
    cut = chain.thresholds or [0.5] * len(chain.categories)
    return out.select(F.col("id").alias(id_col), *[F.col("p")[k].alias(f"p_{c}") for k, c in enumerate(chain.categories)],
                      *[(F.col("p")[k] >= cut[k]).alias(f"is_{c}") for k, c in enumerate(chain.categories)])


def keep(docs: DataFrame, chain: Chain, category: str, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that are not of the category. No row
    needs an id: texts are scored where they stand."""
    k, names = chain.categories.index(category), docs.columns

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            scored = next(_score(chain)(iter([pa.RecordBatch.from_arrays(
                [b.column(0), b.column(names.index(text_col))], ["id", "text"])])))
            p = np.array([r[k] for r in scored.column(1).to_pylist()])
            yield b.filter(pa.array(p < (chain.thresholds[k] if chain.models else 0.5)))

    return map_arrow(docs, run, docs.schema)
