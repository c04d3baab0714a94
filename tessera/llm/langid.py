"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary
(byte-level BPE pieces; the file's path is a parameter). The probability of a
word is the sum over all its segmentations into pieces of the product of their
probabilities, computed by a forward pass; a text's log-likelihood is the sum
over its words, and the score is the posterior under equal priors.

Learning is expectation-maximisation: the backward pass gives the expected use
of each piece over all segmentations of each training word, weighted by the
word's count in the language. It runs as one task per language on word counts
taken (by Spark, with map-side combine) from a bounded sample of the labelled
rows: about ``train_docs`` documents per language, chosen by a hash of the id.

Words are runs of letters, lower-cased, marked at their start by a blank, in
UTF-8. Words are scored whole: sums are kept for as many places as the longest
piece has bytes and scaled up when they get small, so the work is linear in the
text and memory does not grow with a word. Every piece of the vocabulary that a
word can hold takes part.

Defined results: NULL texts and texts without letters are ``und`` with score 0;
ties go to the first language in byte order; without any training row all
texts are ``und``; repeated rows each get a row; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import for_workers, map_arrow
from tessera.plans.strategy import join_small

TRAIN_DOCS = 2000
ROUNDS = 3
SMOOTH = 0.1
UNKNOWN = "und"
#: Bytes of words whose segmentations are summed at once (one word at least).
GROUP = 1 << 18
#: Sums below are scaled up.
TINY = 1e-150
#: Scored words a worker keeps for later batches, and their characters.
KEEP, KEEP_CHARS = 400_000, 8_000_000
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


def read_pieces(path: str) -> list[bytes]:
    """The vocabulary's pieces as bytes (byte-level alphabet undone): all single
    bytes, then pieces that hold letters only, with or without a leading blank."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    found = {bytes([b]) for b in range(256)}
    for piece in vocabulary:
        if all(c in byte_of for c in piece):
            raw = bytes(byte_of[c] for c in piece)
            rest = raw.removeprefix(b" ")
            if not any(c < 97 or 122 < c < 128 for c in rest):
                found.add(raw)
    return sorted(found)


class Lattice:
    """All pieces at all places of words, by walking a trie. Words are rows of a
    byte matrix, padded behind their lengths; padding is never read into a result."""

    def __init__(self, pieces: list[bytes]):
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for k, piece in enumerate(pieces):
            node = 0
            for b in piece:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][b]
            ends[node] = k
        self.child = np.full((len(children), 256), -1, np.int32)
        for node, c in enumerate(children):
            self.child[node, list(c.keys())] = list(c.values())
        self.piece = np.array(ends, np.int32)
        self.longest = max(map(len, pieces))

    def edges(self, words: np.ndarray, a: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(end, word rows, piece numbers) of the pieces that start at ``a``."""
        rows, node = np.arange(len(words)), np.zeros(len(words), np.int32)
        for b in range(a, words.shape[1]):
            node = self.child[node, words[rows, b]]
            alive = node >= 0
            rows, node = rows[alive], node[alive]
            if not len(rows):
                return
            piece = self.piece[node]
            whole = piece >= 0
            yield b + 1, rows[whole], piece[whole]

    def forward(self, words: np.ndarray, lens: np.ndarray, p: np.ndarray, trace: np.ndarray | None = None) -> np.ndarray:
        """(words, languages): log of the summed probability of all segmentations;
        ``p`` is (pieces, languages). ``trace`` takes the log at every place."""
        n, length = words.shape
        size = min(self.longest, length) + 1
        ring = np.zeros((size, n, p.shape[1]))      # sums at the places a .. a + longest, by place modulo size
        ring[0] = 1
        logs, out = np.zeros(ring.shape[1:]), np.zeros(ring.shape[1:])
        for a in range(length + 1):
            now = ring[a % size]
            _scale_up(ring, now, logs)
            done = np.flatnonzero(lens == a)
            if len(done):
                out[done] = np.log(now[done]) + logs[done]
            if trace is not None:
                trace[a] = (np.log(now) + logs)[:, 0]
            if a < length:
                for b, rows, piece in self.edges(words, a):
                    ring[b % size, rows] += now[rows] * p[piece]
            now[:] = 0
        return out

    def expected(self, words: np.ndarray, lens: np.ndarray, weight: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of weighted words."""
        n, length = words.shape
        ahead = np.zeros((length + 1, n))
        total = self.forward(words, lens, p[:, None], ahead)[:, 0]
        size = min(self.longest, length) + 1
        ring, logs, uses = np.zeros((size, n)), np.zeros(n), np.zeros(len(p))
        for a in range(length, -1, -1):
            now = ring[a % size]
            now[:] = 0
            for b, rows, piece in self.edges(words, a):
                step = p[piece] * ring[b % size, rows]
                now[rows] += step
                used = step > 0                      # pieces that end within their word
                rows, step = rows[used], step[used]
                share = np.exp(ahead[a, rows] + logs[rows] - total[rows]) * step
                uses += np.bincount(piece[used], share * weight[rows], len(p))
            now[lens == a] = 1
            _scale_up(ring, now, logs)
        return uses


def _scale_up(ring: np.ndarray, now: np.ndarray, logs: np.ndarray) -> None:
    """Where ``now``, a slice of ``ring``, has become small, the whole ring is
    divided by it and its logarithm moves to ``logs``."""
    small = (now < TINY) & (now > 0)
    if small.any():
        factor = np.where(small, now, 1.0)
        logs += np.log(factor)
        ring /= factor


def matrices(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Whole words as byte matrices with their lengths and numbers: words of one
    length together, long ones padded to the next power of two."""
    by: dict[int, tuple[list[bytes], list[int]]] = {}
    for i, w in enumerate(words):
        raw = b" " + w.encode("utf-8", "surrogatepass")
        width = len(raw) if len(raw) <= 32 else 1 << (len(raw) - 1).bit_length()
        held, at = by.setdefault(width, ([], []))
        held.append(raw)
        at.append(i)
    for width, (held, at) in sorted(by.items()):
        group = max(1, GROUP // width)
        for k in range(0, len(held), group):
            part = held[k:k + group]
            lens = np.array([len(w) for w in part])
            m = np.frombuffer(b"".join(w.ljust(width, b" ") for w in part), np.uint8).reshape(-1, width)
            yield m[:, :lens.max()], lens, np.array(at[k:k + group])


def _fit(pieces: list[bytes], rounds: int):
    """One language's piece probabilities from its word counts."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lattice, p = Lattice(pieces), np.full(len(pieces), 1 / len(pieces))
        n = pdf["n"].to_numpy(np.float64)
        words = [(m, lens, n[at]) for m, lens, at in matrices(pdf["word"].tolist())]
        for _ in range(rounds):
            uses = sum((lattice.expected(m, lens, w, p) for m, lens, w in words), np.zeros(len(p))) + SMOOTH
            p = uses / uses.sum()
        return pd.DataFrame({"lang": key[0], "piece": np.arange(len(p)), "p": p})
    return run


def _count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        counts: dict[str, Counter] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(words_of(text))
        rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))],
            ["lang", "word", "n"])


def train(df: DataFrame, learn: Column, vocabulary: str, text_col: str = "text", lang_col: str = "lang",
          id_col: str = "doc_id", train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS) -> tuple[list[str], list[bytes], np.ndarray]:
    """(languages, pieces, probabilities per piece and language) from the rows
    where ``learn`` holds and the language is known."""
    pieces = read_pieces(vocabulary)
    rows = df.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("h"))
    per_lang = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).select(
        F.col("lang").alias("l"), F.least(F.lit(1.0), train_docs / F.col("rows")).alias("share"))
    # one row a language, broadcast if that is small
    sample = join_small(rows, per_lang.withColumnRenamed("l", "lang"), "lang").where(
        F.pmod("h", F.lit(1_000_000)) < F.col("share") * 1_000_000).select("lang", "text")
    counts = map_arrow(sample, _count, "lang string, word string, n bigint")
    for_workers(df.sparkSession)
    fitted = counts.groupBy("lang", "word").agg(F.sum("n").alias("n")).groupBy("lang").applyInPandas(
        _fit(pieces, rounds), "lang string, piece int, p double").toPandas()
    langs = sorted(fitted["lang"].unique(), key=lambda s: s.encode())
    p = np.zeros((len(pieces), len(langs)))
    for i, lang in enumerate(langs):
        mine = fitted[fitted["lang"] == lang]
        p[mine["piece"].to_numpy(), i] = mine["p"].to_numpy()
    return langs, pieces, p


def _predict(langs: list[str], pieces: list[bytes], model):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, lattice = model.value, Lattice(pieces)
        known: dict[str, int] = {}
        held = 0
        table = np.zeros((0, len(langs)))
        for b in it:
            docs = [words_of(t) for t in b.column(1).to_pylist()]
            if len(known) > KEEP or held > KEEP_CHARS:
                known, table, held = {}, table[:0], 0
            new = list({w for d in docs for w in d}.difference(known))
            held += sum(map(len, new))
            logs = np.zeros((len(new), len(langs)))
            for m, lens, at in matrices(new):
                logs[at] = lattice.forward(m, lens, p)
            known.update(zip(new, range(len(table), len(table) + len(new)), strict=True))
            table = np.concatenate((table, logs))
            lang, score = [], []
            for d in docs:
                if not d or not langs:
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    continue
                total = table[np.fromiter(map(known.__getitem__, d), np.int64, len(d))].sum(axis=0)
                best = int(total.argmax())
                lang.append(langs[best])
                score.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             ["id", "lang_pred", "score"])
    return run


def identify(df: DataFrame, model: tuple[list[str], list[bytes], np.ndarray], text_col: str = "text",
             id_col: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score) of every whole text; only the text is read. The
    model sent to the tasks is bounded by vocabulary times languages."""
    langs, pieces, p = model
    sent = df.sparkSession.sparkContext.broadcast(p)
    out = map_arrow(df.select(F.col(id_col), F.col(text_col).cast("string")), _predict(langs, pieces, sent),
                    f"id {df.schema[id_col].dataType.simpleString()}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)
