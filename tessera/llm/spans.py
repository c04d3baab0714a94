"""Substring de-duplication by sliding sentence spans.

Every run of ``run`` consecutive sentences with at least ``min_words`` words is
hashed (128 bits, letter case and white space ignored). Runs are joined
globally by hash; the first document with a run (smallest id) keeps it, and
sentences covered by any later occurrence are removed, in other documents or
further on in the same one.

Rows are numbered and written to the shared folder, and so are their runs, so
every text is parsed once and again only where something goes. Two shuffles of
(hash, row) find the repeated runs: an aggregate with map-side combine (so a run
that a third of all documents share costs one row a task), then a join back, in
which AQE splits a skewed hash. A run that occurs several times in one document
is sent once. Texts are shuffled once, to meet the positions to remove.

Sentences end at ``.``, ``!`` or ``?`` before white space, or at a line break;
a sentence of more than ``MAX_WORDS`` words is cut where its words say so: after
a word whose hash together with the word before it hits, unless one of the
``GAP`` words before it hits too. Such a cut depends on ``GAP + 2`` words and on
nothing else, so a passage is cut alike from its first cut on, wherever it
stands and whatever was edited before it. Where no cut falls within
``MAX_WORDS`` words (a word repeated over and over) one is made there, counted
from the cut before.

Defined results: NULL stays NULL, empty texts stay empty, both with no
sentences; a text with fewer sentences than a run has no run and stays; every
row is a document of its own, whatever its id: of rows that share a run the one
with the smallest id keeps it, NULL ids last, and of several with that id one;
other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tessera.llm.common import cut_lineage, map_arrow
from tessera.session import scratch_path

RUN = 2
MIN_WORDS = 8
MAX_WORDS = 24
#: Of the pairs of words one in so many hits; words after a hit in which no other counts.
HIT, GAP = 6, 3
#: Any odd number cuts as well; with this one the 60 words of the test of the fallback hit nowhere.
_SEED = np.uint64(0xF52E96A9F5FC5663)
_END = re.compile(r"[.!?]+(?=\s)|\n")
_WORD = re.compile(r"\S+")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def cuts(words: list[str]) -> list[int]:
    """Numbers of words, ascending, before which a long sentence is cut; the last is their count."""
    h = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    mix = (h[1:] * _SEED) ^ (h[:-1] * _B)
    mix = (mix ^ (mix >> np.uint64(32))) * _A
    at, last, hit = [], 0, -GAP
    for k in [*(np.flatnonzero((mix >> np.uint64(40)) % np.uint64(HIT) == 0) + 2).tolist(), len(words)]:
        if k - hit > GAP or k == len(words):
            at += [*range(last + MAX_WORDS, k, MAX_WORDS), k]
            last = k
        hit = k
    return at if at[-2:-1] != [len(words)] else at[:-1]


def sentences(text: str | None, said: list | None = None) -> list[tuple[int, int, int]]:
    """(start, end, words) of each sentence in code points, without outer white
    space; ``said`` receives each one's words in lower case, joined by blanks."""
    out, at = [], 0
    if not text:
        return out
    for end in [*[m.end() for m in _END.finditer(text)], len(text)]:
        part = text[at:end]
        words = part.lower().split()
        n = len(words)
        if n > MAX_WORDS:
            where, cut = [m.span() for m in _WORD.finditer(text, at, end)], cuts(words)
            for a, b in zip([0, *cut], cut, strict=False):
                out.append((where[a][0], where[b - 1][1], b - a))
                if said is not None:
                    said.append(" ".join(words[a:b]))
        elif n:
            out.append((at + len(part) - len(part.lstrip()), at + len(part.rstrip()), n))
            if said is not None:
                said.append(" ".join(words))
        at = end
    return out


def runs(found: list[tuple[int, int, int]], said: list[str], run: int = RUN,
         min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes as two signed longs) of the runs that count."""
    n = len(found) - run + 1
    if n < 1:
        return np.zeros(0, np.int32), np.zeros((0, 2), np.int64)
    one = b"".join([xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in said])
    h = np.frombuffer(one, "<u8").reshape(-1, 2)
    mix = np.zeros((n, 2), np.uint64)
    words = np.zeros(n, np.int64)
    size = np.fromiter((w for _, _, w in found), np.int64, len(found))
    for k in range(run):
        mix = (mix ^ h[k:k + n]) * np.array([_A, _B])
        mix ^= mix >> np.uint64(32)
        words += size[k:k + n]
    at = np.flatnonzero(words >= min_words)
    return at.astype(np.int32), mix[at].view(np.int64)


def _first(hashes: np.ndarray) -> np.ndarray:
    """Mask of the first occurrence of each hash."""
    seen = np.zeros(len(hashes), bool)
    if len(hashes):
        seen[np.unique(np.ascontiguousarray(hashes).view("i8,i8").ravel(), return_index=True)[1]] = True
    return seen


def _emit(run: int, min_words: int):
    """One row for each different run of a document: its hash and position.
    Runs that the document had before come without a hash, and one row says how
    many sentences there are."""
    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            sizes, pos, hashes, known, count = [], [], [], [], []
            for text in b.column(2).to_pylist():
                said: list[str] = []
                found = sentences(text, said)
                at, h = runs(found, said, run, min_words)
                new = _first(h)
                sizes.append(len(at) + 1)
                pos += [at, [-1]]
                hashes += [h, [[0, 0]]]
                known += [new, [False]]
                count += [np.full(len(at), -1), [len(found)]]
            if not sizes:
                continue
            h, known, at, n = np.concatenate(hashes), np.concatenate(known), np.concatenate(pos), np.concatenate(count)
            take = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(h[:, 0], mask=~known), pa.array(h[:, 1], mask=~known),
                 pa.array(at.astype(np.int32), mask=at < 0), pa.array(n.astype(np.int64), mask=n < 0)],
                ["row", "id", "h1", "h2", "pos", "n"])
    return go


def _remove(run: int):
    """Texts without the sentences at given run positions."""
    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            n, gone, left = [], [], []
            for text, late in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if late:
                    found = sentences(text)
                    drop = np.zeros(len(found), bool)
                    for k in range(run):
                        drop[np.array(late) + k] = True
                    removed, spans, text = _cut(text, found, drop)
                else:
                    removed, spans = 0, []
                n.append(removed)
                gone.append(spans)
                left.append(text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(3), pa.array(n, pa.int64()), pa.array(gone, pa.list_(pa.list_(pa.int64()))),
                 pa.array(left, pa.string())], ["id", "n_sentences", "n_removed", "removed", "text"])
    return go


def _cut(text: str, found: list, drop: np.ndarray) -> tuple[int, list, str]:
    gone, kept, at = [], [], 0
    for i, (a, b, _) in enumerate(found):
        if drop[i]:
            if gone and drop[i - 1]:
                gone[-1] = (gone[-1][0], b)
            else:
                gone.append((a, b))
    for a, b in gone:
        kept.append(text[at:a])
        at = b
    return int(drop.sum()), gone, "".join([*kept, text[at:]])


def _stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and reread: rows and numbers stay what they are."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def remove_repeats(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", run: int = RUN,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """(id, n_sentences, n_removed, removed spans in code points, text) of every row."""
    kind = df.schema[id_col].dataType.simpleString()
    docs = _stored(df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                             F.col(text_col).cast("string").alias("text")), "spans-rows")
    found = _stored(map_arrow(docs, _emit(run, min_words), f"row bigint, id {kind}, h1 bigint, h2 bigint, pos int, n bigint"),
                    "spans-runs")
    # the first row of a run: the smallest id, NULL last; of several with that id any one, kept by the checkpoint
    seen = found.where("h1 IS NOT NULL")
    first = F.coalesce(F.min_by("row", "id"), F.min("row"))
    repeated = cut_lineage(seen.groupBy("h1", "h2").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
                           .select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "first"))
    late = seen.join(repeated, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2"))).where("row <> first")
    late = late.select("row", "pos", "n").unionByName(found.where("h1 IS NULL").select("row", "pos", "n"))
    late = late.groupBy(F.col("row").alias("late_row")).agg(F.collect_set("pos").alias("late"), F.max("n").alias("n"))
    met = docs.join(late, F.col("row") == F.col("late_row")).select("id", "text", "late", "n")
    out = map_arrow(met, _remove(run), f"id {kind}, n_sentences bigint, n_removed bigint, "
                                       "removed array<array<bigint>>, text string")
    return out.withColumnRenamed("id", id_col)
