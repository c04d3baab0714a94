"""Benchmark decontamination through an FM-index per training shard.

Phrases are windows of ``window`` consecutive words of each benchmark item (a
shorter item is one phrase). A word outside the phrases' vocabulary matches
none and so only separates: a shard keeps the runs of vocabulary words that
are at least as long as the shortest phrase, each ended by a separator of its
own. Every other run cannot hold an occurrence, so the search stays exact.

Per shard (the documents of one task, gathered up to ``shard_words`` indexed
words, longer documents in overlapping pieces):

* suffix array of the runs by prefix doubling, Burrows-Wheeler transform,
* a wavelet matrix of the transform with bit ranks (64-bit words, block counts),
* backward search of all phrases at once, one word a step, from the last word,
* occurrences located by walking to the nearest sampled suffix position,
* word spans of the occurrences merged per document.

The benchmark is the stated query set. It is read in blocks of at most about
``block_words`` words, one after the other: a block is collected, searched for in
all stored documents by a job of its own, and let go before the next one is read.
So the driver and a task hold one block, whatever the benchmark's size. Rows are
numbered and stored first; the spans of the blocks meet by row number.

Defined results: NULL, empty and wordless texts have no words and no hits;
items without words are no phrases; an empty benchmark leaves all documents
clean; equal items and repeated rows are each counted; NULL item ids are left
out of the item list; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, map_arrow, words_of

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_WORDS = 500_000
SAMPLE = 8
#: Occurrences located at once.
LOCATE = 1 << 18
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")


class BitRank:
    """A bit vector with constant-time counts of the ones before a position."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)

    def at(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Symbols as one bit vector a level, top bit first; each level holds the
    symbols with a 0 before those with a 1."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[tuple[int, BitRank, int]] = []
        top = int(symbols.max(initial=0)).bit_length()
        for shift in range(max(1, top) - 1, -1, -1):
            bit = ((symbols >> shift) & 1).astype(bool)
            self.levels.append((shift, BitRank(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        start = np.zeros_like(i)
        for shift, bits, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = bits.ones(start), bits.ones(i)
            start = np.where(one, zeros + a, start - a)
            i = np.where(one, zeros + b, i - b)
        return i - start

    def at(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and its rank there."""
        symbol, start = np.zeros_like(i), None
        pos = i
        for shift, bits, zeros in self.levels:
            one = bits.at(pos)
            r = bits.ones(pos)
            pos = np.where(one, zeros + r, pos - r)
            symbol |= one.astype(i.dtype) << shift
        start = np.zeros_like(i)
        for shift, bits, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a = bits.ones(start)
            start = np.where(one, zeros + a, start - a)
        return symbol, pos - start


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling. A 0 ends a run: zeros are smaller than
    all symbols and differ from each other by position, so comparisons end there."""
    zeros = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(zeros)
    rank[zeros] = np.arange(len(zeros))
    n, step = len(text), 1
    order = np.argsort(rank, kind="stable")
    while True:
        key = rank[order]
        new = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if n == 0 or new[-1] == n - 1:
            return order
        after = np.full(n, 0, np.int64)
        after[:n - step] = rank[step:] + 1
        rank = rank * (n + 1) + after
        order = np.argsort(rank, kind="stable")
        step *= 2


class FMIndex:
    """Full-text index of int32 symbols > 0, runs ended by a 0."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        sa = suffix_order(text)
        self.wavelet = WaveletMatrix(np.where(sa > 0, text[sa - 1], 0).astype(np.int64))
        counts = np.bincount(text, minlength=int(text.max(initial=0)) + 1)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        # every run's first position is sampled: a walk back never leaves its run
        starts = np.concatenate(([True], text[:-1] == 0))
        kept = (sa % sample == 0) | starts[sa]
        self.sampled = BitRank(kept)
        self.samples = sa[kept]
        self.n = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of equally long phrases (one a row), by backward search."""
        alive = np.flatnonzero((phrases < len(self.first) - 1).all(axis=1))
        lo = np.zeros(len(alive), np.int64)
        hi = np.full(len(alive), self.n, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, k].astype(np.int64)
            both = self.wavelet.rank(np.concatenate((symbol, symbol)), np.concatenate((lo, hi)))
            lo, hi = self.first[symbol] + both[:len(symbol)], self.first[symbol] + both[len(symbol):]
            keep = lo < hi
            alive, lo, hi = alive[keep], lo[keep], hi[keep]
        out = np.zeros((2, len(phrases)), np.int64)
        out[0, alive], out[1, alive] = lo, hi
        return out[0], out[1]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back until a sampled position."""
        pos = np.zeros(len(rows), np.int64)
        todo, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(todo):
            done = self.sampled.at(rows)
            pos[todo[done]] = self.samples[self.sampled.ones(rows[done])] + steps
            todo, rows = todo[~done], rows[~done]
            symbol, rank = self.wavelet.at(rows)
            rows = self.first[symbol] + rank
            steps += 1
        return pos


class Phrases:
    """The distinct phrases of a block of benchmark items, by length, as
    vocabulary numbers; ``items[length][row]`` are the items of a phrase."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        seen: dict[int, dict[tuple[int, ...], set[int]]] = {}
        self.names = []
        for i, (name, text) in enumerate(items):
            self.names.append(name)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            size = min(window, len(ids))
            for k in range(len(ids) - size + 1 if size else 0):
                seen.setdefault(size, {}).setdefault(tuple(ids[k:k + size]), set()).add(i)
        self.rows = {n: np.array(list(p), np.int32) for n, p in seen.items()}
        self.items = {n: [sorted(s) for s in p.values()] for n, p in seen.items()}
        self.shortest, self.longest = min(seen, default=0), max(seen, default=0)


class Shard:
    """Runs of vocabulary words gathered from documents, then searched."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.parts: list[np.ndarray] = []
        self.runs: list[np.ndarray] = []
        self.size = 0

    def add(self, doc: int, ids: np.ndarray, at: int = 0) -> None:
        """Words ``at``... of document ``doc``."""
        known = np.flatnonzero(np.diff(np.concatenate(([0], ids > 0, [0])).astype(np.int8)))
        for a, b in known.reshape(-1, 2).tolist():
            if b - a >= self.phrases.shortest:
                self.runs.append((doc, self.size, at + a))
                self.parts += [ids[a:b], np.zeros(1, np.int32)]
                self.size += b - a + 1

    def occurrences(self) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
        """(document, word position, phrase length, phrase row) arrays."""
        if not self.size:
            return
        index = FMIndex(np.concatenate(self.parts))
        runs = np.array(self.runs, np.int64)
        for length, rows in self.phrases.rows.items():
            lo, hi = index.search(rows)
            count = hi - lo
            total = np.concatenate(([0], np.cumsum(count)))
            for a in range(0, int(total[-1]), LOCATE):
                k = np.arange(a, min(a + LOCATE, int(total[-1])))
                phrase = np.searchsorted(total, k, side="right") - 1
                pos = index.locate(lo[phrase] + k - total[phrase])
                run = np.searchsorted(runs[:, 1], pos, side="right") - 1
                yield runs[run, 0], runs[run, 2] + pos - runs[run, 1], length, phrase


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def char_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans as spans of code points, end exclusive."""
    words = [m.span() for m in _WORD.finditer(text)]
    return [(words[a][0], words[b - 1][1]) for a, b in spans]


FOUND = pa.struct([("words", pa.list_(pa.list_(pa.int64()))), ("chars", pa.list_(pa.list_(pa.int64()))),
                   ("items", pa.list_(pa.string()))])


def _searcher(phrases: Phrases, shard_words: int):
    """A function from texts to words per text, word spans and items found."""
    def hits(texts: list[str | None]) -> tuple[list[int], dict[int, list], dict[int, set]]:
        spans: dict[int, list] = {}
        items: dict[int, set] = {}
        shard, n_words = Shard(phrases), []

        def close() -> None:
            nonlocal shard
            for docs, at, length, phrase in shard.occurrences():
                for d, p, k in zip(docs.tolist(), at.tolist(), phrase.tolist(), strict=True):
                    spans.setdefault(d, []).append((p, p + length))
                    items.setdefault(d, set()).update(phrases.items[length][k])
            shard = Shard(phrases)

        for d, text in enumerate(texts):
            words = words_of(text)
            n_words.append(len(words))
            if not phrases.shortest:
                continue
            get = phrases.vocabulary.get
            ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
            # pieces overlap by all but one word of the longest phrase
            for at in range(0, max(1, len(ids) - phrases.longest + 1), shard_words):
                shard.add(d, ids[at:at + shard_words + phrases.longest - 1], at)
                if shard.size >= shard_words:
                    close()
        close()
        return n_words, spans, items
    return hits


def _names(phrases: Phrases, items: set) -> list[str]:
    return sorted({phrases.names[i] for i in items} - {None})


def _search_all(phrases: Phrases, shard_words: int):
    """All phrases against batches of (id, text): every row with what it holds."""
    hits = _searcher(phrases, shard_words)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = b.column(1).to_pylist()
            n_words, spans, items = hits(texts)
            found = []
            for d, text in enumerate(texts):
                w = merge(spans.get(d, []))
                found.append({"words": w, "chars": char_spans(text, w) if w else [],
                              "items": _names(phrases, items.get(d, set()))})
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(found, FOUND)],
                                             ["id", "n_words", "found"])
    return run


def _search_block(phrases: Phrases, shard_words: int):
    """One block of phrases against batches of (row, text): the rows with hits only."""
    hits = _searcher(phrases, shard_words)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            _, spans, items = hits(b.column(1).to_pylist())
            rows = sorted(spans)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())),
                 pa.array([merge(spans[d]) for d in rows], pa.list_(pa.list_(pa.int64()))),
                 pa.array([_names(phrases, items[d]) for d in rows], pa.list_(pa.string()))], ["row", "words", "items"])
    return run


def _finish(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (id, text, spans of all blocks, items of all blocks) to results."""
    for b in it:
        texts = b.column(1).to_pylist()
        found = []
        for text, words, items in zip(texts, b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            w = merge([*map(tuple, words or [])])
            found.append({"words": w, "chars": char_spans(text, w) if w else [], "items": sorted(set(items or []))})
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(words_of(t)) for t in texts], pa.int64()), pa.array(found, FOUND)],
            ["id", "n_words", "found"])


def block_count(benchmark: DataFrame, item_text: str, block_words: int) -> int:
    """Blocks of about ``block_words`` words: a text has at most a word every two characters."""
    words = benchmark.agg(F.sum(F.length(F.col(item_text).cast("string")) / 2 + 1)).first()[0] or 0
    return max(1, -(-int(words) // block_words))


def phrase_blocks(benchmark: DataFrame, item_col: str, item_text: str, window: int, blocks: int) -> Iterator[Phrases]:
    """The benchmark's phrases, a block at a time: the next one is read when it is asked for."""
    queries = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text).cast("string").alias("t"))
    for k in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("t", "i"), F.lit(blocks)) == k).collect()
        yield Phrases([(r["i"], r["t"]) for r in mine], window)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
               block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(id, n_words, words, chars, items) for every row: merged spans in words
    and in code points, and the item ids (strings, sorted) with an occurrence."""
    kind = docs.schema[id_col].dataType.simpleString()
    result = (f"id {kind}, n_words bigint, "
              "found struct<words:array<array<bigint>>,chars:array<array<bigint>>,items:array<string>>")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = block_count(benchmark, item_text, block_words)
    each = phrase_blocks(benchmark, item_col, item_text, window, blocks)
    if blocks == 1:
        out = map_arrow(texts, _search_all(next(each), shard_words), result)
    else:
        # stored, so that a row keeps its number in every block's job
        rows = cut_lineage(texts.withColumn("row", F.monotonically_increasing_id()))
        hits = None
        for phrases in each:
            part = cut_lineage(map_arrow(rows.select("row", "text"), _search_block(phrases, shard_words),
                                         "row bigint, words array<array<bigint>>, items array<string>"))
            hits = part if hits is None else hits.unionByName(part)
        # a row meets at most one row a block
        hits = hits.groupBy(F.col("row").alias("hit")).agg(F.flatten(F.collect_list("words")).alias("words"),
                                                           F.flatten(F.collect_list("items")).alias("items"))
        met = rows.join(hits, F.col("row") == F.col("hit"), "left").select("id", "text", "words", "items")
        out = map_arrow(met, _finish, result)
    return out.select(F.col("id").alias(id_col), "n_words", "found.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
                      shard_words: int = SHARD_WORDS) -> DataFrame:
    """The rows, with all their columns, that hold no occurrence. What a block
    leaves is stored before the next one is searched for."""
    at = docs.columns.index(text_col)

    def clean(phrases: Phrases):
        hits = _searcher(phrases, shard_words)

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in it:
                _, spans, _ = hits(b.column(at).to_pylist())
                yield b.filter(pa.array([d not in spans for d in range(b.num_rows)], pa.bool_()))
        return run

    blocks = block_count(benchmark, item_text, block_words)
    for k, phrases in enumerate(phrase_blocks(benchmark, item_col, item_text, window, blocks)):
        docs = map_arrow(docs, clean(phrases), docs.schema)
        if k + 1 < blocks:
            docs = cut_lineage(docs)
    return docs


def cut_out(text: str | None, chars: list[tuple[int, int]]) -> str | None:
    """The text without its spans; a line break stands for each."""
    if not text or not chars:
        return text
    out, at = [], 0
    for a, b in chars:
        out += [text[at:a], "\n"]
        at = b
    return "".join([*out, text[at:]])
