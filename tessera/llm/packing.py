"""Lexical retrieval packing into fixed windows.

Every document becomes token ids and an end id. Pieces of a whole window fill
sequences of their own; the rest of each document (shorter than a window) is
packed by retrieval: a BM25 inverted index, sharded, returns the unused
neighbours of a seed document, which greedily fill its window.

1. Tokenise (Arrow batches). Pieces of a text, or its words at ASCII white
   space, are tokenised once and remembered by the worker, at most ``KEEP`` of them:
   no token reaches over a piece and letter case does not matter to the vocabulary,
   so the ids are those of the whole text. Per document one row leaves:
   counts, checksums of its pieces, and its terms (token ids with counts).
   The rows are checkpointed, so tokens are made once.
2. Corpus statistics over all documents: documents per term (at most one row
   per term and batch is shuffled, at most one per vocabulary entry reaches
   the driver), number of documents, mean length.
3. Shards of about ``shard_docs`` documents, dealt by a hash of the row number,
   so no source or repeated row makes a large shard. Each shard builds its
   inverted index with the corpus statistics and packs: seeds from the longest
   rest down; each seed's BM25 neighbours in order of score, larger first among
   equals, as long as they fit. Documents without common terms score 0 and
   come last, so a window closes only when nothing unused fits.

Memory and work of a task are bounded by ``shard_docs``; a very long document
adds only a checksum per window.

Defined results: NULL and empty texts consist of the end id; repeated rows and
NULL ids are packed like any other row; an empty table gives no pieces; other
columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

from tessera.llm.common import cut_lineage, for_workers, map_arrow

WINDOW = 4096
END_ID = 2
SHARD_DOCS = 2048
K1, B = 1.2, 0.75
#: So many pieces are remembered (some 50 MB); characters encoded at once.
KEEP, CHUNK = 250_000, 1 << 21
#: Letters above ASCII of plain texts; in composed normal form, also in lower case.
_LETTERS = r"\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}\x{152}\x{153}"
_NOT_PLAIN = rf"[^\t\n\r\x20-~{_LETTERS}]"
#: The vocabulary's own pieces of such a text but for runs of letters: contractions, single digits, runs of signs.
_PIECE = rf"('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\sa-z0-9{_LETTERS}]+)"


class Encoder:
    """Whole texts to little-endian 32-bit ids, remembering words.

    The vocabulary cuts a text into pieces and encodes each by itself, so a
    piece, or a word between white space, has the same ids wherever it stands.
    Plain texts are cut into pieces by Arrow kernels, whose dictionary leaves
    each different piece once; the ids are gathered by its codes. Other texts are
    cut into words. New runs of letters go to the model many at a time, as one
    text without the pattern."""

    def __init__(self, vocabulary: str, end_id: int = END_ID, keep: int = KEEP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        #: Ids that end a word: the model marks them.
        mark = json.loads(self.tokenizer.to_str())["model"]["end_of_word_suffix"]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if mark and token.endswith(mark)]] = True
        self.end = np.array([end_id], "<u4").tobytes()
        #: The remembered pieces by number, and their ids end to end: piece k has flat[start[k]:start[k + 1]].
        self.keep, self.known = keep, {"": 0}
        self.flat, self.start = np.zeros(0, "<u4"), np.zeros(2, np.int64)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, number of ids of each text)."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in got for i in ids], "<u4"), np.array([len(ids) for ids in got], np.int64)

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of runs of letters: many as one text, cut behind the ids that end a word."""
        ids = np.array(self.letters.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def _learn(self, words: list[str], of_letters: int) -> tuple[np.ndarray, np.ndarray]:
        """The same of words of which the first ``of_letters`` are runs of plain letters."""
        some = [self._letters(words[k:min(k + 20_000, of_letters)]) for k in range(0, of_letters, 20_000)]
        some += [self._ids(words[k:k + 20_000]) for k in range(of_letters, len(words), 20_000)]
        return tuple(np.concatenate(x) for x in zip((self.flat[:0], self.start[:0]), *some, strict=True))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, some ``CHUNK`` characters of them at a time."""
        chunk, size = [], 0
        for t in texts:
            chunk.append(t or "")
            size += len(chunk[-1])
            if size >= CHUNK:
                yield from self._encode(chunk)
                chunk, size = [], 0
        yield from self._encode(chunk)

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        column = pa.array(texts, pa.large_string())
        # a special token's name counts in its own letter case: such texts go whole
        special = pc.match_substring(column, "<|").to_numpy(zero_copy_only=False)
        plain = ~special & ~pc.match_substring_regex(column, _NOT_PLAIN).to_numpy(zero_copy_only=False)
        words = {i: [w.decode("utf-8") for w in texts[i].encode("utf-8", "replace").lower().split()]
                 for i in np.flatnonzero(~special & ~plain).tolist()}
        apart = pc.replace_substring_regex(pc.utf8_lower(column.filter(pa.array(plain))), _PIECE, r" \1 ")
        parts = pc.ascii_split_whitespace(apart)
        coded = parts.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        known, n = self.known, len(self.known)
        at = np.fromiter((known.get(w, -1) for w in pieces), np.int64, len(pieces))
        missed = np.flatnonzero(at < 0)
        letters = np.array([pieces[k][0].isalpha() for k in missed.tolist()], bool)
        missed = np.concatenate((missed[letters], missed[~letters]))
        at[missed] = n + np.arange(len(missed))
        new = [pieces[k] for k in missed.tolist()]
        new += {w for s in words.values() for w in s if w not in known}.difference(new if words else ())
        ids, sizes = self._learn(new, int(letters.sum()))
        flat, start = np.concatenate((self.flat, ids)), np.concatenate((self.start, self.start[-1] + np.cumsum(sizes)))
        fresh = {w: n + k for k, w in enumerate(new)} if words else {}
        # what is frequent is learnt first; the rest is rare, and forgotten with its chunk
        stay = min(len(new), max(0, self.keep - n))
        known.update(zip(new[:stay], range(n, n + stay), strict=True))
        self.start = start[:n + stay + 1]
        self.flat = flat[:self.start[-1]].copy()
        gathered = self._gather(flat, start, at[coded.indices.to_numpy()], np.asarray(parts.offsets))
        for i, t in enumerate(texts):
            if plain[i]:
                yield next(gathered) + self.end
            elif special[i]:
                yield self._ids([t])[0].tobytes() + self.end
            else:
                numbers = np.array([fresh[w] if w in fresh else known[w] for w in words[i]], np.int64)
                yield next(self._gather(flat, start, numbers, np.array([0, len(numbers)]))) + self.end

    @staticmethod
    def _gather(flat: np.ndarray, start: np.ndarray, numbers: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        """The ids of texts given as numbers of their pieces, cut by ``offsets``."""
        first = start[numbers]
        size = start[numbers + 1] - first
        ends = np.concatenate(([0], np.cumsum(size)))
        out = flat[np.repeat(first - ends[:-1], size) + np.arange(ends[-1])]
        for a, b in zip(ends[offsets[:-1]].tolist(), ends[offsets[1:]].tolist(), strict=True):
            yield out[a:b].tobytes()


@lru_cache(maxsize=1)
def encoder(vocabulary: str, end_id: int) -> Encoder:
    """A worker process keeps its encoder, and the words it knows, for later tasks."""
    return Encoder(vocabulary, end_id)


ROW = "n_tokens bigint, full array<bigint>, rest int, rest_crc bigint, terms binary, n_terms int"


def _tokenise(vocabulary: str, window: int, end_id: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 4 * window
        for b in it:
            rows = []
            for raw in encoder(vocabulary, end_id).encode(b.column(1).to_pylist()):
                whole = len(raw) // size * size
                term, count = np.unique(np.frombuffer(raw, "<u4")[:-1], return_counts=True)
                both = np.concatenate((term, count))
                rows.append((len(raw) // 4, [zlib.crc32(raw[k:k + size]) for k in range(0, whole, size)],
                             (len(raw) - whole) // 4, zlib.crc32(raw[whole:]),
                             both.astype("<u2" if both.max(initial=0) < 1 << 16 else "<u4").tobytes(), len(term)))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                ["id", "n_tokens", "full", "rest", "rest_crc", "terms", "n_terms"])
    return run


def _terms(terms: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(terms, their counts): two rows of numbers of two bytes, or four where one needs them."""
    both = np.frombuffer(terms, "<u2" if len(terms) == 4 * n else "<u4").astype(np.int64)
    return both[:n], both[n:]


def _document_frequency(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for b in it:
        for t, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            term = _terms(t, c)[0]
            if len(term):
                if term[-1] >= len(total):
                    total = np.concatenate((total, np.zeros(int(term[-1]) + 1 - len(total), np.int64)))
                total[term] += 1
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["term", "docs"])


class Index:
    """A shard's inverted index: postings by term with their BM25 weights."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], lengths: np.ndarray, idf: np.ndarray, mean: float):
        self.terms, self.n = [t[idf[t] > 0] for t in terms], len(terms)
        doc = np.repeat(np.arange(self.n), [len(t) for t in self.terms])
        term = np.concatenate([*self.terms, np.zeros(0, np.int64)])
        tf = np.concatenate([*[c[idf[t] > 0] for t, c in zip(terms, counts, strict=True)], np.zeros(0)])
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / mean))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.at = np.searchsorted(term[order], np.arange(len(idf) + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for the seed's terms."""
        a, b = self.at[self.terms[seed]], self.at[self.terms[seed] + 1]
        size = b - a
        take = np.arange(size.sum()) + np.repeat(a - np.concatenate(([0], np.cumsum(size)[:-1])), size) if len(size) else np.zeros(0, int)
        return np.bincount(self.doc[take], self.weight[take], self.n)


def fill(index: Index, size: np.ndarray, window: int) -> list[list[tuple[int, float]]]:
    """Windows as (document, score for the seed) lists; each document once."""
    unused, windows = np.ones(len(size), bool), []
    for seed in np.argsort(-size, kind="stable").tolist():
        if not unused[seed]:
            continue
        unused[seed] = False
        room, mine = window - int(size[seed]), [(seed, 0.0)]
        fits = np.flatnonzero(unused & (size <= room))
        if len(fits):
            score = index.scores(seed)[fits]
            smallest = int(size[fits].min())
            for k in np.lexsort((-size[fits], -score)).tolist():
                doc = int(fits[k])
                if size[doc] <= room:
                    unused[doc] = False
                    mine.append((doc, float(score[k])))
                    room -= int(size[doc])
                    if room < smallest:
                        break
        windows.append(mine)
    return windows


def _pack(window: int, stats):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        idf, mean = stats.value
        pdf = pdf.sort_values("row").reset_index(drop=True)
        base, out, seq = int(key[0]) << 32, [], 0
        for i, crcs in enumerate(pdf["full"]):
            for k, crc in enumerate(crcs):
                out.append((i, k * window, window, crc, base + seq, 0, 0.0))
                seq += 1
        own = np.flatnonzero(pdf["rest"].to_numpy() > 0)
        pairs = [_terms(pdf["terms"][i], pdf["n_terms"][i]) for i in own]
        size = pdf["rest"].to_numpy(np.int64)[own]
        index = Index([t for t, _ in pairs], [c for _, c in pairs], pdf["n_tokens"].to_numpy(np.float64)[own], idf, mean)
        for docs in fill(index, size, window):
            offset = 0
            for k, score in docs:
                i = int(own[k])
                out.append((i, len(pdf["full"][i]) * window, int(size[k]), int(pdf["rest_crc"][i]), base + seq, offset, score))
                offset += int(size[k])
            seq += 1
        made = pd.DataFrame(out, columns=["i", "start", "length", "ids_crc32", "sequence_id", "offset", "bm25"])
        made.insert(0, "id", pdf["id"].take(made["i"]).to_numpy())
        made.insert(4, "doc_tokens", pdf["n_tokens"].take(made["i"]).to_numpy())
        return made[["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bm25"]]
    return run


def pack(df: DataFrame, vocabulary: str, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW,
         end_id: int = END_ID, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, bm25 (score for the seed of its window; 0 for seeds)."""
    for_workers(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    rows = cut_lineage(map_arrow(df.select(F.col(id_col), F.col(text_col).cast("string")),
                                 _tokenise(vocabulary, window, end_id), f"id {kind}, {ROW}"))
    freq = map_arrow(rows.select("terms", "n_terms"), _document_frequency, "term bigint, docs bigint")
    freq = freq.groupBy("term").agg(F.sum("docs").alias("docs")).toPandas()     # at most one row per vocabulary entry
    n, total = rows.agg(F.count(F.lit(1)), F.sum("n_tokens")).first()
    docs = np.zeros(int(freq["term"].max()) + 1 if len(freq) else 1)
    docs[freq["term"].to_numpy(np.int64)] = freq["docs"].to_numpy()
    # terms in over half of all documents get no weight
    idf = np.maximum(0, np.log((n - docs + 0.5) / (docs + 0.5)))
    stats = df.sparkSession.sparkContext.broadcast((idf, (total or 1) / max(1, n)))
    shards = max(1, -(-n // shard_docs))
    # rows come from a checkpoint, so their numbers do not change
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    out = dealt.groupBy("shard").applyInPandas(
        _pack(window, stats), f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                              "sequence_id bigint, offset bigint, bm25 double")
    return out.withColumnRenamed("id", id_col)
