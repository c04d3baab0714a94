"""Filter interaction audit with radix text tries.

Five filters (``A`` to ``E``) judge every whole text; the audit says, for every
order in which they could run, what each step removes, what it would have
removed but for an earlier step, and what it costs in labelled documents.

Filter ``E`` (a text that a smaller id has too) is answered by tries:

1. adaptive prefixes: byte strings that cut the order of all texts into ranges
   of about ``range_bytes``. A pass takes approximate quantiles of the seven
   bytes after the prefix that a range shares, a second one weighs the ranges
   and finds what each shares; ranges still too heavy are cut again behind their
   longer prefix. A range is cut no more when its texts are equal.
2. texts, combined inside each batch (a hot text leaves a batch once), go to
   their range; ranges that could not be cut (copies of one text) are dealt
   over several salts;
3. each (range, salt) inserts its whole texts into a compressed trie whose
   terminals hold the minimum id; a salted range merges its salts' terminals in
   a second, equally small trie;
4. the terminals give one (id, digest) per text, the row that is no duplicate.
   Rows meet them by id, with 128 bits of the text beside it to tell rows that
   share an id apart; texts do not travel again.

Every document is then a mask of the five filters. Masks are counted per part
with map-side combine: 32 counts a part hold all that the 120 orders need.

Defined results: NULL texts count as empty; a NULL id is no smaller id and has
none, so its row never fails ``E``; rows with the same id and text are no
duplicates of each other; a NULL source is the empty string, and shares its part
with an empty one; a document with several label rows is good (toxic) if one
says so; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from xxhash import xxh3_128_digest

from tessera.llm.common import cut_lineage, for_workers, map_arrow

FILTERS = "ABCDE"
#: Bytes of text in a range, and bytes that a task remembers before it sends them on.
RANGE_BYTES = 32 << 20
#: Bytes of a shared prefix looked at in one pass, bytes of a code, pieces that a heavy range is cut into at a time.
WINDOW, CODE, PIECES = 512, 7, 512
#: Bytes that a text costs beside its own.
ROW_BYTES = 100
_UPPER = bytes(range(65, 91))
_SIGN = re.compile(rb"[#$%&*|]")


def failed(data: bytes, code_points: int) -> int:
    """Mask of the filters A to D that a text (UTF-8) fails; bit 0 is A."""
    words = data.split()        # of bytes: blank, \\t to \\r
    n = len(words)
    upper = len(data) - len(data.translate(None, _UPPER))
    return ((n < 50) | (100 * len(set(words)) < 65 * n) << 1 | (100 * upper > 5 * code_points) << 2
            | (_SIGN.search(data) is not None) << 3)


# ------------------------------------------------------------------ the trie

class Trie:
    """A compressed trie of byte strings; terminals hold the least value put there.

    A node is [children by first byte, value or None]; a child is [label, node]."""

    def __init__(self) -> None:
        self.root: list = [{}, None]

    def put(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while at < len(key):
            edge = node[0].get(key[at])
            if edge is None:
                leaf: list = [{}, None]
                node[0][key[at]] = [key[at:], leaf]
                node, at = leaf, len(key)
            elif key.startswith(edge[0], at):
                node, at = edge[1], at + len(edge[0])
            else:
                k = shared_prefix(edge[0], key[at:at + len(edge[0])])
                middle: list = [{edge[0][k]: [edge[0][k:], edge[1]]}, None]
                edge[0], edge[1] = edge[0][:k], middle
                node, at = middle, at + k
        if node[1] is None or value < node[1]:
            node[1] = value

    def items(self) -> Iterator[tuple[bytes, object]]:
        """(text, value) of the terminals; a stack, so depth is no limit."""
        todo: list = [(self.root, b"")]
        while todo:
            node, key = todo.pop()
            if node[1] is not None:
                yield key, node[1]
            todo += [(child, key + label) for label, child in node[0].values()]


def shared_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


# --------------------------------------------------------- adaptive prefixes

def _code(data: Column, depth: Column) -> Column:
    """Order-preserving number of the ``CODE`` bytes after the first ``depth``."""
    return F.conv(F.rpad(F.hex(F.substring(data, depth + 1, F.lit(CODE))), 2 * CODE, "0"), 16, 10).cast("bigint")


def _placed(texts: DataFrame, cuts: list[bytes]) -> DataFrame:
    """(range, data): the number of each text's range."""
    if not cuts:
        return texts.select(F.lit(0).alias("range"), "data")
    known = texts.sparkSession.sparkContext.broadcast(cuts)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            at = [bisect_right(known.value, t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), b.column(0)], ["range", "data"])

    return map_arrow(texts, run, "range int, data binary")


def _cut_heavy(texts: DataFrame, cuts: list[bytes], heavy: dict[int, bytes]) -> list[bytes]:
    """More cut points inside the heavy ranges, behind the prefix each shares."""
    placed = _placed(texts, cuts)
    depth = F.create_map(*[F.lit(x) for r, prefix in heavy.items() for x in (r, len(prefix))])
    codes = placed.where(F.col("range").isin(*heavy)).select("range", _code(F.col("data"), depth[F.col("range")]).alias("code"))
    points = [k / PIECES for k in range(1, PIECES)]
    new = set()
    for r in codes.groupBy("range").agg(F.percentile_approx("code", points, 10 * PIECES).alias("q")).collect():
        # a frequent code gets a range of its own: its successor is a cut, too
        for code in {c for q in r["q"] for c in (q, q + 1)}:
            new.add(heavy[r["range"]] + code.to_bytes(CODE + 1, "big")[1:].rstrip(b"\0"))
    return sorted({*cuts, *new} - {b""})


def adaptive_prefixes(texts: DataFrame, range_bytes: int = RANGE_BYTES) -> tuple[list[bytes], dict[int, int]]:
    """(cut points, salts of the ranges that could not be cut) for the binary
    column ``data``. The driver sees one row per range, and the prefixes of the
    heavy ones."""
    texts = texts.select("data")
    cuts: list[bytes] = []
    weight: dict[bytes, int] = {}
    salts: dict[int, int] = {}
    total = texts.agg(F.sum(F.length("data") + ROW_BYTES)).first()[0] or 0
    heavy = {0: b""} if total > 2 * range_bytes else {}
    while heavy:
        finer = _cut_heavy(texts, cuts, heavy)
        # a range inside a heavy one shares what that one shares
        shared = [heavy.get(bisect_right(cuts, c), b"") for c in (b"", *finer)]
        cuts, heavy, salts = _weigh(texts, finer, shared, weight, range_bytes)
    return cuts, salts


def _weigh(texts: DataFrame, cuts: list[bytes], shared: list[bytes], weight: dict[bytes, int],
           range_bytes: int) -> tuple[list[bytes], dict[int, bytes], dict[int, int]]:
    """Ranges weighed in one pass and light neighbours merged: (cut points, the
    heavy ranges with the prefix each shares, salts of those that cannot be cut:
    their texts are equal, or their prefix and weight are what they were)."""
    placed = _placed(texts, cuts)
    depth = {r: len(p) for r, p in enumerate(shared) if p}
    at = F.coalesce(F.create_map(*[F.lit(x) for kv in depth.items() for x in kv])[F.col("range")], F.lit(0)) if depth else F.lit(0)
    # the deeper, the farther a pass looks
    part = F.substring(F.col("data"), at + 1, F.greatest(at, F.lit(WINDOW)))
    size = F.length("data")
    rows = placed.groupBy("range").agg(F.sum(size + ROW_BYTES).alias("bytes"), F.min(part).alias("lo"), F.max(part).alias("hi"),
                                       F.max(size).alias("longest"))
    big = F.col("bytes") > 2 * range_bytes
    rows = rows.select("range", "bytes", "longest", F.when(big, F.col("lo")).alias("lo"), F.when(big, F.col("hi")).alias("hi"))
    kept, heavy, salts, load = [], {}, {}, 0
    for r in sorted(rows.collect(), key=lambda r: r["range"]):
        k, alone = r["range"], r["lo"] is not None
        if load and (alone or load + r["bytes"] > range_bytes):
            kept.append(cuts[k - 1])
            load = 0
        load += 2 * range_bytes if alone else r["bytes"]       # nothing is merged with a heavy range
        if alone:
            lo, hi = bytes(r["lo"]), bytes(r["hi"])
            prefix = shared[k] + lo[:shared_prefix(lo, hi)]
            equal = lo == hi and r["longest"] <= len(prefix)
            if equal or weight.get(prefix) == r["bytes"]:
                salts[len(kept)] = -(-r["bytes"] // range_bytes)
            else:
                heavy[len(kept)] = prefix
                weight[prefix] = r["bytes"]
    return kept, heavy, salts


# ------------------------------------------------- first rows of equal texts

def _digests(texts: list[bytes]) -> list[pa.Array]:
    """Two longs of each text."""
    h = np.frombuffer(b"".join(map(xxh3_128_digest, texts)), "<i8").reshape(-1, 2)
    return [pa.array(h[:, 0]), pa.array(h[:, 1])]


def _send(cuts, salts: dict[int, int], kind: pa.DataType):
    """The least id of each text of a batch, with the text's range and salt."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            least: dict[bytes, object] = {}
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                old = least.get(t)
                if old is None or i < old:
                    least[t] = i
            at = [bisect_right(cuts.value, t) for t in least]
            salt = [zlib.crc32(str(i).encode()) % salts[r] if r in salts else 0 for r, i in zip(at, least.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(salt, pa.int32()), pa.array(least.values(), kind),
                 pa.array(least.keys(), pa.binary())], ["range", "salt", "id", "data"])
    return run


def _terminals(salted: frozenset[int], kind: pa.DataType):
    """One group's texts put into a trie; its terminals as rows. Only texts that
    are to meet those of other salts are sent on."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        trie, again = Trie(), key[0].as_py() in salted
        for batch in table.select(["data", "id"]).to_batches():
            for t, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                trie.put(t, i)
        texts, ids = zip(*trie.items(), strict=True)
        return pa.Table.from_arrays(
            [pa.array([key[0].as_py()] * len(ids), pa.int32()), pa.array(ids, kind), *_digests(list(texts)),
             pa.array(texts if again else [None] * len(ids), pa.binary())], ["range", "id", "h1", "h2", "data"])
    return run


def first_rows(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(id, h1, h2): of each different text the least id, and the text's digest."""
    for_workers(df.sparkSession)
    name = df.schema[id_col].dataType.simpleString()
    docs = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8").alias("data"))
    kind = to_arrow_type(df.schema[id_col].dataType)
    cuts, salts = adaptive_prefixes(docs, range_bytes)
    known = df.sparkSession.sparkContext.broadcast(cuts)
    sent = map_arrow(docs, _send(known, salts, kind), f"range int, salt int, id {name}, data binary")
    shape = f"range int, id {name}, h1 bigint, h2 bigint, data binary"
    found = sent.groupBy("range", "salt").applyInArrow(_terminals(frozenset(salts), kind), shape)
    if salts:
        found = cut_lineage(found)
        met = found.where("data IS NOT NULL").groupBy("range").applyInArrow(_terminals(frozenset(), kind), shape)
        found = found.where("data IS NULL").unionByName(met)
    return found.select("id", "h1", "h2")


# ------------------------------------------------------------------ the audit

def _judge():
    """(id, part, mask of A to D, digest) of each row."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = [t.encode("utf-8", "surrogatepass") for t in b.column(2).to_pylist()]
            points = pc.utf8_length(b.column(2)).to_pylist()
            mask = [failed(t, n) for t, n in zip(texts, points, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(mask, pa.int32()), *_digests(texts)],
                                             ["id", "part", "mask", "h1", "h2"])
    return run


def masks(df: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "source",
          label_id_col: str = "doc_id", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(id, part, mask, good, toxic) of every row. ``labels`` has the id column
    and boolean columns ``good`` and ``toxic``."""
    name = df.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = cut_lineage(map_arrow(docs, _judge(), f"id {name}, part string, mask int, h1 bigint, h2 bigint"))
    said = labels.where(F.col(label_id_col).isNotNull()).groupBy(F.col(label_id_col).alias("label_id")).agg(
        F.coalesce(F.bool_or("good"), F.lit(False)).alias("good"), F.coalesce(F.bool_or("toxic"), F.lit(False)).alias("toxic"))
    first = first_rows(df, text_col, id_col, range_bytes).select(
        F.col("id").alias("first_id"), F.col("h1").alias("f1"), F.col("h2").alias("f2"), F.lit(True).alias("first"))
    with_id = rows.where("id IS NOT NULL").join(
        first, (F.col("id") == F.col("first_id")) & (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")), "left").join(
        said, F.col("id") == F.col("label_id"), "left")
    yes = F.lit(1 << FILTERS.index("E"))
    out = with_id.select("id", "part", F.when(F.col("first").isNull(), F.col("mask").bitwiseOR(yes)).otherwise(F.col("mask")).alias("mask"),
                         F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # NULL ids meet no label and no other row, so they take no part in the joins
    return out.unionByName(rows.where("id IS NULL").select(
        "id", "part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic")))


def _steps() -> str:
    """Every step of every order as JSON: the filter's bit and those before it."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for k, f in enumerate(order):
            bit = 1 << FILTERS.index(f)
            rows.append({"filter_order": "".join(order), "step": k + 1, "bit": bit, "before": before})
            before |= bit
    return json.dumps(rows)


def audit(masked: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) from (part, mask, good, toxic) rows."""
    counts = masked.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))   # at most 32
    steps = F.from_json(F.lit(_steps()), "array<struct<filter_order:string,step:int,bit:int,before:int>>")
    rows = parts.select("part", "masks", F.inline(steps))
    bit, before = F.col("bit"), F.col("before")

    def total(value: str, when) -> Column:
        return F.aggregate("masks", F.lit(0).cast("bigint"), lambda acc, m: acc + F.when(when(m["mask"]), m[value]).otherwise(0))

    fails = lambda m: m.bitwiseAND(bit) != 0
    alive = lambda m: m.bitwiseAND(before) == 0
    # of the orders of a mask's filters, an equal share has this one first
    shares = F.array(*[F.lit(math.factorial(len(FILTERS)) // k) for k in range(1, len(FILTERS) + 1)])
    share = F.aggregate("masks", F.lit(0).cast("bigint"), lambda acc, m: acc + F.when(
        fails(m["mask"]), m["n"] * F.element_at(shares, F.bit_count(m["mask"]))).otherwise(0))
    return rows.select(
        "part", "filter_order", "step", total("n", lambda m: alive(m) & ~fails(m)).alias("kept"),
        total("n", lambda m: alive(m) & fails(m)).alias("removed"), total("n", lambda m: ~alive(m) & fails(m)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"), total("good", lambda m: alive(m) & fails(m)).alias("good_lost"),
        total("toxic", lambda m: alive(m) & fails(m)).alias("toxic_lost"), share.alias("shapley"))
