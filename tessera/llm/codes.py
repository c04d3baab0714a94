"""Vector code compression: product codes found by equal-average search.

Vectors become integers (floor of ``scale`` times each component) and are cut
into ``parts`` equal consecutive parts. Each part position has a codebook of
``entries`` integer entries, begun with that part of the vectors with the
smallest ids and moved ``rounds`` times to the floored mean of the parts that
are nearest to it. A vector's code is the nearest entry of each part.

Equal-average search: the entries of a codebook are sorted by component sum. A
part starts where its own sum would stand and expands outward, the entry with
the smaller sum gap first. By Cauchy and Schwarz the squared gap over the
dimension never exceeds the squared distance, so the search of a part ends
when it strictly exceeds the best distance found; every entry that ties with
the best has been met by then, and the lowest index wins. All parts of an
Arrow batch move outward together, finished ones leave.

A round reads the quantised vectors (kept in the shared folder) once. A task
sends one row per part and used entry, its sums and count; the codebooks are
the only thing that reaches the driver, ``entries`` vectors whatever the input.
All arithmetic is on integers, so a repeated task gives the same rows; where
numbers could pass 64 bits they are computed as Python integers.

Defined results: a NULL vector and one with NULL, NaN or infinite components
has no row; a table without a valid vector gives no rows and empty codebooks;
with fewer vectors than entries the codebooks are as small; NULL ids count as
the largest, and equal ids are ordered by vector, to begin the codebooks;
repeated rows each get a row; valid vectors must have one length (else
ValueError), and one that ``parts`` does not divide is filled up with zeros;
equal labels share ``label_error``, NULLs among them; components beyond 10**30
count as that, errors beyond the largest long are given as it; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, map_arrow
from tessera.plans.strategy import join_small

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Largest component, and largest error that a result says.
FAR, LONG_MAX = 1e30, (1 << 63) - 1


@dataclass
class Codebooks:
    """``books[p]``: the entries of part ``p``, one integer row each."""
    books: list[np.ndarray]
    width: int          # components of a part
    exact: bool         # Python integers

    def sha256(self) -> str:
        """Digest of all components in decimal, by part, entry and position."""
        return hashlib.sha256(",".join(str(int(x)) for b in self.books for x in b.ravel()).encode()).hexdigest()


def equal_average(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance) of each point's nearest entry, ties to the
    lower index, and how many distances were computed."""
    n, k, dim = len(points), len(book), points.shape[1]
    best = np.full(n, -1, points.dtype)
    index = np.zeros(n, np.int64)
    if not n or not k:
        return index, np.zeros(n, points.dtype), 0
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    ranked = sums[order]
    own = points.sum(axis=1)
    right = np.searchsorted(ranked, own).astype(np.int64)
    left = right - 1
    live, computed = np.arange(n), 0
    for _ in range(k):
        # the nearer of the next entries on both sides; a side that has ended is farther than any
        lo, hi = left[live], right[live]
        to_lo = own[live] - ranked[np.maximum(lo, 0)]
        to_hi = ranked[np.minimum(hi, k - 1)] - own[live]
        down = (lo >= 0) & ((hi >= k) | (to_lo <= to_hi))
        gap = np.where(down, to_lo, to_hi)
        # strictly beyond the best: nothing further out can win or tie
        go = (best[live] < 0) | (gap * gap <= best[live] * dim)
        live, down, lo, hi = live[go], down[go], lo[go], hi[go]
        if not len(live):
            break
        entry = order[np.where(down, lo, hi)]
        diff = points[live] - book[entry]
        dist = (diff * diff).sum(axis=1)
        computed += len(live)
        old = best[live]
        win = (old < 0) | (dist < old) | ((dist == old) & (entry < index[live]))
        best[live[win]], index[live[win]] = dist[win], entry[win]
        left[live[down]] -= 1
        right[live[~down]] += 1
    return index, best, computed


def _points(column: pa.Array, width: int, exact: bool) -> np.ndarray:
    """The vectors of a batch as rows of integers."""
    flat = column.flatten()
    got = np.array([int(x) for x in flat.to_pylist()], object) if exact else flat.to_numpy(zero_copy_only=False).astype(np.int64)
    return got.reshape(len(column), width)


def _sums(state: Codebooks):
    """One row for each part and entry that is nearest to something: count and component sums."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = object if state.exact else np.int64
        count = [np.zeros(len(b), np.int64) for b in state.books]
        total = [np.zeros(b.shape, kind) for b in state.books]
        for batch in it:
            points = _points(batch.column(0), state.width * len(state.books), state.exact)
            for p, book in enumerate(state.books):
                mine = points[:, p * state.width:(p + 1) * state.width]
                index = equal_average(mine, book)[0]
                np.add.at(total[p], index, mine)
                count[p] += np.bincount(index, minlength=len(book))
        used = [(p, int(e)) for p, c in enumerate(count) for e in np.flatnonzero(c)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()),
             pa.array([int(count[p][e]) for p, e in used], pa.int64()),
             pa.array([[str(int(x)) for x in total[p][e]] for p, e in used], pa.list_(pa.string()))],
            ["part", "entry", "n", "total"])
    return run


def _assign(state: Codebooks):
    """Code and error of each vector; id and label pass."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            points = _points(batch.column(2), state.width * len(state.books), state.exact)
            error = np.zeros(len(points), points.dtype)
            index = np.zeros((len(points), len(state.books)), np.int64)
            for p, book in enumerate(state.books):
                index[:, p], dist, _ = equal_average(points[:, p * state.width:(p + 1) * state.width], book)
                error = error + dist
            digits = max(2, len(f"{max([1, *map(len, state.books)]) - 1:x}"))
            code = ["".join(f"{x:0{digits}x}" for x in row) for row in index.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()),
                                              pa.array([min(int(x), LONG_MAX) for x in error], pa.int64())],
                                             ["id", "label", "code", "error"])
    return run


def valid(vector: Column) -> Column:
    """No NULL vector and no NULL, NaN or infinite component."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def quantised(vector: Column, scale: int, exact: bool) -> Column:
    """Floors of ``scale`` times each component. From 2**53 on a double has no
    fraction; the exact form goes that far and stops at ``FAR``."""
    def floor(v: Column) -> Column:
        y = v * scale
        if not exact:
            return F.floor(y).cast("int")
        near = F.least(F.greatest(y, F.lit(-FAR)), F.lit(FAR))
        return F.when(F.abs(y) < 2.0 ** 53, F.floor(y).cast("decimal(38,0)")).otherwise(near.cast("decimal(38,0)"))
    return F.transform(vector, floor)


def train(rows: DataFrame, width: int, parts: int, entries: int, rounds: int, exact: bool) -> Codebooks:
    """Codebooks of (id, label, vec) rows."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    kind = object if exact else np.int64
    start = np.array([[int(x) for x in r["vec"]] for r in first], kind).reshape(len(first), width * parts)
    state = Codebooks([start[:, p * width:(p + 1) * width].copy() for p in range(parts)], width, exact)
    if not len(first):
        return state
    for _ in range(rounds):
        found = map_arrow(rows.select("vec"), _sums(state), "part int, entry int, n bigint, total array<string>")
        place = found.select("part", "entry", "n", F.posexplode("total").alias("at", "x"))
        means = (place.groupBy("part", "entry", "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n"))
                 .collect())       # at most one row per component of the codebooks
        books = [b.copy() for b in state.books]
        for r in means:
            books[r["part"]][r["entry"], r["at"]] = int(r["x"]) // int(r["n"])
        state = Codebooks(books, width, exact)
    return state


def compress(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """((id, label, code, error, label_error), codebooks) of the valid vectors."""
    id_kind, label_kind = (df.schema[c].dataType.simpleString() for c in (id_col, label_col))
    given = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                      F.col(vector_col).cast("array<double>").alias("vec")).where(valid(F.col("vec")))
    shortest, longest, low, high = given.agg(F.min(F.size("vec")), F.max(F.size("vec")),
                                             F.min(F.array_min("vec")), F.max(F.array_max("vec"))).first()
    if shortest != longest:
        raise ValueError(f"vectors of {shortest} to {longest} components")
    width = -(-(longest or 0) // parts)
    # the largest number there can be: the square of a gap between two sums
    top = scale * max(abs(low or 0.0), abs(high or 0.0)) + 1
    exact = 2 * top * max(width, 1) >= 2.0 ** 30
    vec = quantised(F.col("vec"), scale, exact)
    if width * parts != (longest or 0):
        vec = F.concat(vec, F.array_repeat(F.lit(0).cast("decimal(38,0)" if exact else "int"), width * parts - longest))
    rows = cut_lineage(given.select("id", "label", vec.alias("vec")))
    state = train(rows, width, parts, entries, rounds, exact)
    coded = cut_lineage(map_arrow(rows, _assign(state), f"id {id_kind}, label {label_kind}, code string, error bigint"))
    total = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"))
    total = total.select("label", F.least("label_error", F.lit(LONG_MAX)).cast("bigint").alias("label_error"))
    out = join_small(coded, total, "label", null_safe=True)
    return out.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error"), state
