"""Column-oriented JSON in parallel: ``{"col": {"0": v, ...}, ...}``, many tasks per file.

``multiLine`` makes a file one task and one row, and takes only its first
object. Here the text reader splits files at commas as it does plain text at
line ends, and two passes settle where each split begins:

1. every task counts the quotes of its splits, and the brackets both for a split
   that begins inside a string and for one that does not. Summed up over a file
   this says of each split whether it does, and how deep it begins.
2. every task follows the entries of its splits and says which column it saw
   opened last and how many objects. An entry that crosses splits (a text with
   commas, a nested value) is put together from its pieces, one a split.

A third pass then reads the entries. The driver holds a few numbers per split.

Files are UTF-8, strings in double quotes, objects one after the other or in an
array. A column named twice in an object has the entries of both. What is no
JSON raises, but within columns not asked for only brackets and quotes are
looked at.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIECE, OPEN, MARK = 0, 1, 2
#: In place of a column's number: not asked for; not known yet.
SKIP, UNKNOWN = -1, -2
_ANY = r'"[^"\\\x00-\x1f]*(?:\\.[^"\\\x00-\x1f]*)*"'
_PLAIN = r'[^"\\\x00-\x1f]*'
_SCALAR = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|NaN|[+-]?Infinity|[+-]INF"
_S = r"[ \t\r\n]*"
# one entry without escapes, in the words of both regular expression engines
_ENTRY = rf"^{_S}\"(?P<key>{_PLAIN})\"{_S}:{_S}(?:\"(?P<text>{_PLAIN})\"|(?P<scalar>{_SCALAR})){_S}$"
_ONE = re.compile(_ENTRY[:-1] + r"\Z")
_BLANK = re.compile(_S)
_KEY = re.compile(rf"({_ANY}){_S}:{_S}")
_VALUE = re.compile(rf"({_ANY})|({_SCALAR})(?![0-9.eE])")
_MARKS = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|["{}\[\]]', re.DOTALL)
_TO_QUOTE = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)
_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_STATE = "path string, split bigint, odd boolean, outside bigint, inside bigint, head string"
_UNIT = "file int, split bigint, number bigint, kind int, depth int, object bigint, field int, text string"
_CELL = "file int, object bigint, index string, field int, value string"
#: Fewest entries in a row that are taken by Arrow kernels instead of one by one.
ROW = 32


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(path, split, value): what stands between commas, in the order of the split within a task."""
    return spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), "value")


def _runs(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """Pieces of one split that follow each other in a batch; a split has one or several runs."""
    for b in it:
        paths, splits, values = b.columns
        other = pc.or_(pc.not_equal(paths[1:], paths[:-1]), pc.not_equal(splits[1:], splits[:-1]))
        cuts = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), len(values)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                yield (paths[lo].as_py(), splits[lo].as_py()), values[lo:hi]


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    names, types = zip(*(f.split(" ") for f in ddl.split(", ")), strict=True)
    cols = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(cols, types, strict=True)], list(names))


def _counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: is its number of quotes odd, its change of depth if it begins outside of a string, or inside."""
    at, odd, depth, head, out = None, 0, [0, 0], "", []
    for now, pieces in _runs(it):
        if now != at:
            if at:
                out.append((*at, bool(odd), *depth, head))
            at, odd, depth, head = now, 0, [0, 0], pieces[0].as_py().lstrip("\ufeff \t\r\n")[:1]
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(pieces)], pieces), ",")[0].as_buffer().to_pybytes()
        if b"\\" in text:
            text = _ESCAPE.sub(b"__", text)
        chars = np.frombuffer(text, np.uint8)
        quote = chars == ord('"')
        inside = (np.cumsum(quote) + odd) % 2
        low = chars | 32                # [ and { differ in this bit only, so do ] and }
        step = (low == ord("{")).astype(np.int8) - (low == ord("}"))
        depth = [depth[k] + int(step[inside == k].sum(dtype=np.int64)) for k in (0, 1)]
        odd = (odd + int(quote.sum())) % 2
    if at:
        out.append((*at, bool(odd), *depth, head))
    yield _batch(out, _STATE)


def _begins(spark: SparkSession, pieces: DataFrame) -> dict[tuple[str, int], tuple]:
    """(file's number, begins inside a string, depth) of each split."""
    states: dict[tuple[str, int], tuple] = {}
    path, file, inside, depth, base = None, -1, False, 0, 0
    for r in [*sorted(pieces.mapInArrow(_counts, _STATE).collect()), None]:
        if r is None or r["path"] != path:
            if inside or depth != base:
                raise ValueError(f"malformed JSON: strings or brackets do not end in {path}")
            if r is None:
                break
            base = -1 if r["head"] == "[" else 0
            path, file, inside, depth = r["path"], file + 1, False, base
        states[path, r["split"]] = (file, inside, depth)
        depth += r["inside"] if inside else r["outside"]
        inside ^= r["odd"]
    return states


def _text(token: str) -> str:
    """The string that a token in quotes stands for."""
    if "\\" not in token:
        return token[1:-1]
    return json.loads(token).encode("utf-8", "replace").decode()     # half a surrogate pair: "?"


def _after(piece: str, inside: bool, depth: int) -> tuple[bool, int]:
    """Inside a string, and how deep, after the piece."""
    at = 0
    if inside:
        m = _TO_QUOTE.match(piece)
        if not m:
            return True, depth
        at = m.end()
    for m in _MARKS.finditer(piece, at):
        c = m.group()
        if c == '"':
            return True, depth
        depth += (c in "{[") - (c in "}]")
    return False, depth


def _read(text: str, depth: int, number: int, field: int, fields: dict[str, int], cells: list | None) -> tuple[int, int, int]:
    """Reads what stands between two commas outside of strings and values, from
    the state it begins in (depth, number of the object, column). Adds its
    entries to ``cells`` as (object, index, column, value); returns the state after it."""
    def bad() -> ValueError:
        return ValueError(f"malformed column-oriented JSON at: {text[at:at + 40]!r}")

    at, may_end, ended = 0, False, False         # a bracket may close here; an entry was read
    while (at := _BLANK.match(text, at).end()) < len(text):
        c = text[at]
        if depth <= 0:
            if c == "{" and depth == 0:
                depth, number, field, may_end, ended = 1, number + 1, SKIP, True, False
            elif c == "[" and depth < 0:
                depth = 0
            elif c == "]" and depth == 0:
                depth = -1
            else:
                raise bad()
            at += 1
        elif depth == 2 and field < 0:           # a column not asked for
            for m in _MARKS.finditer(text, at):
                depth += (m.group() in "{[") - (m.group() in "}]")
                if depth == 1:
                    at, field, may_end, ended = m.end(), SKIP, True, True
                    break
            else:
                at = len(text)
        elif c == "}" and may_end:
            depth, field, ended, at = depth - 1, SKIP, True, at + 1
        else:
            m = _KEY.match(text, at)
            if ended or not m:
                raise bad()
            key, start = _text(m.group(1)), m.end()
            at, may_end, ended = start, True, True
            c = text[at:at + 1]
            value = _VALUE.match(text, at)
            if depth == 1:
                if c == "{" or (c == "[" and key not in fields):
                    depth, field, ended, at = 2, fields.get(key, SKIP), False, at + 1
                elif value and (key not in fields or value.group() == "null"):
                    at = value.end()
                else:
                    raise bad()
            elif value:
                at = value.end()
                if cells is not None:
                    shown = value.group(2) if value.group(2) else _text(value.group(1))
                    cells.append((number, key, field, None if value.group(2) == "null" else shown))
            else:                                # a nested value stays as it is written
                level = 0
                for m in _MARKS.finditer(text, at):
                    level += (m.group() in "{[") - (m.group() in "}]")
                    if level <= 0:
                        at = m.end()
                        break
                raw = text[start:at]
                if c not in ("{", "["):
                    raise bad()
                json.loads(raw)                  # raises if it is no JSON
                if cells is not None:
                    cells.append((number, key, field, raw))
    if not ended and (depth == 1 or (depth == 2 and field >= 0)):
        raise bad()
    return depth, number, field


def _taken(pieces: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(key, value, is one entry) of all pieces, by one pattern; an empty scalar is none."""
    found = pc.extract_regex(pieces, _ENTRY)
    key, text, scalar = found.flatten()
    value = pc.if_else(pc.equal(scalar, ""), text, pc.if_else(pc.equal(scalar, "null"), pa.scalar(None, pa.string()), scalar))
    return key, value, found.is_valid()


def _cells(file: int, number: int, field: int, key: pa.Array, value: pa.Array) -> pa.RecordBatch:
    n = len(key)
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(file, pa.int32()), n), pa.repeat(pa.scalar(number, pa.int64()), n), key,
                                       pa.repeat(pa.scalar(field, pa.int32()), n), value], ["file", "object", "index", "field", "value"])


def _entries(states, fields: dict[str, int], read: bool):
    """The entries of each split as cells or, without ``read``, its mark (objects
    and column opened) and the pieces of entries at its ends. ``states`` is the
    broadcast state that each split begins in."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, kept, units = None, [], []
        lead, first, inside, depth, deep, file, number, field = False, False, False, 0, 0, 0, 0, UNKNOWN

        def end() -> None:
            if kept:
                units.append((file, at[1], 0, PIECE if lead else OPEN, depth, number, field, ",".join(kept)))
            units.append((file, at[1], 0, MARK, depth, number, field, None))

        for now, pieces in _runs(it):
            cells: list[tuple] = []
            if now != at:
                if at:
                    end()
                if now not in states.value:
                    raise RuntimeError(f"splits of {now[0]} changed between the passes")
                at, kept = now, []
                file, inside, depth, number, field = states.value[now]
                lead, deep = inside or depth > 2, depth
                if now[1] == 0:
                    pieces = pa.concat_arrays([pa.array([pieces[0].as_py().removeprefix("\ufeff")]), pieces[1:]])
            keys, values, plain = _taken(pieces) if read else (None, None, pc.match_substring_regex(pieces, _ENTRY))
            odd = [*np.flatnonzero(~plain.to_numpy(zero_copy_only=False)).tolist(), len(pieces)]
            pieces, i, next_odd = pieces.to_pylist() if len(odd) > 1 or lead or kept or depth != 2 else None, 0, 0
            while i < odd[-1]:
                if depth == 2 and not kept and not lead:
                    while odd[next_odd] < i:
                        next_odd += 1
                    if (hi := odd[next_odd]) - i >= ROW or pieces is None:
                        if read and field >= 0:
                            yield _cells(file, number, field, keys[i:hi], values[i:hi])
                        i = hi
                        continue
                    if m := _ONE.match(pieces[i]):
                        if read and field >= 0:
                            key, text, scalar = m.groups()
                            cells.append((number, key, field, text if scalar is None else None if scalar == "null" else scalar))
                        i += 1
                        continue
                piece, i = pieces[i], i + 1
                inside, deep = _after(piece, inside, deep)
                kept.append(piece)
                if inside or deep > 2:
                    continue
                if lead:
                    units.append((file, at[1], 0, PIECE, depth, number, field, ",".join(kept)))
                    lead, depth = False, deep
                else:
                    depth, number, field = _read(",".join(kept), depth, number, field, fields, cells if read else None)
                kept = []
            if read:
                units.clear()
                yield _batch([(file, n, key, k, v) for n, key, k, v in cells], _CELL)
        if at:
            end()
        yield _batch([], _CELL) if read else _batch(units, _UNIT)
    return run


def _joined(pieces: DataFrame) -> DataFrame:
    """Entries put together from their pieces: an open one begins an entry, the others go on with it."""
    # of one split the piece that goes on comes before the one that opens
    order = Window.partitionBy("file").orderBy("split", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chained = pieces.withColumn("chain", F.sum((F.col("kind") == OPEN).cast("int")).over(order))
    begun = [F.max(F.when(F.col("kind") == OPEN, F.col(c))).alias(c) for c in ("depth", "object", "field")]
    return chained.groupBy("file", "chain").agg(
        F.min("split").alias("split"), *begun,
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "text"))), lambda p: p["text"]), ",").alias("text")
    ).select("file", "split", "depth", "object", "field", "text")


def _read_joined(starts, fields: dict[str, int], read: bool):
    """Cells of entries that cross splits or, without ``read``, a mark of each."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            units, cells = [], []
            for file, split, depth, number, field, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not read:
                    _, after, last = _read(text, depth, 0, field, fields, None)
                    units.append((file, split, 1, MARK, depth, after, last, None))
                    continue
                begun, column = starts.value[file, split]
                found: list[tuple] = []
                _read(text, depth, begun + number, column if field == UNKNOWN else field, fields, found)
                cells += [(file, *c) for c in found]
            yield _batch(cells, _CELL) if read else _batch(units, _UNIT)
    return run


def json_cells(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """(file, object, index, field, value as text) of all entries of the named columns, ``field`` a column's place in ``names``."""
    from tessera.plans.strategy import checkpointed
    fields = {n: i for i, n in enumerate(names)}
    share = spark.sparkContext.broadcast
    pieces = _pieces(spark, path)
    begins = _begins(spark, pieces)
    # a checkpoint of two or three rows per split
    marks = share({k: (*v, 0, UNKNOWN) for k, v in begins.items()})
    units = checkpointed(pieces.mapInArrow(_entries(marks, fields, False), _UNIT))
    crossing = _joined(units.where(F.col("kind") != MARK))
    seen = units.where(F.col("kind") == MARK)
    crosses = bool(units.where(F.col("kind") == OPEN).take(1))
    if crosses:
        seen = seen.unionByName(crossing.mapInArrow(_read_joined(None, fields, False), _UNIT))
    starts: dict[tuple[int, int], tuple[int, int]] = {}
    opened = {}                         # by file: objects so far, column
    for r in sorted(seen.select("file", "split", "number", "object", "field").collect()):
        number, field = opened.get(r["file"], (0, SKIP))
        starts.setdefault((r["file"], r["split"]), (number, field))
        opened[r["file"]] = (number + r["object"], field if r["field"] == UNKNOWN else r["field"])
    known = share({k: (*v, *starts[v[0], k[1]]) for k, v in begins.items()})
    cells = pieces.mapInArrow(_entries(known, fields, True), _CELL)
    if crosses:
        cells = cells.unionByName(crossing.mapInArrow(_read_joined(share(starts), fields, True), _CELL))
    return cells
