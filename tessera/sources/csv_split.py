"""Quoted CSV in parallel: line breaks inside quotes, many tasks per file.

``multiLine`` makes a file one task, for where a record starts depends on all
quotes before it. Here the text reader splits files as it does plain text, and
two passes settle what lies in quotes:

1. one aggregate counts the quotes of each split (and takes the first line of
   each file, its header). Doubled quotes count twice, so the parity of the
   count says whether a split ends inside quotes if it began outside; summed up
   over a file's splits it says how each begins.
2. every task then starts at its first real record end. Records that begin and
   end in a split leave it whole; a piece at either end of a split is put
   together with its neighbours, at most two pieces a split.

Records are parsed by ``from_csv``, so fields follow Spark's own CSV rules.

Quotes may stand only around fields (doubled inside); a file whose quotes do
not end raises. Headers have no line break.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE, PIECE, OPEN = 0, 1, 2
_OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, split, value): physical lines, in the order of the split within a task."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), "value")


def _begins_inside(splits: DataFrame) -> dict[tuple[str, int], bool]:
    """Whether each split begins inside quotes; one entry per split."""
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    rows = splits.select("path", "split", F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)).alias("inside"))
    return {(r["path"], r["split"]): bool(r["inside"]) for r in rows.collect()}


def _records(inside) -> object:
    """Records of each split, and the pieces of records at its ends. ``inside``
    is the broadcast result of :func:`_begins_inside`."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None           # the split being read
        kept: list[str] = []        # lines of a record that has not ended
        odd, kind, number = False, WHOLE, 0

        def leftover() -> list[tuple]:
            return [(*at, number, OPEN if kind == WHOLE else PIECE, "\n".join(kept))] if kept else []

        for b in it:
            out: list[tuple] = []
            value = b.column(2)
            quotes = pc.count_substring(value, '"').to_numpy(zero_copy_only=False)
            paths, splits = b.column(0).to_pylist(), b.column(1).to_numpy()
            lines = value.to_pylist()
            change = [0, *(np.flatnonzero(splits[1:] != splits[:-1]) + 1).tolist(), len(lines)]
            change = sorted({*change, *[k for k in range(1, len(lines)) if paths[k] is not paths[k - 1] and paths[k] != paths[k - 1]]})
            for lo, hi in zip(change, change[1:], strict=False):
                if at != (paths[lo], int(splits[lo])):
                    out += leftover()
                    at, kept, number = (paths[lo], int(splits[lo])), [], 0
                    if at not in inside.value:
                        raise RuntimeError(f"splits of {at[0]} changed between the passes")
                    odd = inside.value[at]
                    kind = PIECE if odd else WHOLE
                ends = (np.cumsum(quotes[lo:hi]) + odd) % 2 == 0
                for line, end in zip(lines[lo:hi], ends.tolist(), strict=True):
                    if not end:
                        kept.append(line)
                        continue
                    out.append((*at, number, kind, "\n".join([*kept, line]) if kept else line))
                    kept, kind, number = [], WHOLE, number + 1
                odd = bool(not ends[-1])
            yield _batch(out)
        yield _batch(leftover())
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                      ["path", "split", "number", "kind", "record"])


def _joined(pieces: DataFrame) -> DataFrame:
    """Pieces of records put together: an open one begins a record, the others go on with it."""
    order = Window.partitionBy("path").orderBy("split", "number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chained = pieces.withColumn("chain", F.sum((F.col("kind") == OPEN).cast("int")).over(order))
    return chained.groupBy("path", "chain").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "number", "record"))), lambda p: p["record"]), "\n")
        .alias("record")).select("path", "record")


def csv_records(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, str]]:
    """((path, record) of all records but the headers, header line of each file)."""
    lines = _lines(spark, path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    # a checkpoint of one row per split
    from tessera.plans.strategy import checkpointed
    numbered = lines.select("path", "split", quotes.alias("quotes"), F.monotonically_increasing_id().alias("n"),
                            F.when(F.col("split") == 0, F.col("value")).alias("value"))
    splits = checkpointed(numbered.groupBy("path", "split").agg(F.sum("quotes").alias("quotes"), F.min_by("value", "n").alias("first")))
    headers = {r["path"]: r["first"].rstrip("\r") for r in splits.where("split = 0").select("path", "first").collect()}
    if not headers:
        raise ValueError(f"no files under {path}")
    broken = [p for p, h in headers.items() if h.count('"') % 2]
    unended = splits.groupBy("path").agg(F.sum("quotes").alias("q")).where("q % 2 = 1").select("path").collect()
    if broken or unended:
        raise ValueError(f"quotes do not end, or a line break in a header: {sorted({*broken, *[r['path'] for r in unended]})}")
    inside = spark.sparkContext.broadcast(_begins_inside(splits))
    found = lines.mapInArrow(_records(inside), "path string, split bigint, number bigint, kind int, record string")
    whole = found.where((F.col("kind") == WHOLE) & ((F.col("split") > 0) | (F.col("number") > 0))).select("path", "record")
    if any(inside.value.values()):
        whole = whole.unionByName(_joined(found.where(F.col("kind") != WHOLE)))
    return whole.select("path", F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''"), headers


def csv_text_split(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as text by name, whatever order each file's header has."""
    records, headers = csv_records(spark, path)
    options = {**_OPTIONS, "sep": sep}
    lines = sorted(set(headers.values()))
    probe = spark.createDataFrame([(h,) for h in lines], "h string")
    width = max(h.count(sep) + 1 for h in lines)
    names = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(width)])
    read = probe.select("h", F.from_csv("h", names.simpleString()[7:-1].replace(":", " "), {**options, "mode": "PERMISSIVE"}).alias("n")).collect()
    parts = []
    for r in read:
        fields = [n for n in r["n"] if n is not None]
        schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in fields)
        mine = records
        if len(lines) > 1:
            mine = records.where(F.col("path").isin([p for p, h in headers.items() if h == r["h"]]))
        parts.append(mine.select(F.from_csv("record", schema, options).alias("r")).select("r.*"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
