"""Typed CSV and JSON scans that bind columns by name.

Spark's CSV reader binds columns by *position*, within one file and, for a
folder, with the header of one of its files. These readers read every column
as text from files that share one header (a folder with differing headers is
read header by header), then select and cast every declared field by name: a
required field that is absent raises, an optional one becomes a typed NULL.

Fields may be quoted, with doubled quotes and line breaks inside
(``multiline``, the default for CSV; turn it off to split large files without
such fields). The usual tokens for a missing value become NULL. Integers may be
written with a zero fraction (``3.0``). A required value that is missing or
malformed raises; an optional one becomes NULL and is reported: see
``rejects`` and :func:`cast_rejects`. Floating columns have NaN normalised to
NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.csv_split import csv_text_split
from tessera.sources.json_split import json_cells

#: Texts that data-frame tools read as a missing value.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
           "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
_CORRUPT = "_malformed_record"
#: Rows of a written column-oriented object: it is one row while it is written.
OBJECT_ROWS = 100_000


def _string_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def _cast(text: Column, kind: T.DataType) -> Column:
    """NULL where the text is not a value of the type. Whole numbers go through
    decimal, so ``3.0`` and ``3e2`` are integers and long ids stay exact."""
    if isinstance(kind, T.IntegralType):
        number = F.coalesce(text.try_cast("decimal(38,10)"), text.try_cast("double").try_cast("decimal(38,10)"))
        return F.when(number == F.floor(number), F.floor(number).try_cast(kind))
    return text.try_cast(kind)


def _typed(raw: DataFrame, schema: T.StructType, required: set[str], missing=MISSING,
           rejects: str | None = None) -> DataFrame:
    present = set(raw.columns)
    missing_required = sorted(n for n in required if n not in present)
    if missing_required:
        raise ValueError(f"required columns absent from input: {missing_required}")
    cols: list[Column] = []
    bad: list[Column] = []
    for f in schema.fields:
        if f.name not in present:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.col(f"`{f.name}`")
        text = F.when(~F.trim(text).isin(*missing), text)
        value = text if isinstance(f.dataType, T.StringType) else _cast(F.trim(text), f.dataType)
        if f.name in required:
            value = F.when(value.isNotNull(), value).otherwise(
                F.raise_error(F.concat(F.lit(f"required {f.name}: bad value "), F.coalesce(F.col(f"`{f.name}`"), F.lit("(none)"))))
                .cast(f.dataType))
        else:
            bad.append(F.when(text.isNotNull() & value.isNull(), F.lit(f.name)))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        cols.append(value.alias(f.name))
    if rejects:
        cols.append(F.filter(F.array(*bad, F.lit(None).cast("string")), lambda c: c.isNotNull()).alias(rejects))
    return raw.select(*cols)


def _csv_text(spark: SparkSession, path: str, sep: str, multiline: bool) -> DataFrame:
    """All columns as text by name, whatever order each file's header has."""
    files = sorted(spark.read.text(path).inputFiles())          # a listing, no scan
    reader = lambda: (spark.read.option("header", True).option("sep", sep).option("multiLine", multiline)
                      .option("quote", '"').option("escape", '"').option("mode", "FAILFAST"))
    headers: dict[tuple, list[str]] = {}
    for file in files:          # the first line of each file
        headers.setdefault(tuple(reader().csv(file).columns), []).append(file)
    parts = [reader().csv(group) for group in headers.values()]
    if not parts:
        raise ValueError(f"no files under {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   required: list[str] | tuple[str, ...] = (), sep: str = ",", multiline: bool | str = True,
                   missing=MISSING, rejects: str | None = None) -> DataFrame:
    """CSV with a header row, bound by name to ``schema`` (no inference pass).
    With ``rejects``, a column of that name lists the fields of the row whose
    present value was malformed. ``multiline="split"`` reads files with quoted
    line breaks by many tasks each (see :mod:`tessera.sources.csv_split`)."""
    text = csv_text_split(spark, path, sep) if multiline == "split" else _csv_text(spark, path, sep, multiline)
    return _typed(text, schema, set(required), missing, rejects)


def read_json_typed(spark: SparkSession, path: str, schema: T.StructType,
                    required: list[str] | tuple[str, ...] = (), multiline: bool = False,
                    rejects: str | None = None) -> DataFrame:
    """JSON lines (splittable) or, with ``multiline``, a JSON array of records.

    Fields are read as raw text under their declared names, then cast. A
    malformed line raises; so does a record without a required field. A
    column-oriented object (``{"col": {"0": v}}``) is not a record layout and
    is rejected.
    """
    text = T.StructType(_string_schema(schema).fields + [T.StructField(_CORRUPT, T.StringType(), True)])
    raw = (spark.read.schema(text).option("multiLine", multiline).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _CORRUPT).json(path))
    _reject_column_oriented(raw, schema)
    # the check sits in the first column, so it runs whenever rows are read
    first = schema.fields[0].name
    raw = raw.withColumn(first, F.when(F.col(_CORRUPT).isNull(), F.col(f"`{first}`")).otherwise(
        F.raise_error(F.concat(F.lit("malformed JSON record: "), F.col(_CORRUPT)))))
    return _typed(raw.drop(_CORRUPT), schema, set(required), missing=("\0",), rejects=rejects)


def read_json_columns(spark: SparkSession, path: str, schema: T.StructType,
                      required: list[str] | tuple[str, ...] = (), rejects: str | None = None) -> DataFrame:
    """Column-oriented JSON, ``{"col": {"0": v, ...}, ...}``, any number of
    objects a file and any number of tasks (see :mod:`tessera.sources.json_split`).
    Values of one index and object meet again by one aggregate. An index that a
    column lacks is a missing value of it."""
    cells = json_cells(spark, path, schema.names)
    met = cells.groupBy("file", "object", "index").agg(*[
        F.max(F.when(F.col("field") == i, F.col("value"))).alias(f.name) for i, f in enumerate(schema.fields)])
    return _typed(met.drop("file", "object", "index"), schema, set(required), missing=("\0",), rejects=rejects)


def write_json_columns(df: DataFrame, path: str, index: str) -> None:
    """Column-oriented objects, one a line: every other column as a map from
    ``index`` to its value. A task's rows make one object for each
    ``OBJECT_ROWS`` of them; rows of one index share it, and a second one raises."""
    cols = [c for c in df.columns if c != index]
    part = df.select(F.spark_partition_id().alias("_part"), *[F.col(c) for c in df.columns])
    most = part.groupBy("_part").count().agg(F.max("count")).first()[0] or 1
    key = F.col(index).cast("string")
    part = part.withColumn("_object", F.pmod(F.xxhash64(key), F.lit(-(-most // OBJECT_ROWS))))
    held = part.groupBy("_part", "_object").agg(*[F.map_from_entries(F.collect_list(F.struct(key, F.col(c)))).alias(c) for c in cols])
    held.drop("_part", "_object").write.json(path)


def _reject_column_oriented(raw: DataFrame, schema: T.StructType) -> None:
    """A column-oriented object (``{"col": {"0": v, ...}}``) is one record whose
    scalar fields hold objects; looking at the first record is enough."""
    scalar = [f.name for f in schema.fields
              if not isinstance(f.dataType, (T.StringType, T.StructType, T.MapType, T.ArrayType))]
    if not scalar:
        return
    first = raw.select(*scalar).limit(1).collect()
    if first and any(isinstance(v, str) and v.lstrip().startswith("{") for v in first[0]):
        raise ValueError("column-oriented JSON is not a record layout: write JSON lines or an array of records")


def cast_rejects(spark: SparkSession, path: str, schema: T.StructType,
                 fmt: str = "csv") -> DataFrame:
    """One row: per declared field, how many present values were malformed
    (they are loaded as NULL). One scan, one aggregate."""
    read = read_csv_typed if fmt == "csv" else read_json_typed
    rows = read(spark, path, schema, rejects="_rejects")
    return rows.agg(*[F.count_if(F.array_contains("_rejects", f.name)).alias(f.name) for f in schema.fields])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", quote_all: bool = False) -> None:
    """With ``quote_all``, every field in quotes, doubled inside, blanks and line breaks as they are."""
    w = df.write.mode(mode).option("header", True)
    if quote_all:
        w = (w.option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
             .option("ignoreTrailingWhiteSpace", False))
    w.csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)
