"""Column expressions used by the reports and feature operators.

All are built-in Spark expressions (code-generated, no Python per row).
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The depression bands of the reference report (inclusive integer
# bounds, labels as the reference prints them, and its default label).
BDI_BANDS = [
    (0, 13, "Мінімальная / Норма"),
    (14, 19, "Лёгкая дэпрэсія"),
    (20, 28, "Умераная дэпрэсія"),
    (29, 63, "Цяжкая дэпрэсія"),
]
BDI_UNKNOWN = "Невядома"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL. Spark keeps NaN distinct from NULL and lets it win
    comparisons, max and averages; the reference treats both as missing."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def is_missing(c: str | Column, floating: bool) -> Column:
    c = col_(c)
    return (c.isNull() | F.isnan(c)) if floating else c.isNull()


def band(value: str | Column, bands: Sequence[tuple], default: str) -> Column:
    """``CASE WHEN v BETWEEN lo AND hi THEN label ... ELSE default END``.

    Bounds are inclusive; a value between two bands (13.5 for integer
    bands) and NULL fall to ``default``.
    """
    v = col_(value)
    expr = None
    for lo, hi, label in bands:
        cond = v.between(F.lit(lo), F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def band_position(value: str | Column, bands: Sequence[tuple]) -> Column:
    """1-based index of the band holding ``value``; NULL when none does."""
    v = col_(value)
    expr = None
    for i, (lo, hi, _label) in enumerate(bands, start=1):
        cond = v.between(F.lit(lo), F.lit(hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr if expr is not None else F.lit(None).cast("int")


def row_sum(cols: Sequence[str | Column], missing_as=0) -> Column:
    """Sum across columns with missing as ``missing_as`` (COALESCE per term)."""
    return reduce(add, [F.coalesce(col_(c), F.lit(missing_as)) for c in cols])


def answered_count(cols: Sequence[str | Column]) -> Column:
    """How many of the columns are non-NULL in the row."""
    return reduce(add, [col_(c).isNotNull().cast("int") for c in cols])


def strip_lower(c: str | Column) -> Column:
    """``str(x).lower().strip()``: Spark ``trim`` removes spaces only, so tabs
    and newlines are stripped with a whitespace regex."""
    return F.regexp_replace(F.lower(col_(c).cast("string")), r"^\s+|\s+$", "")


def value_map(c: str | Column, mapping: Mapping, keep_unmapped: bool = True) -> Column:
    """``Series.replace(mapping)``: mapped values replaced, others kept."""
    c = col_(c)
    expr = None
    for k, v in mapping.items():
        cond = c == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    if expr is None:
        return c
    return expr.otherwise(c if keep_unmapped else F.lit(None))


def decode_codes(code: str | Column, labels: Sequence[str]) -> Column:
    """Integer code -> label (``Categorical.from_codes``). A code outside
    ``0..len(labels)-1`` raises under ANSI, as it does in pandas."""
    arr = F.array(*[F.lit(x) for x in labels])
    return F.element_at(arr, col_(code).cast("int") + F.lit(1))


def percent(num: str | Column, den: str | Column) -> Column:
    """``100 * num / den``, 0 when ``den`` is 0 (empty input)."""
    return F.coalesce(F.try_divide(F.lit(100.0) * col_(num), col_(den)), F.lit(0.0))


def rounded(c: str | Column, digits: int = 6) -> Column:
    """Round and clear a negative zero, so results hash identically across engines."""
    return F.round(col_(c).cast("double"), digits) + F.lit(0.0)


def md5_rank_key(key: str | Column, seed: int | str) -> Column:
    """Deterministic pseudo-random ordering key: ``md5('<seed>:' || key)``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col_(key).cast("string")))
