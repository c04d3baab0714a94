"""Constraints kept with a table and checked when rows are written to it.

Parquet tables keep no NOT NULL, key or reference. They are stored with the
table instead (a catalog property), and :func:`insert_rows` checks a load
before any of it is written. Only the load and the keys it touches are looked
at: its keys and references are grouped (map-side combine, so a hot key is one
row a task), met with the stored keys and the referenced tables, and all
violations are counted in one aggregate.

Defined results: a key's columns are NOT NULL as well; rows with a NULL in the
key are counted there and not as duplicates; a reference with a NULL in it
refers to nothing and is no violation; an empty load violates nothing.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.strategy import BROADCAST_MAX_ROWS, checkpointed, keys_present, read_once

PROPERTY = "tessera.constraints"


class ConstraintError(ValueError):
    """A load that its table does not allow."""


@dataclass(frozen=True)
class Reference:
    """``columns`` must be found as ``target`` in ``table``."""

    columns: tuple[str, ...]
    table: str
    target: tuple[str, ...]


@dataclass(frozen=True)
class Constraints:
    not_null: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()

    def required(self) -> list[str]:
        return list(dict.fromkeys([*self.not_null, *self.key]))


def of_schema(schema: T.StructType, declared: Constraints | None = None) -> Constraints:
    """The declared constraints and NOT NULL of the schema's non-nullable fields."""
    declared = declared or Constraints()
    named = [*declared.required(), *[c for r in declared.references for c in r.columns]]
    if unknown := [c for c in named if c not in schema.fieldNames()]:
        raise ValueError(f"constraints name unknown columns {unknown}")
    fixed = [f.name for f in schema.fields if not f.nullable]
    return replace(declared, not_null=tuple(dict.fromkeys([*declared.not_null, *fixed])))


def keep(spark: SparkSession, table: str, constraints: Constraints) -> None:
    """Store the constraints with the table."""
    text = json.dumps(asdict(constraints)).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE `{table}` SET TBLPROPERTIES ('{PROPERTY}' = '{text}')")


def kept(spark: SparkSession, table: str) -> Constraints:
    """The constraints stored with the table; none for a table without."""
    rows = spark.sql(f"SHOW TBLPROPERTIES `{table}`").where(F.col("key") == PROPERTY).collect()
    if not rows:
        return Constraints()
    d = json.loads(rows[0]["value"])
    return Constraints(tuple(d["not_null"]), tuple(d["key"]),
                       tuple(Reference(tuple(r["columns"]), r["table"], tuple(r["target"])) for r in d["references"]))


def _present(values: DataFrame, among: DataFrame, columns: Sequence[str], target: Sequence[str]) -> DataFrame:
    """Rows of ``values`` (distinct by ``columns``, computed) found as ``target``
    in ``among``. Few values are broadcast, so the large table is not shuffled."""
    small, values = read_once(values, BROADCAST_MAX_ROWS)
    there = among.select(*[F.col(t).alias(f"_t_{c}") for c, t in zip(columns, target, strict=True)])
    on = [F.col(f"_t_{c}") == F.col(c) for c in columns]
    if not small:
        return values.join(there, on, "left_semi")
    # the small side is built, so it meets the large one from the right; then one row a value again
    met = there.join(F.broadcast(values), on, "inner").select(*values.columns)
    return met.distinct()


def violations(rows: DataFrame, constraints: Constraints, stored: DataFrame | None = None,
               tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``(constraint, n)``, a row for every constraint: the rows of a load with
    a NULL where none may be, with a key that ``stored`` or an earlier row of
    the load has (of equal keys in the load one is no violation), or with a
    reference that the referenced table, given by name in ``tables``, lacks."""
    parts = []
    if required := constraints.required():
        counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(f"not null {c}").alias("constraint"), F.col(c).alias("n")) for c in required]))))
    if key := list(constraints.key):
        each = checkpointed(rows.where(keys_present(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("_n")))
        taken = each.select(*key, (F.col("_n") - 1).alias("n"))
        if stored is not None:
            # the row of the load that would be allowed is not, when the key is stored
            taken = taken.unionByName(_present(each, stored, key, key).select(*key, F.lit(1).alias("n")))
        parts.append(_total(taken, f"key {', '.join(key)}"))
    for r in constraints.references:
        cols = list(r.columns)
        each = checkpointed(rows.where(keys_present(cols)).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")))
        found = _present(each, tables[r.table], cols, r.target)
        missing = each.unionByName(found.select(*cols, (-F.col("n")).alias("n")))
        parts.append(_total(missing, f"reference {', '.join(cols)} to {r.table}"))
    if not parts:
        return rows.sparkSession.createDataFrame([], "constraint string, n long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("constraint").agg(F.sum("n").alias("n"))


def _total(counted: DataFrame, name: str) -> DataFrame:
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit(name).alias("constraint"), "n")


def enforce(rows: DataFrame, constraints: Constraints, stored: DataFrame | None = None,
            tables: Mapping[str, DataFrame] | None = None) -> None:
    """Raise :class:`ConstraintError` naming every violated constraint and its rows."""
    bad = violations(rows, constraints, stored, tables).where("n > 0").orderBy("constraint").collect()
    if bad:
        raise ConstraintError("; ".join(f"{r['constraint']}: {r['n']} rows" for r in bad))


def insert_rows(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Append a load, bound by name, if the table's constraints allow all of it;
    otherwise nothing is written and :class:`ConstraintError` is raised.

    The load is computed once, so the checked rows are the written ones. A
    table may refer to itself, also to rows of the same load. Loads of one
    table follow each other: two at a time do not see each other's keys."""
    stored = spark.table(table)
    if missing := sorted(set(stored.columns) ^ set(rows.columns)):
        raise ValueError(f"load of {table}: columns differ: {missing}")
    load = checkpointed(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored.schema.fields]))
    rules = kept(spark, table)
    others = {r.table: spark.table(r.table) for r in rules.references}
    if table in others:
        others[table] = stored.unionByName(load)
    enforce(load, rules, stored, others)
    load.write.insertInto(table)
