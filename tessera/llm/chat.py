"""Chat formatting: tool calls linked to their results, ordered, validated and
written as canonical JSON, with DataFrame functions only.

An event is a row (conversation, turn, role, text, call_id, after_id, name,
arguments). With a call_id, an ``assistant`` row is a call and a ``tool`` row a
result; every other row is a message. ``after_id`` names the call whose result
a call needs.

* Linking: calls and results are hash-joined on (conversation, call_id).
* Topological order: an event's place is the latest turn among itself and all
  it depends on, then its depth, so dependencies always come first and turns
  otherwise keep their order. Both are found by pointer doubling over the
  calls: a chain of n calls takes about log2(n) joins, each checkpointed. The
  place is turned into a gapless ``seq`` by ``common.ranked``, which splits a
  conversation holding a third of all rows over many tasks.
* Validation: arguments are parsed as a variant and checked against the tool's
  fields: (name, type, required), types ``string integer number boolean array
  object``; null counts as absent, a number may be an integer.
* Canonical JSON: keys in byte order, no blanks, absent fields left out;
  numbers in their shortest form.

No conversation is gathered into one row or task; one row per event leaves.

Defined results: rows equal in all these columns count once; a call_id that
several calls share belongs to the first by (turn, text, arguments), the
others are ``duplicate``; so are further results of a call; a result without a
call is ``orphan``; a call without a result is ``unanswered``; an after_id that
names no call of the conversation is the error ``after`` and is ignored; calls
on or behind a dependency cycle are ``cycle`` and are placed by their turn;
NULL turns come first; NULL conversations form one; an empty call_id is one
like any other; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, cut_points, ranked

ROWS_PER_BUCKET = 100_000
COLUMNS = ("conv_id", "turn", "role", "text", "call_id", "after_id", "name", "arguments")
#: Variant type names by schema type.
TYPES = {"string": "^STRING$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DECIMAL\(.*\)|DOUBLE|FLOAT)$",
         "boolean": "^BOOLEAN$", "array": "^ARRAY<", "object": "^OBJECT<"}


def tool_table(spark: SparkSession, tools: dict[str, list[tuple[str, str, bool]]]) -> DataFrame:
    """Tool schemas as a table: name, fields (field, type, required)."""
    return spark.createDataFrame([(k, [tuple(f) for f in v]) for k, v in tools.items()],
                                 "tool string, fields array<struct<field:string,type:string,required:boolean>>")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _errors(given: Column, fields: Column) -> Column:
    """What is wrong with a variant of arguments, in order of field names."""
    kind = F.schema_of_variant(given)
    names = F.map_keys(F.col("given_map"))
    at = lambda f: F.schema_of_variant(F.element_at(F.col("given_map"), f))
    has = lambda f: F.coalesce(F.array_contains(names, f) & (at(f) != "VOID"), F.lit(False))
    fits = lambda f: F.coalesce(F.when(f["type"] == "string", at(f["field"]).rlike(TYPES["string"])).when(
        f["type"] == "integer", at(f["field"]).rlike(TYPES["integer"])).when(
        f["type"] == "number", at(f["field"]).rlike(TYPES["number"])).when(
        f["type"] == "boolean", at(f["field"]).rlike(TYPES["boolean"])).when(
        f["type"] == "array", at(f["field"]).rlike(TYPES["array"])).when(
        f["type"] == "object", at(f["field"]).rlike(TYPES["object"])), F.lit(False))
    missing = F.transform(F.filter(fields, lambda f: f["required"] & ~has(f["field"])), lambda f: F.concat(F.lit("missing:"), f["field"]))
    wrong = F.transform(F.filter(fields, lambda f: has(f["field"]) & ~fits(f)), lambda f: F.concat(F.lit("type:"), f["field"]))
    extra = F.transform(F.filter(names, lambda k: ~F.exists(fields, lambda f: f["field"] == k)), lambda k: F.concat(F.lit("extra:"), k))
    return (F.when(fields.isNull(), F.array(F.lit("unknown tool")))
            .when(given.isNull() | ~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), F.array(F.lit("not an object")))
            .otherwise(F.array_sort(F.concat(missing, wrong, extra))))


def _chains(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, latest, depth, cyclic): for each call the latest turn
    it depends on and its depth, by pointer doubling over ``after``."""
    state = calls.select(F.col("conv_id").alias("c"), F.col("call_id").alias("k"), "after", "weight")
    parents = state.select(F.col("c").alias("pc"), F.col("k").alias("pk"), F.col("weight").alias("pw"))
    state = state.join(parents, _same("c", "pc") & (F.col("after") == F.col("pk")), "left").select(
        "c", "k", F.col("pk").alias("jump"), F.col("pw").alias("latest"),
        F.when(F.col("pk").isNotNull(), 1).otherwise(0).cast("bigint").alias("depth"))
    state = cut_lineage(state)
    rounds = max(1, state.count()).bit_length() + 1
    for _ in range(rounds):
        if state.where("jump IS NOT NULL").isEmpty():
            break
        far = state.select(F.col("c").alias("pc"), F.col("k").alias("pk"), F.col("jump").alias("j2"),
                           F.col("latest").alias("l2"), F.col("depth").alias("d2"))
        state = cut_lineage(state.join(far, _same("c", "pc") & (F.col("jump") == F.col("pk")), "left").select(
            "c", "k", F.col("j2").alias("jump"),
            F.greatest("latest", "l2").alias("latest"), (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth")))
    return state.select(F.col("c").alias("sc"), F.col("k").alias("sk"), "latest", "depth", F.col("jump").isNotNull().alias("cyclic"))


def link_tool_calls(events: DataFrame, tools: DataFrame) -> DataFrame:
    """One row per event: conv_id, seq, turn, kind (call, result, message),
    call_id, status, errors, valid (calls only), json."""
    call = (F.col("role") == "assistant") & F.col("call_id").isNotNull()
    result = (F.col("role") == "tool") & F.col("call_id").isNotNull()
    rows = events.select(*COLUMNS).distinct().withColumn(
        "kind", F.when(call, "call").when(result, "result").otherwise("message"))
    rows = cut_lineage(rows.withColumn("event", F.monotonically_increasing_id()))

    # the first call and the first result of each identifier
    order = F.struct("turn", "text", "arguments", "event")
    heads = rows.where("kind <> 'message'").groupBy("conv_id", "call_id").agg(
        F.min(F.when(F.col("kind") == "call", order)).alias("first_call"),
        F.min(F.when(F.col("kind") == "result", order)).alias("first_result"))
    heads = cut_lineage(heads.select(
        F.col("conv_id").alias("hc"), F.col("call_id").alias("hk"), F.col("first_call.event").alias("call_event"),
        F.col("first_call.turn").alias("call_turn"), F.col("first_result.event").alias("result_event"),
        F.col("first_result.turn").alias("result_turn")))
    linked = rows.join(heads, _same("conv_id", "hc") & (F.col("call_id") == F.col("hk")) & (F.col("kind") != "message"), "left")

    # a call that others depend on is done when its result is in
    first = linked.where("event = call_event").select(
        "conv_id", "call_id", F.col("after_id").alias("after"), F.greatest("turn", "result_turn").alias("weight"))
    chains = _chains(first)
    linked = linked.join(chains, _same("conv_id", "sc") & (F.col("call_id") == F.col("sk")) & (F.col("kind") != "message"), "left")
    known = heads.where("call_event IS NOT NULL").select(F.col("hc").alias("ac"), F.col("hk").alias("ak"))
    linked = linked.join(known, _same("conv_id", "ac") & (F.col("after_id") == F.col("ak")) & (F.col("kind") == "call"), "left")

    linked = linked.join(tools, (F.col("name") == F.col("tool")) & (F.col("kind") == "call"), "left")
    given = F.when(F.col("kind") == "call", F.try_parse_json("arguments"))
    linked = linked.withColumn("given", given).withColumn("given_map", F.expr(
        "CASE WHEN schema_of_variant(given) LIKE 'OBJECT%' THEN CAST(given AS MAP<STRING, VARIANT>) END"))
    main = F.when(F.col("kind") == "call", F.col("event") == F.col("call_event")).otherwise(F.col("event") == F.col("result_event"))
    status = (F.when(F.col("kind") == "message", "message")
              .when((F.col("kind") == "result") & F.col("call_event").isNull(), "orphan")
              .when(~main, "duplicate").when(F.col("cyclic"), "cycle")
              .when(F.col("result_event").isNull(), "unanswered").otherwise("linked"))
    dangling = F.col("after_id").isNotNull() & F.col("ak").isNull()
    errors = F.when(F.col("kind") == "call", F.concat(
        F.when(dangling, F.array(F.lit("after"))).otherwise(F.array().cast("array<string>")),
        _errors(F.col("given"), F.col("fields"))))
    chained = main & ~F.coalesce(F.col("cyclic"), F.lit(False)) & F.col("call_event").isNotNull()
    linked = linked.withColumn("status", status).withColumn("errors", errors).withColumn(
        "place", F.when(chained, F.greatest("turn", "latest", F.when(F.col("kind") == "result", F.col("call_turn"))))
        .otherwise(F.col("turn"))).withColumn(
        "depth", F.when(chained, 2 * F.col("depth") + F.when(F.col("kind") == "result", 1).otherwise(0)).otherwise(0))

    slim = linked.select("conv_id", "place", "depth", "turn", "event", "role", "text", "call_id", "after_id", "name",
                         "kind", "status", "errors", "given", "arguments")
    n = rows.count()
    cuts = cut_points(rows, F.col("turn"), min(4096, max(16, -(-n // ROWS_PER_BUCKET)))) if n else []
    placed = ranked(slim, ["conv_id"], ["place", "depth", "turn", "kind", "call_id", "text", "event"], "place", cuts, "seq")
    return placed.select(
        "conv_id", "seq", "turn", "kind", "call_id", "status", F.array_join("errors", ",").alias("errors"),
        (F.size("errors") == 0).alias("valid"), _json().alias("json"))


def _json() -> Column:
    """Fields in byte order of their names; to_json leaves NULL fields out."""
    return F.to_json(F.struct(
        "after_id", F.col("given").alias("arguments"), "call_id",
        F.when((F.col("kind") == "call") & F.col("given").isNull(), F.col("arguments")).alias("invalid_arguments"),
        "kind", "name", "role", "seq", "status", "text", "turn"))
