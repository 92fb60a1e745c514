"""Chat formatting: linking tool calls and results, ordering, validating, canonical JSON."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shared_folder, written

# Tool → argument → (type, whether it must be there). Types as in JSON Schema.
Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]
TYPES = {
    "string": "^STRING$",
    "integer": "^BIGINT$",
    "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
    "object": "^OBJECT<",
    "array": "^ARRAY<",
}
# Arguments may name the result of another call so.
REFERENCE = r'"\$result:([^"\\]+)"'
SEP = "; "


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with the arguments (JSON text) of a call, joined by semicolons; empty if
    nothing is. Field errors follow in the order of the names."""
    parsed = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT<"), F.lit(False))

    def of_tool(fields: Mapping[str, tuple[str, bool]]) -> Column:
        found: list[Column] = []
        for field, (kind, needed) in sorted(fields.items()):
            path = F.try_variant_get(parsed, F.lit(f"$['{field}']"), "variant")
            value = F.schema_of_variant(path)
            absent = F.lit(f"{field} is missing") if needed else F.lit(None)
            found.append(F.when(value.isNull(), absent).when(~value.rlike(TYPES[kind]), F.lit(f"{field} is not {kind}")))
        known = F.array(*(F.lit(f) for f in sorted(fields))) if fields else F.array().cast("array<string>")
        other = F.transform(F.array_sort(F.array_except(F.json_object_keys(arguments), known)), lambda f: F.concat(f, F.lit(" is unknown")))
        return F.concat_ws(SEP, *found, other)

    verdict = F.when(parsed.isNull() | ~is_object, F.lit("arguments are not a JSON object"))
    for tool, fields in sorted(schemas.items()):
        verdict = verdict.when(name == tool, of_tool(fields))
    return verdict.otherwise(F.lit("tool is unknown"))


def canonical(arguments: Column) -> Column:
    """JSON text with sorted keys and no blanks; what does not parse stays as it is, quoted."""
    return F.coalesce(F.to_json(F.try_parse_json(arguments)), _quoted(arguments), F.lit("null"))


def _quoted(text: Column) -> Column:
    """A JSON string; null for null. An array holds it, as the writer takes no bare string."""
    written_array = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(written_array, F.lit(2), F.length(written_array) - 2))


def _object(**fields: Column) -> Column:
    """Canonical JSON of an object, from JSON texts by field name; null fields are left out."""
    parts = [F.concat(F.lit(f'"{name}":'), fields[name]) for name in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def call_depths(calls: DataFrame) -> DataFrame:
    """Rows ``chat``, ``call_id``, ``place``, ``depth`` of the calls that can be ordered, from
    rows ``chat``, ``call_id``, ``turn``, ``needs`` (ids of calls).

    A call comes after all it needs: its ``place`` is the latest turn among them and itself,
    its ``depth`` one more than theirs. What it needs outside the table does not count. Calls
    in a cycle of needs, or behind one, are missing from the result. Each round settles the
    calls whose needs are all settled, as a table in the shared folder, so there are as many
    rounds as the longest chain has calls; a round reads only the needs that are left.
    """
    spark, folder = calls.sparkSession, shared_folder(calls.sparkSession)
    own = calls.select("chat", "call_id", "turn")
    needs = calls.select("chat", "call_id", F.explode(F.array_distinct("needs")).alias("need"))
    known = own.select("chat", F.col("call_id").alias("need"))
    left = written(needs.join(known, ["chat", "need"]), f"{folder}/needs-0")
    waiting = left.select("chat", "call_id").distinct()
    start = own.join(waiting, ["chat", "call_id"], "left_anti")
    settled = written(start.select("chat", "call_id", F.col("turn").alias("place"), F.lit(0).alias("depth")), f"{folder}/depth-0")
    parts, round_number = [settled], 0
    while not left.isEmpty():
        round_number += 1
        before = reduce(DataFrame.union, parts)
        met = left.join(before.withColumnRenamed("call_id", "need"), ["chat", "need"], "left")
        ready = (
            met.groupBy("chat", "call_id")
            .agg(F.max("place").alias("latest"), F.max("depth").alias("deepest"), F.count("depth").alias("met"), F.count(F.lit(1)).alias("all"))
            .where("met = all")
            .join(own, ["chat", "call_id"])
            .select("chat", "call_id", F.greatest("latest", "turn").alias("place"), (F.col("deepest") + 1).alias("depth"))
        )
        settled = written(ready, f"{folder}/depth-{round_number}")
        if settled.isEmpty():
            break
        parts.append(settled)
        left = written(left.join(settled, ["chat", "call_id"], "left_anti"), f"{folder}/needs-{round_number}")
    return reduce(DataFrame.union, parts)


def format_chats(messages: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per step: each message, each tool call, each tool result.

    ``messages`` has ``conv_id``, ``turn``, ``role``, ``text``, ``tool_calls`` (array of
    structs ``id``, ``name``, ``arguments``) and ``tool_call_id`` (of a result). The rows have
    ``conv_id``, ``turn``, ``kind``, ``call_id``, ``status``, ``errors``, ``json``, and the
    sort key of the conversation: ``place``, ``depth``, ``part``, ``turn``, ``number``.

    Calls and results meet by conversation and id, with one row per id on either side, so an
    id that repeats never multiplies: the first call and the first result of an id are linked,
    later ones have status ``repeated``. Other statuses: ``message``, ``linked``, ``no
    result``, ``no call``, ``cycle`` (ordered by its own turn). A result stands right behind
    its call, a call behind all whose results its arguments name. Null conversations and null
    ids are one of their own each; null turns come first; a null text has no content; repeated
    rows are repeated steps. An empty table gives an empty one. Further columns are not read.

    No conversation is gathered anywhere: the result is dealt and sorted by the sort key.
    """
    rows = messages.select(
        "conv_id",
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("chat"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(-1)).alias("turn_at"),
        "turn",
        "role",
        "text",
        "tool_calls",
        "tool_call_id",
    )
    calls = written(
        rows.select("conv_id", "chat", "turn_at", "turn", F.posexplode("tool_calls").alias("number", "call"))
        .select("conv_id", "chat", "turn_at", "turn", "number", F.coalesce("call.id", F.lit("")).alias("call_id"), "call.name", "call.arguments")
    )
    results = rows.where("tool_call_id is not null").withColumn("call_id", F.col("tool_call_id"))
    first_call = calls.groupBy("chat", "call_id").agg(F.min(F.struct("turn_at", "number", "name", "arguments")).alias("call"))
    one_call = first_call.select(
        "chat",
        "call_id",
        F.col("call.turn_at").alias("turn"),
        F.regexp_extract_all(F.col("call.arguments"), F.lit(REFERENCE)).alias("needs"),
    )
    depths = call_depths(one_call.withColumn("needs", F.coalesce("needs", F.array().cast("array<string>"))))
    first_result = results.groupBy("chat", "call_id").agg(F.min(F.struct("turn_at", F.xxhash64("role", "text").alias("content"))).alias("result"))
    # Written, so that Spark can split the steps of an id that very many have.
    known = written(
        first_call.join(depths, ["chat", "call_id"], "left")
        .join(first_result, ["chat", "call_id"], "full_outer")
        .select("chat", "call_id", "call", "result", "place", "depth")
    )
    step = ["conv_id", "turn", "kind", "call_id", "status", "errors", "json", "place", "depth", "part", "number"]
    place, depth = F.coalesce("place", "turn_at").alias("place"), F.coalesce("depth", F.lit(0)).alias("depth")
    none = F.lit(None).cast("string")
    plain = rows.where("tool_call_id is null").select(
        "conv_id",
        "turn",
        F.lit("message").alias("kind"),
        none.alias("call_id"),
        F.lit("message").alias("status"),
        F.lit("").alias("errors"),
        _object(role=_quoted(F.col("role")), content=_quoted(F.col("text"))).alias("json"),
        F.col("turn_at").alias("place"),
        F.lit(0).alias("depth"),
        F.lit(0).alias("part"),
        F.lit(0).alias("number"),
    )
    is_first = F.struct("turn_at", "number", "name", "arguments") == F.col("call")
    made = calls.join(known, ["chat", "call_id"]).select(
        "conv_id",
        "turn",
        F.lit("call").alias("kind"),
        "call_id",
        F.when(~is_first, "repeated").when(F.col("depth").isNull(), "cycle").when(F.col("result").isNull(), "no result").otherwise("linked").alias("status"),
        argument_errors(F.col("name"), F.col("arguments"), schemas).alias("errors"),
        _object(id=_quoted(F.col("call_id")), name=_quoted(F.col("name")), arguments=canonical(F.col("arguments"))).alias("json"),
        place,
        depth,
        F.lit(1).alias("part"),
        F.col("number"),
    )
    is_linked = F.struct("turn_at", F.xxhash64("role", "text").alias("content")) == F.col("result")
    got = results.join(known, ["chat", "call_id"]).select(
        "conv_id",
        "turn",
        F.lit("result").alias("kind"),
        "call_id",
        F.when(F.col("call").isNull(), "no call").when(~is_linked, "repeated").otherwise("linked").alias("status"),
        F.lit("").alias("errors"),
        _object(id=_quoted(F.col("call_id")), role=_quoted(F.col("role")), content=_quoted(F.col("text"))).alias("json"),
        place,
        depth,
        F.lit(1).alias("part"),
        F.coalesce("call.number", F.lit(0)).alias("number"),
    )
    return plain.select(*step).union(made.select(*step)).union(got.select(*step))


def in_order(steps: DataFrame) -> DataFrame:
    """Steps dealt by ranges of conversation and place and sorted within them."""
    key = ["conv_id", "place", "depth", "part", "number", "call_id", "kind", "turn", "json"]
    return steps.repartitionByRange("conv_id", "place", "depth").sortWithinPartitions(*key)


# How turns of the given conversations become tool calls: a system or user turn calls a tool,
# the answer right after a user turn is its result, and questions need the system turn.
TURN_SCHEMAS: Schemas = {
    "configure": {"prompt": ("string", True), "turn": ("integer", True)},
    "reply": {"prompt": ("string", True), "turn": ("integer", True), "system": ("string", False)},
}


def turns_as_calls(conversations: DataFrame) -> DataFrame:
    """Messages with tool calls, from plain turns (conv_id, turn, role, text)."""
    name = F.when(F.col("role") == "system", "configure").when(F.col("role") == "user", "reply")
    call_id = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit(":"), turn.cast("string"))
    # A question at an odd turn follows a system turn.
    needs = F.when((F.col("role") == "user") & (F.col("turn") % 2 == 1), F.concat(F.lit("$result:"), call_id(F.lit(0))))
    arguments = F.to_json(F.struct(F.col("turn"), F.col("text").alias("prompt"), needs.alias("system")))
    call = F.struct(call_id(F.col("turn")).alias("id"), name.alias("name"), arguments.alias("arguments"))
    return conversations.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.when(name.isNotNull(), F.array(call)).alias("tool_calls"),
        F.when(F.col("role") == "assistant", call_id(F.col("turn") - 1)).alias("tool_call_id"),
    )
