"""Tool calls of conversations linked to their results, ordered, validated and serialised.

Calls and results are linked by a hash join on (conversation, call id).  A call may name the
call it follows; the steps of the calls are their depths in that forest, found by
pointer doubling, so a chain of n calls takes about log2(n) joins and no conversation
is ever gathered in one task.  A call has step 2 * depth, its result 2 * depth + 1, so every
call comes after its parent and every result after its call.  Arguments are validated
against the schema of the called tool, and each link is serialised as canonical JSON
(sorted keys, no spaces, integral floats as integers, no NaN).

A schema is a subset of JSON Schema: ``type`` (or a list of types), ``properties``,
``required``, ``additionalProperties: false``, ``enum``, ``minLength``, ``maxLength``,
``minimum``, ``maximum``, ``items``.

Defined results: of a call id given more than once in a conversation the least call (arguments by text) and
the least result stand in its row, and every other one in a row of its own with step -1, all with status
``duplicate``, so no row is lost.  Otherwise the status is
``cyclic`` (it follows itself, or a call that does; step -1), ``orphan`` (a result without a call;
step -1), ``invalid`` (unknown tool, arguments that aren't a JSON object or fail the schema),
``unanswered`` (no result) or ``linked``.  A parent that doesn't exist counts as none.  Null
conversations are one conversation; rows without a call id are left out, as nothing can be
linked by them.  Repeated rows count as duplicates; empty tables give an empty result.

Plain conversations may hold turns that are neither call nor result (system prompts, other roles).  They
stand as ``context`` in the record of the call one turn later; without such a call or result they are a row
of their own with status ``context`` and step -1, as is every turn without a number.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, slices

_TYPES = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}


def _is(value, kind: str) -> bool:
    if kind in ("number", "integer"):
        return isinstance(value, (int, float)) and not isinstance(value, bool) and (kind == "number" or float(value).is_integer())
    return isinstance(value, _TYPES[kind])


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """What in ``value`` fails ``schema``, as ``place: rule``."""
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: type"]
    out = [f"{at}: enum"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, str):
        out += [f"{at}: minLength"] if len(value) < schema.get("minLength", 0) else []
        out += [f"{at}: maxLength"] if len(value) > schema.get("maxLength", math.inf) else []
    elif _is(value, "number"):
        out += [f"{at}: minimum"] if value < schema.get("minimum", -math.inf) else []
        out += [f"{at}: maximum"] if value > schema.get("maximum", math.inf) else []
    elif isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: required" for k in schema.get("required", ()) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: unknown" for k in sorted(set(value) - set(known))]
        for k in sorted(set(value) & set(known)):
            out += violations(value[k], known[k], f"{at}.{k}")
    elif isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += violations(x, schema["items"], f"{at}[{i}]")
    return out


def _plain(value):
    if isinstance(value, float) and value.is_integer() and abs(value) < 1 << 53:
        return int(value)
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def canonical(value) -> str:
    return json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def parsed(arguments: str | None):
    """The JSON value, and whether it could be read: numbers beyond a double's range and strings that aren't
    Unicode text count as no JSON."""
    def refuse(x: str):
        raise ValueError(x)

    def real(x: str) -> float:
        return float(x) if math.isfinite(float(x)) else refuse(x)

    def whole(x: str) -> int:
        return int(x) if math.isfinite(float(x)) else refuse(x)

    try:
        value = json.loads(arguments, parse_constant=refuse, parse_float=real, parse_int=whole)
        if "\\u" in arguments:      # half a surrogate pair is no text
            json.dumps(value, ensure_ascii=False).encode()
        return value, True
    except (TypeError, ValueError, RecursionError):
        return None, False


def _surplus(rows: DataFrame, least: DataFrame) -> DataFrame:
    """The rows other than the least of each id, each with a key of its own."""
    return rows.join(least.select("_row"), "_row", "left_anti").withColumn("key", F.concat(F.lit("+"), "_row"))


def _key(group: str, call_id: Column) -> Column:
    """One string for (conversation, call id), null conversation included."""
    return F.to_json(F.struct(F.col(group).alias("g"), call_id.cast("string").alias("i")))


def steps(calls: DataFrame) -> DataFrame:
    """key, depth of (key, parent): links to the root by pointer doubling; -1 on or after a cycle."""
    own = calls.select("key", "parent")
    known = own.select(F.col("key").alias("p"))
    now = cut(own.join(known, own["parent"] == known["p"], "left").select("key", F.col("p").alias("up"), F.col("p").isNotNull().cast("long").alias("depth")))
    for _ in range(max(1, now.count()).bit_length() + 1):      # longer than any path: what is open then is on a cycle
        if now.where("up is not null").isEmpty():
            break
        above = now.select(F.col("key").alias("k"), F.col("up").alias("u"), F.col("depth").alias("d"))
        now = cut(now.join(above, now["up"] == above["k"], "left")
                  .select("key", F.col("u").alias("up"), (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth")))
    return now.select("key", F.when(F.col("up").isNull(), F.col("depth")).otherwise(F.lit(-1)).alias("depth"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], group: str = "conv_id", context: DataFrame | None = None) -> DataFrame:
    """One row for each call id of a conversation: ``group``, call_id, step, status, problems, json.

    ``calls``: group, call_id, parent_id, name, arguments (JSON text); ``results``: group, call_id, content;
    ``context``: group, call_id, turn, role, text of turns to be told with a call, or on their own if call_id is null.
    """
    kind = calls.schema[group].dataType.simpleString()
    all_calls = cut(calls.where("call_id is not null").select(group, F.col("call_id").cast("string").alias("call_id"), F.col("parent_id").cast("string").alias("parent_id"),
                                                              "name", "arguments", _key(group, F.col("call_id")).alias("key"), F.monotonically_increasing_id().alias("_row")))
    call = F.struct(F.coalesce("arguments", F.lit("")).alias("a"), "name", "parent_id", "arguments", "_row")
    made = all_calls.groupBy("key").agg(F.min(group).alias("g"), F.min("call_id").alias("call_id"), F.min(call).alias("call"), F.count("*").alias("n_calls"))
    made = cut(made.select("key", F.col("g").alias(group), "call_id", "n_calls", F.col("call.name").alias("name"), F.col("call.arguments").alias("arguments"), F.col("call._row").alias("_row"),
                           F.when(F.col("call.parent_id").isNotNull(), F.to_json(F.struct(F.col("g").alias("g"), F.col("call.parent_id").alias("i")))).alias("parent")))
    all_results = cut(results.where("call_id is not null").select(group, F.col("call_id").cast("string").alias("call_id"), "content", _key(group, F.col("call_id")).alias("key"),
                                                                  F.monotonically_increasing_id().alias("_row")))
    # null contents come last, as everywhere a least value is taken
    result = F.struct(F.col("content").isNull().alias("z"), "content", "_row")
    given = (all_results.groupBy("key").agg(F.min(group).alias("r_g"), F.min("call_id").alias("r_id"), F.min(result).alias("r"), F.count("*").alias("n_results"))
             .select("key", "r_g", "r_id", F.col("r.content").alias("content"), "n_results", F.col("r._row").alias("_row")))
    more_calls = _surplus(all_calls, made).select("key", F.col(group).alias("c_g"), F.col("call_id").alias("c_id"), "name", "arguments", F.lit(2).cast("long").alias("n_calls"))
    more_results = _surplus(all_results, given).select("key", F.col(group).alias("c_g"), F.col("call_id").alias("c_id"), "content",
                                                       F.lit(2).cast("long").alias("n_results"))
    made, given = made.drop("_row"), given.drop("_row")
    told = F.struct("role", "text", "turn")
    if context is None:
        context = calls.sparkSession.createDataFrame([], f"{group} {kind}, call_id string, turn long, role string, text string")
    by_call = (context.where("call_id is not null").withColumn("key", _key(group, F.col("call_id"))).groupBy("key")
               .agg(F.min(group).alias("c_g"), F.min(F.col("call_id").cast("string")).alias("c_id"), F.array_sort(F.collect_list(told)).alias("context")))
    # no key of a call begins like these, so each is a row of its own
    alone = context.where("call_id is null").select(F.concat(F.lit("-"), F.monotonically_increasing_id()).alias("key"), F.col(group).alias("c_g"),
                                                    F.lit(None).cast("string").alias("c_id"), F.array(told).alias("context"))
    linked = made.join(steps(made), "key").join(given, "key", "full").join(by_call.union(alone), "key", "full").select(
        F.coalesce(group, "r_g", "c_g").alias(group), F.coalesce("call_id", "r_id", "c_id").alias("call_id"), "n_calls", "n_results",
        F.coalesce(F.when(F.col("depth") >= 0, 2 * F.col("depth")), F.lit(-1)).alias("step"), "name", "arguments", "content", "context")
    own = more_calls.unionByName(more_results, allowMissingColumns=True).drop("key").withColumnsRenamed({"c_g": group, "c_id": "call_id"})
    joined = linked.unionByName(own.withColumn("step", F.lit(-1).cast("long")), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            out: list[list] = [[], [], []]
            for _, call_id, n_calls, n_results, step, name, arguments, content, said in zip(*(c.to_pylist() for c in batch.columns)):
                value, fine = parsed(arguments)
                problems: list[str] = []
                if n_calls:
                    problems = (["name: unknown"] if name not in schemas else ["arguments: no JSON"] if not fine
                                else violations(value, {"type": "object"} | schemas[name]))
                status = ("context" if not n_calls and not n_results else "duplicate" if max(n_calls or 0, n_results or 0) > 1
                          else "orphan" if not n_calls else "cyclic" if step < 0 else "invalid" if problems
                          else "unanswered" if not n_results else "linked")
                record = {"id": call_id}
                if n_calls:
                    record["call"] = {"name": name, "arguments": value if fine else arguments}
                if n_results:
                    record["result"] = {"content": content}
                if said:
                    record["context"] = said
                for column, x in zip(out, (status, problems, canonical(record))):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(4), pa.array(out[0], pa.string()), pa.array(out[1], pa.list_(pa.string())),
                 pa.array(out[2], pa.string())], [group, "call_id", "step", "status", "problems", "json"])

    return joined.mapInArrow(run, f"{group} {kind}, call_id string, step long, status string, problems array<string>, json string")


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations: each user turn calls the tool ``reply``, and each assistant
    turn is the result of the turn before it.

    A call's id is its turn; it follows the call two turns earlier, or one if that is what there is.  All
    by the turn number, so a conversation of any length needs no window.
    """
    said = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    user = said.where("role = 'user' and turn is not null")
    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), F.col("turn").alias("turn")))
    marks = user.select(F.col("conv_id").alias("c"), F.col("turn").alias("t")).distinct()
    calls = user.select("conv_id", F.col("turn").alias("call_id"), F.explode(F.array(F.col("turn") - 1, F.col("turn") - 2)).alias("p"), arguments.alias("arguments"))
    found = calls.join(marks, calls["conv_id"].eqNullSafe(marks["c"]) & (calls["p"] == marks["t"]), "left")
    parents = found.groupBy("conv_id", "call_id", "arguments").agg(F.max("t").alias("parent_id"), (F.count("*") / 2).cast("long").alias("n"))
    calls = parents.select("conv_id", "call_id", "parent_id", F.lit("reply").alias("name"), "arguments", F.explode(F.sequence(F.lit(1), "n")).alias("one")).drop("one")
    results = said.where("role = 'assistant' and turn is not null").select("conv_id", (F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def other_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, call_id, turn, role, text of the rows that ``turns_as_calls`` has no place for: other roles, told
    with the call one turn later, and all rows without a turn number."""
    said = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return (said.where("turn is null or role is null or role not in ('user', 'assistant')")
            .select("conv_id", (F.col("turn") + 1).alias("call_id"), "turn", "role", "text"))


#: The schema of the tool in plain conversations.
REPLY = {"reply": {"type": "object", "required": ["prompt", "turn"], "additionalProperties": False,
                   "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}}}
