"""Chat formatting with tool calls: linked by identifier, ordered by dependence, validated, and written as canonical JSON.

Calls and results are rows of their own and meet in a hash join on conversation
and call id; no conversation is gathered anywhere, so one with a third of all
turns is spread like any other. Order is a pair of numbers per row, not a place
in a list: rows of a conversation sorted by them stand in topological order.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged

MESSAGES = (
    "conv_id bigint, turn bigint, role string, text string, "
    "tool_calls array<struct<id:string,name:string,arguments:string,after:array<string>>>, tool_call_id string"
)


class Invalid(ValueError):
    """Arguments do not fit their schema."""


def _kind(value: Any) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "integer" if isinstance(value, int) or value.is_integer() else "number"
    return {str: "string", list: "array", dict: "object"}[type(value)]


def validate(value: Any, schema: dict, place: str = "$") -> None:
    """Raises Invalid at the first keyword that fails; keywords as JSON Schema has them."""
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        kind = _kind(value)
        if kind not in kinds and not (kind == "integer" and "number" in kinds):
            raise Invalid(f"{place}: {kind} instead of {' or '.join(kinds)}")
    if "enum" in schema and canonical(value) not in [canonical(v) for v in schema["enum"]]:
        raise Invalid(f"{place}: not one of the values")
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        raise Invalid(f"{place}: not the value")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            raise Invalid(f"{place}: too short")
        if len(value) > schema.get("maxLength", len(value)):
            raise Invalid(f"{place}: too long")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            raise Invalid(f"{place}: does not match")
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            raise Invalid(f"{place}: out of range")
    elif isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            raise Invalid(f"{place}: wrong number of items")
        for i, item in enumerate(value):
            validate(item, schema.get("items", {}), f"{place}[{i}]")
    elif isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", []):
            if name not in value:
                raise Invalid(f"{place}: {name} is missing")
        for name in sorted(value):
            inner = known.get(name, schema.get("additionalProperties", {}))
            if inner is False:
                raise Invalid(f"{place}: {name} is not known")
            validate(value[name], inner if isinstance(inner, dict) else {}, f"{place}.{name}")


def canonical(value: Any) -> str:
    """JSON without blanks, keys ordered by UTF-16 units, whole floats as integers."""
    if isinstance(value, dict):
        items = sorted(value.items(), key=lambda kv: kv[0].encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(v)}" for k, v in items) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float) and value.is_integer() and abs(value) < 1e21:
        return str(int(value))
    return json.dumps(value, ensure_ascii=False, allow_nan=False)


def read_json(text: str | None) -> Any:
    def no(name: str):
        raise Invalid(f"$: {name} is no JSON")

    try:
        return json.loads(text or "", parse_constant=no)
    except (json.JSONDecodeError, RecursionError) as wrong:
        raise Invalid("$: no JSON") from wrong


def _serialiser(schemas: dict[str, dict]):
    """Adds problem and json to rows (conv_id, position, step, turn, role, text, call_id, name, arguments, status)."""

    def line(row: dict) -> tuple[str, str]:
        status = row["status"]
        out: dict[str, Any] = {"role": row["role"]}
        if row["name"] is not None or row["role"] == "tool_call":
            arguments: Any = row["arguments"]
            try:
                arguments = read_json(arguments)
                if row["name"] not in schemas:
                    raise Invalid("$: no such tool")
                validate(arguments, schemas[row["name"]])
            except Invalid as wrong:
                status = f"invalid arguments: {wrong}" if status == "ok" else status
            out["tool_calls"] = [{"id": row["call_id"], "name": row["name"], "arguments": arguments}]
            out["role"] = "assistant"
        else:
            out["content"] = row["text"] or ""
            if row["call_id"] is not None:
                out["tool_call_id"] = row["call_id"]
        return status, canonical(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["conv_id", "position", "step", "turn", "role", "call_id"]
        for batch in batches:
            told = [line(row) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k) for k in keys],
                    pa.array([s for s, _ in told], pa.string()),
                    pa.array([j for _, j in told], pa.string()),
                ],
                names=[*keys, "status", "json"],
            )

    return run


def _placed_calls(calls: DataFrame, results: DataFrame) -> DataFrame:
    """conv_id, call_id, position, step of calls whose every dependence is placed.

    Calls without any come first; each round places those whose last open
    dependence was placed, so there are as many rounds as the longest chain of
    calls that wait for results. Calls in a cycle are never placed.
    """
    place = F.struct("position", "step")
    placed = staged(
        calls.where(F.size("after") == 0).select(
            "conv_id", "call_id", F.col("turn").alias("position"), F.lit(0).cast("long").alias("step")
        ),
        "placed",
    )
    waiting = calls.where(F.size("after") > 0).select("conv_id", "call_id", "turn", "after")
    needs = staged(
        waiting.select("conv_id", "call_id", "turn", F.size("after").alias("n"), F.explode("after").alias("needed")), "needs"
    )
    if needs.isEmpty():
        return placed
    # A result is there from its turn on, and not before its call.
    answers = results.groupBy("conv_id", "call_id").agg(F.min("turn").alias("answered"))
    while True:
        ready = placed.join(answers, ["conv_id", "call_id"]).select(
            "conv_id",
            F.col("call_id").alias("needed"),
            F.greatest("position", "answered").alias("position"),
            F.when(F.col("answered") > F.col("position"), 0).otherwise(F.col("step") + 1).cast("long").alias("step"),
        )
        done = (
            needs.join(ready, ["conv_id", "needed"])
            .groupBy("conv_id", "call_id")
            .agg(F.count("*").alias("m"), F.max("n").alias("n"), F.max("turn").alias("turn"), F.max(place).alias("last"))
            .where("m = n")
            .select(
                "conv_id",
                "call_id",
                F.greatest("turn", "last.position").alias("position"),
                F.when(F.col("turn") > F.col("last.position"), 0).otherwise(F.col("last.step") + 1).cast("long").alias("step"),
            )
        )
        new = staged(done.join(placed, ["conv_id", "call_id"], "left_anti"), "placed")
        if new.isEmpty():
            return placed
        placed = staged(placed.unionByName(new), "placed")


def linked(messages: DataFrame) -> DataFrame:
    """Messages, calls and results as rows with position, step, status, in topological order within a conversation.

    Sorted by (position, step, turn) a result stands after its call, and a call
    after the results it waits for, whatever turns they were logged in. The text
    of a message with calls is a row of its own, with step -1: it stands before
    them. Status
    is ok, or unanswered call, unknown call (a result without one), repeated
    call id (the first by turn, name and arguments is the call), unresolved
    (a call that waits for what never comes). NULL conversations or ids link to
    nothing. A call's ``after`` names calls whose results it needs.
    """
    plain = ["conv_id", "turn", "role", "text"]
    empty = F.array().cast("array<string>")
    raw = messages.where(F.size("tool_calls") > 0).select(
        "conv_id", "turn", F.explode("tool_calls").alias("call")
    ).select(
        "conv_id",
        "turn",
        F.col("call.id").alias("call_id"),
        F.col("call.name").alias("name"),
        F.col("call.arguments").alias("arguments"),
        F.array_distinct(F.coalesce("call.after", empty)).alias("after"),
    )
    firsts = (
        raw.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
        .groupBy("conv_id", "call_id")
        .agg(F.min(F.struct("turn", "name", "arguments", "after")).alias("call"), F.count("*").alias("n"))
        .select("conv_id", "call_id", "call.*", "n")
    )
    results = messages.where("role = 'tool'").select(*plain, F.col("tool_call_id").alias("call_id"))
    placed = _placed_calls(firsts, results)
    answered = results.select("conv_id", "call_id").distinct().withColumn("answered", F.lit(True))
    calls = (
        firsts.join(placed, ["conv_id", "call_id"], "left")
        .join(answered.hint("shuffle_hash"), ["conv_id", "call_id"], "left")
        .select(
            "conv_id",
            F.coalesce("position", "turn").alias("position"),
            F.coalesce("step", F.lit(0)).cast("long").alias("step"),
            "turn",
            F.lit("tool_call").alias("role"),
            F.lit(None).cast("string").alias("text"),
            "call_id",
            "name",
            "arguments",
            F.when(F.col("position").isNull(), "unresolved")
            .when(F.col("answered").isNull(), "unanswered call")
            .otherwise("ok")
            .alias("status"),
        )
    )
    lost = raw.where("conv_id IS NULL OR call_id IS NULL").withColumn("state", F.lit("call without an id"))
    again = (
        raw.join(firsts.where("n > 1").select("conv_id", "call_id", F.struct("turn", "name", "arguments", "after").alias("kept")), ["conv_id", "call_id"])
        .where(~F.struct("turn", "name", "arguments", "after").eqNullSafe(F.col("kept")))
        .drop("kept")
        .withColumn("state", F.lit("repeated call id"))
    )
    others = lost.unionByName(again).select(
        "conv_id",
        F.col("turn").alias("position"),
        F.lit(0).cast("long").alias("step"),
        "turn",
        F.lit("tool_call").alias("role"),
        F.lit(None).cast("string").alias("text"),
        "call_id",
        "name",
        "arguments",
        F.col("state").alias("status"),
    )
    found = calls.select("conv_id", "call_id", F.col("position").alias("called"), F.col("step").alias("call_step"))
    # Calls are one row per id, so the hashed side of a partition is small however hot a conversation is.
    answers = results.join(found.hint("shuffle_hash"), ["conv_id", "call_id"], "left").select(
        "conv_id",
        F.coalesce(F.greatest("turn", "called"), "turn").alias("position"),
        F.when(F.col("called") >= F.col("turn"), F.col("call_step") + 1).otherwise(0).cast("long").alias("step"),
        "turn",
        "role",
        "text",
        "call_id",
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"),
        F.when(F.col("called").isNull(), "unknown call").otherwise("ok").alias("status"),
    )
    calling = F.coalesce(F.size("tool_calls"), F.lit(0)) > 0
    rest = messages.where("role IS NULL OR role <> 'tool'").where(
        ~calling | (F.coalesce("text", F.lit("")) != "")
    ).select(
        "conv_id",
        F.col("turn").alias("position"),
        F.when(calling, -1).otherwise(0).cast("long").alias("step"),
        "turn",
        "role",
        "text",
        F.lit(None).cast("string").alias("call_id"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"),
        F.lit("ok").alias("status"),
    )
    return calls.unionByName(others).unionByName(answers).unionByName(rest)


def formatted(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """conv_id, position, step, turn, role, call_id, status, json: one canonical JSON line per message, call or result.

    ``messages`` has MESSAGES' columns, others are ignored. ``schemas`` holds the
    JSON schema of each tool's arguments; a call that does not fit, or names no
    tool, has status "invalid arguments: ..." and its arguments as they came.
    Rows that repeat a call exactly are one call; other repeated rows repeat.
    NULL and empty texts are empty contents.
    """
    columns = [field.split()[0] for field in MESSAGES.split(", ")]
    schema = (
        "conv_id bigint, position bigint, step bigint, turn bigint, role string, call_id string, status string, json string"
    )
    return linked(messages.select(*columns)).mapInArrow(_serialiser(schemas), schema)
