"""Chat formatting: linking tool calls and their results.

Calls and results are hash-joined by identifier. Within a conversation calls
are put in topological order of what they need: where everything needed comes in an
earlier turn the turns are that order (level 0). In other conversations a call's level
is the longest chain of needs below it: where no call needs more than one other,
chains are followed by doubling (as many joins as the logarithm of the longest
chain); the remaining conversations are layered by rounds that take off all
calls without open needs (as many rounds as the longest chain). Arguments are checked against the tool's schema and
written as canonical JSON (sorted keys, no spaces, whole numbers and text as they are).

Results are rows, one per call, sorted by (conv_id, level, turn, call_id):
no conversation is gathered, so its length does not matter.

Defined cases: a call without result has status ``no_result``; a result without
call is left to ``orphans``; of rows that repeat an identifier the one with
the smallest (turn, ...) counts; needs that name no call of the same conversation are ignored; calls on
or behind a cycle have a null level and status ``cycle``; null, empty or
malformed arguments are ``bad_arguments``, and so are numbers beyond doubles and values
nested deeper than ``MOST_DEPTH``; half a surrogate pair in arguments is written as its escape; a name without schema is
``unknown_tool``. Of several troubles the first of this order is given:
cycle, unknown_tool, bad_arguments, no_result. Null identifiers take no part. Long arguments
are parsed whole, one row at a time; empty tables give no rows. Only the named columns are read,
so other columns may have any name.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.base import materialize

KINDS = {"string": (str,), "integer": (int,), "number": (int, float), "boolean": (bool,), "object": (dict,), "array": (list,)}


MOST_DEPTH = 300
#: Half of a surrogate pair: valid as an escape, but not as UTF-8.
HALF = re.compile("[\ud800-\udfff]")


def canonical(value: object) -> str:
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return HALF.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def writable(value: object) -> bool:
    """Whether JSON can hold it: finite numbers, nested no deeper than ``MOST_DEPTH``."""
    level = [value]
    for _ in range(MOST_DEPTH + 1):
        if any(isinstance(v, float) and not math.isfinite(v) for v in level):
            return False
        level = [x for v in level if isinstance(v, (dict, list)) for x in (v.values() if isinstance(v, dict) else v)]
        if not level:
            return True
    return False


def fits(value: object, schema: Mapping) -> bool:
    """JSON-schema subset: type, required, properties, enum, items; objects
    take no other keys than their properties."""
    kind = schema.get("type")
    if kind and (not isinstance(value, KINDS[kind]) or (isinstance(value, bool) and kind != "boolean")):
        return False
    if "enum" in schema and value not in schema["enum"]:
        return False
    if isinstance(value, dict):
        known = schema.get("properties", {})
        return set(schema.get("required", ())) <= set(value) and all(k in known and fits(v, known[k]) for k, v in value.items())
    return not isinstance(value, list) or all(fits(v, schema.get("items", {})) for v in value)


def checked(arguments: str | None, schema: Mapping | None) -> tuple[str | None, object]:
    """(trouble or None, parsed arguments or None)."""
    if schema is None:
        return "unknown_tool", None
    try:
        value = json.loads(arguments or "", parse_constant=lambda c: 1 / 0)
    except (ValueError, ZeroDivisionError, RecursionError):
        return "bad_arguments", None
    return (None, value) if writable(value) and fits(value, schema) else ("bad_arguments", None)


def levels(edges: DataFrame) -> DataFrame:
    """``call_id, level`` of calls with needs (``call_id, needs``); calls on or
    behind a cycle are missing. As many rounds as the longest chain of needs."""
    edges = materialize(edges.distinct(), "needs")
    placed, at = None, 0
    while True:
        at += 1
        waiting = edges.select(F.col("call_id").alias("needs")).distinct()
        still = materialize(edges.join(waiting, "needs", "left_semi").select("call_id", "needs"), "needs-open")
        ready = edges.select("call_id").distinct().join(still.select("call_id").distinct(), "call_id", "left_anti")
        ready = materialize(ready.withColumn("level", F.lit(at)), "needs-ready")
        placed = ready if placed is None else placed.union(ready)
        if ready.isEmpty():  # nothing is left, or only cycles
            return placed
        edges = still


def depths(edges: DataFrame) -> DataFrame:
    """The same where every call has one need, by doubling: each round a call
    skips to where its present target points."""
    now = materialize(edges.groupBy("call_id").agg(F.min("needs").alias("at")).withColumn("level", F.lit(1)), "chains")
    most, reach = now.count(), 1
    while True:
        ends = now.select(F.col("call_id").alias("at"), F.col("at").alias("next"), F.col("level").alias("more"))
        # A target that needs nothing is final.
        joined = now.join(ends, "at", "left")
        open_ = joined.filter("next IS NOT NULL")
        if reach > most or open_.isEmpty():
            done = now.join(ends, "at", "left_anti")
            return done.select("call_id", "level")
        level = (F.col("level") + F.coalesce(F.col("more"), F.lit(0))).cast("int")
        now = materialize(joined.select("call_id", F.coalesce("next", "at").alias("at"), level.alias("level")), "chains")
        reach *= 2


def link(calls: DataFrame, needs: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """``conv_id, call_id, turn, level, status, message`` for every call.

    calls: ``conv_id, call_id, turn, name, arguments``; needs: ``call_id,
    needs``; results: ``call_id, turn, content``."""
    once = F.min(F.struct("turn", "conv_id", "name", "arguments")).alias("c")
    calls = materialize(calls.filter("call_id IS NOT NULL").groupBy("call_id").agg(once).select("call_id", "c.*"), "calls")
    answers = results.filter("call_id IS NOT NULL").groupBy("call_id").agg(F.min(F.struct("turn", "content")).alias("r"))
    answers = materialize(answers.select("call_id", F.lit(True).alias("answered"), F.col("r.content").alias("content")), "answers")
    ends = calls.select("call_id", "conv_id", "turn").filter("conv_id IS NOT NULL")
    known = needs.select("call_id", "needs").filter("call_id IS NOT NULL AND needs IS NOT NULL")
    known = known.join(ends, "call_id").join(ends.select("conv_id", F.col("call_id").alias("needs"), F.col("turn").alias("needs_turn")), ["needs", "conv_id"])
    known = materialize(known.select("call_id", "needs", "conv_id", F.coalesce(F.col("needs_turn") < F.col("turn"), F.lit(False)).alias("forward")), "edges")
    back = known.filter("NOT forward").select("conv_id").distinct()
    back = materialize(known.join(back, "conv_id", "left_semi").select("conv_id", "call_id", "needs").distinct(), "edges-back")
    many = materialize(back.groupBy("conv_id", "call_id").count().filter("count > 1").select("conv_id").distinct(), "edges-many")
    layered = depths(back.join(many, "conv_id", "left_anti")).union(levels(back.join(many, "conv_id", "left_semi").select("call_id", "needs")))
    open_ = back.select("call_id").distinct().withColumn("open", F.lit(True))
    order = materialize(open_.join(layered, "call_id", "left").select("call_id", "open", "level"), "order")
    linked = calls.join(answers, "call_id", "left").join(order, "call_id", "left")
    level = F.when(F.col("open"), F.col("level")).otherwise(0).cast("int")
    linked = linked.select("conv_id", "call_id", "turn", "name", "arguments", "content", F.coalesce("answered", F.lit(False)).alias("answered"), level.alias("level"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            status, message = [], []
            for row in b.select(["call_id", "name", "arguments", "content", "answered", "level"]).to_pylist():
                trouble, value = checked(row["arguments"], schemas.get(row["name"]))
                trouble = "cycle" if row["level"] is None else trouble or (None if row["answered"] else "no_result")
                status.append(trouble or "ok")
                message.append(canonical({"arguments": value, "id": row["call_id"], "name": row["name"], "result": row["content"], "status": status[-1]}))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("conv_id", "call_id", "turn", "level")], pa.array(status, pa.string()), pa.array(message, pa.string())], ["conv_id", "call_id", "turn", "level", "status", "message"])

    types = {f.name: f.dataType.simpleString() for f in linked.schema.fields}
    schema = f"conv_id {types['conv_id']}, call_id {types['call_id']}, turn {types['turn']}, level int, status string, message string"
    return linked.mapInArrow(write, schema).orderBy("conv_id", F.col("level").asc_nulls_last(), "turn", "call_id")


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose identifier no call has."""
    return results.join(calls.select("call_id").distinct(), "call_id", "left_anti")
