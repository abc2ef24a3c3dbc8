"""Tool-call linking: calls meet their results by identifier and are put in dependency order.

1. Results are reduced to one row an identifier, calls and results are then hash-joined on
   (conversation, identifier). Results without a call are kept as orphans.
2. A call may name the calls it comes after; its place is its depth in that graph, one more than that
   of its deepest predecessor. Calls with a single predecessor are chains, followed by pointer doubling:
   each round a call points twice as far, so a chain of n calls takes log2(n) joins and no
   conversation is ever gathered in a task. That leaves the calls with several predecessors, which
   are settled in topological rounds of joins, one for each such call that follows another. Calls that
   are never settled lie on or behind a cycle.
3. Rows are sorted by range over all tasks; the position in a conversation is the rank less
   the conversation's first rank.
4. Arguments are parsed, checked against the tool's schema and written as canonical JSON, row by row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaneed.llm.words import text_column
from areaneed.operators.groups import with_key
from areaneed.sources.scratch import materialise

_TYPES = {
    "object": lambda x: isinstance(x, dict),
    "array": lambda x: isinstance(x, list),
    "string": lambda x: isinstance(x, str),
    "boolean": lambda x: isinstance(x, bool),
    "integer": lambda x: isinstance(x, int) and not isinstance(x, bool),
    "number": lambda x: isinstance(x, int | float) and not isinstance(x, bool),
    "null": lambda x: x is None,
}


def breaches(value, schema: dict, at: str = "$") -> list[str]:
    """Where ``value`` breaks a schema of type, enum, bounds, lengths, properties and items."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_TYPES[k](value) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    found = []
    # 1 and true are equal in Python, not in JSON.
    if "enum" in schema and not any(type(x) is type(value) and x == value for x in schema["enum"]):
        found.append(f"{at}: not in enum")
    if _TYPES["number"](value):
        if value < schema.get("minimum", value):
            found.append(f"{at}: below minimum")
        if value > schema.get("maximum", value):
            found.append(f"{at}: above maximum")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            found.append(f"{at}: too short")
        if len(value) > schema.get("maxLength", len(value)):
            found.append(f"{at}: too long")
    if isinstance(value, dict):
        own = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties", True) is False:
            found += [f"{at}.{k}: unknown" for k in sorted(value) if k not in own]
        for k in sorted(own):
            if k in value:
                found += breaches(value[k], own[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += breaches(x, schema["items"], f"{at}[{i}]")
    return found


def canonical(value) -> str:
    """JSON with sorted keys, no blanks, and other than ASCII escaped."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), allow_nan=False)


def _refuse(name: str):
    raise ValueError(f"{name} is not JSON")


def judged(name: str | None, arguments: str | None, schemas: dict) -> tuple[str | None, list[str]]:
    """Canonical arguments (null if they are not JSON) and the breaches of the tool's schema."""
    if arguments is None:
        return None, ["$: no arguments"]
    try:
        value = json.loads(arguments, parse_constant=_refuse)
        text = canonical(value)
        if name not in schemas:
            return text, ["$: unknown tool"]
        return text, breaches(value, schemas[name])
    except (ValueError, RecursionError):
        return None, ["$: not JSON"]


def message(conv, call_id, name, arguments: str | None, result: str | None) -> str:
    """One call and its result as canonical JSON; ``arguments`` is canonical already."""
    head = canonical({"call_id": call_id, "conv_id": conv, "name": name})
    body = f'"arguments":{arguments or "null"},{head[1:-1]},"result":{canonical(result)}'
    return "{" + body + "}"


def _serialise(batches: Iterator[pa.RecordBatch], schemas: dict):
    names = ["conv_id", "call_id", "name", "arguments", "result"]
    for batch in batches:
        rows = zip(*[text_column(batch, x).to_pylist() for x in names], strict=True)
        done, text = [], []
        for conv, call_id, name, arguments, result in rows:
            done.append(judged(name, arguments, schemas))
            text.append(message(conv, call_id, name, done[-1][0], result))
        at = batch.schema.names.index("arguments")
        columns = [c for i, c in enumerate(batch.columns) if i != at and i != at + 1]
        kept = [c for i, c in enumerate(batch.schema.names) if i != at and i != at + 1]
        yield pa.RecordBatch.from_arrays(
            [
                *columns,
                pa.array([not x[1] for x in done], pa.bool_()),
                pa.array([x[1] for x in done], pa.list_(pa.string())),
                pa.array(text, pa.string()),
            ],
            [*kept, "valid", "errors", "json"],
        )


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) from (conv_id, call_id, after), one row a call and predecessor.

    Depth 0: the call names none, or none that is there; else one more than its deepest predecessor.
    Null: on or behind a cycle. Repeated rows are one; a null ``after`` names none.
    """
    keys = ["conv_id", "call_id"]
    nodes = calls.select(*keys).distinct()
    edges = calls.where("after is not null").distinct().join(
        nodes.select("conv_id", F.col("call_id").alias("after")), ["conv_id", "after"]
    )
    edges = materialise(edges, "call-edges")
    only = edges.groupBy(*keys).agg(F.count("*").alias("named"), F.min("after").alias("after"))
    # Calls with no or several predecessors point to themselves: chains end there.
    single = F.coalesce(F.col("named") == 1, F.lit(False))
    state = nodes.join(only, keys, "left").select(
        *keys,
        F.when(single, F.col("after")).otherwise(F.col("call_id")).alias("end"),
        single.cast("long").alias("far"),
        (~single).alias("done"),
        F.coalesce(F.col("named") > 1, F.lit(False)).alias("joins"),
    )
    state = materialise(state, "call-chains")
    n, reach = state.count(), 1
    # A pointer is up to 2^rounds calls ahead: what is open beyond n runs in a circle.
    while reach <= 2 * n and state.where("not done").count():
        ahead = state.select(
            "conv_id", F.col("call_id").alias("end"), F.col("end").alias("next"),
            F.col("far").alias("more"), F.col("done").alias("ended"),
        )
        moved = state.where("not done").join(ahead, ["conv_id", "end"]).select(
            *keys, F.col("next").alias("end"), (F.col("far") + F.col("more")).alias("far"),
            F.col("ended").alias("done"), "joins",
        )
        state = materialise(state.where("done").unionByName(moved), "call-chains")
        reach *= 2

    ends = state.where("done").select(
        "conv_id", F.col("call_id").alias("after"), "end", (F.col("far") + 1).alias("far")
    )
    several = state.where("joins").select(*keys)
    waiting = edges.join(several, keys, "left_semi").join(ends, ["conv_id", "after"], "left")
    waiting = materialise(waiting.select(*keys, "end", "far"), "call-joins")
    settled = state.where("done and not joins and end = call_id").select(
        *keys, F.lit(0).cast("long").alias("depth")
    )
    settled = materialise(settled, "call-depths")
    left = waiting.count()
    while left:
        known = settled.select("conv_id", F.col("call_id").alias("end"), "depth")
        ready = (
            waiting.join(known, ["conv_id", "end"], "left")
            .groupBy(*keys)
            .agg(
                F.max(F.col("depth") + F.col("far")).alias("depth"),
                F.count_if(F.col("depth").isNull()).alias("open"),
            )
            .where(F.col("open") == 0)
            .drop("open")
        )
        ready = materialise(ready, "call-ready")
        waiting = materialise(waiting.join(ready, keys, "left_anti"), "call-joins")
        settled = materialise(settled.unionByName(ready), "call-depths")
        before, left = left, waiting.count()
        if left == before:
            break
    known = settled.select("conv_id", F.col("call_id").alias("end"), "depth")
    return state.join(known, ["conv_id", "end"], "left").select(
        *keys, F.when(F.col("done"), F.col("depth") + F.col("far")).alias("depth")
    )


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call, and per result without a call, with its place, validity and JSON.

    ``calls``: conv_id, call_id, name, arguments (JSON text), after (call_id of the call it depends
    on, or an array of them, or null). ``results``: conv_id, call_id, content. Returned: conv_id, call_id, name,
    ``n_results``, ``status`` (linked, no result, orphan result), ``depth``, ``position`` (from 0 in the
    conversation, by depth, call_id, then content), ``valid``, ``errors`` and ``json``.

    Of several results of one identifier the smallest content is linked; ``n_results`` counts all. Calls
    that repeat an identifier are rows of their own, linked with the same result; they come after all
    that any of them names. Calls on or behind a cycle have a null depth and come last. A null
    conv_id or call_id is linked with nothing: such calls have depth 0, such results are
    orphans, one row each distinct pair. A null result content is a result. Texts that are not
    JSON, unknown tools and null arguments are not valid. Other columns are not read.
    Empty tables give an empty result.
    """
    after = F.col("after")
    if not isinstance(calls.schema["after"].dataType, T.ArrayType):
        after = F.array(after)
    calls = calls.select(
        *[F.col(c).cast("string").alias(c) for c in ("conv_id", "call_id", "name", "arguments")],
        after.cast("array<string>").alias("after"),
    )
    once = results.select(
        *[F.col(c).cast("string").alias(c) for c in ("conv_id", "call_id", "content")]
    ).groupBy("conv_id", "call_id").agg(
        F.count("*").alias("n_results"), F.min("content").alias("result")
    )
    once = materialise(once, "results")
    keys = ["conv_id", "call_id"]
    named = calls.where("conv_id is not null and call_id is not null")
    graph = depths(named.select(*keys, F.explode_outer("after").alias("after")))
    linked = (
        calls.join(once.hint("shuffle_hash"), keys, "left")
        .join(graph.withColumn("in_graph", F.lit(True)), keys, "left")
        .select(
            *keys,
            "name",
            "arguments",
            "result",
            F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
            F.when(F.col("n_results").isNull(), "no result").otherwise("linked").alias("status"),
            F.when(F.col("in_graph"), F.col("depth")).otherwise(0).cast("long").alias("depth"),
        )
    )
    orphans = once.join(named.select(*keys).distinct(), keys, "left_anti").select(
        *keys,
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"),
        "result",
        "n_results",
        F.lit("orphan result").alias("status"),
        F.lit(None).cast("long").alias("depth"),
    )
    rows = linked.unionByName(orphans)
    # The row number tells copies apart, so not even those have to meet in a task.
    order = ["conv_id", "orphan", "depth", "call_id", "digest", "copy"]
    rows = rows.withColumns(
        {
            "orphan": F.col("status") == "orphan result",
            "digest": F.xxhash64("name", "arguments", "result"),
            "copy": F.monotonically_increasing_id(),
        }
    )
    rows = with_key(materialise(rows, "linked-calls"), order, "rank")
    first = rows.groupBy("conv_id").agg(F.min("rank").alias("first"))
    rows = rows.alias("r").join(
        first.alias("f"), F.col("r.conv_id").eqNullSafe(F.col("f.conv_id"))
    ).select(
        "r.conv_id", "r.call_id", "r.name", "r.arguments", "r.result", "r.n_results", "r.status",
        "r.depth", (F.col("r.rank") - F.col("f.first")).alias("position"),
    )
    return rows.mapInArrow(
        partial(_serialise, schemas=schemas),
        "conv_id string, call_id string, name string, n_results long, status string, "
        "depth long, position long, valid boolean, errors array<string>, json string",
    )
