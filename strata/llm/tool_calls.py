"""Linking the tool calls of conversations to their results.

Calls and results meet in a hash join on conversation and call id.  Calls are
put in topological order of their dependencies, their arguments are checked
against the tool's schema, and each linked call is written as canonical JSON
(sorted keys, no blanks, shortest numbers).

Defined results
- the earliest result of a call (by turn, then text) is linked, later ones are
  counted in ``n_results``; rows that repeat a call id in a conversation keep
  the earliest (by turn, then name and arguments);
- a call without a result has status ``unanswered``; results without a call
  are returned by ``orphan_results``;
- dependencies on unknown ids, null or the call itself do not order anything
  but are counted in ``n_unknown``; calls on a cycle, or behind one, have null
  ``level`` and ``position``;
- arguments that are no JSON object, a null or unknown tool, and every broken
  schema rule are listed in ``errors``, sorted; NaN, infinities, numbers beyond
  doubles and keys that an object repeats are no JSON here, and arguments nested too deep to be read are an
  error of their own: all of these go into the message as the text they came as;
- a null conversation or call id links with nothing; calls with one, or with a null turn, are dropped; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.operators.staging import stage

KEY = ["conv_id", "call_id"]

# The type names of JSON Schema.
JSON_TYPES = {
    "string": str,
    "integer": int,
    "number": (int, float),
    "boolean": bool,
    "array": list,
    "object": dict,
    "null": type(None),
}


def canonical_json(value) -> str:
    """Keys sorted by UTF-16 code units, no blanks, shortest numbers."""
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical_json(k)}:{canonical_json(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical_json, value)) + "]"
    if isinstance(value, float):
        if value.is_integer() and abs(value) < 1e21:
            return str(int(value))
        return re.sub(r"e([+-])0*(\d)", r"e\1\2", repr(value))
    return json.dumps(value, ensure_ascii=False)


def broken_rules(arguments, schema: dict, at: str = "") -> list[str]:
    """What of ``schema`` (type, enum, bounds, required, properties, items) the value breaks."""
    found = []
    wanted = schema.get("type")
    if wanted:
        right = isinstance(arguments, JSON_TYPES[wanted])
        if isinstance(arguments, bool) and wanted in ("integer", "number"):
            right = False
        if not right:
            return [f"{at or '/'}: not of type {wanted}"]
    if "enum" in schema and arguments not in schema["enum"]:
        found.append(f"{at or '/'}: not one of the allowed values")
    if isinstance(arguments, (int, float)) and not isinstance(arguments, bool):
        if arguments < schema.get("minimum", arguments):
            found.append(f"{at or '/'}: below the minimum")
        if arguments > schema.get("maximum", arguments):
            found.append(f"{at or '/'}: above the maximum")
    if isinstance(arguments, dict):
        known = schema.get("properties", {})
        found += [f"{at}/{name}: missing" for name in schema.get("required", []) if name not in arguments]
        for name, value in arguments.items():
            if name in known:
                found += broken_rules(value, known[name], f"{at}/{name}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{at}/{name}: unknown")
    if isinstance(arguments, list) and "items" in schema:
        for i, value in enumerate(arguments):
            found += broken_rules(value, schema["items"], f"{at}/{i}")
    return found


def _earliest(rows: DataFrame, order: list[str], keep: list[str]) -> DataFrame:
    """Per key the first row by ``order`` and the number of rows, combined before the shuffle."""
    first = F.min_by(F.struct(*keep), F.struct(*[F.col(c) for c in order]))
    return rows.groupBy(*KEY).agg(first.alias("first"), F.count("*").alias("n")).select(*KEY, "first.*", "n")


def dependency_levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level, n_unknown``: 0 without dependencies, else one above the highest of them.

    Each round settles one level of all conversations at once; rounds end when
    nothing more can be settled, so they number the longest chain plus one.
    """
    wanted = calls.select(*KEY, F.explode("depends_on").alias("needs")).distinct()
    known = calls.select("conv_id", F.col("call_id").alias("needs"))
    edges = wanted.where("needs is not null and needs <> call_id").join(known, ["conv_id", "needs"], "left_semi")
    asked = wanted.groupBy(*KEY).agg(F.count("*").alias("asked"))
    met = edges.groupBy(*KEY).agg(F.count("*").alias("met"))
    unknown = asked.join(met, KEY, "left").select(*KEY, (F.col("asked") - F.coalesce("met", F.lit(0))).alias("n_unknown"))
    edges = stage(edges, "call-edges")
    free = calls.select(*KEY).join(edges, KEY, "left_anti").withColumn("level", F.lit(0))
    settled = stage(free, "call-levels")
    pending = edges
    while not pending.isEmpty():
        level = settled.select("conv_id", F.col("call_id").alias("needs"), "level")
        tried = pending.join(level, ["conv_id", "needs"], "left").groupBy(*KEY)
        ready = stage(
            tried.agg(F.count("*").alias("n"), F.count("level").alias("known"), (F.max("level") + 1).alias("level"))
            .where("n = known")
            .select(*KEY, "level"),
            "call-levels",
        )
        if ready.isEmpty():
            break
        settled = settled.unionByName(ready)
        pending = stage(pending.join(ready, KEY, "left_anti"), "call-edges")
    return (
        calls.select(*KEY)
        .join(settled, KEY, "left")
        .join(unknown, KEY, "left")
        .select(*KEY, "level", F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"))
    )


def positions(ordered: DataFrame, width: int = 1000) -> DataFrame:
    """``position`` of each call in its conversation by level, turn and call id.

    Rows are ranked within spans of ``width`` turns and the spans' counts are
    summed, so that a conversation of any size is spread over many tasks.
    """
    spans = ordered.withColumn("span", F.floor(F.col("turn") / width))
    part = ["conv_id", "level", "span"]
    sizes = spans.where("level is not null").groupBy(*part).agg(F.count("*").alias("size"))
    before = Window.partitionBy("conv_id").orderBy("level", "span").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(*part, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy(*part).orderBy("turn", "call_id")
    ranked = spans.withColumn("rank", F.row_number().over(inside))
    return ranked.join(firsts, part, "left").withColumn("position", F.col("first") + F.col("rank")).drop("span", "rank", "first")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call.

    ``calls(conv_id, turn, call_id, name, arguments, depends_on)`` with
    ``arguments`` as JSON text and ``depends_on`` an array of call ids;
    ``results(conv_id, turn, call_id, content)``.  Returns ``conv_id, call_id,
    turn, name, level, position, n_unknown, n_results, status, errors,
    message``.
    """
    given = calls.select("conv_id", "turn", "call_id", "name", "arguments", "depends_on")
    given = given.where("conv_id is not null and call_id is not null and turn is not null")
    first = stage(
        _earliest(given, ["turn", "name", "arguments"], ["turn", "name", "arguments", "depends_on"]).drop("n"), "calls"
    )
    answers = results.select("conv_id", "turn", "call_id", "content").where("conv_id is not null and call_id is not null")
    answer = _earliest(answers, ["turn", "content"], ["content"]).withColumnRenamed("n", "n_results")
    linked = (
        positions(first.join(dependency_levels(first), KEY).drop("depends_on"))
        .join(answer, KEY, "left")
        .withColumn("n_results", F.coalesce("n_results", F.lit(0)))
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_written(row, schemas) for row in batch.itertuples(index=False)]
            out = batch[["conv_id", "call_id", "turn", "name", "level", "position", "n_unknown", "n_results"]].copy()
            out["status"], out["errors"], out["message"] = zip(*found) if found else ([], [], [])
            yield out

    text = linked.withColumns({c: F.col(c).cast("string") for c in ("level", "position")})
    written = text.mapInPandas(
        write,
        "conv_id long, call_id string, turn long, name string, level string, position string, n_unknown long, "
        "n_results long, status string, errors array<string>, message string",
    )
    return written.withColumns({c: F.col(c).cast("long") for c in ("level", "position")})


def _written(row, schemas: dict[str, dict]) -> tuple[str, list[str], str]:
    message = {"id": row.call_id, "name": row.name, "arguments": row.arguments}
    if row.n_results:
        message["result"] = row.content
    try:
        errors, message["arguments"] = _checked(row, schemas)
        text = canonical_json(message)
    except RecursionError:
        errors, message["arguments"] = ["/: nested too deep"], row.arguments
        text = canonical_json(message)
    status = "invalid" if errors else "linked" if row.n_results else "unanswered"
    return status, errors, text


def _checked(row, schemas: dict[str, dict]) -> tuple[list[str], object]:
    """What is wrong with a call's arguments, and the arguments: read, or as text where they cannot be."""
    try:
        arguments = json.loads(row.arguments or "", parse_constant=_refused, parse_float=_double, object_pairs_hook=_object)
    except ValueError:
        return ["/: not JSON"], row.arguments
    if not isinstance(arguments, dict):
        return ["/: not an object"], row.arguments if arguments is None else arguments
    schema = schemas.get(row.name)
    return ["unknown tool"] if schema is None else sorted(broken_rules(arguments, schema)), arguments


def _refused(text: str):
    raise ValueError(text)


def _double(text: str) -> float:
    value = float(text)
    return value if math.isfinite(value) else _refused(text)


def _object(pairs: list[tuple]) -> dict:
    found = dict(pairs)
    return found if len(found) == len(pairs) else _refused("a key is repeated")


def orphan_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """The results that no call asked for, null ids among them."""
    asked = calls.select(*KEY).where("call_id is not null").distinct()
    return results.select("conv_id", "turn", "call_id", "content").join(asked, KEY, "left_anti")


def calls_of_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that plain conversations imply.

    Every assistant turn asks the tool ``reply`` (``search`` on every third)
    with its first words and length; the next turn, where there is one, is the
    result.  From the second of each four turns on, a turn needs the one two before it.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    call_id = lambda turn: F.concat(F.lit("call_"), turn.cast("string"))
    turn = F.col("turn")
    words = F.substring_index("text", " ", 3)
    search = turn % 3 == 2
    arguments = F.when(
        search, F.to_json(F.struct(words.alias("query"), (turn % 7).alias("limit")))
    ).otherwise(F.to_json(F.struct(F.length("text").alias("length"), words.alias("opening"))))
    needs: Column = F.when(turn % 8 >= 2, F.array(call_id(turn - 2))).otherwise(F.array().cast("array<string>"))
    calls = rows.where("role = 'assistant'").select(
        "conv_id",
        "turn",
        call_id(turn).alias("call_id"),
        F.when(search, "search").otherwise("reply").alias("name"),
        arguments.alias("arguments"),
        needs.alias("depends_on"),
    )
    results = rows.where("role <> 'assistant' and turn > 0").select(
        "conv_id", "turn", call_id(turn - 1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results
