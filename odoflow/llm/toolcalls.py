"""Operator 9: chat formatting with tool-call linking.

Calls and their results meet in a hash join by (conversation, call id). Calls are
ordered topologically: a call's level is one more than the highest level of the
calls it comes after, found in rounds of joins that each settle one level (the
rounds are as many as the longest chain; calls in or behind a cycle, or behind an
unknown id, never settle). Arguments are validated against the tool's JSON schema,
and messages, calls and results are serialised as canonical JSON: sorted keys, no
blanks, shortest escapes. One output row each, so a conversation of any length is
never gathered in one task; sort by (conv_id, turn, kind, level, call_id) to read.

Schemas know: ``type``, ``required``, ``properties``, ``additionalProperties``,
``enum``, ``minimum``, ``maximum``, ``minLength``, ``maxLength``, ``items``.

Defined cases: of rows with the same (conversation, call id) the call with the least
(turn, name, arguments) and the result with the least content count; a null call id
or conversation never links; null texts are empty texts; a call whose arguments are
no JSON object, or whose tool is unknown, is invalid and its arguments are kept as a
JSON string (so are arguments nested deeper than DEEPEST, or that hold a half of a
surrogate pair, which UTF-8 cannot write); results without a call are returned with kind ``result`` and ``linked``
false; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoflow.llm.common import Scratch

#: Levels of brackets up to which arguments are read.
DEEPEST = 500

_BRACKETS = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}]', re.S)
_KINDS = {"object": dict, "array": list, "string": str, "integer": int, "number": (int, float), "boolean": bool, "null": type(None)}


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def read_arguments(text: str) -> tuple[object, str]:
    """The value that ``text`` stands for and no problem, or the text itself and the problem."""
    depth = 0
    for found in _BRACKETS.finditer(text):
        depth += {"[": 1, "{": 1, "]": -1, "}": -1}.get(found.group(), 0)
        if depth > DEEPEST:
            return text, "$: nested too deeply"
    try:
        value = json.loads(text)
        canonical(value).encode()
    except UnicodeEncodeError:
        return text, "$: half a surrogate pair"
    except (ValueError, RecursionError):
        return text, "$: no JSON"
    return value, ""


def fault(value: object, schema: dict, at: str = "$") -> str:
    """The first way in which ``value`` breaks ``schema``; empty if none."""
    kind = schema.get("type")
    if kind and (not isinstance(value, _KINDS[kind]) or (isinstance(value, bool) and kind in ("integer", "number"))):
        return f"{at}: not {kind}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{at}: not in enum"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            return f"{at}: out of range"
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        return f"{at}: length"
    if isinstance(value, list) and "items" in schema:
        return next((e for k, v in enumerate(value) if (e := fault(v, schema["items"], f"{at}[{k}]"))), "")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in sorted(schema.get("required", ())):
            if name not in value:
                return f"{at}.{name}: missing"
        for name in sorted(value):
            if name in known:
                if e := fault(value[name], known[name], f"{at}.{name}"):
                    return e
            elif schema.get("additionalProperties", True) is False:
                return f"{at}.{name}: unknown"
    return ""


def _levels(calls: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, call_id, level) of the calls that settle."""
    after = scratch.save(calls.select("conv_id", "call_id", F.explode("after").alias("needs")).where("needs is not null").distinct(), "after")
    done = calls.select("conv_id", "call_id").join(after.select("conv_id", "call_id").distinct(), ["conv_id", "call_id"], "left_anti")
    done = scratch.save(done.withColumn("level", F.lit(0)), "level-0")
    k, waiting = 0, after
    while True:
        settled = done.select("conv_id", F.col("call_id").alias("needs"), "level")
        met = waiting.join(settled, ["conv_id", "needs"], "left").groupBy("conv_id", "call_id").agg(F.count("*").alias("all"), F.count("level").alias("known"), F.max("level").alias("top"))
        k += 1
        fresh = scratch.save(met.where(F.col("all") == F.col("known")).select("conv_id", "call_id", (F.col("top") + 1).alias("level")), f"fresh-{k}")
        if fresh.isEmpty():
            return done
        waiting = scratch.save(waiting.join(fresh.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti"), f"waiting-{k}")
        done = scratch.save(done.unionByName(fresh), f"level-{k}")


def _serialised(schemas: dict[str, dict]):
    names = ["conv_id", "turn", "kind", "call_id", "level", "linked", "valid", "fault", "json"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                problem, valid = "", None
                if r["kind"] == "message":
                    value = {"content": r["body"], "role": r["name"]}
                elif r["kind"] == "result":
                    value = {"call_id": r["call_id"], "content": r["body"]}
                else:
                    arguments, problem = read_arguments(r["body"])
                    schema = schemas.get(r["name"])
                    problem = problem or ("unknown tool" if schema is None else fault(arguments, {"type": "object"} | schema))
                    valid = not problem
                    value = {"arguments": arguments, "id": r["call_id"], "name": r["name"]}
                rows.append((r["conv_id"], r["turn"], r["kind"], r["call_id"], r["level"], r["linked"], valid, problem, canonical(value)))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 9, types)], names=names)

    return run


def link_and_format(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Messages (conv_id, turn, role, text), calls (conv_id, turn, call_id, name, arguments, after) and
    results (conv_id, turn, call_id, content) as rows: conv_id, turn, kind, call_id, level, linked, valid, fault, json."""
    scratch = Scratch(messages.sparkSession, "calls")
    key = ["conv_id", "call_id"]
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    once = calls.where(known).groupBy(*key).agg(F.min(F.struct("turn", "name", "arguments", "after")).alias("x")).select(*key, "x.*")
    once = scratch.save(once.unionByName(calls.where(~known).select(*key, "turn", "name", "arguments", "after")), "calls")
    answers = results.where(known).groupBy(*key).agg(F.min(F.struct("content", "turn")).alias("x")).select(*key, F.col("x.turn").alias("at"), "x.content")
    answers = scratch.save(answers.unionByName(results.where(~known).select(*key, F.col("turn").alias("at"), "content")), "results")
    levels = _levels(once.where(known), scratch)

    met = once.join(levels, key, "left").join(answers.select(*key, F.lit(True).alias("answered")).where(known), key, "left")
    calls_out = met.select("conv_id", "turn", F.lit("call").alias("kind"), "call_id", "level", F.coalesce("answered", F.lit(False)).alias("linked"), "name", F.coalesce("arguments", F.lit("")).alias("body"))
    back = answers.join(once.where(known).join(levels, key, "left").select(*key, "level", F.lit(True).alias("called")), key, "left")
    results_out = back.select("conv_id", F.col("at").alias("turn"), F.lit("result").alias("kind"), "call_id", "level", F.coalesce("called", F.lit(False)).alias("linked"), F.lit(None).cast("string").alias("name"), F.coalesce("content", F.lit("")).alias("body"))
    texts = messages.select("conv_id", "turn", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("boolean").alias("linked"), F.coalesce("role", F.lit("")).alias("name"), F.coalesce("text", F.lit("")).alias("body"))
    rows = texts.unionByName(calls_out).unionByName(results_out).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "kind", "call_id", "level", "linked", "name", "body")
    return rows.mapInArrow(_serialised(schemas), "conv_id long, turn long, kind string, call_id string, level int, linked boolean, valid boolean, fault string, json string")
