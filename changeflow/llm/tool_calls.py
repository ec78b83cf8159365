"""Chat formatting: tool calls joined to their results, ordered, validated, and serialised as canonical JSON."""

from __future__ import annotations

import heapq
import json
import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

KINDS = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int | float) and not isinstance(v, bool) and v == v // 1,
    "number": lambda v: isinstance(v, int | float) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "null": lambda v: v is None,
}


def canonical(value) -> str:
    """JSON with sorted keys, no spaces and whole floats as integers; not-a-number and infinities are refused."""

    def plain(v):
        if isinstance(v, dict):
            return {str(k): plain(x) for k, x in v.items()}
        if isinstance(v, list):
            return [plain(x) for x in v]
        return int(v) if isinstance(v, float) and math.isfinite(v) and v == int(v) and abs(v) < 2**53 else v

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


# The keywords of a schema that calls are checked against, and those that say nothing about a value.
CHECKED = ("type", "enum", "minimum", "maximum", "minLength", "items", "required", "properties", "additionalProperties")
REMARKS = ("title", "description", "default", "examples", "$schema")


def refuse_unknown(schema: dict, where: str = "$") -> None:
    """Raises for a keyword, or a form of one, that :func:`faults` does not check, at any depth."""
    for word in schema:
        if word not in (*CHECKED, *REMARKS):
            raise ValueError(f"{where}: no check for {word}")
    kinds = schema.get("type", [])
    for kind in [kinds] if isinstance(kinds, str) else kinds:
        if kind not in KINDS:
            raise ValueError(f"{where}: no type {kind}")
    if not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"{where}: no check for a schema of additionalProperties")
    if "items" in schema:
        refuse_unknown(schema["items"], f"{where}[]")
    for name, inner in schema.get("properties", {}).items():
        refuse_unknown(inner, f"{where}.{name}")


def finite(text: str) -> float:
    """A number that a double holds; others are no value that could be written again."""
    number = float(text)
    if not math.isfinite(number):
        raise ValueError(f"out of range: {text}")
    return number


def read_call(name: str, text: str | None, call_id: str, status: str, schemas: dict[str, dict]) -> tuple[str, bool]:
    """A call's JSON up to its result, and whether it is invalid.

    Arguments that are no JSON, or JSON that cannot be written again as UTF-8 (numbers beyond a double, half
    characters, nesting beyond what is parsed), are kept as text.
    """
    late = ["$: answered before it was called"] if status == "early" else []

    def written(arguments, errors: list[str]) -> tuple[str, bool]:
        piece = canonical({"arguments": arguments, "errors": errors + late, "id": call_id, "name": name})[:-1]
        piece.encode()
        return piece, bool(errors + late)

    try:
        arguments = json.loads(text or "{}", parse_float=finite, parse_constant=finite)
        return written(arguments, faults(arguments, schemas[name]) if name in schemas else ["$: unknown tool"])
    except (ValueError, RecursionError):
        return written(text, ["$: not JSON"])


def faults(value, schema: dict, where: str = "$") -> list[str]:
    """What of ``value`` breaks ``schema``: type, enum, minimum, maximum, minLength, items, required, properties, additionalProperties."""
    kinds = schema.get("type")
    if kinds is not None and not any(KINDS[k](value) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{where}: not {kinds}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{where}: not in enum")
    if KINDS["number"](value):
        if value < schema.get("minimum", value):
            found.append(f"{where}: below minimum")
        if value > schema.get("maximum", value):
            found.append(f"{where}: above maximum")
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        found.append(f"{where}: too short")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += faults(item, schema["items"], f"{where}[{i}]")
    if isinstance(value, dict):
        properties = schema.get("properties", {})
        found += [f"{where}.{name}: missing" for name in schema.get("required", []) if name not in value]
        for name, item in value.items():
            if name in properties:
                found += faults(item, properties[name], f"{where}.{name}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{where}.{name}: unknown")
    return found


CALL = "struct<id: string, name: string, arguments: string, after: array<string>>"


def linked(messages: DataFrame) -> DataFrame:
    """A row per call of ``messages`` (``conv_id, turn, role, text, calls, result_of``) with its result.

    ``calls`` is an array of :data:`CALL`, null or empty where a message calls nothing; ``result_of`` is the
    identifier that a tool's message answers. Calls and results are joined by conversation and identifier.
    Columns: ``conv_id, call_id, turn, place, name, arguments, after, result, result_turn, status``. ``status`` is
    ``ok``, ``unanswered`` (no result), ``early`` (the result stands before its call) or ``orphan`` (a result
    without a call, which has no name). Of repeated identifiers the first call and the first result count;
    the others are ``repeated``. Identifiers that are null link with nothing.
    """
    calls = messages.where("calls IS NOT NULL").select("conv_id", "turn", F.posexplode("calls").alias("place", "call"))
    calls = calls.select("conv_id", F.col("call.id").alias("call_id"), "turn", "place", "call.name", "call.arguments", "call.after")
    # rows without an identifier are not numbered, so they need not meet
    apart = lambda *by: F.when(F.col("call_id").isNull(), F.xxhash64(*by))
    calls = calls.withColumn("apart", apart("turn", "place", "name", "arguments"))
    nth_call = F.row_number().over(W.partitionBy("conv_id", "call_id", "apart").orderBy("turn", "place", "name", "arguments"))
    calls = calls.withColumn("nth", F.when(F.col("call_id").isNotNull(), nth_call))
    results = messages.where("role = 'tool'").select(
        "conv_id", F.col("result_of").alias("call_id"), F.col("turn").alias("result_turn"), F.col("text").alias("result")
    )
    results = results.withColumn("apart", apart("result_turn", "result"))
    nth_result = F.row_number().over(W.partitionBy("conv_id", "call_id", "apart").orderBy("result_turn", "result"))
    results = results.withColumn("nth", F.when(F.col("call_id").isNotNull(), nth_result))
    status = (
        F.when(F.col("nth") > 1, "repeated")
        .when(F.col("turn").isNull() & F.col("name").isNull() & F.col("result_turn").isNotNull(), "orphan")
        .when(F.col("result_turn").isNull(), "unanswered")
        .when(F.col("result_turn") <= F.col("turn"), "early")
        .otherwise("ok")
    )
    calls, results = calls.drop("apart"), results.drop("apart")
    named = F.col("call_id").isNotNull()
    joined = calls.where(named).join(results.where(named), ["conv_id", "call_id", "nth"], "full")
    for rest in (calls.where(~named), results.where(~named)):
        joined = joined.unionByName(rest, allowMissingColumns=True)
    return joined.withColumn("status", status).drop("nth")


FORMATTED = (
    "conv_id long, n_calls long, n_ok long, n_unlinked long, n_invalid long, n_cyclic long, document string"
)


def ordered(calls: list[dict]) -> tuple[list[dict], list[dict]]:
    """Calls with every call after those it names in ``after``, otherwise by turn and place; and those on or behind a cycle.

    Names of calls that are not in the conversation bind nothing.
    """
    known = {c["call_id"] for c in calls if c["call_id"] is not None}
    behind, waits = defaultdict(list), []
    for i, c in enumerate(calls):
        before = {a for a in (c["after"] or []) if a in known}
        waits.append(len(before))
        for a in before:
            behind[a].append(i)
    ready = [(c["turn"], c["place"], i) for i, c in enumerate(calls) if not waits[i]]
    heapq.heapify(ready)
    done = []
    while ready:
        first = calls[heapq.heappop(ready)[2]]
        done.append(first)
        for i in behind.pop(first["call_id"], ()):
            waits[i] -= 1
            if not waits[i]:
                heapq.heappush(ready, (calls[i]["turn"], calls[i]["place"], i))
    rest = sorted((i for i, n in enumerate(waits) if n), key=lambda i: (calls[i]["turn"], calls[i]["place"]))
    return done, [calls[i] for i in rest]


def judged(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``calls`` of :func:`linked`, each row by itself: ``invalid``, and ``piece``, its JSON up to the result, instead of name and arguments.

    Both are null for calls that no document lists. A schema with a keyword that is not checked is refused at once.
    """
    for schema in schemas.values():
        refuse_unknown(schema)
    kept = [c for c in calls.columns if c not in ("name", "arguments")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, invalid = [], []
            for name, text, call_id, status in zip(*(batch[c].to_pylist() for c in ("name", "arguments", "call_id", "status")), strict=True):
                if status not in ("ok", "early"):
                    pieces.append(None)
                    invalid.append(None)
                    continue
                piece, bad = read_call(name, text, call_id, status, schemas)
                pieces.append(piece)
                invalid.append(bad)
            arrays = [*(batch[c] for c in kept), pa.array(pieces, pa.string()), pa.array(invalid, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "piece", "invalid"])

    schema = ", ".join(f"`{c}` {calls.schema[c].dataType.simpleString()}" for c in kept)
    return calls.mapInArrow(judge, f"{schema}, piece string, invalid boolean")


def formatted(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """A canonical JSON document per conversation of ``messages`` (as for :func:`linked`) and what was found in it.

    ``document`` holds ``messages`` (``role``, ``content``; a tool's message also ``tool_call_id``) by turn and
    ``tool_calls`` in topological order with ``arguments`` as parsed, ``valid`` by ``schemas[name]``, ``errors``
    and ``result``. A call with an unknown name, with arguments that are no JSON, or that break the schema is
    invalid; calls without a result, results without a call and repeats count as unlinked and are left out of
    ``tool_calls``; calls on a cycle come last. Null text is empty content; rows without ``conv_id`` are left
    out; a conversation without calls has none. Repeated rows are repeated messages.

    Calls are parsed, checked and serialised row by row before they are grouped. One conversation is handled at a
    time; its messages arrive sorted, and only their JSON and the calls' are held.
    """
    calls = judged(linked(messages), schemas)
    rows = messages.select(
        "conv_id", F.lit(0).alias("kind"), "turn", F.lit(0).alias("place"), "role", "text", "result_of",
        *[F.lit(None).cast(t).alias(c) for c, t in (("after", "array<string>"), ("status", "string"), ("piece", "string"), ("invalid", "boolean"))],
    ).unionByName(
        calls.select(
            "conv_id", F.lit(1).alias("kind"), "turn", F.coalesce("place", F.lit(0)).alias("place"), F.lit(None).cast("string").alias("role"),
            F.col("result").alias("text"), F.col("call_id").alias("result_of"), "after", "status", "piece", "invalid",
        )
    )
    order = ("conv_id", "kind", F.col("turn").asc_nulls_last(), "place", "role", "text", "result_of")
    sent = rows.where("conv_id IS NOT NULL").repartition("conv_id").sortWithinPartitions(*order)

    def said(r: dict) -> str:
        return canonical({"role": r["role"], "content": r["text"] or ""} | ({"tool_call_id": r["result_of"]} if r["role"] == "tool" else {}))

    def made(r: dict) -> dict:
        document = None
        if r["piece"] is not None:
            document = f'{r["piece"]},"result":{canonical(r["text"] or "")},"valid":{canonical(not r["invalid"])}}}'
        return {"call_id": r["result_of"], "document": document} | {c: r[c] for c in ("turn", "place", "after", "invalid")}

    def document(conv_id: int, messages: list[str], calls: list[dict]) -> dict:
        done, cyclic = ordered([c for c in calls if c["document"] is not None])
        out = done + cyclic
        invalid = sum(c["invalid"] for c in out)
        return {
            "conv_id": conv_id,
            "n_calls": sum(c["turn"] is not None for c in calls),
            "n_ok": len(out) - invalid,
            "n_unlinked": len(calls) - len(out),
            "n_invalid": invalid,
            "n_cyclic": len(cyclic),
            "document": f'{{"messages":[{",".join(messages)}],"tool_calls":[{",".join(c["document"] for c in out)}]}}',
        }

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), *((c, pa.int64()) for c in ("n_calls", "n_ok", "n_unlinked", "n_invalid", "n_cyclic")), ("document", pa.string())]
        )
        conv, messages, calls = None, [], []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (messages or calls) and row["conv_id"] != conv:
                    out.append(document(conv, messages, calls))
                    messages, calls = [], []
                conv = row["conv_id"]
                if row["kind"]:
                    calls.append(made(row))
                else:
                    messages.append(said(row))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if messages or calls:
            yield pa.RecordBatch.from_pylist([document(conv, messages, calls)], schema=schema)

    return sent.withColumn("conv_id", F.col("conv_id").cast("long")).mapInArrow(write, FORMATTED)


# The tools that the query's calls name.
SCHEMAS = {
    "lookup": {
        "type": "object",
        "properties": {"query": {"type": "string", "minLength": 20}, "limit": {"type": "integer", "minimum": 1, "maximum": 6}},
        "required": ["query", "limit"],
        "additionalProperties": False,
    }
}


def with_calls(conversations: DataFrame) -> DataFrame:
    """Conversations in which every user turn calls ``lookup`` and the assistant turn behind it is the result.

    The call's arguments are the whole question and the turn's number as its limit; each
    call comes after that of the user turn before. So short questions and late turns break the schema, and
    questions without an answer stay unlinked.
    """
    call_id = F.concat_ws("-", F.lit("call"), "conv_id", "turn")
    made = F.struct(
        call_id.alias("id"),
        F.lit("lookup").alias("name"),
        F.to_json(F.struct(F.col("text").alias("query"), F.col("turn").alias("limit"))).alias("arguments"),
        F.array(F.concat_ws("-", F.lit("call"), "conv_id", (F.col("turn") - 2).cast("string"))).alias("after"),
    )
    asked = F.concat_ws("-", F.lit("call"), "conv_id", (F.col("turn") - 1).cast("string"))
    return conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.when(F.col("role") == "assistant", F.lit("tool")).otherwise(F.col("role")).alias("role"),
        "text",
        F.when(F.col("role") == "user", F.array(made)).alias("calls"),
        F.when(F.col("role") == "assistant", asked).alias("result_of"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(with_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet")), SCHEMAS)
