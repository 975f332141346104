"""Chat formatting: tool calls linked to their results, ordered, checked and serialised.

1. Calls and results are hash-joined by (conversation, identifier).
2. A call whose arguments hold {"$ref": identifier} depends on that call.  Calls are ordered
   topologically, ties by turn and identifier; calls on a cycle follow in that order.
3. Arguments are validated against the JSON schema of the tool's name (type, enum, required,
   properties, additionalProperties, items, minimum, maximum, minLength, maxLength, minItems,
   maxItems).
4. Each conversation becomes one line of canonical JSON: sorted keys, no blanks, no escapes but
   the necessary ones, whole floats as integers.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_TYPES = {"string": str, "number": (int, float), "integer": int, "boolean": bool, "object": dict, "array": list, "null": type(None)}

#: Tools that assistant turns stand for.
SCHEMAS = {
    "reply": {"type": "object", "required": ["length", "text"], "properties": {"after": {"type": "object"}, "length": {"type": "integer", "minimum": 0, "maximum": 400}, "text": {"type": "string"}}, "additionalProperties": False},
    "write": {"type": "object", "required": ["length", "text"], "properties": {"after": {"type": "object"}, "length": {"type": "integer", "minimum": 0, "maximum": 1500}, "text": {"type": "string"}}, "additionalProperties": False},
}


def _plain(x):
    if isinstance(x, dict):
        return {str(k).encode("utf-8", "replace").decode(): _plain(v) for k, v in x.items()}
    if isinstance(x, list):
        return [_plain(v) for v in x]
    if isinstance(x, str):
        return x.encode("utf-8", "replace").decode()
    if isinstance(x, float) and x.is_integer() and abs(x) < 2**53:
        return int(x)
    return x


def canonical(x) -> str:
    return json.dumps(_plain(x), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def _no_constant(name: str):
    raise ValueError(name)


def parsed(text: str | None) -> tuple[object, str | None]:
    """(value, error)."""
    if text is None:
        return None, "arguments: missing"
    try:
        value = json.loads(text, parse_constant=_no_constant)
        canonical(value)
        return value, None
    except (ValueError, RecursionError):
        return text, "arguments: not JSON"


def _is(value, kind: str) -> bool:
    if kind in ("integer", "number") and isinstance(value, bool):
        return False
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, _TYPES[kind])


def violations(value, schema: dict, at: str = "") -> list[str]:
    """What is wrong, in order of path."""
    where = at or "arguments"
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{where}: not {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{where}: not allowed")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{where}: below {schema['minimum']}")
        if value > schema.get("maximum", value):
            out.append(f"{where}: above {schema['maximum']}")
    size = {str: "Length", list: "Items"}.get(type(value))
    if size:
        if len(value) < schema.get(f"min{size}", 0):
            out.append(f"{where}: shorter than {schema[f'min{size}']}")
        if len(value) > schema.get(f"max{size}", len(value)):
            out.append(f"{where}: longer than {schema[f'max{size}']}")
    if isinstance(value, list) and "items" in schema:
        for k, x in enumerate(value):
            out += violations(x, schema["items"], f"{at}[{k}]")
    if isinstance(value, dict):
        own = schema.get("properties", {})
        inner = (lambda k: f"{at}.{k}") if at else str
        out += [f"{inner(k)}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in own:
                out += violations(value[k], own[k], inner(k))
            elif schema.get("additionalProperties") is False:
                out.append(f"{inner(k)}: unknown")
    return out


def references(value) -> set[str]:
    todo, out = [value], set()
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if isinstance(x.get("$ref"), str):
                out.add(x["$ref"])
            todo += x.values()
        elif isinstance(x, list):
            todo += x
    return out


def ordered(calls: list[dict]) -> tuple[list[dict], set[str]]:
    """(calls in topological order, identifiers on or behind a cycle)."""
    own = {c["id"]: c for c in calls}
    needs = {i: {r for r in c["refs"] if r in own and r != i} for i, c in own.items()}
    then: dict[str, list[str]] = {i: [] for i in own}
    for i, rs in needs.items():
        for r in rs:
            then[r].append(i)
    key = lambda i: (own[i]["turn"] is None, own[i]["turn"] or 0, i)
    ready = [key(i) for i, rs in needs.items() if not rs]
    heapq.heapify(ready)
    out, left = [], {i: len(rs) for i, rs in needs.items()}
    while ready:
        i = heapq.heappop(ready)[2]
        out.append(own[i])
        for j in then[i]:
            left[j] -= 1
            if not left[j]:
                heapq.heappush(ready, key(j))
    done = {c["id"] for c in out}
    rest = sorted((i for i in own if i not in done), key=key)
    return out + [own[i] for i in rest], {*rest} | {i for i, c in own.items() if i in c["refs"]}


def _format(schemas: dict[str, dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                calls = []
                for c in r["calls"] or []:
                    value, error = parsed(c["arguments"])
                    calls.append({"id": c["call_id"], "turn": c["turn"], "name": c["name"], "arguments": value, "error": error, "result": c["result"], "refs": references(value) if error is None else set()})
                line, cyclic = ordered(calls)
                known = {c["id"] for c in line}
                out = []
                for c in line:
                    errors = [c["error"]] if c["error"] else violations(c["arguments"], schemas[c["name"]]) if c["name"] in schemas else ["name: unknown tool"]
                    errors += [f"$ref: no call {x}" for x in sorted(c["refs"] - known)] + ["$ref: cycle"] * (c["id"] in cyclic)
                    out.append({"arguments": c["arguments"], "errors": errors, "id": c["id"], "name": c["name"], "result": c["result"], "turn": c["turn"]})
                messages = sorted(r["messages"] or [], key=lambda m: (m["turn"] is None, m["turn"] or 0, m["role"] or "", m["content"] or ""))
                rows.append((r["conv_id"], len(out), sum(c["result"] is not None for c in out), sum(bool(c["errors"]) for c in out), canonical({"calls": out, "conv_id": r["conv_id"], "messages": messages})))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()))], ["conv_id", "calls", "answered", "faulty", "formatted"])

    return run


def link(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """(conv_id, calls, answered, faulty, formatted), one row for each conversation of messages or calls.

    messages (conv_id, turn, role, content), calls (conv_id, turn, call_id, name, arguments as JSON) and
    results (conv_id, turn, call_id, content); other columns aren't read.  Calls without an identifier and
    results without a call are left out.  Of calls that repeat an identifier in a conversation the first by
    (turn, name, arguments) counts, of results the first by (turn, content).  A call without a result has
    null there.  A null name is an unknown tool, null arguments are missing, and arguments that aren't JSON
    stay as they are, each with an error.  Repeated messages stay.  Rows without a conversation go together
    under a null conv_id.  Empty tables give an empty result.
    """
    one = Window.partitionBy("conv_id", "call_id")
    calls = calls.select("conv_id", "call_id", "turn", "name", "arguments").where("call_id IS NOT NULL")
    calls = calls.withColumn("k", F.row_number().over(one.orderBy("turn", "name", "arguments"))).where("k = 1").drop("k")
    found = results.select("conv_id", "call_id", F.col("turn").alias("answer"), F.col("content").alias("result")).where("call_id IS NOT NULL")
    found = found.groupBy("conv_id", "call_id").agg(F.min(F.struct(F.col("answer").isNull(), "answer", F.col("result").isNull(), "result")).alias("r")).select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), "r.result")
    linked = calls.join(found.hint("shuffle_hash"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("i")), "left")
    linked = linked.select("conv_id", F.struct("call_id", F.col("turn").cast("long").alias("turn"), "name", "arguments", "result").alias("call"), F.lit(None).alias("message"))
    texts = messages.select("conv_id", F.lit(None).alias("call"), F.struct("content", "role", F.col("turn").cast("long").alias("turn")).alias("message"))
    rows = linked.unionByName(texts).groupBy("conv_id").agg(F.collect_list("call").alias("calls"), F.collect_list("message").alias("messages"))
    return rows.mapInArrow(_format(schemas), "conv_id long, calls int, answered int, faulty int, formatted string")


def turn_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(messages, calls, results) of a table of turns without tool markup: each assistant turn stands for a
    call, 'write' where it has several lines, else 'reply', that refers to the assistant turn before it;
    a user turn that follows directly is its result."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    name = lambda turn: F.md5(F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string")))
    turns = conversations.select("conv_id", "turn", "role", "text").withColumn("next_role", F.lead("role").over(w)).withColumn("next_text", F.lead("text").over(w)).withColumn("next_turn", F.lead("turn").over(w))
    turns = turns.withColumn("before", F.last(F.when(F.col("role") == "assistant", F.col("turn")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    said = turns.where("role = 'assistant'").withColumn("call_id", name(F.col("turn")))
    after = F.when(F.col("before").isNotNull(), F.struct(name(F.col("before")).alias("$ref")))
    arguments = F.to_json(F.struct(after.alias("after"), F.char_length("text").alias("length"), F.col("text")))
    calls = said.select("conv_id", "turn", "call_id", F.when(F.instr("text", "\n") > 0, "write").otherwise("reply").alias("name"), arguments.alias("arguments"))
    results = said.where("next_role = 'user'").select("conv_id", F.col("next_turn").alias("turn"), "call_id", F.col("next_text").alias("content"))
    return turns.select("conv_id", "turn", "role", F.col("text").alias("content")), calls, results


def format_conversations(conversations: DataFrame, schemas: dict[str, dict] | None = None) -> DataFrame:
    """`link` over `turn_calls`."""
    return link(*turn_calls(conversations), schemas or SCHEMAS)


ORACLE_SQL = r"""
WITH t AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS nr, lead(text) OVER w AS nt,
  last_value(CASE WHEN role = 'assistant' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
c AS (SELECT *, CASE WHEN contains(text, chr(10)) THEN 'write' ELSE 'reply' END AS name, CASE WHEN contains(text, chr(10)) THEN 1500 ELSE 400 END AS most, CASE WHEN nr = 'user' THEN nt END AS result FROM t WHERE role = 'assistant'),
j AS (SELECT conv_id, count(*)::INT AS calls, count(result)::INT AS answered, count_if(length(text) > most)::INT AS faulty,
  string_agg('{"arguments":{' || CASE WHEN before IS NULL THEN '' ELSE '"after":{"$ref":"' || md5(conv_id || ':' || before) || '"},' END || '"length":' || length(text) || ',"text":' || to_json(text)::VARCHAR
    || '},"errors":[' || CASE WHEN length(text) > most THEN '"length: above ' || most || '"' ELSE '' END || '],"id":"' || md5(conv_id || ':' || turn) || '","name":"' || name || '","result":' || coalesce(to_json(result)::VARCHAR, 'null') || ',"turn":' || turn || '}', ',' ORDER BY turn) AS a
  FROM c GROUP BY conv_id),
m AS (SELECT conv_id, string_agg('{"content":' || to_json(text)::VARCHAR || ',"role":' || to_json(role)::VARCHAR || ',"turn":' || turn || '}', ',' ORDER BY turn) AS b FROM t GROUP BY conv_id)
SELECT conv_id, coalesce(calls, 0)::INT AS calls, coalesce(answered, 0)::INT AS answered, coalesce(faulty, 0)::INT AS faulty, '{"calls":[' || coalesce(a, '') || '],"conv_id":' || conv_id || ',"messages":[' || b || ']}' AS formatted FROM m LEFT JOIN j USING (conv_id)
"""
