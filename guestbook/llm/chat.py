"""Chat formatting: tool calls linked to their results, in topological order, as canonical JSON.

Calls and results meet in a hash join on conversation and identifier. Per conversation the calls are ordered so
that each stands after the calls that it needs, else by turn and identifier; arguments are parsed and validated
against the schema of the tool; and the conversation is written as JSON with sorted keys, no spaces and no
escapes beyond what JSON asks for, so that equal conversations give equal bytes. A conversation is one result
row and the largest unit that a task holds; calls and results are brought together before, by the shuffle.

Defined results: of several results for a call or an orphaned identifier the smallest text counts, and the others
stand in ``repeated_results``, each distinct text with its copies, which ``n_repeated`` counts; of several calls with the same identifier the first by turn, name and arguments counts and the others are
``repeated``. A call without a result, a result without a call, arguments that are no JSON object, that break
their schema or name an unknown tool are kept and marked. Calls on a cycle of needs, and those that need them,
stand last in the order of turn and identifier, marked ``cyclic``; a need that is no call of the conversation is
ignored. Null texts are empty (of several results for a call a null text counts after all others), null roles ``unknown``, null turns come first. Rows with a null conversation
are conversations of their own, equal ones together. A call or result with a null identifier links with
nothing: every such result is an orphan of its own. Other columns are not read. Empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestbook.llm.batches import batch

KEYWORDS = set("type enum minimum maximum minLength maxLength required properties additionalProperties items title description default".split())
TYPES = {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}

CHAT = (
    "conv_id long, chat string, n_messages long, n_calls long, n_linked long, n_invalid long, n_orphans long,"
    " n_repeated long, n_cyclic long"
)


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _is(value, kind: str | None) -> bool:
    if kind in ("integer", "number"):
        return not isinstance(value, bool) and isinstance(value, int if kind == "integer" else (int, float))
    return kind is None or isinstance(value, TYPES[kind])


def check_schema(schema: dict, at: str = "") -> None:
    """Refuse what ``problems`` would pass over in silence: unknown keywords and unknown types."""
    if unknown := sorted(set(schema) - KEYWORDS):
        raise ValueError(f"{at or '/'}: {', '.join(unknown)} cannot be checked")
    kinds = schema.get("type")
    for kind in kinds if isinstance(kinds, list) else [kinds]:
        if kind is not None and kind not in (*TYPES, "integer", "number"):
            raise ValueError(f"{at or '/'}: {kind} is no type")
    for name, some in schema.get("properties", {}).items():
        check_schema(some, f"{at}/{name}")
    if "items" in schema:
        check_schema(schema["items"], f"{at}/items")


def problems(value, schema: dict, at: str = "") -> list[str]:
    """What breaks the schema: type, enum, minimum, maximum, minLength, maxLength, required, properties,
    additionalProperties and items are understood."""
    kinds, found = schema.get("type"), []
    kinds = kinds if isinstance(kinds, list) else [kinds]
    if not any(_is(value, kind) for kind in kinds):
        return [f"{at or '/'} is no {' or '.join(map(str, kinds))}"]
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at or '/'} is none of the choices")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            found.append(f"{at or '/'} is too small")
        if value > schema.get("maximum", value):
            found.append(f"{at or '/'} is too large")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        found.append(f"{at or '/'} has a wrong length")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}/{name} is missing" for name in schema.get("required", []) if name not in value]
        for name in sorted(value):
            if name in known:
                found += problems(value[name], known[name], f"{at}/{name}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}/{name} is unknown")
    if isinstance(value, list) and "items" in schema:
        found += [x for i, item in enumerate(value) for x in problems(item, schema["items"], f"{at}/{i}")]
    return found


def checked_arguments(name: str | None, arguments: str | None, schemas: dict[str, dict]) -> tuple[object, list[str]]:
    """The arguments as a value, or as the text that they are, and what is wrong with them."""
    try:
        value = json.loads(arguments or "", parse_constant=lambda word: float(word.replace("Infinity", "inf")), parse_int=_whole)
        canonical(value).encode()
        if name not in schemas:
            return value, ["the tool is unknown"]
        return value, problems(value, schemas[name])
    except RecursionError:
        return arguments or "", ["/ is too deep"]
    except ValueError:  # no JSON, a number that JSON does not have, or half of a surrogate pair
        return arguments or "", ["/ is no JSON"]


def _whole(digits: str) -> int | float:
    """A number of any length: one beyond what Python reads as a whole number becomes a float, or no JSON."""
    return int(digits) if len(digits) <= 4_300 else float(digits)


def topological(needs: dict[str, list[str]], order: dict[str, tuple]) -> tuple[list[str], set[str]]:
    """Identifiers, each after what it needs and else in the given order; then those that never get free."""
    after: dict[str, list[str]] = {}
    open_needs = {}
    for call, some in needs.items():
        some = {need for need in some if need in needs}
        open_needs[call] = len(some)
        for need in some:
            after.setdefault(need, []).append(call)
    free = [(order[call], call) for call, n in open_needs.items() if not n]
    heapq.heapify(free)
    out = []
    while free:
        _, call = heapq.heappop(free)
        out.append(call)
        for later in after.get(call, []):
            open_needs[later] -= 1
            if not open_needs[later]:
                heapq.heappush(free, (order[later], later))
    cyclic = set(needs) - set(out)
    return out + sorted(cyclic, key=lambda call: order[call]), cyclic


def _turn(value: int | None) -> tuple[bool, int]:
    return value is not None, value or 0


def formatted(messages: list[dict], calls: list[dict], schemas: dict[str, dict]) -> dict:
    """One conversation: messages by turn, then the linked calls in topological order, then orphaned results."""
    key = lambda x: (_turn(x["turn"]), x["name"] or "", x["arguments"] or "")
    called = sorted((x for x in calls if x["called"]), key=key)
    first, repeated = {}, []
    for n, call in enumerate(called):
        name = call["call_id"] if call["call_id"] is not None else f"\0{n}"
        if name in first:
            repeated.append(call)
        else:
            first[name] = call
    order, cyclic = topological(
        {name: call["needs"] or [] for name, call in first.items()},
        {name: (_turn(call["turn"]), name) for name, call in first.items()},
    )
    entries, invalid = [], 0
    for call, name in [(first[name], name) for name in order] + [(call, None) for call in repeated]:
        value, wrong = checked_arguments(call["name"], call["arguments"], schemas)
        invalid += bool(wrong)
        entry = {"id": call["call_id"], "name": call["name"], "arguments": value, "errors": wrong}
        if call["answered"] and name is not None:
            entry["result"] = call["result"] or ""
        marks = ["cyclic"] * (name in cyclic) + ["repeated"] * (name is None) + ["pending"] * ("result" not in entry)
        entries.append(entry | ({"marks": marks} if marks else {}))
    by_text = lambda x: (x["call_id"] or "", x["result"] or "", x["copies"] or 0)
    orphans = sorted((x for x in calls if not x["called"] and x["copies"] is None), key=by_text)
    again = sorted((x for x in calls if x["copies"] is not None), key=by_text)
    said = sorted(messages, key=lambda m: (_turn(m["turn"]), m["role"] or "", m["text"] or ""))
    chat = {
        "messages": [{"role": m["role"] or "unknown", "content": m["text"] or ""} for m in said],
        "tool_calls": entries,
        "orphans": [{"id": x["call_id"], "result": x["result"] or ""} for x in orphans],
    }
    if again:
        chat["repeated_results"] = [{"id": x["call_id"], "result": x["result"] or "", "copies": x["copies"]} for x in again]
    return {
        "chat": canonical(chat),
        "n_messages": len(messages),
        "n_calls": len(called),
        "n_linked": sum(call["answered"] for call in first.values()),
        "n_invalid": invalid,
        "n_orphans": len(orphans),
        "n_repeated": len(repeated) + sum(x["copies"] for x in again),
        "n_cyclic": len(cyclic),
    }


def _conversation(*values: str) -> Column:
    """A conversation's key; rows without a conversation go by their own values."""
    return F.when(F.col("conv_id").isNull(), F.xxhash64(*values)).alias("alone")


def linked_calls(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls (conv_id, turn, call_id, name, arguments, needs) with results (conv_id, call_id, content)."""
    calls = calls.select("conv_id", _conversation("turn", "call_id", "name", "arguments"), "turn", "call_id", "name", "arguments", "needs", F.lit(True).alias("called"))
    results = results.select("conv_id", "call_id", F.col("content").alias("result"))
    linkable = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    texts = results.filter(linkable).groupBy("conv_id", "call_id", "result").agg(F.count("*").alias("copies"))
    least = texts.groupBy("conv_id", "call_id").agg(F.min("result").alias("result"))
    answers = least.withColumn("answered", F.lit(True))
    again = texts.join(least.withColumnRenamed("result", "least"), ["conv_id", "call_id"])
    again = again.withColumn("copies", F.col("copies") - F.col("result").eqNullSafe(F.col("least")).cast("long"))
    joined = calls.join(answers.hint("shuffle_hash"), ["conv_id", "call_id"], "full")
    every = joined.unionByName(again.filter("copies > 0").drop("least"), allowMissingColumns=True)
    every = every.unionByName(results.filter(~linkable).withColumn("answered", F.lit(True)), allowMissingColumns=True)
    return every.select(
        "conv_id",
        F.when(F.col("conv_id").isNull(), F.coalesce("alone", F.xxhash64("call_id", "result"))).alias("alone"),
        F.struct(
            "turn",
            "call_id",
            "name",
            "arguments",
            "needs",
            "result",
            "copies",
            F.coalesce("called", F.lit(False)).alias("called"),
            F.coalesce("answered", F.lit(False)).alias("answered"),
        ).alias("call"),
    )


def chats(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per conversation: canonical JSON and counts of what was linked, invalid, orphaned, repeated
    or cyclic."""
    for schema in schemas.values():
        check_schema(schema)
    said = messages.select("conv_id", _conversation("turn", "role", "text"), F.struct("turn", "role", "text").alias("message"))
    both = said.unionByName(linked_calls(calls, results), allowMissingColumns=True)
    whole = both.groupBy("conv_id", "alone").agg(F.collect_list("message").alias("messages"), F.collect_list("call").alias("calls"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            pairs = zip(rows.column("messages").to_pylist(), rows.column("calls").to_pylist())
            found = [formatted(messages, calls, schemas) for messages, calls in pairs]
            columns = {
                name: pa.array([x[name] for x in found], pa.string() if name == "chat" else pa.int64())
                for name in ("chat", "n_messages", "n_calls", "n_linked", "n_invalid", "n_orphans", "n_repeated", "n_cyclic")
            }
            yield batch(conv_id=rows.column("conv_id"), **columns)

    return whole.mapInArrow(work, CHAT)
