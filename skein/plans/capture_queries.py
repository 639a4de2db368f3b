"""Queries over captures with tool calls, streams, defects and envelopes, and over what is derived from them."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import canonical, markers, names
from ..operators import quality
from ..sources import captures, envelopes
from . import inputs
from .queries import query

#: One question and one answer of each conversation; three wire formats go by turns.
PAIRS = f"SELECT conv_id, min(CASE WHEN role = 'user' THEN text END) AS asked, min(CASE WHEN role = 'assistant' THEN text END) AS said FROM ({inputs.TURNS}) AS t GROUP BY conv_id HAVING min(CASE WHEN role = 'user' THEN text END) <> '' AND min(CASE WHEN role = 'assistant' THEN text END) <> ''"
OPERATION = "CASE conv_id % 3 WHEN 0 THEN 'chat_completions' WHEN 1 THEN 'messages' ELSE 'responses' END"
PATHS = ("/v1/chat/completions", "/v1/messages", "/v1/responses")
LOOK = {"type": "object", "properties": {"q": {"type": "string"}}, "required": ["q"]}


def _raw(spark, sf_dir, build, rows: str = PAIRS) -> DataFrame:
    """``build(conv_id, asked, said)`` as the payload of a capture for each conversation."""

    @F.pandas_udf(T.StringType())
    def payload(x: pd.DataFrame) -> pd.Series:
        return pd.Series([own if isinstance(own := build(*r), str) else json.dumps(own) for r in zip(x["conv_id"], x["asked"], x["said"], strict=True)])

    found = inputs.derive(spark, sf_dir, rows).withColumn("payload", payload(F.struct("conv_id", "asked", "said")))
    return found.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("source_ref"), "payload", F.sha2("payload", 256).alias("sha256"))


def _base(conv: int, **more) -> dict:
    return {"path": PATHS[conv % 3], "session_id": f"s{conv}", "captured_at": "2024-01-01T00:00:00Z", "request_id": f"r{conv}", "status_code": 200, "request_headers": {}} | more


def _with_calls(conv: int, asked: str, said: str) -> dict:
    """A question, a call with its result, and an answer that calls again, with arguments that are no JSON."""
    if conv % 3 == 0:
        call = lambda i, arguments: {"id": i, "type": "function", "function": {"name": "look", "arguments": arguments}}
        request = [{"role": "user", "content": asked}, {"role": "assistant", "content": None, "tool_calls": [call("k1", '{"q": "x", "a": 1}')]}, {"role": "tool", "tool_call_id": "k1", "content": said}]
        tools = [{"type": "function", "function": {"name": "look", "description": "d", "parameters": LOOK}}]
        answer = {"role": "assistant", "content": said, "tool_calls": [call("k2", "not json")]}
        return _base(conv, request_body={"model": "m", "messages": request, "tools": tools}, response_body={"object": "chat.completion", "model": "m", "choices": [{"index": 0, "finish_reason": "tool_calls", "message": answer}]})
    if conv % 3 == 1:
        request = [{"role": "user", "content": asked}, {"role": "assistant", "content": [{"type": "tool_use", "id": "k1", "name": "look", "input": {"q": "x", "a": 1}}]}, {"role": "user", "content": [{"type": "tool_result", "tool_use_id": "k1", "content": [{"type": "text", "text": said}]}]}]
        answer = [{"type": "thinking", "thinking": "hm"}, {"type": "text", "text": said}, {"type": "tool_use", "id": "k2", "name": "look", "input": {"raw": "not json"}}]
        return _base(conv, request_body={"model": "m", "messages": request, "tools": [{"name": "look", "description": "d", "input_schema": LOOK}]}, response_body={"type": "message", "model": "m", "stop_reason": "tool_use", "content": answer})
    call = lambda i, arguments: {"type": "function_call", "call_id": i, "name": "look", "arguments": arguments}
    request = [{"type": "message", "role": "user", "content": [{"type": "input_text", "text": asked}]}, call("k1", '{"q": "x", "a": 1}'), {"type": "function_call_output", "call_id": "k1", "output": said}]
    answer = [{"type": "message", "role": "assistant", "content": [{"type": "output_text", "text": said}]}, call("k2", "not json")]
    return _base(conv, request_body={"model": "m", "input": request, "tools": [{"type": "function", "name": "look", "description": "d", "parameters": LOOK}]}, response_body={"status": "completed", "model": "m", "output": answer})


@query(f"""SELECT 'c' || conv_id AS source_path, {OPERATION} AS operation, 'success' AS outcome, 'user,assistant,tool,assistant' AS roles, 'k1=look={{"a":1,"q":"x"}}|k2=look={{"raw":"not json"}}' AS calls,
  'k1=look=' || CASE WHEN conv_id % 3 = 1 THEN '[{{"text":' || to_json(said) || ',"type":"text"}}]' ELSE said END AS results, 'look=d' AS tools, asked AS first_text, said AS last_text, CASE WHEN conv_id % 3 = 1 THEN 'hm' ELSE '' END AS thought FROM ({PAIRS})""")
def wire_tool_calls(spark, sf_dir):
    """Calls, results and definitions of the three formats come out alike; arguments that are no JSON are kept as ``raw``."""
    out = captures.parse_captures(_raw(spark, sf_dir, _with_calls), "freerouter").withColumn("m", F.concat("history", "response"))
    joined = lambda x, sep: F.array_join(x, sep)
    calls = F.flatten(F.transform("m", lambda m: F.coalesce(F.transform(m["tool_calls"], lambda c: F.concat_ws("=", c["id"], c["name"], c["arguments"])), F.array().cast("array<string>"))))
    results = F.transform(F.filter("m", lambda m: m["role"] == "tool"), lambda m: F.concat_ws("=", m["tool_call_id"], m["name"], m["content"]))
    last = F.element_at("m", -1)
    return out.select(
        "source_path", "operation", "outcome", joined(F.transform("m", lambda m: m["role"]), ",").alias("roles"), joined(calls, "|").alias("calls"), joined(results, "|").alias("results"),
        joined(F.transform("tools", lambda t: F.concat_ws("=", t["name"], t["description"])), "|").alias("tools"), F.col("m")[0]["content"].alias("first_text"), last["content"].alias("last_text"), F.coalesce(last["reasoning_content"], F.lit("")).alias("thought"),
    )


def _event(name: str, data: dict) -> str:
    return f"event: {name}\n" + "".join(f"data: {line}\n" for line in json.dumps(data | {"type": name}, indent=1).split("\n")) + "\n"


def _stream(conv: int, said: str) -> str:
    """An answer word by word, as the format of the conversation streams it; data goes over several lines, with comments between."""
    words = [w + " " * (k < said.count(" ")) for k, w in enumerate(said.split(" "))]
    if conv % 3 == 0:
        chunk = lambda delta, end=None: "data: " + json.dumps({"object": "chat.completion.chunk", "model": "m", "choices": [{"index": 0, "delta": delta, "finish_reason": end}]}) + "\r\n\r\n"
        return ": hello\n\n" + chunk({"role": "assistant"}) + "".join(chunk({"content": w}) for w in words) + chunk({}, "stop") + "data: [DONE]\n\n"
    if conv % 3 == 1:
        start = _event("message_start", {"message": {"model": "m", "role": "assistant", "content": []}}) + _event("content_block_start", {"index": 0, "content_block": {"type": "text", "text": ""}})
        return start + "".join(_event("content_block_delta", {"index": 0, "delta": {"type": "text_delta", "text": w}}) for w in words) + _event("content_block_stop", {"index": 0}) + _event("message_delta", {"delta": {"stop_reason": "end_turn"}}) + _event("message_stop", {})
    said_item = {"type": "message", "role": "assistant", "content": [{"type": "output_text", "text": said}]}
    steps = [("response.output_item.added", {"output_index": 0, "item": {"type": "message", "role": "assistant", "content": []}})]
    steps += [("response.output_text.delta", {"output_index": 0, "content_index": 0, "delta": w}) for w in words]
    steps += [("response.output_item.done", {"output_index": 0, "item": said_item}), ("response.completed", {"response": {"status": "completed", "model": "m"}})]
    return "".join(_event(name, data | {"sequence_number": k}) for k, (name, data) in enumerate(steps))


def _asked(conv: int, asked: str) -> dict:
    if conv % 3 == 2:
        return {"model": "m", "input": [{"type": "message", "role": "user", "content": asked}]}
    return {"model": "m", "messages": [{"role": "user", "content": asked}]}


def _streamed(conv: int, asked: str, said: str) -> dict:
    return {"schema": envelopes.RAW_SCHEMA, "path": PATHS[conv % 3], "capture_id": f"q{conv}", "started_at": "2024-01-01T00:00:00Z", "status_code": 200, "request_headers": {"Session-Id": f"s{conv}"}, "request_body": _asked(conv, asked), "response_body": _stream(conv, said)}


@query(f"SELECT 'c' || conv_id AS source_path, {OPERATION} AS operation, 'success' AS outcome, TRUE AS wire_complete, 's' || conv_id AS session_id, 'q' || conv_id AS request_id, said AS text, 0 AS n_issues FROM ({PAIRS})")
def wire_streams(spark, sf_dir):
    """Streams of the three formats fold to the answer that they say word by word."""
    out = captures.parse_captures(_raw(spark, sf_dir, _streamed), "sxf")
    return out.select("source_path", "operation", "outcome", "wire_complete", "session_id", "request_id", F.element_at("response", -1)["content"].alias("text"), F.size("issues").alias("n_issues"))


def _defective(conv: int, asked: str, said: str):
    """Eight captures that lack something, by conversation."""
    kind, conv = conv % 8, 3 * conv + (0, 2, 1, 2, 0, 0, 1, 2)[conv % 8]
    own = _base(conv, request_body=_asked(conv, asked))
    if kind == 0:
        return own | {"status_code": 500, "response_body": {"error": {"type": "server_error", "code": "boom"}}}
    if kind == 1:
        return own | {"response_body": {"status": "incomplete", "model": "m", "output": [{"type": "message", "role": "assistant", "content": [{"type": "output_text", "text": said}]}]}}
    if kind == 2:
        return own | {"response_body": [{"type": "message_start", "message": {"model": "m"}}]}
    if kind == 3:
        frames = envelopes.events(_stream(conv, said))
        return own | {"response_body": [*frames[:1], *frames[2:]]}
    if kind == 4:
        return own | {"path": "/v1/models", "response_body": {}}
    if kind == 5:
        return '{"path": "/v1/chat/completions", '
    if kind == 6:
        return own | {"path": "/v1/messages/count_tokens", "response_body": {"input_tokens": 3}}
    return own | {"response_body": {"status": "completed", "model": "m", "output": [{"type": "unheard_of"}]}}


def _seen(conv: str, values: str) -> str:
    return f"CASE {conv} % 8 " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values.split("|"))) + " END"


@query(f"SELECT 'c' || conv_id AS source_ref, {_seen('conv_id', "'api_error'|'truncated'|'truncated'|'capture_invalid'|NULL|NULL|'success'|'capture_invalid'")} AS outcome, conv_id % 8 IN (4, 5) AS refused, coalesce({_seen('conv_id', "FALSE|FALSE|FALSE|FALSE|NULL|NULL|TRUE|TRUE")}, FALSE) AS wire_complete, conv_id % 8 = 3 AS gap FROM ({PAIRS})")
def wire_defects(spark, sf_dir):
    """What becomes of answers that are faults, cut, gapped, of unknown parts, and of captures that no parser takes."""
    out = captures.parse_captures(_raw(spark, sf_dir, _defective), "freerouter")
    gap = F.coalesce(F.exists("issues", lambda i: i["code"] == "sse_sequence_gap"), F.lit(False))
    return out.select("source_ref", "outcome", F.col("reason").isNotNull().alias("refused"), F.coalesce("wire_complete", F.lit(False)).alias("wire_complete"), gap.alias("gap"))


def _chat_answer(said: str) -> dict:
    return {"object": "chat.completion", "model": "m", "choices": [{"index": 0, "finish_reason": "stop", "message": {"role": "assistant", "content": said}}]}


def _enveloped(conv: int, asked: str, said: str) -> dict:
    request, kind = {"model": "m", "messages": [{"role": "user", "content": asked}]}, conv % 3
    if kind == 0:
        return {"capture_meta": {"status_code": 200, "agent_kind": "h"}, "path": PATHS[0], "created_at": "2024-01-01T00:00:00Z", "conversation_session_id": f"s{conv}", "request_body": request, "response_body": _chat_answer(said)}
    if kind == 1:
        told = {"request_id": f"r{conv}", "session_id": f"s{conv}", "completed_at_ms": 1_704_067_200_000 + conv, "http_status_code": 200, "data_quality": envelopes.WHOLE}
        return {"client_request": {"path": PATHS[0], "protocol": "openai_chat", "capture": {"status": "COMPLETE", "body": request}}, "client_response": {"capture": {"status": "COMPLETE", "body": _chat_answer(said), "format": envelopes.FINAL["/chat/completions"]}}, "metadata": told}
    return {"request_id": f"r{conv}", "request_time": "2024-01-01T00:00:00Z", "request": {"path": PATHS[0], "headers": {"X-Session-Id": f"s{conv}"}, "body": json.dumps(request)}, "response": {"status_code": 200, "body": json.dumps(_chat_answer(said))}}


@query(f"SELECT 'c' || conv_id AS source_path, 'chat_completions' AS operation, 'success' AS outcome, said AS text, CASE WHEN conv_id % 3 = 1 THEN strftime(make_timestamp((1704067200000 + conv_id) * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' ELSE '2024-01-01T00:00:00Z' END AS captured_at FROM ({PAIRS})")
def envelope_adapters(spark, sf_dir):
    """The same exchange in three envelopes, each read by its adapter."""
    raw = _raw(spark, sf_dir, _enveloped).withColumn("kind", F.substr("source_ref", F.lit(2)).cast("long") % 3)
    parts = [captures.parse_captures(raw.where(F.col("kind") == k).drop("kind"), source) for k, source in enumerate(("sxf", "tokenplan", "deepinfra"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("source_path", "operation", "outcome", F.element_at("response", -1)["content"].alias("text"), "captured_at")


# --- functions


@query(f"SELECT conv_id, arg_max(role, turn) = 'assistant' AND max(turn) % 3 <> 0 AS final FROM ({inputs.TURNS}) GROUP BY conv_id")
def final_turns(spark, sf_dir):
    """Conversations that end with an answer without calls; those whose last turn is a multiple of three have one call."""
    rows = inputs.derive(spark, sf_dir, inputs.TURNS).groupBy("conv_id").agg(F.max_by("role", "turn").alias("role"), F.max("turn").alias("turn"))
    return rows.select("conv_id", quality.final_turn(F.col("role"), F.when(F.col("turn") % 3 == 0, 1).otherwise(0)).alias("final"))


@query("""SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN '{"a":[1,2.5,null],"b":"é"}' WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN '{"a":2}' ELSE '123456789012345678901234567890' END AS text FROM supplier""")
def strict_json(spark, sf_dir):
    """JSON with constants that it doesn't have, or cut short, is none; of a repeated key the last counts; big integers stay."""
    texts = ('{"b": "\\u00e9", "a": [1, 2.50, null]}', '{"a": NaN}', '{"a": 1', '{"a": 1, "a": 2}', "123456789012345678901234567890")
    s = inputs.table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", canonical.canonical_json(F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("s_suppkey") % 5 + 1).cast("int"))).alias("text"))


def _part(column: str) -> str:
    return f"coalesce(length({column})::VARCHAR, '-') || ':' || coalesce({column}, '')"


@query(f"SELECT doc_id, sha256({_part('lang')} || {_part('nullif(source, ' + repr('src0') + ')')} || {_part('left(text, 200)')}) AS digest FROM documents")
def digests(spark, sf_dir):
    """Digests of parts, each behind its length; a null part is not an empty one."""
    d = inputs.table(spark, sf_dir, "documents")
    return d.select("doc_id", canonical.digest(F.col("lang"), F.nullif("source", F.lit("src0")), F.left("text", F.lit(200))).alias("digest"))


@query(f"SELECT node_id, pos, CASE WHEN name IN ('tool_0', 'tool_1') OR name = 'tool_2' THEN 'spawn_agent' ELSE name END || chr(31) || CASE WHEN pos % 4 = 0 THEN 'raw:' || call_id ELSE arguments END AS signature FROM ({inputs.CALLS})")
def spawn_signatures(spark, sf_dir):
    """One signature for a spawn call under any of its names."""
    calls = inputs.derive(spark, sf_dir, inputs.CALLS)
    alias = F.when(F.col("name") == "tool_0", "Agent").when(F.col("name") == "tool_1", "spawn_agent").when(F.col("name") == "tool_2", "team.spawn_agent").otherwise(F.col("name"))
    return calls.select("node_id", "pos", markers.spawn_signature(alias, F.when(F.col("pos") % 4 == 0, F.col("call_id")).otherwise(F.col("arguments"))).alias("signature"))


@query("SELECT s_suppkey, 'f' || s_suppkey || CASE WHEN s_suppkey % 2 = 0 THEN '.json' ELSE '.jsonl' END AS file, CASE WHEN s_suppkey % 2 = 1 THEN s_suppkey ELSE 0 END AS line FROM supplier")
def source_references(spark, sf_dir):
    """Files and lines of source references, with folders and line marks."""
    s = inputs.table(spark, sf_dir, "supplier")
    ref = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("a/b#L7/f"), F.col("s_suppkey").cast("string"), F.lit(".json"))).otherwise(F.concat(F.lit("x/f"), F.col("s_suppkey").cast("string"), F.lit(".jsonl#L"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0")))
    return s.select("s_suppkey", names.source_file(ref).alias("file"), names.line_number(ref).alias("line"))
