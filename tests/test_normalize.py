"""Files of every format to published, validated trajectories."""

import json

import pytest
from pyspark.sql import functions as F

from skein.functions.canonical import redacted_text
from skein.plans.normalize import normalize
from skein.sources import captures, envelopes, sinks, wires

USER = {"role": "user", "content": "find the river"}
CALL = {"id": "c1", "type": "function", "function": {"name": "search", "arguments": '{"q": "river"}'}}
ASKED = {"role": "assistant", "content": "", "tool_calls": [CALL]}
FOUND = {"role": "tool", "tool_call_id": "c1", "content": "blue"}
SEARCH = {"type": "function", "function": {"name": "search", "description": "looks", "parameters": {"type": "object", "properties": {"q": {"type": "string"}}, "required": ["q"]}}}


def chat(messages, answer, at, end="stop", session="s1", **more):
    return {"path": "/v1/chat/completions", "session_id": session, "request_id": f"r{at}", "captured_at": f"2024-05-01T00:00:{at:02d}Z", "status_code": 200, "is_stream": False, "request_headers": {}, "request_body": {"model": "m", "messages": messages, "tools": [SEARCH]}, "response_body": {"object": "chat.completion", "model": "m", "choices": [{"index": 0, "finish_reason": end, "message": answer}]}} | more


FIRST = chat([USER], ASKED, 1, "tool_calls")
SECOND = chat([USER, ASKED, FOUND], {"role": "assistant", "content": "It is blue."}, 2)
BRANCH = chat([USER, ASKED, FOUND], {"role": "assistant", "content": "It is green."}, 3)
AGAIN = chat([USER, ASKED, FOUND], {"role": "assistant", "content": "It is blue."}, 4)
ALIEN = chat([USER], {"role": "assistant", "content": "hello"}, 5, session="", user_id="u9")
BROKEN = chat([USER], {"role": "assistant", "content": "cut"}, 6, "length", session="s2")
MESSAGES = {"path": "/v1/messages", "session_id": "s3", "captured_at": "2024-05-01T00:00:07Z", "status_code": 200, "request_headers": {}, "request_body": {"model": "c", "system": "be kind", "messages": [{"role": "user", "content": [{"type": "text", "text": "hi"}, {"type": "image", "source": {"type": "base64", "data": "AAAA"}}]}], "tools": []}, "response_body": [{"seq": 0, "event": "message_start", "data": {"type": "message_start", "message": {"model": "c", "role": "assistant", "content": []}}}, {"seq": 1, "event": "content_block_start", "data": {"type": "content_block_start", "index": 0, "content_block": {"type": "text", "text": ""}}}, {"seq": 2, "event": "content_block_delta", "data": {"type": "content_block_delta", "index": 0, "delta": {"type": "text_delta", "text": "hel"}}}, {"seq": 3, "event": "content_block_delta", "data": {"type": "content_block_delta", "index": 0, "delta": {"type": "text_delta", "text": "lo"}}}, {"seq": 4, "event": "message_delta", "data": {"type": "message_delta", "delta": {"stop_reason": "end_turn"}}}, {"seq": 5, "event": "message_stop", "data": {"type": "message_stop"}}]}
COUNT = MESSAGES | {"path": "/v1/messages/count_tokens", "response_body": {"input_tokens": 3}}


def responses(items, output, at, thread="main", **meta):
    return {"path": "/v1/responses", "captured_at": f"2024-05-01T00:01:{at:02d}Z", "status_code": 200, "request_headers": {}, "request_body": {"model": "o", "instructions": "work", "input": items, "tools": [{"type": "function", "name": "spawn_agent", "parameters": {"properties": {"task_name": {"type": "string"}}}}], "client_metadata": {"session_id": "s4", "thread_id": thread, **meta}}, "response_body": {"status": "completed", "model": "o", "output": output}}


GO = {"type": "message", "role": "user", "content": [{"type": "input_text", "text": "go"}]}
SPAWN = {"type": "function_call", "call_id": "k1", "name": "spawn_agent", "arguments": '{"task_name": "dig"}'}
DONE = {"type": "function_call_output", "call_id": "k1", "output": '{"task_name": "/root/dig"}'}
SAY = lambda t: {"type": "message", "role": "assistant", "content": [{"type": "output_text", "text": t}]}
PARENT = [responses([GO], [SPAWN], 1, turn_id="t1"), responses([GO, SPAWN, DONE], [SAY("done")], 3, turn_id="t2")]
CHILD = responses([{"type": "message", "role": "user", "content": "dig"}], [SAY("dug")], 2, "child", parent_thread_id="main", parent_turn_id="t1", subagent_marker='{"call_id":"k1"}')


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("in")
    for k, c in enumerate([FIRST, SECOND, BRANCH, AGAIN, ALIEN, BROKEN, MESSAGES, COUNT, *PARENT, CHILD]):
        (root / "a" / f"{k:02d}.json").parent.mkdir(exist_ok=True)
        (root / "a" / f"{k:02d}.json").write_text(json.dumps(c))
    (root / "bad.json").write_text("{nope")
    (root / "odd.json").write_text(json.dumps(FIRST | {"path": "/v1/models"}))
    return normalize(spark, str(root), "freerouter", str(tmp_path_factory.mktemp("work")))


def test_fold_and_dedup(run):
    rows = {r["source_path"]: r for r in run.trajectories.collect()}
    assert sorted(rows) == ["a/01.json", "a/02.json", "a/04.json", "a/06.json", "a/09.json", "a/10.json"]
    lineage = {r["representative"]: [o["source_ref"] for o in r["origins"]] for r in run.lineage.collect()}
    assert lineage["a/01.json"] == ["a/00.json", "a/01.json", "a/03.json"] and lineage["a/02.json"] == ["a/00.json", "a/02.json"]
    assert {(r["source_ref"], r["reason"]) for r in run.quarantine.collect()} == {("a/05.json", "snapshot_truncated"), ("a/07.json", "non_trajectory_operation"), ("bad.json", "invalid_json"), ("odd.json", "unsupported_endpoint")}
    blue = rows["a/01.json"]
    assert blue["disposition"] == "pass" and blue["completeness_tag"] == "complete_main_no_sub" and blue["total_rounds"] == 2 and blue["total_tool_calls"] == 1 and blue["tool_counts"] == {"search": 1}
    assert [t["name"] for t in blue["tools"]] == ["search"] and blue["reason_codes"] == []
    # find the river / search {"q":"river"} / search blue / It is blue. / search looks {schema}
    assert blue["total_tokens"] == 3 + (1 + 9) + (1 + 1) + 4 + 1 + 1 + _schema_tokens()
    assert {rows[k]["sub_session_id"] for k in ("a/01.json", "a/02.json")} == {0, 1}


def _schema_tokens():
    import re

    return len(re.findall(r"[A-Za-z0-9_]+|[^\w\s]", json.dumps(SEARCH["function"]["parameters"], separators=(",", ":"))))


def test_stream_and_media(run):
    row = next(r for r in run.trajectories.collect() if r["source_path"] == "a/06.json")
    said = [(m["role"], m["content"]) for m in run.messages.where("node_id = 'a/06.json'").orderBy("pos").collect()]
    assert said[0] == ("system", "be kind") and said[-1] == ("assistant", "hello") and said[1][1].startswith('hi{"source"')
    assert row["termination"] == "end_turn" and row["total_tokens"] == 2 + 1 + 1


def test_mounts(run):
    assert [(e["child_id"], e["parent_leaf"], e["call_id"]) for e in run.edges.collect()] == [("a/10.json", "a/09.json", "k1")]
    parent = next(r for r in run.trajectories.collect() if r["source_path"] == "a/09.json")
    assert parent["completeness_tag"] == "complete_main_with_complete_sub" and parent["children"] == ["a/10.json"] and parent["disposition"] == "pass"


def test_rollup(spark, tmp_path):
    bad = CHILD | {"response_body": {"status": "completed", "model": "o", "output": [{"type": "function_call", "call_id": "z", "name": "nothing", "arguments": "{}"}]}}
    for k, c in enumerate([*PARENT, bad]):
        (tmp_path / f"{k}.json").write_text(json.dumps(c))
    made = normalize(spark, str(tmp_path), "freerouter", str(tmp_path / "work"))
    rows = {r["source_path"]: r for r in made.trajectories.collect()}
    assert rows["2.json"]["tool_defs_tag"] == "incomplete" and rows["2.json"]["parent_id"] == "1.json"
    parent = rows["1.json"]
    assert parent["tool_defs_tag"] == "complete_with_incomplete_sub" and parent["tool_call_tag"] == "consistent_with_inconsistent_sub"
    assert "subagent_quality_failure" in parent["reason_codes"] and parent["disposition"] == "quarantined" and parent["completeness_tag"] == "complete_main_with_complete_sub"


def test_publish_validate_inspect(spark, run, tmp_path):
    out = str(tmp_path / "out")
    manifest = sinks.publish(spark, run, out, "in", "freerouter")
    assert manifest["record_count"] == 5 and manifest["counts"]["skip_reason_counts"] == {"invalid_json": 1, "unsupported_endpoint": 1}
    assert manifest["counts"]["quarantined_records"] == 2 and manifest["counts"]["excluded_records"] == 1 and manifest["counts"]["input_files"] == 13
    assert sinks.validate(spark, out) == []
    parent = next(json.loads((tmp_path / "out" / f["path"]).read_text()) for f in manifest["files"] if f["path"].startswith("s4"))
    assert parent["sub_agent_trajectory"]["k1"]["messages"][-1]["content"] == "dug"
    ids = {r["source_path"]: r["trajectory_id"] for r in run.trajectories.collect()}
    found = sinks.inspect(spark, out, ids["a/09.json"])
    assert found["representative"] == "a/09.json" and [o["source_ref"] for o in found["origins"]] == ["a/08.json", "a/10.json", "a/09.json"] and sinks.inspect(spark, out, "no") is None
    assert parent["metadata"]["session_id"] == "s4" and parent["tool_call_check"]["total_calls"] == 1 and "completeness" not in parent["sub_agent_trajectory"]["k1"]
    again = sinks.publish(spark, run, out, "in", "freerouter")
    assert [f["sha256"] for f in again["files"]] == [f["sha256"] for f in manifest["files"]]
    assert sinks.rewrite_clock(spark, out)["completed_at_ms"] >= again["completed_at_ms"] and sinks.validate(spark, out) == []
    (tmp_path / "out" / "stray.jsonl").write_text("{}")
    name = manifest["files"][-1]["path"]
    (tmp_path / "out" / name).write_text("{}")
    (tmp_path / "out" / f".{name}.crc").unlink(missing_ok=True)
    errors = sinks.validate(spark, out)
    assert any(e.startswith("unlisted file") for e in errors) and f"changed file: {name}" in errors
    assert captures.verified(spark, out, manifest).where("NOT intact").count() == 1
    sinks.publish_rows(run, str(tmp_path / "rows"))
    assert spark.read.json(str(tmp_path / "rows" / "trajectories")).count() == 5


def test_sxf_lines(spark, tmp_path):
    import zstandard

    text = "event: message\ndata: " + json.dumps({"object": "chat.completion.chunk", "id": "x", "model": "m", "choices": [{"index": 0, "delta": {"role": "assistant", "content": "he"}}]}) + "\n\n: ping\n\ndata: " + json.dumps({"object": "chat.completion.chunk", "choices": [{"index": 0, "delta": {"content": "y", "tool_calls": [{"index": 0, "id": "c", "function": {"name": "f", "arguments": "{"}}, {"index": 0, "function": {"arguments": "}"}}]}, "finish_reason": "tool_calls"}]}) + "\n\ndata: [DONE]\n"
    text = text.replace("event: message\n", "")
    raw = {"schema": "tap_raw_capture_record.v1", "capture_id": "q", "started_at": "2024-01-01T00:00:00Z", "path": "/v1/chat/completions", "status_code": 200, "request_headers": {"Session-Id": ["z"], "Cookie": ["no"]}, "request_body": {"model": "m", "messages": [USER]}, "response_body": text}
    other = {"capture_meta": {"status_code": 200, "agent_kind": "bot"}, "path": "/v1/chat/completions", "created_at": "t", "conversation_session_id": "w", "user_id": "u", "request_body": {"messages": [USER]}, "response_body": json.dumps(FIRST["response_body"])}
    packed = b"".join(zstandard.compress("".join(json.dumps(x) + "\r\n" for x in part).encode()) for part in ([raw], [other, {"x": 1}]))
    (tmp_path / "day").mkdir()
    (tmp_path / "day" / "f.jsonl.zst").write_bytes(packed)
    rows = captures.parse_captures(captures.read(spark, str(tmp_path), "sxf"), "sxf").orderBy("source_ref").collect()
    assert [r["source_ref"] for r in rows] == [f"day/f.jsonl.zst#L0000000{k}" for k in (1, 2, 3)]
    assert rows[0]["session_id"] == "z" and rows[0]["response"][0]["content"] == "hey" and rows[0]["response"][0]["tool_calls"][0]["arguments"] == "{}" and rows[0]["outcome"] == "success"
    assert rows[1]["harness"] == "bot" and rows[1]["user_id"] == "u" and rows[2]["reason"] == "unrecognized_sxf_envelope"


def test_tokenplan():
    plan = {"client_request": {"path": "/v1/messages", "protocol": "anthropic_messages", "capture": {"status": "COMPLETE", "body": {"messages": [{"role": "user", "content": 'see $media_ref:p1 and {"$media_ref": "p2"}'}]}}, "media": [{"part_id": "p1", "object_name": "o1"}, {"part_id": "p2", "object_name": "o2"}]}, "client_response": {"capture": {"status": "COMPLETE", "body": {"type": "message", "content": []}, "format": "ANTHROPIC_MESSAGES_NORMALIZED"}}, "metadata": {"request_id": "r", "session_id": "s", "task_id": "t", "received_at_ms": 1500, "http_status_code": 200, "data_quality": envelopes.WHOLE}}
    own = envelopes.adapt(plan, "tokenplan")
    assert own["captured_at"] == "1970-01-01T00:00:01.500Z" and own["session_id"] == "s" and own["turn_id"] == "t" and own["normalized_final"]
    assert own["media"] == [{"part_id": "p1", "object_name": "o1"}, {"part_id": "p2", "object_name": "o2"}]
    for wrong in ({}, {"metadata": {}}, plan | {"metadata": plan["metadata"] | {"http_status_code": True}}, plan | {"client_request": plan["client_request"] | {"media": []}}):
        with pytest.raises(envelopes.EnvelopeError):
            envelopes.adapt(wrong, "tokenplan")


def test_deepinfra():
    own = {"request_id": "r", "request_time": "t", "request": {"path": "/v1/chat/completions", "headers": {"X-Session-Id": "<SENSITIVE>", "Thread-Id": "th"}, "body": json.dumps({"messages": [USER], "metadata": {"session_id": "<redacted>", "user_id": '{"user_id": "***", "id": "u"}'}})}, "response": {"status_code": 200, "body": json.dumps(FIRST["response_body"])}}
    out = wires.snapshot(envelopes.adapt(own, "deepinfra"), "p", "h", "deepinfra")
    assert out["session_id"] == "" and out["thread_id"] == "th" and out["user_id"] == "u"
    assert {"metadata_session_id_masked", "metadata_user_id_masked"} <= {i["code"] for i in out["issues"]}
    with pytest.raises(envelopes.EnvelopeError, match="incomplete"):
        envelopes.adapt(own | {"response": {"status_code": 200, "body": "x", "body_truncated": True}}, "deepinfra")


@pytest.mark.parametrize(
    ("change", "outcome", "code"),
    [
        ({"status_code": 0}, "transport_error", "missing_http_status"),
        ({"status_code": 500, "response_body": {"error": {"type": "overloaded", "code": "x y"}}}, "api_error", "openai_api_error"),
        ({"response_body": "{"}, "capture_invalid", "invalid_response_json"),
        ({"response_body": {"choices": []}}, "capture_invalid", "invalid_chat_choice_count"),
        ({"response_body": {"choices": [{"finish_reason": "odd", "message": {"role": "assistant"}}]}}, "capture_invalid", "invalid_chat_finish_reason"),
        ({"request_body": {"messages": [FOUND]}}, "capture_invalid", "orphan_tool_result"),
        ({"request_body": {"messages": [{"role": "robot"}]}}, "capture_invalid", "unsupported_message_role"),
    ],
)
def test_chat_outcomes(change, outcome, code):
    own = wires.snapshot(SECOND | change, "p", "h")
    assert own["outcome"] == outcome and code in [i["code"] for i in own["issues"]] and own["wire_complete"] is False


def test_responses_items():
    items = [GO, {"type": "reasoning", "summary": [{"type": "summary_text", "text": "hm"}]}, SPAWN, {"type": "web_search_call", "id": "w", "status": "completed", "action": {"query": "x"}, "result": {"n": 1}}, DONE, {"type": "agent_message", "id": "m", "author": "/root/dig", "recipient": "/root"}, {"type": "compaction", "encrypted_content": "zz"}, {"type": "shell_call"}, {"type": "mystery"}]
    own = wires.snapshot(responses(items, [SAY("a"), SAY("b")], 1), "p", "h")
    assert [(m["role"], m["reasoning_content"], [c["name"] for c in m["tool_calls"] or ()]) for m in own["history"]] == [("user", None, []), ("assistant", "hm", ["spawn_agent"]), ("tool", None, [])]
    assert [m["content"] for m in own["response"]] == ["a", "b"] and own["server_tool_calls"][0]["result"] == '{"result":{"n":1}}'
    assert own["agent_messages"][0]["preceding"] == ["k1"] and len(own["compaction_items"]) == 1
    assert {"ambiguous_tool_execution", "unknown_response_item"} <= {i["code"] for i in own["issues"]} and own["outcome"] == "capture_invalid" and own["wire_complete"]


def test_responses_stream():
    frames = [{"type": "response.output_item.added", "output_index": 0, "sequence_number": 1, "item": {"type": "message", "role": "assistant", "content": []}}, {"type": "response.output_text.delta", "output_index": 0, "sequence_number": 2, "delta": "x"}, {"type": "response.output_item.done", "output_index": 0, "sequence_number": 3, "item": SAY("xy")}, {"type": "response.completed", "sequence_number": 4, "response": {"status": "completed", "model": "o"}}]
    own = wires.snapshot(responses([GO], [], 1) | {"response_body": frames}, "p", "h")
    assert own["outcome"] == "success" and own["response"][0]["content"] == "xy"
    gap = wires.snapshot(responses([GO], [], 1) | {"response_body": [frames[0], *frames[2:]]}, "p", "h")
    assert gap["outcome"] == "capture_invalid" and "sse_sequence_gap" in [i["code"] for i in gap["issues"]]
    cut = wires.snapshot(responses([GO], [], 1) | {"response_body": frames[:-1]}, "p", "h")
    assert cut["outcome"] == "truncated" and not cut["wire_complete"]


def test_redaction():
    for text, hidden in [("Authorization: Bearer abcdef123", "abcdef123"), ("postgres://me:pw@host/x", "pw"), ("api_key=zzz", "zzz"), ("sk-abcdefgh12", "sk-abc"), ("from 10.1.2.3 to ::1", "10.1.2.3"), ("eyJhb.eyJzd.abc", "eyJhb")]:
        out = redacted_text(text)
        assert hidden not in out and redacted_text(out) == out
    assert redacted_text("version 1.2.3.999") == "version 1.2.3.999" and len(redacted_text("x" * 5000)) == 1024 + len("...[TRUNCATED]")


def test_object_locations():
    assert captures.object_location("s3://bucket-1/a/b/") == ("bucket-1", "a/b")
    for bad in ("http://x/y", "s3://B/x", "s3://bucket/../x", "s3://bucket//x"):
        with pytest.raises(ValueError):
            captures.object_location(bad)


def test_discovery(spark, tmp_path):
    for name in ("a/req_1.json", "b/c/req_2.json", "x.json", "y.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("{}")
    assert captures.discover(spark, str(tmp_path), "tokenplan").count() == 2
    raw = captures.read(spark, str(tmp_path), "freerouter").orderBy("source_ref")
    assert [r["source_ref"] for r in raw.collect()] == ["a/req_1.json", "b/c/req_2.json", "x.json"]
    assert raw.select(F.count_distinct("sha256")).first()[0] == 1


def test_resume(spark, tmp_path):
    root, work = tmp_path / "in", str(tmp_path / "work")
    root.mkdir()
    (root / "a.json").write_text(json.dumps(FIRST))
    (root / "b.json").write_text(json.dumps(ALIEN))
    assert normalize(spark, str(root), "freerouter", work).trajectories.count() == 2
    (root / "a.json").write_text(json.dumps(SECOND))
    (root / "b.json").unlink()
    (root / "c.json").write_text(json.dumps(BRANCH))
    rows = normalize(spark, str(root), "freerouter", work, resume=True)
    assert sorted(r["source_path"] for r in rows.trajectories.collect()) == ["a.json", "c.json"]


def test_labels_of_published(spark, run, tmp_path):
    from skein.operators.labels import LabelJob, Taxonomy
    from skein.plans.label import label

    out, cache = str(tmp_path / "out"), str(tmp_path / "cache")
    sinks.publish(spark, run, out, "in", "freerouter")
    answer = json.dumps({"scenarios": ["s"], "capabilities": ["c"], "subjects": ["j"]})
    job = LabelJob(Taxonomy(("s",), ("c",), ("j",)), lambda: lambda prompt: answer)
    assert label(spark, out, str(tmp_path / "one"), job, cache) == {"input_trajectories": 5, "classified": 3, "failed": 0, "skipped_no_toolcall": 2, "cache_hits": 0, "context_truncated": 0}
    again = label(spark, out, str(tmp_path / "two"), LabelJob(job.taxonomy, lambda: lambda prompt: 1 / 0), cache)
    assert again["classified"] == 3 and again["cache_hits"] == 3
    rows = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "one" / "trajectories")).collect()]
    assert sorted(r["classification"]["status"] for r in rows) == ["accepted"] * 3 + ["skipped"] * 2


def test_command_line(spark, tmp_path, capsys):
    from skein.__main__ import main

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(SECOND))
    out = str(tmp_path / "out")
    assert main(["normalize", "--input", str(tmp_path / "in"), "--output", out, "--work", str(tmp_path / "work")]) == 0
    assert json.loads(capsys.readouterr().out)["accepted"] == 1
    assert main(["validate", "--output", out]) == 0 and main(["inspect", "--output", out, "none"]) == 1


def test_record_contract():
    from skein.plans.published import record_errors

    assert record_errors([]) == ["$ is not an object"]
    assert "$.messages is missing" in record_errors({"odd": 1}) and "$.odd is unknown" in record_errors({"odd": 1})


def test_client():
    import io
    import urllib.error

    from skein.operators.labels import ContextTooLong
    from skein.sources.client import ChatClient, ConfigurationError, ServiceError

    good = lambda: io.BytesIO(json.dumps({"choices": [{"message": {"content": "ok"}}]}).encode())
    fault = lambda status, text="", **h: urllib.error.HTTPError("u", status, "", h, io.BytesIO(text.encode()))

    def client(*steps, **more):
        left, waits = list(steps), []

        def opener(request, timeout):
            step = left.pop(0)
            if isinstance(step, Exception):
                raise step
            return step

        return ChatClient("https://x/y", "m", "k", opener=opener, sleep=waits.append, jitter=lambda: 1.0, **more), waits

    own, waits = client(fault(429, **{"Retry-After": "7"}), fault(503), urllib.error.URLError("x"), io.BytesIO(b"{}"), good())
    assert own("p") == "ok" and waits == [7.0, 2.0, 4.0, 8.0]
    for step, kind in ((fault(401), ConfigurationError), (fault(400), ServiceError), (fault(413, "maximum context length"), ContextTooLong), (fault(413, "no word of it"), ContextTooLong)):
        with pytest.raises(kind):
            client(step)[0]("p")
    with pytest.raises(ServiceError, match="rate_limit_exhausted"):
        client(*[fault(429)] * 3, retries=2)[0]("p")
    with pytest.raises(ConfigurationError):
        ChatClient("file://x", "m", "k")
    assert "k'" not in repr(client()[0])
