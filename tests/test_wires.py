"""Defects and shapes of each wire format, one case each."""

import pytest

from skein.sources.envelopes import EnvelopeError, body, events, fold_chunks
from skein.sources.wires import WireError, snapshot

BASE = {"status_code": 200, "captured_at": "t", "session_id": "s"}


def messages(request=None, response=None, **more):
    answer = {"type": "message", "role": "assistant", "model": "c", "stop_reason": "end_turn", "content": [{"type": "text", "text": "ok"}]} if response is None else response
    return snapshot(BASE | {"path": "/v1/messages?beta=true", "request_body": {"messages": [{"role": "user", "content": "hi"}]} | (request or {}), "response_body": answer} | more, "p", "h")


def items(given=(), output=(), **more):
    return snapshot(BASE | {"path": "/v1/responses/", "request_body": {"input": list(given)}, "response_body": {"status": "completed", "output": list(output)}} | more, "p", "h")


def codes(own):
    return [i["code"] for i in own["issues"] if i["severity"] == "error"]


def blocks(*content):
    return {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": list(content)}]}


USE = {"type": "tool_use", "id": "c", "name": "f", "input": {"b": 1, "a": 2}}


@pytest.mark.parametrize(
    ("request_", "code"),
    [
        ({"messages": 1}, "invalid_messages"),
        ({"messages": [1]}, "invalid_message"),
        ({"messages": [{"role": "odd", "content": ""}]}, "unsupported_message_role"),
        ({"messages": [{"role": "user", "content": 5}]}, "invalid_user_content"),
        ({"messages": [{"role": "user", "content": [{"type": "tool_result", "content": "x"}]}]}, "invalid_tool_result"),
        ({"messages": [{"role": "user", "content": [{"type": "tool_result", "tool_use_id": "z", "content": "x"}]}]}, "orphan_tool_result"),
        (blocks({"type": "thinking"}), "invalid_thinking_block"),
        (blocks({"type": "text", "text": 1}), "invalid_text_block"),
        (blocks({"type": "odd"}), "unsupported_content_block"),
        (blocks(USE, USE), "duplicate_tool_call_id"),
        (blocks({"type": "tool_use", "name": "f", "input": {}}), "invalid_tool_call"),
        (blocks({"type": "web_search_tool_result", "tool_use_id": "q"}), "orphan_server_tool_result"),
        ({"tools": [{"name": "", "input_schema": {}}]}, "invalid_tool_definition"),
        ({"tools": [{"name": "f", "input_schema": 3}]}, "invalid_tool_schema"),
    ],
)
def test_message_defects(request_, code):
    own = messages(request_)
    assert code in codes(own) and own["outcome"] == "capture_invalid" and own["wire_complete"]


def test_message_shapes():
    own = messages({"system": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}], "messages": [{"role": "user", "content": [{"type": "text", "text": "x"}]}, {"role": "assistant", "content": [{"type": "thinking", "thinking": "hm"}, {"type": "redacted_thinking", "data": "zz"}, {"type": "text", "text": "t"}, USE, {"type": "server_tool_use", "id": "w", "name": "web_search", "input": {"q": 1}}, {"type": "web_search_tool_result", "tool_use_id": "w", "content": []}]}, {"role": "user", "content": [{"type": "tool_result", "tool_use_id": "c", "content": "r"}, {"type": "text", "text": "more"}]}]})
    assert [m["role"] for m in own["history"]] == ["system", "user", "assistant", "tool", "user"] and own["history"][0]["content"] == "ab"
    assert own["history"][2]["reasoning_content"] == "hm" and own["history"][2]["tool_calls"] == [{"id": "c", "name": "f", "arguments": '{"a":2,"b":1}'}] and own["history"][3]["name"] == "f"
    assert own["server_tool_calls"][0]["result"] is not None and own["outcome"] == "success" and own["termination"] == "end_turn"


@pytest.mark.parametrize(
    ("response", "outcome", "whole"),
    [
        ({"type": "error", "error": {"type": "x"}}, "api_error", False),
        ({"type": "message", "stop_reason": "max_tokens", "content": [{"type": "text", "text": "a"}]}, "truncated", False),
        ([{"type": "message_start", "message": {"model": "c"}}], "truncated", False),
        ([{"type": "message_start", "message": {}}, {"type": "message_stop"}, {"type": "message_delta", "delta": {}}], "capture_invalid", True),
        ("{", "capture_invalid", False),
        (7, "capture_invalid", False),
    ],
)
def test_message_outcomes(response, outcome, whole):
    own = messages(response=response)
    assert (own["outcome"], own["wire_complete"]) == (outcome, whole)


def test_streamed_tool_input():
    frames = [{"type": "message_start", "message": {"model": "c"}}, {"type": "content_block_start", "index": 0, "content_block": {"type": "tool_use", "id": "c", "name": "f", "input": {}}}, {"type": "content_block_delta", "index": 0, "delta": {"type": "input_json_delta", "partial_json": '{"a"'}}, {"type": "content_block_delta", "index": 0, "delta": {"type": "input_json_delta", "partial_json": ": 1}"}}, {"type": "message_delta", "delta": {"stop_reason": "tool_use"}}, {"type": "ping"}, {"type": "message_stop"}]
    own = messages(response=frames)
    assert own["response"][0]["tool_calls"][0]["arguments"] == '{"a":1}' and own["outcome"] == "success" and own["termination"] == "tool_use"


CALL = {"type": "function_call", "call_id": "c", "name": "f", "arguments": "{}"}
RESULT = {"type": "function_call_output", "call_id": "c", "output": "r"}


@pytest.mark.parametrize(
    ("given", "code"),
    [
        ([3], "invalid_response_item"),
        ([{"type": "message", "role": "odd", "content": ""}], "invalid_message_role"),
        ([{"type": "message", "role": "user", "content": 3}], "invalid_message_content"),
        ([{"type": "message", "role": "user", "content": [{"type": "odd"}]}], "unknown_content_part"),
        ([CALL, CALL], "duplicate_tool_call_id"),
        ([CALL, RESULT, RESULT], "duplicate_tool_result"),
        ([RESULT], "orphan_tool_result"),
        ([{"type": "function_call", "name": "f", "arguments": "{}"}], "missing_tool_call_id"),
        ([{"type": "function_call", "call_id": "c", "arguments": "{}"}], "missing_tool_name"),
        ([{"type": "function_call", "call_id": "c", "name": "f"}], "missing_tool_arguments"),
        ([{"type": "web_search_call"}], "missing_server_tool_id"),
        ([{"type": "agent_message", "id": "m", "author": "a"}], "invalid_agent_message_recipient"),
    ],
)
def test_item_defects(given, code):
    assert code in codes(items(given))


def test_item_shapes():
    own = items([{"role": "user", "content": [{"type": "input_text", "text": "a"}, {"type": "input_text", "text": "b"}]}, CALL, {"type": "custom_tool_call", "call_id": "d", "name": "g", "namespace": "n", "input": "free text"}, RESULT, {"type": "local_shell_call", "call_id": "e", "action": {"command": ["ls"]}}, {"type": "shell_call", "call_id": "g", "action": {}}, {"type": "tool_search_call", "execution": "server", "id": "z", "arguments": {}}, {"type": "tool_search_output", "execution": "server", "call_id": "z", "tools": []}])
    assert [m["role"] for m in own["history"]] == ["user", "assistant", "tool", "assistant"] and own["history"][0]["content"] == "a\nb"
    calls = [c for m in own["history"] for c in m["tool_calls"] or ()]
    assert [(c["name"], c["arguments"]) for c in calls] == [("f", "{}"), ("n.g", '{"raw":"free text"}'), ("local_shell", '{"command":["ls"]}'), ("shell", "{}")]
    assert [(c["name"], c["result"] is not None) for c in own["server_tool_calls"]] == [("tool_search", True)]


def test_rejected_call_is_evidence():
    own = items([CALL, RESULT | {"output": "unsupported call: f"}])
    assert [i["code"] for i in own["issues"] if i["severity"] == "warning" and i["stage"] == "responses"].count("responses_unsupported_tool_call") == 1 and own["outcome"] == "success"


def test_namespaced_tools():
    own = snapshot(BASE | {"path": "/responses", "request_body": {"input": "x", "tools": [{"type": "namespace", "name": "n", "tools": [{"type": "function", "name": "f", "parameters": {}}, {"type": "web_search"}]}, {"type": "web_search"}, {"type": "function", "name": "f", "parameters": {}}, {"type": "function", "name": "f", "parameters": {}}, {"type": "namespace"}]}, "response_body": {"output": []}}, "p", "h")
    assert [t["name"] for t in own["tools"]] == ["n.f", "web_search", "f"] and {"unsupported_namespace_tool", "invalid_namespace_definition"} <= set(codes(own))


@pytest.mark.parametrize(
    ("meta", "capture", "session", "conflict"),
    [
        ({"session_id": "a"}, {"session_id": "a"}, "a", False),
        ({"session_id": "a"}, {"session_id": "b"}, "a", True),
        ({"session_id": "no_session_id"}, {"session_id": "b"}, "b", False),
        ({"x-codex-turn-metadata": '{"session_id": "c"}'}, {"session_id": ""}, "c", False),
        ({"user_id": '{"session_id": "d", "user_id": "u"}'}, {"session_id": ""}, "d", False),
    ],
)
def test_sessions(meta, capture, session, conflict):
    own = snapshot(BASE | capture | {"path": "/v1/messages", "request_body": {"messages": [], "metadata": meta}, "response_body": {"type": "message", "content": []}}, "p", "h")
    assert own["session_id"] == session and ("metadata_conflict" in codes(own)) == conflict


def test_isolated_thread():
    own = messages({"metadata": {"parent_thread_id": "t"}})
    assert own["thread_id"] == "__isolated_subagent__:p" and "isolated_subagent_missing_thread_id" in [i["code"] for i in own["issues"]]
    assert messages({"metadata": {"subagent_marker": "main"}})["subagent_marker"] == ""


def test_endpoints():
    with pytest.raises(WireError):
        snapshot({"path": "/v1/embeddings"}, "p", "h")
    assert messages(path="/v1/messages/count_tokens")["operation"] == "count_tokens"


def test_events():
    text = 'event: a\ndata: {"x":\ndata: 1}\n\n: keep\nid: 4\n\ndata: [{"type":"b"},{"type":"c"}]\r\n\r\ndata: {"type":"d"}'
    assert events(text) == [{"x": 1, "type": "a"}, {"type": "b"}, {"type": "c"}, {"type": "d"}]
    for wrong in ("data: [DONE]\n\n", "data: {\n\n", 'event: a\ndata: {"type":"b"}\n\n', "data: 3\n\n"):
        with pytest.raises(EnvelopeError):
            events(wrong)
    assert body("/v1/responses", "plain") == "plain" and body("/v1/responses", '{"a":1}') == {"a": 1} and body("/x", None) is None
    with pytest.raises(EnvelopeError, match="missing_done"):
        body("/v1/chat/completions", 'data: {"object":"chat.completion.chunk"}\n\n')
    with pytest.raises(EnvelopeError):
        fold_chunks([{"object": "chat.completion.chunk", "choices": [{"index": -1}]}])
    with pytest.raises(EnvelopeError):
        fold_chunks([])
