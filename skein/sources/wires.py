"""Three providers' wire formats, read into one snapshot.

Each provider says how its items become *parts* of a transcript: text, thought, call, result and so on. One assembler turns
parts into messages, pairs results with calls and collects the defects. Snapshots are plain dictionaries in the shape of
``skein.sources.schema.SNAPSHOT``; open payloads are canonical JSON text.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Iterator

from ..functions.canonical import canonical_text, parse

# What the formats call things.
ROLES = ("system", "developer", "user")
TEXT_PARTS = ("text", "input_text", "output_text", "summary_text", "reasoning_text")
MEDIA_PARTS = ("image", "image_url", "input_image", "output_image", "input_audio", "audio", "file", "input_file", "document", "video", "search_result", "container_upload", "computer_screenshot")
CLIENT_CALLS = {"function_call": "function_call_output", "custom_tool_call": "custom_tool_call_output", "local_shell_call": "local_shell_call_output", "apply_patch_call": "apply_patch_call_output", "computer_call": "computer_call_output"}
BUILT_IN = {"local_shell_call": "local_shell", "apply_patch_call": "apply_patch", "computer_call": "computer"}
EITHER = {"shell_call": "shell_call_output", "tool_search_call": "tool_search_output"}
SERVER_CALLS = {"web_search_call": "web_search", "file_search_call": "file_search", "code_interpreter_call": "code_interpreter", "image_generation_call": "image_generation", "mcp_call": "mcp", "mcp_list_tools": "mcp_list_tools", "mcp_approval_request": "mcp_approval"}
SERVER_BLOCKS = ("server_tool_use", "mcp_tool_use")
IDENTITY = ("session_id", "thread_id", "turn_id", "parent_thread_id", "parent_turn_id", "forked_from_thread_id", "user_id", "harness")
MARKERS = ("subagent_marker", "x-openai-subagent", "subagent_kind")
HEADERS = {"x-codex-parent-thread-id": "parent_thread_id", "x-claude-code-session-id": "session_id", "session_id": "session_id", "thread_id": "thread_id"}
TRUNCATING = {"chat_completions": ("length", "content_filter"), "messages": ("max_tokens", "model_context_window_exceeded")}


class WireError(ValueError):
    """A capture that is of no known format; its text is a stable reason."""


def text_of(value) -> str:
    return value if isinstance(value, str) else ""


def compact(value) -> str:
    return value if isinstance(value, str) else canonical_text(value)


class Draft:
    """A snapshot under way: its messages, its defects, and what pairs calls with results."""

    def __init__(self, stage: str, join: str):
        self.stage, self.join = stage, join
        self.issues: list[dict] = []
        self.calls: dict[str, str] = {}
        self.awaiting: list[tuple[dict, str, str]] = []
        self.server: list[dict] = []
        self.agents: list[dict] = []
        self.compactions: list[dict] = []
        self.finished: list[str] = []
        self.unnamed: Counter = Counter()

    def note(self, code: str, path: str, severity: str = "error", detail: str = "") -> None:
        self.issues.append({"code": code, "stage": self.stage, "severity": severity, "path": path, "detail": detail})

    @property
    def errors(self) -> list[str]:
        return [i["code"] for i in self.issues if i["severity"] == "error"]

    def spare_id(self, kind: str) -> str:
        self.unnamed[kind] += 1
        return f"missing-{kind}:{self.unnamed[kind]}"

    def text(self, content, path: str) -> str:
        """Content as text: strings as they are, text parts joined, media and unknown parts as canonical JSON."""
        if content is None or isinstance(content, str):
            return content or ""
        if not isinstance(content, list):
            self.note("invalid_message_content", path)
            return canonical_text(content)
        out = []
        for k, part in enumerate(content):
            kind = part.get("type") if isinstance(part, dict) else None
            if isinstance(part, str):
                out.append(part)
                self.note("invalid_content_part", f"{path}[{k}]")
            elif kind in TEXT_PARTS:
                if not isinstance(part.get("text"), str):
                    self.note("invalid_text_part", f"{path}[{k}]")
                out.append(compact(part.get("text")))
            elif kind == "refusal":
                out.append(compact(part.get("refusal")))
            else:
                if not isinstance(part, dict):
                    self.note("invalid_content_part", f"{path}[{k}]")
                elif kind not in MEDIA_PARTS:
                    self.note("unknown_content_part", f"{path}[{k}]")
                out.append(canonical_text({a: b for a, b in part.items() if a != "cache_control"} if isinstance(part, dict) else part))
        return self.join.join(out)

    def arguments(self, holder: dict, key: str, path: str) -> str:
        """Arguments as canonical JSON: those given as text are read if they are JSON, else kept raw."""
        if key not in holder:
            self.note("missing_tool_arguments", path)
            return "{}"
        value = holder[key]
        if isinstance(value, str):
            try:
                return canonical_text(parse(value))
            except ValueError:
                return canonical_text({"raw": value})
        return canonical_text(value)

    def call(self, identifier, name, arguments: str, path: str) -> dict:
        if not isinstance(identifier, str) or not identifier:
            self.note("missing_tool_call_id" if self.stage == "responses" else "invalid_tool_call", path)
            identifier = self.spare_id("client-tool-call")
        elif identifier in self.calls:
            self.note("duplicate_tool_call_id", path)
        if not isinstance(name, str) or not name:
            self.note("missing_tool_name" if self.stage == "responses" else "invalid_tool_call", path)
            name = text_of(name)
        self.calls.setdefault(identifier, name)
        return {"id": identifier, "name": name, "arguments": arguments}

    def result(self, identifier, content: str, path: str) -> dict:
        if not isinstance(identifier, str) or not identifier:
            self.note("missing_tool_result_id" if self.stage == "responses" else "invalid_tool_result", path)
            identifier = self.spare_id("client-tool-result")
        out = message("tool", content, tool_call_id=identifier, name="")
        self.awaiting.append((out, identifier, path))
        if identifier in self.calls and identifier not in self.finished and is_spawn(self.calls[identifier]):
            self.finished.append(identifier)
        return out

    def pair(self) -> None:
        """Give every result its call's name."""
        seen: set[str] = set()
        for out, identifier, path in self.awaiting:
            if identifier in seen:
                self.note("duplicate_tool_result", path)
            seen.add(identifier)
            if identifier not in self.calls:
                self.note("orphan_tool_result", path)
            out["name"] = self.calls.get(identifier, out["name"])

    def server_call(self, identifier, name: str, arguments: str, origin: str, path: str) -> None:
        if not isinstance(identifier, str) or not identifier:
            self.note("missing_server_tool_id", path)
            identifier = f"missing:{origin}:{len(self.server)}"
        elif any(c["id"] == identifier for c in self.server):
            self.note("duplicate_server_tool_call_id", path)
        self.server.append({"id": identifier, "name": name, "arguments": arguments, "origin": origin, "result": None})

    def server_result(self, identifier, result: str, path: str) -> None:
        own = [c for c in self.server if c["id"] == identifier]
        if not own:
            self.note("orphan_server_tool_result", path)
        elif len(own) > 1:
            self.note("ambiguous_server_tool_result", path)
        elif own[0]["result"] is not None:
            self.note("duplicate_server_tool_result", path)
        else:
            own[0]["result"] = result


def is_spawn(name: str) -> bool:
    return name in ("Agent", "spawn_agent") or (name.endswith(".spawn_agent") and name != ".spawn_agent")


def message(role: str, content: str, **more) -> dict:
    out = {"role": role, "content": content, "reasoning_content": None, "tool_calls": None, "tool_call_id": None, "name": None}
    return out | ({"reasoning_content": ""} if role == "assistant" else {}) | more


def objects(draft: Draft, value, path: str, code: str) -> Iterator[tuple[str, dict]]:
    for k, item in enumerate(value):
        if isinstance(item, dict):
            yield f"{path}[{k}]", item
        else:
            draft.note(code, f"{path}[{k}]")


def tool(draft: Draft, name, description, parameters, path: str) -> dict | None:
    if not isinstance(name, str) or not name:
        draft.note("missing_tool_definition_name" if draft.stage == "responses" else "invalid_tool_definition", path)
        return None
    if not isinstance(parameters, dict):
        draft.note("invalid_tool_parameters" if draft.stage == "responses" else "invalid_tool_schema", path)
        parameters = {}
    return {"name": name, "description": "" if description is None else compact(description), "parameters": canonical_text(parameters)}


# --- identity


def _object(value) -> dict:
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return {}
    return value if isinstance(value, dict) else {}


def identity(draft: Draft, capture: dict, request: dict) -> dict[str, str]:
    """Who speaks: plain metadata first, then copies encoded in it, then headers, then the capture itself. Values that
    differ are a conflict; the first counts."""
    plain = [request[k] for k in ("client_metadata", "metadata") if isinstance(request.get(k), dict)]
    nested = [_object(p.get("x-codex-turn-metadata")) for p in plain]
    user = plain[-1].get("user_id") if plain else None
    nested += [_object(user)] if isinstance(user, str) and user.lstrip().startswith("{") else []
    headers = {str(k).lower(): v for k, v in _object(capture.get("request_headers")).items()}
    nested.append(_object(headers.get("x-codex-turn-metadata")))
    nested.append({field: headers[h] for h, field in HEADERS.items() if isinstance(headers.get(h), str)})
    out = {}
    for field in IDENTITY:
        found = [v for s in (*plain, *nested, capture) if isinstance(v := s.get(field), str) and v]
        if field == "session_id":
            found = [v for v in found if v != "no_session_id"]
        if field == "user_id":
            found = [u for v in found if (u := _user(v))]
        if len(set(found)) > 1 and field != "harness":
            draft.note("metadata_conflict", field)
        out[field] = found[0] if found else ""
    marks = [v for key in MARKERS for s in (*plain, *nested, headers, capture) if isinstance(v := s.get(key), str) and v]
    mark = marks[0] if marks else ""
    out["subagent_marker"] = "" if draft.stage != "responses" and mark in ("main", "user") else mark
    out["coded"] = "1" if any(nested[: len(plain)]) or "client_metadata" in request else ""
    return out


def _user(value: str) -> str:
    own = _object(value) if value.lstrip().startswith("{") else None
    return value if own is None else next((v for k in ("user_id", "userId", "id", "account_uuid") if isinstance(v := own.get(k), str) and v), "")


# --- frames of streams


def frames(draft: Draft, body: list) -> list[dict]:
    """Events of a recorded stream in order: frames ``{seq, event, data}`` or events themselves. A sequence number seen
    again is a replay, or a conflict if it says something else; numbers that lack are gaps."""
    out, seen, last = [], {}, None
    for path, frame in objects(draft, body, "response_body", "invalid_sse_frame"):
        data, name = frame.get("data", frame), frame.get("event")
        if isinstance(data, str):
            if data.strip() == "[DONE]":
                continue
            try:
                data = parse(data)
            except ValueError:
                draft.note("invalid_sse_data", path)
                continue
        if not isinstance(data, dict):
            draft.note("invalid_sse_data", path)
            continue
        if isinstance(name, str) and name and data.get("type", name) != name:
            draft.note("sse_event_type_mismatch", path)
        number = frame.get("seq", data.get("sequence_number"))
        if isinstance(number, int) and not isinstance(number, bool):
            own = canonical_text(data)
            if number in seen:
                if seen[number] != own:
                    draft.note("conflicting_sse_sequence", path)
                continue
            if last is not None and number > last + 1:
                draft.note("sse_sequence_gap", path)
            seen[number], last = own, number
        out.append(data if "type" in data or not name else data | {"type": name})
    return out


# --- chat completions


def _chat_message(draft: Draft, raw: dict, path: str) -> dict:
    calls = raw.get("tool_calls")
    if calls is not None and not isinstance(calls, list):
        draft.note("invalid_tool_calls", f"{path}.tool_calls")
        calls = None
    own = []
    for at, call in objects(draft, calls or (), f"{path}.tool_calls", "invalid_tool_call"):
        if call.get("type") not in (None, "function"):
            draft.note("unsupported_tool_call", at)
            continue
        function = call.get("function") if isinstance(call.get("function"), dict) else {}
        own.append(draft.call(call.get("id"), function.get("name"), draft.arguments(function, "arguments", at), at))
    thought = raw.get("reasoning_content", raw.get("reasoning"))
    if thought is not None and not isinstance(thought, str):
        draft.note("invalid_reasoning_content", path)
    return message("assistant", draft.text(raw.get("content"), f"{path}.content"), reasoning_content=text_of(thought), tool_calls=own or None)


def _chat(draft: Draft, capture: dict, request: dict, status: int | None):
    history = []
    if not isinstance(request.get("messages"), list):
        draft.note("invalid_messages", "request_body.messages")
    for path, raw in objects(draft, request["messages"] if isinstance(request.get("messages"), list) else (), "request_body.messages", "invalid_message"):
        role = raw.get("role")
        if role == "assistant":
            history.append(_chat_message(draft, raw, path))
        elif role == "tool":
            history.append(draft.result(raw.get("tool_call_id"), draft.text(raw.get("content"), path), path))
        elif role in ROLES:
            history.append(message(role, draft.text(raw.get("content"), path)))
        else:
            draft.note("unsupported_message_role", path)
    tools = []
    if request.get("tools") is not None and not isinstance(request["tools"], list):
        draft.note("invalid_tools", "request_body.tools")
    for path, raw in objects(draft, request["tools"] if isinstance(request.get("tools"), list) else (), "request_body.tools", "invalid_tool_definition"):
        function = raw.get("function")
        if raw.get("type") != "function" or not isinstance(function, dict):
            draft.note("unsupported_tool_definition" if raw.get("type") != "function" else "invalid_tool_definition", path)
        elif own := tool(draft, function.get("name"), function.get("description"), function.get("parameters", {}), path):
            tools.append(own)

    def answer():
        body = capture.get("response_body")
        if isinstance(body, str):
            try:
                body = parse(body)
            except ValueError:
                draft.note("invalid_response_json", "response_body")
                return [], "", "capture_invalid"
        if not isinstance(body, dict):
            draft.note("invalid_response_body", "response_body")
            return [], "", "capture_invalid"
        model = text_of(body.get("model"))
        if body.get("error") is not None or body.get("object") == "error":
            draft.note("openai_api_error", "response_body")
            return [], model, "api_error"
        if body.get("object") not in (None, "chat.completion"):
            draft.note("invalid_chat_completion_object", "response_body.object")
        choices = body.get("choices")
        if not isinstance(choices, list):
            draft.note("invalid_chat_choices", "response_body.choices")
            return [], model, "capture_invalid"
        if len(choices) != 1:
            draft.note("invalid_chat_choice_count", "response_body.choices")
        choice = choices[0] if choices and isinstance(choices[0], dict) else {}
        raw, end = choice.get("message"), choice.get("finish_reason")
        if not isinstance(raw, dict):
            draft.note("invalid_chat_response_message", "response_body.choices[0].message")
            return [], model, "capture_invalid"
        cut = end in TRUNCATING["chat_completions"]
        if raw.get("role") != "assistant":
            draft.note("invalid_chat_response_role", "response_body.choices[0].message.role")
        own = _chat_message(draft, raw, "response_body.choices[0].message")
        if cut:
            draft.note("chat_completion_truncated", "response_body.choices[0].finish_reason")
        elif end not in ("stop", "tool_calls") or (end == "tool_calls" and not own["tool_calls"]):
            draft.note("invalid_chat_finish_reason", "response_body.choices[0].finish_reason")
        return [own], model, "truncated" if cut else "success"

    response, model, outcome = answer() if status else ([], "", "")
    return history, response, tools, "", model, outcome, outcome == "success", ""


# --- messages


def _block_message(draft: Draft, content, origin: str, path: str) -> dict:
    if isinstance(content, str):
        return message("assistant", content)
    if not isinstance(content, list):
        draft.note("invalid_assistant_content", path)
        return message("assistant", compact(content))
    texts, thoughts, calls = [], [], []
    for at, block in objects(draft, content, path, "invalid_content_block"):
        kind = block.get("type")
        if kind == "text":
            if not isinstance(block.get("text"), str):
                draft.note("invalid_text_block", at)
            texts.append(compact(block.get("text")))
        elif kind == "thinking":
            if not isinstance(block.get("thinking"), str):
                draft.note("invalid_thinking_block", at)
            thoughts.append(compact(block.get("thinking")))
        elif kind == "redacted_thinking":
            draft.note("redacted_thinking_preserved", at, "warning")
        elif kind == "tool_use":
            calls.append(draft.call(block.get("id"), block.get("name"), draft.arguments(block, "input", at), at))
        elif kind in SERVER_BLOCKS:
            draft.server_call(block.get("id"), text_of(block.get("name")), draft.arguments(block, "input", at), origin, at)
        elif isinstance(kind, str) and kind.endswith("_tool_result"):
            draft.server_result(block.get("tool_use_id"), canonical_text(block), at)
        else:
            if kind not in MEDIA_PARTS:
                draft.note("unsupported_content_block", at)
            texts.append(canonical_text({a: b for a, b in block.items() if a != "cache_control"}))
    return message("assistant", "".join(texts), reasoning_content="".join(thoughts), tool_calls=calls or None)


def _user_turns(draft: Draft, content, path: str) -> list[dict]:
    """A user's content parted around its tool results."""
    if not isinstance(content, list):
        if not isinstance(content, str):
            draft.note("invalid_user_content", path)
        return [message("user", compact(content))]
    out, plain = [], []

    def close() -> None:
        if plain:
            out.append(message("user", "".join(plain)))
            plain.clear()

    for k, block in enumerate(content):
        at = f"{path}[{k}]"
        if isinstance(block, dict) and block.get("type") == "tool_result":
            close()
            out.append(draft.result(block.get("tool_use_id"), compact(block.get("content", "")), at))
        else:
            plain.append(draft.text([block], at))
    close()
    return out or [message("user", "")]


def _fold_message_events(draft: Draft, events: Iterable[dict]) -> tuple[dict | None, bool]:
    """The final message of a stream and whether it was ended."""
    final, blocks, ended = None, {}, False
    for event in events:
        kind, at = event.get("type"), event.get("index")
        if ended and kind != "ping":
            draft.note("event_after_message_stop", "response_body")
        elif kind == "message_start":
            if final is not None:
                draft.note("duplicate_message_start", "response_body")
            else:
                final = dict(event["message"]) if isinstance(event.get("message"), dict) else {}
        elif kind in ("content_block_start", "content_block_delta") and final is None:
            draft.note("content_before_message_start", "response_body")
        elif kind == "content_block_start":
            blocks[at] = dict(_object(event.get("content_block"))) | {"_json": ""}
        elif kind == "content_block_delta" and at in blocks:
            delta, own = _object(event.get("delta")), blocks[at]
            for name in ("text", "thinking", "signature"):
                if isinstance(delta.get(name), str):
                    own[name] = text_of(own.get(name)) + delta[name]
            own["_json"] += text_of(delta.get("partial_json"))
        elif kind == "message_delta":
            final = (final or {}) | _object(event.get("delta"))
        elif kind == "message_stop":
            ended = True
        elif kind == "error":
            draft.note("anthropic_api_error", "response_body")
    if final is not None and blocks:
        for own in blocks.values():
            given = own.pop("_json")
            if given:
                try:
                    own["input"] = parse(given)
                except ValueError:
                    draft.note("invalid_tool_input_json", "response_body")
                    own["input"] = {"raw": given}
        final["content"] = [blocks[k] for k in sorted(blocks)]
    return final, ended


def _messages(draft: Draft, capture: dict, request: dict, status: int | None):
    history = []
    if request.get("system") is not None:
        history.append(message("system", draft.text(request["system"], "request_body.system")))
    raw_messages = request.get("messages", [])
    if not isinstance(raw_messages, list):
        draft.note("invalid_messages", "request_body.messages")
        raw_messages = []
    for path, raw in objects(draft, raw_messages, "request_body.messages", "invalid_message"):
        role, content = raw.get("role"), raw.get("content", "")
        if role == "assistant":
            history.append(_block_message(draft, content, "history", path))
        elif role == "user":
            history += _user_turns(draft, content, path)
        elif role == "tool":
            history.append(draft.result(raw.get("tool_call_id"), compact(content), path))
        elif role in ROLES:
            history.append(message(role, draft.text(content, path)))
        else:
            draft.note("unsupported_message_role", path)
    tools = []
    for path, raw in objects(draft, request["tools"] if isinstance(request.get("tools"), list) else (), "request_body.tools", "invalid_tool_definition"):
        if own := tool(draft, raw.get("name"), raw.get("description"), raw.get("input_schema", {}), path):
            tools.append(own)

    def answer():
        body, ended = capture.get("response_body"), True
        if isinstance(body, str):
            try:
                body = parse(body)
            except ValueError:
                draft.note("invalid_stream_body", "response_body")
                return [], "", "capture_invalid", False, ""
        if isinstance(body, list):
            body, ended = _fold_message_events(draft, frames(draft, body))
        if not isinstance(body, dict):
            draft.note("invalid_response_body", "response_body")
            return [], "", "capture_invalid", False, ""
        model, end = text_of(body.get("model")), text_of(body.get("stop_reason"))
        if body.get("type") == "error" or "anthropic_api_error" in draft.errors:
            draft.note("anthropic_api_error", "response_body")
            return [], model, "api_error", False, end
        own = [_block_message(draft, body.get("content"), "response", "response_body.content")] if body.get("content") else []
        if not ended or end in TRUNCATING["messages"] or any(c.startswith("sse_") or c.startswith("conflicting_sse") for c in draft.errors):
            if not ended:
                draft.note("missing_message_stop", "response_body")
            return own, model, "truncated", False, end
        return own, model, "success", True, end

    response, model, outcome, whole, end = answer() if status else ([], "", "", False, "")
    return history, response, tools, "", model, outcome, whole, end


# --- responses


def _items(draft: Draft, items, origin: str, path: str) -> list[dict]:
    """Messages of a list of items. Text, thought and calls gather in one assistant message until a second text, a new
    thought, or anything that isn't the assistant's begins another."""
    if items is None:
        return []
    if isinstance(items, str):
        return [message("user", items)]
    if not isinstance(items, list):
        draft.note("invalid_item_list", path)
        return []
    out: list[dict] = []
    current: dict | None = None
    told = False  # the current message has a text item

    def close() -> None:
        nonlocal current, told
        current, told = None, False

    def speaking() -> dict:
        nonlocal current
        if current is None:
            current = message("assistant", "")
            out.append(current)
        return current

    client_ids = {i.get("call_id") for i in items if isinstance(i, dict) and i.get("type") in CLIENT_CALLS}
    for k, item in enumerate(items):
        at = f"{path}[{k}]"
        if not isinstance(item, dict):
            close()
            draft.note("invalid_response_item", at)
            continue
        kind = item.get("type", "message" if "role" in item else None)
        if kind in EITHER or kind in EITHER.values():
            kind = _side(draft, item, kind, client_ids, at)
        if kind == "message":
            role, content = item.get("role"), draft.text(item.get("content", ""), f"{at}.content")
            if role == "assistant":
                if told:
                    close()
                speaking()["content"] += content
                told = True
                continue
            close()
            if role in ROLES:
                out.append(message(role, content))
            else:
                draft.note("invalid_message_role", at)
        elif kind == "reasoning":
            close()
            own = [text_of(p.get("text")) for key in ("summary", "content") for p in (item.get(key) if isinstance(item.get(key), list) else ()) if isinstance(p, dict)]
            speaking()["reasoning_content"] += "\n".join(t for t in own if t)
        elif kind in CLIENT_CALLS or kind in ("client_call",):
            name = BUILT_IN.get(item.get("type"), item.get("name") if item.get("type") not in EITHER else str(item["type"]).removesuffix("_call"))
            namespace = item.get("namespace")
            if isinstance(namespace, str) and namespace and isinstance(name, str) and name and not name.startswith(namespace + "."):
                name = f"{namespace}.{name}"
            key = next((x for x in ("arguments", "input", "action", "operation") if x in item), "arguments")
            own = draft.call(item.get("call_id"), name, draft.arguments(item, key, at), at)
            said = speaking()
            said["tool_calls"] = (said["tool_calls"] or []) + [own]
        elif kind in CLIENT_CALLS.values() or kind == "client_result":
            close()
            output = item.get("output", item.get("tools", ""))
            made = draft.result(item.get("call_id"), draft.text(output, at) if isinstance(output, list) else compact(output), at)
            out.append(made)
            name = draft.calls.get(made["tool_call_id"], "")
            if output in (f"unsupported call: {name}", f"unsupported custom tool call: {name}") and name:
                draft.note("responses_unsupported_tool_call", at, "warning", f"{made['tool_call_id']} {name}")
        elif kind in SERVER_CALLS or kind == "server_call":
            name = text_of(item.get("name")) or SERVER_CALLS.get(item.get("type"), str(item.get("type")).removesuffix("_call"))
            key = next((x for x in ("arguments", "action", "queries", "code") if x in item), None)
            draft.server_call(item.get("call_id") or item.get("id"), name, draft.arguments(item, key, at) if key else "{}", origin, at)
            given = {x: item[x] for x in ("result", "results", "output", "outputs", "error") if item.get(x) is not None}
            if given:
                draft.server_result(draft.server[-1]["id"], canonical_text(given), at)
        elif kind == "server_result":
            draft.server_result(item.get("call_id") or item.get("id"), canonical_text(item), at)
        elif kind == "agent_message":
            close()
            for name in ("id", "author", "recipient"):
                if not text_of(item.get(name)):
                    draft.note(f"invalid_agent_message_{name}", at)
            draft.agents.append({"origin": origin, "item_index": k, "item": canonical_text(item), "preceding": list(draft.finished)})
        elif kind == "compaction":
            close()
            draft.compactions.append({"origin": origin, "item_index": k, "item": canonical_text(item)})
        elif kind != "additional_tools":
            close()
            if kind != "unclear":
                draft.note("unknown_response_item", at)
    return out


def _side(draft: Draft, item: dict, kind: str, client_ids: set, at: str) -> str:
    """Whether a shell or tool-search item ran at the client or the server."""
    stated = item.get("execution")
    side = stated if stated in ("client", "server") else "client" if text_of(item.get("call_id")) else "server" if text_of(item.get("id")) else None
    if side is None:
        draft.note("ambiguous_tool_execution", at)
        return "unclear"
    return f"{side}_{'call' if kind in EITHER else 'result'}"


def _tools(draft: Draft, raw_tools, prefix: str = "", path: str = "request_body.tools") -> list[dict]:
    out = []
    if raw_tools is not None and not isinstance(raw_tools, list):
        draft.note("invalid_tool_definitions", path)
    for at, raw in objects(draft, raw_tools if isinstance(raw_tools, list) else (), path, "invalid_tool_definition"):
        kind, name = raw.get("type"), raw.get("name")
        if kind == "namespace":
            if not text_of(name) or not isinstance(raw.get("tools"), list):
                draft.note("invalid_namespace_definition", at)
            else:
                out += _tools(draft, raw["tools"], f"{name}.", f"{at}.tools")
        elif kind in ("function", "custom"):
            full = name if not text_of(name) or name.startswith(prefix) else prefix + name
            if own := tool(draft, full, raw.get("description"), raw.get("parameters", {}) if kind == "function" else {"properties": {"raw": {"type": "string"}}}, at):
                out.append(own)
        elif prefix:
            draft.note("unsupported_namespace_tool", at)
        elif isinstance(kind, str) and kind:
            out.append({"name": kind, "description": compact(raw.get("description") or ""), "parameters": "{}"})
        else:
            draft.note("invalid_tool_definition", at)
    unique = {canonical_text(t): t for t in out}
    return list(unique.values())


def _final_response(draft: Draft, events: list[dict]) -> tuple[dict, bool]:
    """The final object of a stream: items by their place, ``done`` over what deltas add up to, and what the last event says."""
    items: dict[int, dict] = {}
    last, open_, deltas = None, set(), {}
    for event in events:
        kind, at = text_of(event.get("type")), event.get("output_index")
        if last is not None:
            draft.note("event_after_terminal", "response_body")
        if kind == "response.output_item.added" and isinstance(event.get("item"), dict):
            items.setdefault(at, dict(event["item"]))
            open_.add(at)
        elif kind == "response.output_item.done" and isinstance(event.get("item"), dict):
            items[at] = dict(event["item"])
            open_.discard(at)
        elif kind == "response.output_text.delta":
            deltas[at] = deltas.get(at, "") + text_of(event.get("delta"))
        elif kind in ("response.completed", "response.incomplete", "response.failed", "response.cancelled"):
            last = event.get("response") if isinstance(event.get("response"), dict) else {"status": kind.removeprefix("response.")}
        elif kind == "error":
            last = {"status": "failed", "error": event.get("error") or event}
    for at in open_:
        draft.note("unfinished_output_item", "response_body")
        if at in deltas and not items[at].get("content"):
            items[at]["content"] = [{"type": "output_text", "text": deltas[at]}]
    final = dict(last or {})
    if items:
        final["output"] = [items[k] for k in sorted(items, key=lambda x: (x is None, x))]
    return final, last is not None


def _responses(draft: Draft, capture: dict, request: dict, status: int | None):
    history = _items(draft, request.get("input"), "history", "request_body.input")
    tools = _tools(draft, request.get("tools"))
    for item in request["input"] if isinstance(request.get("input"), list) else ():
        if isinstance(item, dict) and item.get("type") == "additional_tools":
            tools += [t for t in _tools(draft, item.get("tools"), path="request_body.input") if t not in tools]

    def answer():
        body, ended = capture.get("response_body"), True
        if isinstance(body, str):
            try:
                body = parse(body)
            except ValueError:
                draft.note("invalid_sse_data", "response_body")
                return [], "", "capture_invalid", False
        if isinstance(body, list):
            body, ended = _final_response(draft, frames(draft, body))
        if not isinstance(body, dict):
            draft.note("invalid_response_body", "response_body")
            return [], "", "capture_invalid", False
        model, state = text_of(body.get("model")), body.get("status", "completed")
        damaged = any(c in ("conflicting_sse_sequence", "sse_sequence_gap", "event_after_terminal", "unfinished_output_item") for c in draft.errors)
        own = _items(draft, body.get("output"), "response", "response_body.output")
        if body.get("error") is not None or state == "failed":
            draft.note("openai_api_error", "response_body")
            return own, model, "api_error", False
        if not ended or state in ("incomplete", "cancelled"):
            draft.note("response_incomplete", "response_body")
            return own, model, "truncated", False
        return own, model, "capture_invalid" if damaged else "success", not damaged

    response, model, outcome, whole = answer() if status else ([], "", "", False)
    return history, response, tools, text_of(request.get("instructions")), model, outcome, whole, ""


# --- one capture

WIRES = {"/responses": ("responses", "responses", "openai", _responses, "\n"), "/chat/completions": ("chat_completions", "chat", "openai", _chat, ""), "/messages": ("messages", "anthropic", "anthropic", _messages, ""), "/messages/count_tokens": ("count_tokens", "anthropic", "anthropic", _messages, "")}


def endpoint(path) -> str:
    plain = path.split("?", 1)[0].rstrip("/") if isinstance(path, str) else ""
    for end in sorted(WIRES, key=len, reverse=True):
        if plain.endswith(end):
            return end
    raise WireError("unsupported_endpoint")


def snapshot(capture: dict, source_path: str, sha256: str, source_name: str = "freerouter") -> dict:
    """The snapshot of one capture; :class:`WireError` if its endpoint is unknown."""
    operation, stage, provider, read, join = WIRES[endpoint(capture.get("path"))]
    draft = Draft(stage, join)
    request = capture.get("request_body")
    if isinstance(request, str):
        request = _object(request)
    if not isinstance(request, dict):
        draft.note("invalid_request_body", "request_body")
        request = {}
    who = identity(draft, capture, request)
    status = capture.get("status_code")
    valid = isinstance(status, int) and not isinstance(status, bool) and status > 0
    good = valid and 200 <= status < 300 and operation != "count_tokens"
    history, response, tools, instructions, model, outcome, whole, end = read(draft, capture, request, status if good else None)
    if not valid:
        draft.note("missing_http_status", "status_code")
        outcome, whole = "transport_error", False
    elif not 200 <= status < 300:
        error = _object(_object(capture.get("response_body")).get("error"))
        parts = "; ".join(f"{k}={error[k]}" for k in ("type", "code") if isinstance(error.get(k), str) and error[k].replace("_", "").replace("-", "").replace(".", "").isalnum() and len(error[k]) <= 80)
        draft.note("openai_api_error" if provider == "openai" else "anthropic_api_error", "response_body", detail=f"HTTP {status}" + (f" ({parts})" if parts else ""))
        outcome, whole = "api_error", False
    elif operation == "count_tokens":
        outcome, whole = "success", True
    draft.pair()
    if outcome == "success" and draft.errors:
        # only chat takes request-side errors as damage of the wire
        outcome, whole = "capture_invalid", whole and operation != "chat_completions"
    linked = bool(who["subagent_marker"] or who["parent_thread_id"] or who["parent_turn_id"] or who["forked_from_thread_id"])
    thread = who["thread_id"] or (f"__isolated_subagent__:{source_path}" if linked else who["session_id"])
    if linked and not who["thread_id"]:
        draft.note("isolated_subagent_missing_thread_id", "request_body", "warning")
    for name, value in (("session_id", who["session_id"]), ("thread_id", thread)):
        if not value:
            draft.note(f"missing_{name}", name, "warning")
    for name in capture.get("masked_fields") or ():
        draft.note(f"metadata_{name}_masked", name, "warning")
    return {
        "source_path": source_path, "source_sha256": sha256, "source_name": source_name,
        **{k: who[k] for k in ("session_id", "turn_id", "parent_thread_id", "parent_turn_id", "forked_from_thread_id", "subagent_marker", "user_id")},
        "thread_id": thread, "provider": provider, "operation": operation, "outcome": outcome, "captured_at": text_of(capture.get("captured_at")), "request_id": text_of(capture.get("request_id")),
        "model": text_of(request.get("model")) or model, "end_user_id": text_of(capture.get("end_user_id")), "harness": who["harness"] or ("codex" if who["coded"] and provider == "openai" else "unknown"),
        "instructions": instructions, "termination": end, "wire_complete": whole, "history": history, "response": response, "tools": tools, "server_tool_calls": draft.server, "agent_messages": draft.agents,
        "compaction_items": draft.compactions, "media": capture.get("media") or [], "issues": draft.issues,
    }
