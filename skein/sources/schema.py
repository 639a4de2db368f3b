"""Types of snapshots and of what is published."""

from __future__ import annotations

CALL = "STRUCT<id: STRING, name: STRING, arguments: STRING>"
MESSAGE = f"STRUCT<role: STRING, content: STRING, reasoning_content: STRING, tool_calls: ARRAY<{CALL}>, tool_call_id: STRING, name: STRING>"
TOOL = "STRUCT<name: STRING, description: STRING, parameters: STRING>"
ISSUE = "STRUCT<code: STRING, stage: STRING, severity: STRING, path: STRING, detail: STRING>"
SERVER_CALL = "STRUCT<id: STRING, name: STRING, arguments: STRING, origin: STRING, result: STRING>"
RECORD = "STRUCT<origin: STRING, item_index: INT, item: STRING>"
AGENT = "STRUCT<origin: STRING, item_index: INT, item: STRING, preceding: ARRAY<STRING>>"
MEDIA = "STRUCT<part_id: STRING, object_name: STRING>"
PLAIN = "source_path source_sha256 source_name session_id thread_id turn_id parent_thread_id parent_turn_id forked_from_thread_id subagent_marker provider operation outcome captured_at request_id model user_id end_user_id harness instructions termination".split()
SNAPSHOT = ", ".join([*(f"{c} STRING" for c in PLAIN), "wire_complete BOOLEAN", f"history ARRAY<{MESSAGE}>", f"response ARRAY<{MESSAGE}>", f"tools ARRAY<{TOOL}>", f"server_tool_calls ARRAY<{SERVER_CALL}>", f"agent_messages ARRAY<{AGENT}>", f"compaction_items ARRAY<{RECORD}>", f"media ARRAY<{MEDIA}>", f"issues ARRAY<{ISSUE}>"])
