"""The published JSON of a trajectory, composed from columns; open payloads go in as the canonical text that they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..operators.storage import settled

# What a source is called in the metadata.
ORIGINS = {"freerouter": ("api-router", "free-router"), "tokenplan": ("api-router", "token-plan"), "sxf": ("traj-cooperate", "SXF"), "deepinfra": ("api-router", "deep-infra")}
CHECKS = ("total_calls", "hallucinated_calls", "undefined_tool_calls", "unverifiable_calls", "checked_calls", "extra_arg_calls", "missing_required_calls", "type_mismatch_calls", "defaulted_missing_calls", "mismatch_calls")


def text(value: Column) -> Column:
    """A string as JSON."""
    own = F.to_json(F.array(F.coalesce(value, F.lit(""))))
    return F.substr(own, F.lit(2), F.length(own) - 2)


def number(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("long").cast("string")


def flag(value: Column) -> Column:
    return F.coalesce(value, F.lit(False)).cast("string")


def array(values: Column) -> Column:
    """JSON texts as a JSON array; none for null."""
    return F.concat(F.lit("["), F.coalesce(F.array_join(values, ","), F.lit("")), F.lit("]"))


def members(*pairs: tuple[str, Column]) -> Column:
    """A JSON object of JSON texts; members that are null are left out."""
    own = F.array_compact(F.array(*[F.concat(F.lit(f'"{k}":'), v) for k, v in pairs]))
    return F.concat(F.lit("{"), F.array_join(own, ","), F.lit("}"))


def strings(values: Column) -> Column:
    return array(F.transform(F.coalesce(values, F.array().cast("array<string>")), text))


def message(m: Column) -> Column:
    call = lambda c: members(("type", F.lit('"function"')), ("id", text(c["id"])), ("function", members(("name", text(c["name"])), ("arguments", c["arguments"]))))
    assistant, tool = m["role"] == "assistant", m["role"] == "tool"
    return members(
        ("role", text(m["role"])), ("content", text(m["content"])), ("reasoning_content", F.when(assistant, text(m["reasoning_content"]))),
        ("tool_calls", F.when(assistant & (F.size(m["tool_calls"]) > 0), array(F.transform(m["tool_calls"], call)))), ("tool_call_id", F.when(tool, text(m["tool_call_id"]))), ("name", F.when(tool, text(m["name"]))),
    )


def _record(r: Column) -> Column:
    return members(("origin", text(r["origin"])), ("item_index", number(r["item_index"])), ("item", r["item"]))


def _plain(nodes: DataFrame) -> DataFrame:
    c = F.col
    kind = F.lit(ORIGINS["freerouter"][0])
    specific = F.lit(ORIGINS["freerouter"][1])
    for name, (a, b) in ORIGINS.items():
        kind, specific = F.when(c("source_name") == name, a).otherwise(kind), F.when(c("source_name") == name, b).otherwise(specific)
    tool = lambda t: members(("type", F.lit('"function"')), ("name", text(t["name"])), ("description", text(t["description"])), ("parameters", t["parameters"]))
    server = lambda s: members(("name", text(s["name"])), ("id", text(s["call_id"])), ("arguments", s["arguments"]), ("origin", text(s["origin"])), ("result", F.coalesce(s["result"], F.lit("null"))))
    mismatch = lambda d: members(("tool", text(d["tool"])), ("tool_call_id", text(d["tool_call_id"])), ("message_index", number(d["message_index"])), ("reasons", strings(d["reasons"])), ("extra_args", F.when(F.size(d["extra"]) > 0, strings(d["extra"]))), ("missing_required", F.when(F.size(d["missing"]) > 0, strings(d["missing"]))))
    issue = lambda i: members(*[(k, text(i[k])) for k in ("code", "stage", "severity", "path", "detail")])
    counts = F.concat(F.lit("{"), F.coalesce(F.array_join(F.transform(F.map_entries("tool_counts"), lambda e: F.concat(text(e["key"]), F.lit(":"), e["value"].cast("string"))), ","), F.lit("")), F.lit("}"))
    metadata = members(
        ("source_file", text(names.source_file(c("source_path")))), ("source_name", text(c("source_name"))), ("line_no", number(names.line_number(c("source_path")))), ("created_at", text(c("captured_at"))), ("model", text(c("model"))),
        ("user_id", text(names.first_real(c("user_id"), F.lit(names.NO_USER)))), ("session_id", text(names.first_real(names.real_session(c("session_id")), F.lit(names.NO_SESSION)))), ("sub_session_id", number(c("sub_session_id"))),
        ("source_type", text(kind)), ("specific_source", text(specific)), ("end_user_id", F.when(c("end_user_id") != "", text(c("end_user_id")))),
    )
    completeness = members(
        ("is_subagent", flag(c("is_subagent"))), ("spawn_calls", number(c("spawn_calls"))), ("mounted_subs", number(c("mounted_subs"))), ("subtree_complete", flag(c("subtree_complete") & ~c("is_subagent"))),
        ("unkeyed_mounts", number(c("unkeyed_mounts"))), ("relay_mounts", F.lit("0")), ("trailing_unanswered_call", flag(c("trailing_unanswered_call"))), ("no_final_assistant_turn", flag(~c("has_final_turn"))),
    )
    fields = [
        ("tools", array(F.transform("tools", tool))), *[(k, text(c(k))) for k in ("instructions", "termination", "harness", "model")], ("source", text(names.source_file(c("source_path")))),
        *[(k, number(c(k))) for k in ("total_rounds", "total_tool_calls", "total_tokens")], ("tool_counts", counts), ("reasoning_total_tokens", number(c("reasoning_total_tokens"))),
        ("tool_defs_tag", text(c("tool_defs_tag"))), ("missing_tool_defs", strings(c("missing_tool_defs"))), ("tool_call_tag", text(c("tool_call_tag"))),
        ("tool_call_check", members(*[(k, number(c(k))) for k in CHECKS], ("mismatches", array(F.transform("mismatches", mismatch))), ("mismatches_truncated", number(c("mismatches_truncated"))))),
        ("server_tool_calls", array(F.transform("server_calls", server))), ("agent_messages", array(F.transform("agent_messages", _record))), ("compaction_items", array(F.transform("compaction_items", _record))), ("metadata", metadata),
        ("normalization_audit", members(("tag", text(c("disposition"))), ("reason_codes", strings(c("reason_codes"))), ("issues", array(F.transform("issues", issue))))),
        ("multimodal_file_mapping", F.when(F.size("media") > 0, array(F.transform("media", lambda m: members(("part_id", text(m["part_id"])), ("object_name", text(m["object_name"]))))))),
    ]
    root = [("completeness_tag", text(c("completeness_tag"))), ("completeness", completeness)]
    inner = members(*fields)
    cut = lambda whole: F.substr(whole, F.lit(2), F.length(whole) - 2)
    return nodes.withColumn("plain", F.concat(cut(inner), F.when(c("parent_id").isNull(), F.concat(F.lit(","), cut(members(*root)))).otherwise("")))


def documents(trajectories: DataFrame, messages: DataFrame) -> DataFrame:
    """``(trajectory_id, path, body)``: one for every root, with its mounted sub-agents inside it.

    Nodes are nested level by level from the deepest, so trees cost as many joins as the deepest has levels."""
    said = messages.groupBy("node_id").agg(F.array_sort(F.collect_list(F.struct("pos", message(F.struct("role", "content", "reasoning_content", "tool_calls", "tool_call_id", "name")).alias("m")))).alias("m"))
    nodes = _plain(trajectories).join(said.select("node_id", array(F.transform("m", lambda x: x["m"])).alias("messages_json")), "node_id", "left").withColumn("messages_json", F.coalesce("messages_json", F.lit("[]")))
    left = settled(nodes.select("node_id", "parent_id", "spawn_call_id", "trajectory_id", "session_id", "sub_session_id", "plain", "messages_json"))
    ready = None
    for here in reversed(_levels(left)):
        here = left.join(here, "node_id", "left_semi")
        if ready is None:
            here = here.withColumn("kids", F.lit(None).cast("string"))
        else:
            inner = ready.groupBy(F.col("parent_id").alias("node_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("spawn_call_id", "body"))), lambda x: F.concat(text(x["spawn_call_id"]), F.lit(":"), x["body"])), ",").alias("kids"))
            here = here.join(inner, "node_id", "left")
        kids = F.coalesce(F.concat(F.lit(',"sub_agent_trajectory":{'), F.col("kids"), F.lit("}")), F.lit(""))
        body = F.concat(F.lit('{"messages":'), "messages_json", F.lit(","), "plain", kids, F.lit("}"))
        ready = settled(here.withColumn("body", body).drop("kids", "plain", "messages_json"))
    if ready is None:
        ready = left.withColumn("body", F.lit(""))
    return ready.select("trajectory_id", F.concat(names.trajectory_file(F.col("session_id"), F.col("sub_session_id"), F.col("trajectory_id")), F.lit(".jsonl")).alias("path"), "body")


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """The nodes without a parent among ``nodes``, their children, and so on."""
    known = nodes.select(F.col("node_id").alias("parent_id"))
    out = [settled(nodes.join(known, "parent_id", "left_anti").select("node_id"))]
    while not out[-1].isEmpty():
        out.append(settled(nodes.join(out[-1].select(F.col("node_id").alias("parent_id")), "parent_id", "left_semi").select("node_id")))
    return out[:-1]


# --- the contract of a published record

TEXT, COUNT, LIST, OBJECT = str, int, list, dict
NODE = {
    "messages": LIST, "tools": LIST, "instructions": TEXT, "termination": TEXT, "harness": TEXT, "model": TEXT, "source": TEXT, "total_rounds": COUNT, "total_tool_calls": COUNT, "total_tokens": COUNT, "tool_counts": OBJECT, "reasoning_total_tokens": COUNT,
    "tool_defs_tag": TEXT, "missing_tool_defs": LIST, "tool_call_tag": TEXT, "tool_call_check": OBJECT, "server_tool_calls": LIST, "agent_messages": LIST, "compaction_items": LIST, "metadata": OBJECT, "normalization_audit": OBJECT,
}
MAY = {"multimodal_file_mapping": LIST, "sub_agent_trajectory": OBJECT, "sub_agent_relay_mounts": OBJECT}
ROOT = {"completeness_tag": TEXT, "completeness": OBJECT}
ROLE_FIELDS = {"assistant": {"role", "content", "reasoning_content"}, "tool": {"role", "content", "tool_call_id", "name"}}


def record_errors(node, path: str = "$", root: bool = True) -> list[str]:
    """Where a record, or a sub-agent inside it, breaks the contract; counters must equal what the messages give."""
    if not isinstance(node, dict):
        return [f"{path} is not an object"]
    need = NODE | (ROOT if root else {})
    out = [f"{path}.{k} is missing" for k in need if k not in node] + [f"{path}.{k} is unknown" for k in node if k not in need and k not in MAY]
    out += [f"{path}.{k} is of a wrong type" for k, t in (need | MAY).items() if k in node and (not isinstance(node[k], t) or isinstance(node[k], bool))]
    if out:
        return out
    counts: dict[str, int] = {}
    rounds = 0
    for k, m in enumerate(node["messages"]):
        at, role = f"{path}.messages[{k}]", m.get("role") if isinstance(m, dict) else None
        if role not in ("system", "developer", "user", "assistant", "tool") or set(m) - {"reasoning", "reasoning_details", "tool_calls"} != ROLE_FIELDS.get(role, {"role", "content"}) or (role != "assistant" and set(m) & {"reasoning", "reasoning_details", "tool_calls"}):
            out.append(f"{at} has fields of another role")
            continue
        rounds += role == "assistant"
        for call in m.get("tool_calls") or ():
            try:
                counts[call["function"]["name"]] = counts.get(call["function"]["name"], 0) + 1
            except (KeyError, TypeError):
                out.append(f"{at} has a malformed call")
    audit = node["normalization_audit"]
    checks = {"total_rounds": rounds, "total_tool_calls": sum(counts.values()), "tool_counts": counts}
    out += [f"{path}.{k} differs from the messages" for k, v in checks.items() if node[k] != v]
    if audit.get("tag") not in ("pass", "quarantined", "excluded") or (audit.get("tag") == "pass" and audit.get("reason_codes")):
        out.append(f"{path}.normalization_audit contradicts itself")
    for name, child in (node.get("sub_agent_trajectory") or {}).items():
        out += record_errors(child, f"{path}.sub_agent_trajectory.{name}", False)
    return out
