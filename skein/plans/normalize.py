"""Captures to trajectories: parse, keep what counts, fold, merge, check, mount, number, name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markers, names
from ..functions.canonical import signature
from ..functions.tokens import estimated_tokens, visible_json, visible_text
from ..operators import accounting, merge, mounts, quality, tools
from ..operators.prefix import Fold, scope, token
from ..operators.storage import settled
from ..sources import captures
from ..sources.store import Store

ORDER = ("captured_at", "turn_id", "request_id", "source_path", "source_sha256")
TRACKED = ("instructions", "model", "harness", "termination", "user_id")


@dataclass
class Normalized:
    """What a run gives: ``trajectories``, ``messages`` of them, ``lineage``, ``edges`` of the mounts, ``quarantine`` and ``snapshots``."""

    trajectories: DataFrame
    messages: DataFrame
    lineage: DataFrame
    edges: DataFrame
    quarantine: DataFrame
    snapshots: DataFrame


def _calls_json(m: Column) -> Column:
    own = F.transform(m["tool_calls"], lambda c: F.concat(F.lit('{"arguments":'), c["arguments"], F.lit(',"id":'), F.to_json(c["id"].cast("variant")), F.lit(',"name":'), F.to_json(c["name"].cast("variant")), F.lit("}")))
    return F.when(m["tool_calls"].isNotNull(), F.concat(F.lit("["), F.array_join(own, ","), F.lit("]")))


def tokens_of(messages: Column) -> Column:
    return F.transform(messages, lambda m: token(m["role"], m["content"], m["name"], m["tool_call_id"], _calls_json(m)))


def codes(issues: Column, severity: str) -> Column:
    return F.transform(F.filter(issues, lambda i: i["severity"] == severity), lambda i: i["code"])


def foldable(snapshots: DataFrame) -> DataFrame:
    """Snapshots with what the fold looks at: ``capture_id``, scope, tokens, length of history and signature of compactions."""
    masked = F.array_contains(F.transform("issues", lambda i: i["code"]), "metadata_session_id_masked")
    return snapshots.withColumns(
        {
            "capture_id": F.col("source_path"),
            "scope": scope(F.col("session_id"), F.col("thread_id"), F.col("user_id"), masked, F.col("source_path")),
            "tokens": tokens_of(F.concat("history", "response")),
            "n_history": F.size("history"),
            "signature": signature(F.transform("compaction_items", lambda r: F.to_json(r))),
        }
    )


def normalize_snapshots(parsed: DataFrame) -> Normalized:
    """All of it over parsed captures. What several steps read is written once to the shared folder, so plans stay small."""
    good = parsed.where("reason IS NULL")
    counted = quality.eligible(F.col("operation"), F.col("wire_complete"), F.col("outcome"), codes(F.col("issues"), "error"))
    kept = good.where(counted)
    refused = good.where(~F.coalesce(counted, F.lit(False)))
    refusal = F.when(F.col("operation") == "count_tokens", "non_trajectory_operation").otherwise(F.concat(F.lit("snapshot_"), "outcome"))
    quarantine = parsed.where("reason IS NOT NULL").select("source_ref", "sha256", "reason", F.lit("skipped").alias("disposition")).unionByName(refused.select("source_ref", "sha256", refusal.alias("reason"), F.when(F.col("operation") == "count_tokens", "excluded").otherwise("quarantined").alias("disposition")))

    ready = settled(foldable(kept))
    slim = ready.select("capture_id", "scope", "tokens", F.col("n_history").alias("history"), "signature", *[c for c in ORDER if c != "source_path"], F.col("source_path"))
    fold = Fold(slim, ORDER, "signature")
    leaf_ids = settled(fold.leaves().select("capture_id"))
    leaves = settled(ready.join(leaf_ids, "capture_id", "left_semi").withColumnRenamed("capture_id", "leaf_id"))
    members = settled(fold.contributors())
    facts = members.join(ready.select("capture_id", *ORDER[:-1], "source_sha256", "tools", "server_tool_calls", "media", *TRACKED), "capture_id")

    merged_tools = settled(merge.richest_tools(facts.select("leaf_id", F.explode("tools").alias("t")).select("leaf_id", "t.*")))
    tool_list = merged_tools.groupBy("leaf_id").agg(F.array_sort(F.collect_list(F.struct("name", "description", "parameters"))).alias("tools"), F.bool_or("conflict").alias("tool_conflict"))
    own_media = facts.select("leaf_id", (F.col("capture_id") == F.col("leaf_id")).alias("is_leaf"), F.col("source_path").alias("source_order"), F.posexplode("media").alias("ordinal", "m"))
    media = merge.first_media(own_media.select("leaf_id", "is_leaf", "source_order", "ordinal", "m.*")).groupBy("leaf_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "part_id", "object_name"))).alias("media"))
    served = facts.select("leaf_id", "source_path", (F.col("capture_id") == F.col("leaf_id")).alias("is_leaf"), F.posexplode("server_tool_calls").alias("pos", "c"))
    server = merge.merge_server_calls(served.select("leaf_id", "source_path", "is_leaf", "pos", F.col("c.id").alias("call_id"), "c.name", "c.arguments", "c.origin", "c.result"))
    server = server.groupBy("leaf_id").agg(F.array_sort(F.collect_list(F.struct("call_id", "occurrence", "variant", "name", "arguments", "origin", "result"))).alias("server_calls"), F.bool_or("conflict").alias("server_conflict"))
    changed = merge.changed_fields(facts.select("leaf_id", *TRACKED), leaves.select("leaf_id", *TRACKED), TRACKED).groupBy("leaf_id").agg(F.array_sort(F.collect_set("field")).alias("changed"))

    messages = settled(leaves.select(F.col("leaf_id").alias("node_id"), F.posexplode(F.concat("history", "response")).alias("pos", "m")).select("node_id", "pos", "m.*"))
    calls = settled(messages.select("node_id", "pos", F.explode("tool_calls").alias("c")).select("node_id", "pos", F.col("c.id").alias("call_id"), "c.name", "c.arguments"))
    results = messages.where("role = 'tool'").select("node_id", "pos", F.col("tool_call_id").alias("call_id"), "name")
    definitions = merged_tools.select(F.col("leaf_id").alias("node_id"), "name", "description", "parameters")
    checked = tools.check_calls(calls, definitions)
    counters = tools.call_counters(checked)
    why = F.array_compact(F.array(F.when(F.col("undefined"), "undefined_tool"), F.when(F.size("extra") > 0, "extra_args"), F.when(F.size("missing") > 0, "missing_required"), F.when(F.size("mistyped") > 0, "type_mismatch")))
    details = tools.first_details(checked).groupBy("node_id").agg(F.array_sort(F.collect_list(F.struct(F.col("pos").alias("message_index"), F.col("call_id").alias("tool_call_id"), F.col("name").alias("tool"), why.alias("reasons"), "extra", "missing"))).alias("mismatches"))
    defects = settled(tools.pairing_issues(calls, results))
    paired = defects.groupBy("node_id").agg(F.array_sort(F.collect_set("code")).alias("pairing"))
    counts = tools.tool_counts(calls)
    said = estimated_tokens(visible_text("content")) + estimated_tokens(visible_text("reasoning_content")) + F.when(F.col("role") == "tool", estimated_tokens(F.col("name"))).otherwise(0)
    spoken = messages.groupBy("node_id").agg(F.sum(said).alias("message_tokens"), F.count_if(F.col("role") == "assistant").alias("total_rounds"), F.sum(F.when(F.col("role") == "assistant", estimated_tokens(F.col("reasoning_content"))).otherwise(0)).alias("reasoning_total_tokens"))
    called = calls.groupBy("node_id").agg(F.sum(estimated_tokens(F.col("name")) + estimated_tokens(visible_json("arguments"))).alias("call_tokens"))
    defined = definitions.groupBy("node_id").agg(F.sum(estimated_tokens(F.col("name")) + estimated_tokens(F.col("description")) + estimated_tokens(visible_json("parameters"))).alias("definition_tokens"))
    late = quality.trailing_unanswered(messages, defects.where("code = 'missing_tool_result'")).withColumn("trailing_unanswered_call", F.lit(True))

    events, evidence = mounts.spawn_evidence(_spawn_calls(kept))
    evidence = settled(evidence)
    holds = calls.where(names.is_spawn(F.col("name"))).join(leaves.select(F.col("leaf_id").alias("node_id"), "session_id", "thread_id"), "node_id").select(F.col("node_id").alias("leaf_id"), "session_id", "thread_id", "call_id", "arguments")
    linked = F.greatest(*[F.coalesce(F.length(c), F.lit(0)) for c in ("subagent_marker", "parent_thread_id", "parent_turn_id", "forked_from_thread_id")]) > 0
    kids = leaves.where(linked)
    chosen, _ = mounts.longest_children(kids.select("leaf_id", "session_id", "thread_id", F.size("tokens").alias("length"), F.concat_ws("\x1f", *ORDER).alias("leaf_key")))
    told = markers.marker(F.col("subagent_marker"))
    children = kids.join(chosen.select("leaf_id"), "leaf_id", "left_semi").select(
        F.col("leaf_id").alias("child_id"), "session_id", "thread_id", "parent_thread_id", "parent_turn_id", "forked_from_thread_id", "subagent_marker",
        *[told[f].alias(f"said_{f}") for f in ("parent_thread_id", "parent_turn_id", "forked_from_thread_id")],
        told["spawn_call_id"].alias("marker_call_id"), told["task_name"].alias("marker_task"), told["opaque"].alias("opaque"), _recipient().alias("recipient"),
    )
    children, refused = mounts.admitted(children, kept.where(linked).select("session_id", "thread_id", "parent_thread_id", "parent_turn_id", "forked_from_thread_id", "subagent_marker"))
    mounted = mounts.plan(events, holds, children)
    edges = settled(mounted["edges"].select("child_id", "parent_leaf", "call_id"))
    unsure = mounted["unbound"].select("code", "session_id", "thread_id").unionByName(evidence.select("code", "session_id", "thread_id"))
    concerned = mounts.affected_leaves(unsure.select("code", "session_id", F.col("thread_id").alias("parent_thread_id"), F.lit(None).cast("string").alias("child_thread_id")), leaves.select("leaf_id", "session_id", "thread_id"))
    failed = mounted["diagnostics"].select(F.col("subject").alias("node_id"), "code").unionByName(refused.select(F.col("child_id").alias("node_id"), "code")).unionByName(mounted["unmounted"].select(F.col("parent_leaf").alias("node_id"), F.lit("unmounted_spawn_call").alias("code"))).unionByName(concerned.select(F.col("leaf_id").alias("node_id"), "code"))
    failed = failed.groupBy("node_id").agg(F.array_sort(F.collect_set("code")).alias("mount_codes"))
    spawned = calls.where(names.is_spawn(F.col("name"))).groupBy("node_id").agg(F.count("*").alias("spawn_calls"), F.countDistinct("call_id").alias("spawn_ids"))
    subs = edges.groupBy(F.col("parent_leaf").alias("node_id")).agg(F.count("*").alias("mounted_subs"), F.array_sort(F.collect_set("child_id")).alias("children"))

    node = leaves.withColumnRenamed("leaf_id", "node_id").drop("tools", "media", "server_tool_calls")
    for part in (tool_list, media, server, changed):
        node = node.join(settled(part.withColumnRenamed("leaf_id", "node_id")), "node_id", "left")
    for part in (counters, details, paired, counts, spoken, called, defined, late, failed, spawned, subs):
        node = node.join(settled(part), "node_id", "left")
    node = node.join(edges.select(F.col("child_id").alias("node_id"), F.col("parent_leaf").alias("parent_id"), F.col("call_id").alias("spawn_call_id")), "node_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    some = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    transcript = F.concat("history", "response")
    final = quality.final_turn(F.try_element_at(transcript, F.lit(-1))["role"], F.coalesce(F.size(F.try_element_at(transcript, F.lit(-1))["tool_calls"]), F.lit(0)))
    hallucinated = F.size(F.array_distinct(F.transform(F.filter("issues", lambda i: (i["code"] == "responses_unsupported_tool_call") & (i["severity"] == "warning")), lambda i: F.struct(i["path"], i["detail"]))))
    subtree = (zero("spawn_calls") == zero("spawn_ids")) & (zero("mounted_subs") == zero("spawn_ids")) & (F.size(some("mount_codes")) == 0)
    has_sub = (zero("spawn_calls") > 0) | (zero("mounted_subs") > 0) | (F.size(some("mount_codes")) > 0)
    if_ = lambda test, code: F.when(test, F.array(F.lit(code))).otherwise(F.array().cast("array<string>"))
    local_reasons = F.concat(
        codes(F.col("issues"), "error"), some("pairing"), if_(F.size("missing_tool_defs") > 0, "missing_tool_definitions"),
        if_(zero("extra_arg_calls") + zero("missing_required_calls") + zero("type_mismatch_calls") > 0, "tool_call_schema_mismatch"), if_(~F.col("has_final_turn"), "no_final_assistant_turn"),
        if_(F.size("compaction_items") > 0, "opaque_compaction_context"), if_(F.col("hallucinated_calls") > 0, "hallucinated_tool_call"),
        if_(F.coalesce("tool_conflict", F.lit(False)), "conflicting_tool_definition"), if_(F.coalesce("server_conflict", F.lit(False)), "conflicting_server_tool_call"),
    )
    node = node.withColumns(
        {
            "is_subagent": linked, "has_final_turn": final, "local_subtree": subtree, "has_sub": has_sub, "hallucinated_calls": hallucinated.cast("long"), "trailing_unanswered_call": F.coalesce("trailing_unanswered_call", F.lit(False)),
            "total_tokens": estimated_tokens(F.col("instructions")) + zero("message_tokens") + zero("call_tokens") + zero("definition_tokens"), "missing_tool_defs": some("missing_tool_defs"),
        }
    ).withColumn("local_reasons", local_reasons)
    node = settled(node)
    # what descendants add to their root; a nested agent keeps to itself
    flags = node.select("node_id", (F.size("missing_tool_defs") > 0).alias("defs_bad"), (zero("mismatch_calls") > 0).alias("calls_bad"), ((F.size("local_reasons") > 0) | (zero("mismatch_calls") > 0)).alias("quality_bad"), F.col("local_subtree").alias("complete"), F.lit(0).cast("long").alias("unkeyed"))
    tree = mounts.reachable(edges.select(F.col("child_id").alias("node"), F.col("parent_leaf").alias("up")), node.where("parent_id IS NULL").select(F.col("node_id").alias("node")))
    roll = quality.tree_rollup(flags, tree.select(F.col("root").alias("root_id"), F.col("node").alias("node_id"))).withColumnRenamed("root_id", "node_id")
    node = node.join(roll, "node_id", "left")
    top, below = F.col("parent_id").isNull(), lambda c: F.coalesce(F.col(c), F.lit(False))
    local = F.col("has_final_turn") & (F.size(some("pairing")) == 0)
    node = node.withColumn("subtree_complete", F.coalesce("subtree_complete", "local_subtree")).withColumns(
        {
            "completeness_tag": quality.completeness_tag(local, F.col("has_sub"), F.col("subtree_complete"), F.col("is_subagent") & top),
            "tool_defs_tag": quality.tool_defs_tag(F.size("missing_tool_defs"), below("child_defs_bad"), top), "tool_call_tag": quality.tool_call_tag(zero("mismatch_calls"), below("child_calls_bad"), top),
        }
    )
    reasons = F.concat(F.col("local_reasons"), some("mount_codes"), if_(F.col("has_sub") & ~F.col("subtree_complete"), "incomplete_subagent_mount"), if_(below("child_quality_bad"), "subagent_quality_failure"), if_(F.col("is_subagent") & top, "orphan_subagent"))
    node = node.withColumn("reason_codes", F.array_sort(F.array_distinct(reasons)))
    passed = quality.strict(F.col("reason_codes"), F.col("tool_defs_tag"), F.col("tool_call_tag"), F.col("hallucinated_calls"), F.col("completeness_tag"))
    node = node.withColumn("disposition", F.when(passed, "pass").otherwise("quarantined"))
    identity = F.to_json(F.struct(names.first_real(F.col("user_id"), F.lit(names.NO_USER)), names.real_session(F.col("session_id")), F.col("user_id") == "", F.col("instructions"), F.col("termination"), F.col("harness"), F.col("model")))
    content = F.concat_ws("\x1f", F.array_join("tokens", "\x1e"), F.coalesce(F.to_json("tools"), F.lit("")), F.coalesce(F.to_json(F.transform("server_calls", lambda c: F.struct(c["call_id"], c["name"], c["arguments"], c["result"]))), F.lit("")), F.coalesce(F.to_json("media"), F.lit("")), "signature", identity)
    node = settled(node.withColumn("trajectory_id", F.sha2(content, 256)))

    ranked = node.select("trajectory_id", "disposition", "captured_at", F.col("source_path").alias("path"), F.col("source_sha256").alias("sha"), "node_id")
    best = merge.representatives(ranked).select("trajectory_id", F.col("path").alias("node_id"), "origin_count")
    unique = settled(node.join(best, ["trajectory_id", "node_id"]))
    numbered = accounting.sub_session_numbers(unique.select("trajectory_id", "session_id", (names.real_session(F.col("session_id")) == "").alias("synthesized"), F.col("captured_at").alias("created_at"), F.col("source_path").alias("source_file")))
    unique = unique.join(numbered.select("trajectory_id", "sub_session_id"), "trajectory_id")
    # a mount on a copy that another trajectory stands for has no place to go: its child is a root of its own
    present = unique.select(F.col("node_id").alias("_parent"))
    unique = settled(unique.join(present, F.col("parent_id") == F.col("_parent"), "left").withColumn("parent_id", F.col("_parent")).drop("_parent"))
    tree = mounts.reachable(unique.where("parent_id IS NOT NULL").select(F.col("node_id").alias("node"), F.col("parent_id").alias("up")), unique.where("parent_id IS NULL").select(F.col("node_id").alias("node")))
    root_ids = tree.join(unique.select(F.col("node_id").alias("root"), F.col("trajectory_id").alias("root_id")), "root").join(unique.select(F.col("node_id").alias("node"), "trajectory_id"), "node").select("trajectory_id", "root_id", "root")
    origins = node.select("trajectory_id", F.col("node_id").alias("leaf_id"), "disposition", "reason_codes").join(members, "leaf_id").join(kept.select(F.col("source_path").alias("capture_id"), F.col("source_sha256").alias("sha"), "captured_at"), "capture_id")
    own = F.struct("captured_at", F.col("capture_id").alias("source_ref"), F.col("sha").alias("sha256"), "disposition", "reason_codes")
    first = origins.join(root_ids, "trajectory_id").groupBy(F.col("root_id").alias("trajectory_id"), F.col("root").alias("representative"), "capture_id").agg(F.min(own).alias("o"))
    lineage = first.groupBy("trajectory_id", "representative").agg(F.array_sort(F.collect_list("o")).alias("origins")).withColumn("origin_count", F.size("origins"))
    drop = ("local_subtree", "has_sub", "local_reasons", "child_defs_bad", "child_calls_bad", "child_quality_bad", "tokens", "history", "response", "signature", "scope", "n_history", "wire_complete", "operation", "outcome", "provider")
    return Normalized(settled(unique.drop(*drop)), messages, settled(lineage), edges, settled(quarantine), kept)


def _recipient() -> Column:
    """The one agent that messages to a child from its parent name, if they name one."""
    own = F.array_distinct(F.transform(F.filter("agent_messages", lambda a: (a["origin"] == "history") & (F.get_json_object(a["item"], "$.author") == names.parent_path(F.get_json_object(a["item"], "$.recipient")))), lambda a: F.get_json_object(a["item"], "$.recipient")))
    return F.when(F.size(own) == 1, own[0]).otherwise("")


def _spawn_calls(kept: DataFrame) -> DataFrame:
    """The spawn calls of all responses, with the task names that results after such calls give them."""
    calls = kept.select("session_id", "thread_id", "turn_id", F.explode("response").alias("m")).select("session_id", "thread_id", "turn_id", F.explode("m.tool_calls").alias("c"))
    calls = calls.where(names.is_spawn(F.col("c.name"))).select("session_id", "thread_id", "turn_id", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"))
    asked = kept.select("session_id", "thread_id", F.explode(F.concat("history", "response")).alias("m"))
    results = asked.where("m.role = 'tool'").where(names.is_spawn(F.col("m.name"))).select("session_id", "thread_id", F.col("m.tool_call_id").alias("call_id"), F.col("m.name").alias("name"), F.get_json_object("m.content", "$.task_name").alias("task"))
    agents = results.where("task <> ''").groupBy("session_id", "thread_id", "call_id", "name").agg(F.collect_set("task").alias("names"))
    return calls.join(agents, ["session_id", "thread_id", "call_id", "name"], "left")


def normalize(spark: SparkSession, root: str, source: str, work: str, resume: bool = False) -> Normalized:
    """The files below ``root`` normalized; parsed captures are written to ``work`` and read back.

    With ``resume`` only captures that are new or changed since the last run are parsed, and those that are gone drop out."""
    raw, path = captures.read(spark, root, source), f"{work.rstrip('/')}/snapshots"
    if resume and Store(spark, work).exists("snapshots"):
        old = settled(spark.read.parquet(path))
        state = accounting.resume_diff(old.select("source_ref", F.col("sha256").alias("sha")), raw.select("source_ref", F.col("sha256").alias("sha")))
        state = settled(state)
        same = old.join(state.where("state = 'unchanged'"), "source_ref", "left_semi")
        parsed = same.unionByName(captures.parse_captures(raw.join(state.where("state IN ('added', 'changed')"), "source_ref", "left_semi"), source))
        settled(parsed).write.mode("overwrite").parquet(path)
    else:
        captures.parse_captures(raw, source).write.mode("overwrite").parquet(path)
    return normalize_snapshots(spark.read.parquet(path))
