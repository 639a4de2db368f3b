"""Which captures and trajectories count, and how complete they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Errors in spite of which a capture's transcript can be used.
MATERIALIZABLE = (
    "ambiguous_server_tool_result",
    "duplicate_server_tool_call_id",
    "duplicate_server_tool_result",
    "duplicate_tool_call_id",
    "duplicate_tool_result",
    "invalid_agent_message_author",
    "invalid_agent_message_id",
    "invalid_agent_message_recipient",
    "invalid_server_tool_call",
    "invalid_server_tool_result",
    "invalid_tool_call",
    "invalid_tool_result",
    "missing_server_tool_id",
    "missing_tool_arguments",
    "missing_tool_call_id",
    "missing_tool_name",
    "missing_tool_result_id",
    "missing_tool_result_name",
    "orphan_server_tool_result",
    "orphan_tool_result",
    "tool_result_type_mismatch",
)
COMPLETE = ("complete_main_no_sub", "complete_main_with_complete_sub")


def eligible(operation: Column, wire_complete: Column, outcome: Column, errors: Column, allowed=MATERIALIZABLE) -> Column:
    """Whether a capture takes part: a whole answer that succeeded, or whose errors all are of the allowed codes."""
    mild = (F.size(errors) > 0) & (F.size(F.array_except(errors, F.array(*[F.lit(c) for c in allowed]))) == 0)
    return (operation != "count_tokens") & wire_complete & ((outcome == "success") | mild)


def final_turn(role: Column, n_calls: Column) -> Column:
    """Whether a last message is an assistant's without calls."""
    return F.coalesce((role == "assistant") & (n_calls == 0), F.lit(False))


def completeness_tag(local: Column, has_sub: Column, subtree: Column, orphan: Column) -> Column:
    """One of seven tags of a root."""
    return (
        F.when(orphan, "orphan_sub")
        .when(local & ~has_sub, "complete_main_no_sub")
        .when(~local & ~has_sub, "incomplete_main_no_sub")
        .when(local & subtree, "complete_main_with_complete_sub")
        .when(local, "complete_main_with_incomplete_sub")
        .when(subtree, "incomplete_main_with_complete_sub")
        .otherwise("incomplete_main_with_incomplete_sub")
    )


def tool_defs_tag(missing: Column, child_bad: Column, top: Column) -> Column:
    return F.when(missing > 0, "incomplete").when(top & child_bad, "complete_with_incomplete_sub").otherwise("complete")


def tool_call_tag(mismatches: Column, child_bad: Column, top: Column) -> Column:
    return F.when(mismatches > 0, "inconsistent").when(top & child_bad, "consistent_with_inconsistent_sub").otherwise("consistent")


def strict(reason_codes: Column, defs: Column, calls: Column, hallucinated: Column, tag: Column) -> Column:
    """Whether a trajectory is a strict sample."""
    return (F.size(reason_codes) == 0) & (defs == "complete") & (calls == "consistent") & (hallucinated == 0) & tag.isin(*COMPLETE)


def trailing_unanswered(messages: DataFrame, missing: DataFrame) -> DataFrame:
    """Nodes with a call without result behind which no assistant speaks: ``messages(node_id, pos, role)``, ``missing(node_id, pos)``."""
    last = messages.where("role = 'assistant'").groupBy("node_id").agg(F.max("pos").alias("last"))
    late = missing.groupBy("node_id").agg(F.max("pos").alias("pos")).join(last, "node_id", "left")
    return late.where(F.coalesce("last", F.lit(-1)) <= F.col("pos")).select("node_id")


def tree_rollup(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Each root with what its descendants add: ``nodes(node_id, defs_bad, calls_bad, quality_bad, complete, unkeyed)`` and
    ``roots(root_id, node_id)`` of a transitive closure that includes the root itself."""
    child = F.col("root_id") != F.col("node_id")
    some = lambda c: F.coalesce(F.bool_or(F.when(child, F.col(c))), F.lit(False)).alias("child_" + c)
    return roots.join(nodes, "node_id").groupBy("root_id").agg(some("defs_bad"), some("calls_bad"), some("quality_bad"), F.bool_and("complete").alias("subtree_complete"), F.sum("unkeyed").alias("unkeyed_mounts"))


def message_fields_valid(role: Column, has_reasoning: Column, n_calls: Column, call_id: Column, name: Column) -> Column:
    """Whether a message has the fields of its role and no others; ``n_calls`` is null without a list of calls."""
    is_result = call_id.isNotNull() | name.isNotNull()
    return (
        F.when(role == "assistant", has_reasoning & F.coalesce(n_calls > 0, F.lit(True)) & ~is_result)
        .when(role == "tool", (F.coalesce(call_id, F.lit("")) != "") & name.isNotNull() & ~has_reasoning & n_calls.isNull())
        .when(role.isin("system", "developer", "user"), ~has_reasoning & n_calls.isNull() & ~is_result)
        .otherwise(False)
    )
