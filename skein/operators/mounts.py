"""Sub-agent runs mounted on the calls that spawned them.

``events(session_id, thread_id, turn_id, call_id, arguments, task_name, agent_name)`` are spawn calls that responses
made; ``contains(leaf_id, session_id, thread_id, call_id, arguments)`` the spawn calls that maximal transcripts hold;
``children(child_id, session_id, parent_thread_id, parent_turn_id, marker_call_id, marker_task, recipient)`` the leaves
of linked runs. Every step is a join whose ambiguous rows become diagnostics; nothing is chosen by order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import base_name, parent_path
from .storage import settled

EVENT = ("session_id", "thread_id", "turn_id", "call_id")


def result_names(results: DataFrame, calls: DataFrame) -> DataFrame:
    """``(capture_id, call_id, agent_name, names)``: the one task name that results after a spawn call give; null if several.

    ``results(capture_id, pos, call_id, task_name)``, ``calls(capture_id, pos, call_id)``."""
    after = calls.select("capture_id", "call_id", F.col("pos").alias("call_pos")).join(results, ["capture_id", "call_id"]).where("pos > call_pos AND task_name <> ''")
    return after.groupBy("capture_id", "call_id").agg(F.countDistinct("task_name").alias("names"), F.min("task_name").alias("agent_name")).withColumn("agent_name", F.when(F.col("names") == 1, F.col("agent_name")))


def spawn_evidence(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events of the spawn calls that responses made, one for each turn and call, and ``(session_id, thread_id, turn_id,
    call_id, code)`` of what they lack.

    ``calls(session_id, thread_id, turn_id, call_id, name, arguments, names)``, ``names`` being the task names that results give.
    A call without turn or id is no event; arguments that are no object name no task; a call that replays tell differently is
    not used; several names of its agent are none."""
    lacks = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    is_object = F.startswith(F.trim("arguments"), F.lit("{")) & F.try_parse_json("arguments").isNotNull()
    told = calls.withColumns({"bare": lacks("turn_id") | lacks("call_id"), "whole": F.coalesce(is_object, F.lit(False)), "names": F.array_distinct(F.coalesce("names", F.array().cast("array<string>")))})
    told = told.withColumn("task_name", F.when(F.col("whole"), F.coalesce(F.get_json_object("arguments", "$.task_name"), F.lit(""))).otherwise(""))
    told = told.withColumn("signature", F.struct(F.when(F.col("whole"), F.col("arguments")).otherwise("{}"), "task_name", "name"))
    per = told.where("NOT bare").groupBy(*EVENT).agg(F.min("signature").alias("low"), F.max("signature").alias("high"), F.min("task_name").alias("task_name"), F.min("arguments").alias("arguments"), F.array_distinct(F.flatten(F.collect_set("names"))).alias("names"))
    agent = F.when(F.size("names") == 1, F.col("names")[0]).otherwise("")
    events = per.where("low = high").select(*EVENT, "arguments", "task_name", agent.alias("agent_name"))
    codes = F.array_compact(F.array(
        F.when(lacks("turn_id"), "spawn_missing_turn_id").when(lacks("call_id"), "spawn_missing_call_id"),
        F.when(~F.col("bare") & ~F.col("whole"), "malformed_spawn_arguments"),
        F.when(~F.col("bare") & (F.size("names") > 1), "conflicting_spawn_agent_name"),
    ))
    bad = told.select(*EVENT, F.explode(codes).alias("code")).distinct()
    return events, bad.unionByName(per.where("low <> high").select(*EVENT, F.lit("conflicting_spawn_evidence").alias("code")))


def admitted(children: DataFrame, evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The children whose linkage is whole and says the same everywhere, and ``(child_id, code)`` of all others.

    ``children(child_id, session_id, thread_id, subagent_marker, parent_thread_id, parent_turn_id, forked_from_thread_id,
    said_parent_thread_id, said_parent_turn_id, said_forked_from_thread_id)``, where ``said_`` is what the marker states;
    ``evidence`` the linkage of all linked captures of their threads."""
    fields = ("parent_thread_id", "parent_turn_id", "forked_from_thread_id", "subagent_marker")
    plain = lambda c: F.coalesce(F.col(c), F.lit(""))
    varied = evidence.groupBy("session_id", "thread_id").agg(*[(F.min(plain(f)) != F.max(plain(f))).alias(f"varied_{f}") for f in fields])
    own = children.join(varied, ["session_id", "thread_id"], "left")
    unlike = F.lit(False)
    for f in fields[:3]:
        unlike = unlike | ((plain(f"said_{f}") != "") & (plain(f"said_{f}") != plain(f)))
    several = lambda f: F.coalesce(F.col(f"varied_{f}"), F.lit(False))
    codes = F.array_compact(F.array(
        F.when(plain("subagent_marker") == "", "missing_subagent_marker"),
        F.when(plain("parent_thread_id") == "", "missing_parent_thread_id"),
        F.when(plain("parent_turn_id") == "", "missing_parent_turn_id"),
        F.when(unlike | several("subagent_marker"), "conflicting_marker_metadata"),
        F.when(several(fields[0]) | several(fields[1]) | several(fields[2]), "conflicting_parent_thread"),
    ))
    told = settled(own.withColumn("codes", codes).drop(*[f"varied_{f}" for f in fields]))
    return told.where("size(codes) = 0").drop("codes"), told.select("child_id", F.explode("codes").alias("code"))


def bind_parents(events: DataFrame, contains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events with the one leaf of their thread that holds the call, and ``(event key, code, n)`` of all others."""
    held = contains.select("leaf_id", "session_id", "thread_id", "call_id", F.col("arguments").alias("held")).distinct()
    found = events.join(held, ["session_id", "thread_id", "call_id"], "left")
    same = F.col("leaf_id").isNotNull() & (F.col("held").isNull() | F.col("arguments").isNull() | (F.col("held") == F.col("arguments")))
    counted = found.groupBy(*EVENT).agg(F.count_distinct(F.when(same, F.col("leaf_id"))).alias("n"), F.min(F.when(same, F.col("leaf_id"))).alias("parent_leaf"))
    bound = events.join(counted.where("n = 1").drop("n"), list(EVENT))
    code = F.when(F.col("n") == 0, "missing_parent_leaf").otherwise("ambiguous_parent_leaf")
    return bound, counted.where("n <> 1").select(*EVENT, code.alias("code"), "n")


def longest_children(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The longest leaf of each child thread, ties by key, and the branches that were not chosen: ``leaves(leaf_id, session_id, thread_id, length, leaf_key)``."""
    best = leaves.groupBy("session_id", "thread_id").agg(F.min_by("leaf_id", F.struct((-F.col("length")).alias("a"), "leaf_key")).alias("chosen"))
    marked = leaves.join(best, ["session_id", "thread_id"])
    return marked.where("leaf_id = chosen").drop("chosen"), marked.where("leaf_id <> chosen").select("leaf_id", "chosen", F.lit("unselected_child_branch").alias("code"))


def inconsistent_threads(evidence: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Threads whose captures give different values, none of them empty, of a linkage field: ``(session_id, thread_id, field)``."""
    flags = evidence.groupBy("session_id", "thread_id").agg(*[(F.count_distinct(F.nullif(F.col(f), F.lit(""))) > 1).alias(f) for f in fields])
    named = F.filter(F.array(*[F.when(F.col(f), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return flags.select("session_id", "thread_id", F.explode(named).alias("field"))


def route_children(children: DataFrame, bound: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(child_id, event key, parent_leaf)`` of children that one event fits, and ``(child_id, code)`` of all others.

    Events of the parent's turn are narrowed by the marker's call id, then its task, each only where the child states
    it. A marker without structure (``opaque``) that is the call id or task of some of several events leaves those. If a
    recipient is stated, those whose agent has that name fit, else those without a name whose task is its last part.
    """
    required = F.when(F.coalesce("parent_thread_id", F.lit("")) == "", "missing_parent_thread_id").when(F.coalesce("parent_turn_id", F.lit("")) == "", "missing_parent_turn_id")
    told = children.withColumn("code", required)
    bad = told.where("code IS NOT NULL").select("child_id", "code")
    events = bound.select("session_id", F.col("thread_id").alias("parent_thread_id"), F.col("turn_id").alias("parent_turn_id"), "call_id", "task_name", "agent_name", "parent_leaf")
    pairs = told.where("code IS NULL").drop("code").join(events, ["session_id", "parent_thread_id", "parent_turn_id"], "left")
    stated = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    fits = F.col("call_id").isNotNull() & (~stated("marker_call_id") | (F.col("marker_call_id") == F.col("call_id"))) & (~stated("marker_task") | (F.col("marker_task") == F.col("task_name")))
    tier = F.when(~stated("recipient") | (F.col("recipient") == F.col("agent_name")), 0).when(~stated("agent_name") & (base_name(F.col("recipient")) == F.col("task_name")), 1)
    own = F.struct("session_id", F.col("parent_thread_id").alias("thread_id"), F.col("parent_turn_id").alias("turn_id"), "call_id", "parent_leaf")
    pairs = pairs.withColumn("tier", F.when(fits, tier))
    if "opaque" in children.columns:
        exact = fits & ~stated("marker_call_id") & ~stated("marker_task") & stated("opaque") & ((F.trim("opaque") == F.col("call_id")) | (F.trim("opaque") == F.col("task_name")))
        pairs = pairs.withColumn("named", F.max(F.coalesce(exact, F.lit(False))).over(Window.partitionBy("child_id"))).withColumn("tier", F.when(~F.col("named") | exact, F.col("tier")))
    # one pass: of each tier how many events fit, and the only one if there is no other
    per = pairs.groupBy("child_id").agg(
        F.count("call_id").alias("on_turn"),
        *[F.count_if(F.col("tier") == t).alias(f"n{t}") for t in (0, 1)],
        *[F.min(F.when(F.col("tier") == t, own)).alias(f"own{t}") for t in (0, 1)],
    )
    per = settled(per.select("child_id", "on_turn", F.when(F.col("n0") > 0, F.col("n0")).otherwise(F.col("n1")).alias("n"), F.when(F.col("n0") > 0, F.col("own0")).otherwise(F.col("own1")).alias("own")))
    code = F.when(F.col("on_turn") == 0, "missing_spawn_call").when(F.col("n") == 0, "spawn_routing_mismatch").otherwise("ambiguous_spawn_call")
    return per.where("n = 1").select("child_id", "own.*"), bad.unionByName(per.where("n <> 1").select("child_id", code.alias("code")))


def single_claims(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges that alone claim their call, and the children of all others."""
    n = F.count("*").over(Window.partitionBy("parent_leaf", "call_id"))
    marked = edges.withColumn("_n", n)
    return marked.where("_n = 1").drop("_n"), marked.where("_n > 1").select("child_id", F.lit("multiple_children_for_spawn").alias("code"))


def attach_relays(edges: DataFrame, messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(child_id, relay_id)`` of mounted children, and ``(child_id, code)`` where none can be told.

    ``edges(child_id, parent_leaf, call_id, agent_name)``, ``messages(leaf_id, message_id, author, recipient, preceding)``: the
    one message of the parent that the agent wrote to its own parent after its spawn was done."""
    own = edges.where(F.coalesce("agent_name", F.lit("")) != "")
    pairs = own.join(messages, (F.col("leaf_id") == F.col("parent_leaf")) & (F.col("author") == F.col("agent_name")), "left")
    to_parent = F.col("recipient") == parent_path(F.col("agent_name"))
    after = F.array_contains("preceding", F.col("call_id"))
    counted = pairs.groupBy("child_id", "parent_leaf").agg(F.count("message_id").alias("written"), F.count_if(to_parent).alias("addressed"), F.count_if(to_parent & after).alias("n"), F.min(F.when(to_parent & after, F.col("message_id"))).alias("relay_id"))
    shared = F.count("relay_id").over(Window.partitionBy("parent_leaf", "relay_id"))
    counted = counted.withColumn("shared", F.when(F.col("n") == 1, shared))
    code = (
        F.when(F.col("written") == 0, "unmatched_agent_message")
        .when(F.col("addressed") == 0, "agent_relay_recipient_mismatch")
        .when(F.col("n") == 0, "agent_relay_before_spawn")
        .when(F.col("n") > 1, "ambiguous_agent_relay")
        .when(F.col("shared") > 1, "relay_id_conflict")
    )
    told = counted.withColumn("code", code)
    nameless = edges.where(F.coalesce("agent_name", F.lit("")) == "").select("child_id", F.lit("missing_child_agent_name").alias("code"))
    return told.where("code IS NULL").select("child_id", "relay_id"), told.where("code IS NOT NULL").select("child_id", "code").unionByName(nameless)


def _jumped(edges: DataFrame, rounds: int) -> DataFrame:
    """``(node, top)`` after ``2 ** rounds`` steps along ``edges(node, up)``, or as many as reach a root from everywhere."""
    own = settled(edges.select("node", "up"))
    for _ in range(rounds):
        over = own.select(F.col("node").alias("up"), F.col("up").alias("further"))
        own = settled(own.join(over, "up", "left").select("node", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")))
        if own.where("moved").isEmpty():
            break
        own = own.drop("moved")
    return own.select("node", F.col("up").alias("top"))


def cycles(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """``(node)`` of ``edges(node, up)``, one for each node, that lie on a cycle.

    After as many steps as there are nodes, by pointer jumping, every node has come to a root or onto its cycle, and
    exactly the nodes of cycles are come to by such steps without being roots."""
    edges = settled(edges)
    rounds = rounds if rounds is not None else max(1, (edges.count() + 1).bit_length())
    tops = _jumped(edges, rounds).select(F.col("top").alias("node")).distinct()
    return tops.join(edges.select("node"), "node", "left_semi")


def reachable(edges: DataFrame, roots: DataFrame, rounds: int | None = None) -> DataFrame:
    """``(node, root)`` of all nodes below ``roots(node)`` along ``edges(node, up)``, the roots themselves with it."""
    edges = settled(edges)
    rounds = rounds if rounds is not None else max(1, (edges.count() + 1).bit_length())
    tops = _jumped(edges, rounds)
    main = roots.select(F.col("node").alias("top")).distinct()
    below = tops.join(main, "top", "left_semi").select("node", F.col("top").alias("root"))
    return below.union(roots.select("node", F.col("node").alias("root")).distinct()).distinct()


def affected_leaves(diagnostics: DataFrame, leaves: DataFrame) -> DataFrame:
    """``(leaf_id, code)``: a diagnostic concerns the leaves of its session that are of its parent thread or its child thread.

    ``diagnostics(code, session_id, parent_thread_id, child_thread_id)``, ``leaves(leaf_id, session_id, thread_id)``."""
    threads = F.explode(F.array_distinct(F.array_compact(F.array("parent_thread_id", "child_thread_id"))))
    return diagnostics.select("code", "session_id", threads.alias("thread_id")).join(leaves, ["session_id", "thread_id"]).select("leaf_id", "code").distinct()


def plan(events: DataFrame, contains: DataFrame, children: DataFrame) -> dict[str, DataFrame]:
    """All steps in order: events bound, children routed, double claims and cycles removed, what no main root reaches dropped.

    ``edges`` are the mounts left, ``diagnostics(subject, code)`` why others failed; ``unmounted`` the
    bound events without child, ``unbound`` those that no one leaf holds."""
    events, children = settled(events), settled(children)
    bound, parents = bind_parents(events, contains)
    bound = settled(bound)
    routed, lost = route_children(children, bound)
    single, claimed = single_claims(settled(routed))
    up = single.select(F.col("child_id").alias("node"), F.col("parent_leaf").alias("up"))
    ring = cycles(up)
    ring = settled(ring)
    open_ = single.join(ring.select(F.col("node").alias("child_id")), "child_id", "left_anti")
    open_ = settled(open_)
    kids = children.select(F.col("child_id").alias("node"))
    roots = open_.select(F.col("parent_leaf").alias("node")).distinct().join(kids, "node", "left_anti")
    below = reachable(open_.select(F.col("child_id").alias("node"), F.col("parent_leaf").alias("up")), roots)
    below = settled(below)
    kept = open_.join(below.select(F.col("node").alias("child_id")), "child_id", "left_semi")
    adrift = open_.join(below.select(F.col("node").alias("child_id")), "child_id", "left_anti")
    named = lambda df, key, code: df.select(F.col(key).alias("subject"), F.lit(code).alias("code"))
    diagnostics = (
        parents.select(F.concat_ws("/", *EVENT).alias("subject"), "code")
        .unionByName(lost.select(F.col("child_id").alias("subject"), "code"))
        .unionByName(claimed.select(F.col("child_id").alias("subject"), "code"))
        .unionByName(named(ring, "node", "mount_cycle"))
        .unionByName(named(adrift, "child_id", "unreachable_subagent"))
    )
    unmounted = bound.join(kept.select(*EVENT), list(EVENT), "left_anti")
    return {"edges": kept, "diagnostics": diagnostics.unionByName(unmounted.select(F.concat_ws("/", *EVENT).alias("subject"), F.lit("unmounted_spawn_call").alias("code"))), "unmounted": unmounted, "unbound": parents}


def message_index(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One record for each agent message of a thread, and the ids that can't be trusted: ``(session_id, thread_id, message_id, code)``.

    ``messages(session_id, thread_id, capture_id, message_id, item)``. Captures replay messages, so equal items are one; an id
    that one capture has twice, or that stands for different items, is not used."""
    key = ["session_id", "thread_id", "message_id"]
    own = messages.where(F.coalesce("message_id", F.lit("")) != "")
    per = own.groupBy(*key, "capture_id").agg(F.count("*").alias("n"), F.min("item").alias("low"), F.max("item").alias("high"))
    whole = per.groupBy(*key).agg(F.max("n").alias("n"), F.min("low").alias("item"), F.max("high").alias("other"))
    code = F.array_compact(F.array(F.when(F.col("n") > 1, "duplicate_agent_message_id"), F.when(F.col("item") != F.col("other"), "conflicting_agent_message_evidence")))
    told = whole.withColumn("codes", code)
    return told.where("size(codes) = 0").select(*key, "item"), told.select(*key, F.explode("codes").alias("code"))
