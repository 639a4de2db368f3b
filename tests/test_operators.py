"""Operators against plain versions, and cases that the given tables don't have."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skein.functions import names, projection, tokens
from skein.operators import labels, merge, mounts, quality, tools
from skein.operators.prefix import Fold, token
from skein.streaming import fold

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def captures(spark, rows):
    return spark.createDataFrame(rows, "capture_id string, scope string, tokens array<string>, history int")


def plain_leaves(rows):
    covered = {a[0] for a in rows for b in rows if a[1] == b[1] and len(a[2]) < len(b[2]) and len(a[2]) <= b[3] and b[2][: len(a[2])] == a[2]}
    return sorted(r[0] for r in rows if r[0] not in covered)


@few
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcd"), max_size=6), st.integers(0, 6), st.sampled_from("xy")), min_size=1, max_size=14))
def test_fold_equals_brute_force(spark, drawn):
    rows = [(f"c{k:02d}", s, t, min(h, len(t))) for k, (t, h, s) in enumerate(drawn)]
    own = Fold(captures(spark, rows))
    assert sorted(r["capture_id"] for r in own.leaves().collect()) == plain_leaves(rows)
    leaves = set(plain_leaves(rows))
    expected = {(x, x) for x in leaves} | {(b[0], a[0]) for b in rows if b[0] in leaves for a in rows if a[1] == b[1] and len(a[2]) < len(b[2]) and len(a[2]) <= b[3] and b[2][: len(a[2])] == a[2]}
    assert {(r["leaf_id"], r["capture_id"]) for r in own.contributors().collect()} == expected


def test_long_history_and_chains(spark):
    long = [f"m{k}" for k in range(19_998)]
    rows = [("long", "s", long, 19_997), ("one", "s", long[:1], 0), ("other", "s", ["z"], 0), ("near", "s", [*long[:5], "q"], 5)]
    assert sorted(r["capture_id"] for r in Fold(captures(spark, rows)).leaves().collect()) == ["long", "near", "other"]
    chains = [(f"{g}-{n}", "s", [f"g{g}m{k}" for k in range(n)], n - 1) for g in range(100) for n in (21, 23, 25, 27)]
    random.Random(1).shuffle(chains)
    assert Fold(captures(spark, chains)).leaves().count() == 100


def test_token_is_json(spark):
    row = spark.range(1).select(token(F.lit("assistant"), F.lit('a"b\n'), calls=F.lit("[1]")).alias("a"), token(F.lit("tool"), F.lit(""), F.lit(None), F.lit("i")).alias("b")).first()
    assert json.loads(row["a"]) == {"content": 'a"b\n', "role": "assistant", "tool_calls": [1]}
    assert json.loads(row["b"]) == {"content": "", "name": None, "role": "tool", "tool_call_id": "i"}


def test_stream_by_any_order(spark, tmp_path):
    rows = [(f"c{k}", f"s{k % 2}", [f"t{j}" for j in range(k // 2 + 1)], k // 2) for k in range(12)]
    random.Random(2).shuffle(rows)
    for k in range(0, 12, 3):
        captures(spark, rows[k : k + 3]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(captures(spark, rows).schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    job = fold.fold_stream(stream).writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/out/{n}")).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
    job.awaitTermination()
    found = fold.current(spark.read.schema(fold.UPDATES).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out"))
    assert sorted(r["capture_id"] for r in found.where("kind = 'leaf'").collect()) == plain_leaves(rows) == ["c10", "c11"]


@pytest.mark.parametrize(
    ("arguments", "parameters", "expected"),
    [
        ('{"a":1}', '{"properties":{"a":{"type":"number"}}}', ([], [], [], False)),
        ('{"a":null}', '{"properties":{"a":{"type":["string","null"]}}}', ([], [], [], False)),
        ('{"a":"x","b":1}', '{"properties":{"a":{"type":"integer"}},"required":["a","c","d"]}', (["b"], ["c", "d"], ["a:integer:string"], True)),
        ("{}", '{"properties":{"a":{"default":null},"b":{"type":["null"]}},"required":["a","b"]}', ([], [], [], False)),
        ('{"a":true}', '{"properties":{"a":{}}}', ([], [], [], False)),
    ],
)
def test_call_check(spark, arguments, parameters, expected):
    calls = spark.createDataFrame([("n", 1, "c", "f", arguments)], "node_id string, pos int, call_id string, name string, arguments string")
    defined = spark.createDataFrame([("n", "f", "", parameters)], "node_id string, name string, description string, parameters string")
    r = tools.check_calls(calls, defined).first()
    assert (r["extra"], r["missing"], r["mistyped"], r["mismatch"]) == expected and not r["unverifiable"]


def test_unverifiable(spark):
    calls = spark.createDataFrame([("n", 1, "c", "f", "[1]"), ("n", 2, "d", "g", "{}"), ("n", 3, "e", "h", "{}")], "node_id string, pos int, call_id string, name string, arguments string")
    defined = spark.createDataFrame([("n", "f", "", '{"properties":{}}'), ("n", "g", "", "{}")], "node_id string, name string, description string, parameters string")
    out = {r["call_id"]: r for r in tools.check_calls(calls, defined).collect()}
    assert out["c"]["unverifiable"] and out["d"]["unverifiable"] and out["e"]["undefined"] and out["e"]["mismatch"]


def test_tools_conflict(spark):
    rows = [("l", "a", "", '{"x":1}'), ("l", "a", "long", '{"x":1,"y":2}'), ("l", "b", "", '{"x":1}'), ("l", "b", "", '{"z":3}')]
    out = {r["name"]: r for r in merge.richest_tools(spark.createDataFrame(rows, "leaf_id string, name string, description string, parameters string")).collect()}
    assert out["a"]["parameters"] == '{"x":1,"y":2}' and out["a"]["description"] == "long" and not out["a"]["conflict"] and out["b"]["conflict"]


def test_server_variants(spark):
    rows = [("l", "f1", False, 0, "s", "", "{}", "history", None), ("l", "f2", True, 0, "s", "web", "{}", "response", "r"), ("l", "f3", False, 0, "s", "web", '{"q":1}', "history", None)]
    out = merge.merge_server_calls(spark.createDataFrame(rows, "leaf_id string, source_path string, is_leaf boolean, pos int, call_id string, name string, arguments string, origin string, result string")).orderBy("variant").collect()
    assert [(r["name"], r["origin"], r["result"], r["conflict"]) for r in out] == [("web", "response", "r", True), ("web", "history", None, True)]


def test_cycles_and_reach(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y"), ("y", "x"), ("z", "x"), ("o", "o")], "node string, up string")
    assert sorted(r["node"] for r in mounts.cycles(edges).collect()) == ["o", "x", "y"]
    roots = spark.createDataFrame([("a",)], "node string")
    assert sorted((r["node"], r["root"]) for r in mounts.reachable(edges, roots).collect()) == [("a", "a"), ("b", "a"), ("c", "a")]


def test_visible_text(spark):
    texts = ['a {"type":"image","data":"zzz zzz"} b', 'x {"k":"v","file_data":"AAAA"} y', "plain {not json} text", "data:image/png;base64,QUJD end", "<audio src=q>hidden</audio>seen", '[{"type":"input_file"},{"t":1}]']
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", tokens.visible_text("t").alias("v")).orderBy("k").collect()
    assert [r["v"] for r in rows] == ["a   b", 'x {"k":"v"} y', "plain {not json} text", "  end", " seen", '[{"t":1}]']


def test_token_edges(spark):
    texts = ["", "hello, world_1!", "漢字 kana", "é à", "  \t\n", "😀!", "á"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", tokens.estimated_tokens(F.col("t")).alias("n")).orderBy("k").collect()
    assert [r["n"] for r in rows] == [0, 4, 3, 0, 0, 2, 2]


def test_windows(spark):
    given_ = ["2024-01-01T00:00:00Z", "2023-12-31T23:59:59.5+08:00", "2024-01-01T15:59:59+0000", "2024-01-01T00:00:00", "", "never", None]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(given_)], "k int, t string").select("k", names.eight_hours(F.col("t")).alias("w")).orderBy("k").collect()
    assert [r["w"] for r in rows] == ["2024-01-01T08:00:00+08:00", "2023-12-31T16:00:00+08:00", "2024-01-01T16:00:00+08:00", "", "", "", ""]


def test_label_decisions():
    taxonomy = labels.Taxonomy(("s",), ("c", "d"), ("j",))
    good = json.dumps({"scenarios": ["s"], "capabilities": ["c", "d"], "subjects": ["j"]})
    answers = iter(["?", json.dumps({"scenarios": ["s"], "capabilities": ["c", "c"], "subjects": ["j"]}), good])
    assert labels.decide("t", taxonomy, lambda p: next(answers), 100)[0] == "accepted"
    assert labels.decide("t", taxonomy, lambda p: "?", 100)[:2] == ("failed", "invalid_labels")

    def narrow(prompt):
        if len(prompt) > 3000:
            raise labels.ContextTooLong
        return good

    assert labels.decide("x" * 9000, taxonomy, narrow, 8000)[0::3] == ("accepted", True)
    assert labels.decide("x" * 90000, taxonomy, narrow, 80000)[:2] == ("failed", "context_too_long")
    with pytest.raises(ValueError):
        labels.Taxonomy(("s", "s"), ("c",), ("j",))


def test_label_prompt_and_fatal_errors():
    from skein.sources.client import ConfigurationError

    taxonomy = labels.Taxonomy.load(json.dumps({"schema_version": 2, "scenarios": [{"name": "s", "description": "d\u00e9"}], "capabilities": ["c", {"name": "d"}], "subjects": ["j"]}))
    assert (taxonomy.scenarios, taxonomy.capabilities, len(taxonomy.notes)) == (("s",), ("c", "d"), 1)
    assert taxonomy.digest != labels.Taxonomy(("s",), ("c", "d"), ("j",)).digest
    said = taxonomy.prompt("do >>> this <<<")
    assert "d\u00e9" in said and '["c", "d"]' in said and said.count("<<<") == said.count(">>>") == 1
    for wrong in ("[]", '{"scenarios": [], "capabilities": []}', '{"scenarios": [{"x": 1}], "capabilities": ["c"], "subjects": ["j"]}', '{"scenarios": [], "capabilities": ["c"], "subjects": ["j"]}'):
        with pytest.raises(ValueError):
            labels.Taxonomy.load(wrong)

    def refused(prompt):
        raise ConfigurationError("http_401")

    with pytest.raises(ConfigurationError):
        labels.decide("t", taxonomy, refused, 100)


@given(st.text(max_size=300), st.integers(60, 200))
def test_shortened(text, budget):
    out = labels.shortened(text, budget)
    assert len(out) <= budget and (out == text) == (len(text) <= budget)


def test_projection(spark):
    turns = ["<system-reminder>x <system-reminder>y</system-reminder> z</system-reminder>", "<environment_context>e</environment_context>## My request for Codex:\ndo it", "see <image src=a>q</image> ok"]
    out = spark.createDataFrame([(turns,)], "t array<string>").select(projection.requests("t").alias("r"), projection.without_frames(F.col("t")[1]).alias("p")).first()
    assert json.loads(out["r"]) == ["do it", "see [media] ok"] and out["p"].endswith("do it")


def test_messages_valid(spark):
    rows = [("assistant", True, None, None, None, True), ("assistant", True, 0, None, None, False), ("tool", False, None, "c", "", True), ("tool", False, None, "", "n", False), ("user", False, None, None, None, True), ("user", False, None, None, "n", False), ("robot", False, None, None, None, False)]
    df = spark.createDataFrame(rows, "role string, r boolean, n int, c string, name string, ok boolean")
    assert df.where(~quality.message_fields_valid(F.col("role"), F.col("r"), F.col("n"), F.col("c"), F.col("name")).eqNullSafe(F.col("ok"))).count() == 0


def mount_tables(spark, events, holds, children):
    e = spark.createDataFrame(events, "session_id string, thread_id string, turn_id string, call_id string, arguments string, task_name string, agent_name string")
    h = spark.createDataFrame(holds, "leaf_id string, session_id string, thread_id string, call_id string, arguments string")
    c = spark.createDataFrame(children, "child_id string, session_id string, parent_thread_id string, parent_turn_id string, marker_call_id string, marker_task string, recipient string")
    return e, h, c


def planned(spark, *tables):
    out = mounts.plan(*mount_tables(spark, *tables))
    return {(r["child_id"], r["parent_leaf"], r["call_id"]) for r in out["edges"].collect()}, {(r["subject"], r["code"]) for r in out["diagnostics"].collect()}


TWO = [("s", "m", "t", "k1", "{}", "dig", "/root/dig"), ("s", "m", "t", "k2", "{}", "fill", "")]
HELD = [("L", "s", "m", "k1", "{}"), ("L", "s", "m", "k2", "{}")]


def test_two_children(spark):
    kids = [("c1", "s", "m", "t", "k1", "", ""), ("c2", "s", "m", "t", "", "fill", "")]
    assert planned(spark, TWO, HELD, kids) == ({("c1", "L", "k1"), ("c2", "L", "k2")}, set())


@pytest.mark.parametrize(
    ("holds", "kid", "code"),
    [
        (HELD, ("c", "s", "", "t", "k1", "", ""), "missing_parent_thread_id"),
        (HELD, ("c", "s", "m", "", "k1", "", ""), "missing_parent_turn_id"),
        (HELD, ("c", "s", "m", "other", "k1", "", ""), "missing_spawn_call"),
        (HELD, ("c", "s", "m", "t", "k9", "", ""), "spawn_routing_mismatch"),
        (HELD, ("c", "s", "m", "t", "", "", ""), "ambiguous_spawn_call"),
        (HELD, ("c", "s", "m", "t", "", "", "/root/none"), "spawn_routing_mismatch"),
        ([], ("c", "s", "m", "t", "k1", "", ""), "missing_spawn_call"),
    ],
)
def test_routing_failures(spark, holds, kid, code):
    edges, told = planned(spark, TWO, holds, [kid])
    assert edges == set() and ("c", code) in told
    assert holds or ("s/m/t/k1", "missing_parent_leaf") in told


def test_recipients_claims_and_branches(spark):
    assert planned(spark, TWO, HELD, [("c", "s", "m", "t", "", "", "/root/dig")])[0] == {("c", "L", "k1")}
    assert planned(spark, TWO, HELD, [("c", "s", "m", "t", "", "", "/root/fill")])[0] == {("c", "L", "k2")}
    both = planned(spark, TWO, HELD, [("c", "s", "m", "t", "k1", "", ""), ("d", "s", "m", "t", "k1", "", "")])
    assert both[0] == set() and {("c", "multiple_children_for_spawn"), ("d", "multiple_children_for_spawn"), ("s/m/t/k1", "unmounted_spawn_call")} <= both[1]
    twin = planned(spark, TWO, [*HELD, ("M", "s", "m", "k1", "{}")], [])
    assert ("s/m/t/k1", "ambiguous_parent_leaf") in twin[1]
    assert ("s/m/t/k1", "missing_parent_leaf") in planned(spark, TWO, [("L", "s", "m", "k1", '{"x":1}'), HELD[1]], [])[1]


def test_cycles_and_islands(spark):
    events = [("s", "a", "t", "k1", "{}", "", ""), ("s", "b", "t", "k2", "{}", "", ""), ("s", "c", "t", "k3", "{}", "", "")]
    holds = [("A", "s", "a", "k1", "{}"), ("B", "s", "b", "k2", "{}"), ("C", "s", "c", "k3", "{}")]
    kids = [("B", "s", "a", "t", "k1", "", ""), ("A", "s", "b", "t", "k2", "", ""), ("D", "s", "c", "t", "k3", "", ""), ("C", "s", "a", "gone", "", "", "")]
    edges, told = planned(spark, events, holds, kids)
    assert edges == set() and {("A", "mount_cycle"), ("B", "mount_cycle"), ("D", "unreachable_subagent"), ("C", "missing_spawn_call")} <= told
