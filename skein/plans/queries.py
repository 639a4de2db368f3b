"""The engine's own queries: each operator over a derived input, with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names, tokens
from ..operators import accounting, labels, merge, mounts, quality, tools
from ..operators.prefix import Fold, scope
from . import inputs
from .inputs import derive, duck
from .registry import ORACLE, QUERIES


def query(sql: str | None = None):
    """Registers a query under its function's name; ``sql`` names given tables in braces."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


# --- cumulative captures folded to maximal transcripts


def captures(spark: SparkSession, sf_dir: str, sql: str = inputs.TOKENS) -> DataFrame:
    rows = derive(spark, sf_dir, sql)
    own = F.array_sort(F.collect_list(F.struct("pos", "token")))
    return rows.groupBy("capture_id", "conv_id").agg(F.transform(own, lambda x: x["token"]).alias("tokens"), F.sum("is_history").cast("int").alias("history")).withColumn("scope", F.col("conv_id").cast("string"))


PREFIX = f"""WITH tok AS ({inputs.TOKENS}), s AS (SELECT capture_id, conv_id AS scope, list(token ORDER BY pos) AS toks, sum(is_history)::BIGINT AS h FROM tok GROUP BY capture_id, conv_id),
ends AS (SELECT *, len(toks) AS n, array_to_string(toks, chr(31)) AS k FROM s),
covers AS (SELECT capture_id, scope, n, d, array_to_string(toks[1:d], chr(31)) AS k FROM ends, LATERAL (SELECT unnest(range(0, least(h, n - 1) + 1)) AS d)),
covered AS (SELECT * FROM ends WHERE EXISTS (SELECT 1 FROM covers c WHERE c.scope = ends.scope AND c.d = ends.n AND c.k = ends.k)),
leaves AS (SELECT * FROM ends WHERE capture_id NOT IN (SELECT capture_id FROM covered)) """


@query(PREFIX + "SELECT capture_id, scope AS conv_id, n FROM leaves")
def prefix_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Fold(captures(spark, sf_dir)).leaves().select("capture_id", "conv_id", F.size("tokens").cast("long").alias("n"))


@query(PREFIX + "SELECT capture_id, scope AS conv_id, n FROM covered")
def prefix_intermediates(spark, sf_dir):
    return Fold(captures(spark, sf_dir)).intermediates().select("capture_id", "conv_id", F.size("tokens").cast("long").alias("n"))


@query(PREFIX + "SELECT l.capture_id AS leaf_id, l.capture_id FROM leaves l UNION SELECT c.capture_id, e.capture_id FROM covers c JOIN leaves l USING (capture_id) JOIN ends e ON e.scope = c.scope AND e.n = c.d AND e.k = c.k")
def prefix_contributors(spark, sf_dir):
    return Fold(captures(spark, sf_dir)).contributors()


@query(PREFIX + "SELECT e.capture_id, arg_min(c.capture_id, c.n * 1000000000 + c.capture_id) AS witness_id FROM ends e JOIN covers c ON e.scope = c.scope AND e.n = c.d AND e.k = c.k GROUP BY e.capture_id")
def prefix_witness(spark, sf_dir):
    return Fold(captures(spark, sf_dir)).witnesses()


SHORT = f"SELECT c.capture_id, c.conv_id, c.session_id, c.thread_id, c.user_id, c.masked, c.source_path, t.turn AS pos, t.role || ':' || CAST(t.turn AS STRING) AS token, CASE WHEN t.turn < c.turn THEN 1 ELSE 0 END AS is_history FROM ({inputs.CAPTURES}) AS c JOIN ({inputs.TURNS}) AS t ON t.conv_id = c.conv_id AND t.turn <= c.turn"


def _scoped(spark, sf_dir) -> DataFrame:
    """Captures whose messages say only who spoke, so they meet across conversations of a user without session."""
    rows = derive(spark, sf_dir, SHORT)
    own = F.array_sort(F.collect_list(F.struct("pos", "token")))
    out = rows.groupBy("capture_id", "conv_id", "session_id", "thread_id", "user_id", "masked", "source_path").agg(F.transform(own, lambda x: x["token"]).alias("tokens"), F.sum("is_history").cast("int").alias("history"))
    return out.withColumn("scope", scope(F.col("session_id"), F.col("thread_id"), F.col("user_id"), F.col("masked"), F.col("source_path")))


@query(
    f"""WITH tok AS ({SHORT}), s AS (SELECT capture_id, conv_id, CASE WHEN session_id NOT IN ('', 'no_session_id') THEN 'session ' || session_id || ' ' || thread_id WHEN masked THEN 'source ' || source_path ELSE 'user ' || user_id END AS scope, list(token ORDER BY pos) AS toks, sum(is_history)::BIGINT AS h FROM tok GROUP BY ALL),
e AS (SELECT capture_id, conv_id, scope, h, len(toks) AS n, toks, array_to_string(toks, ' ') AS k FROM (SELECT capture_id, conv_id, scope, toks, h FROM s)),
c AS (SELECT DISTINCT scope, d, array_to_string(toks[1:d], ' ') AS k FROM e, LATERAL (SELECT unnest(range(0, least(h, n - 1) + 1)) AS d))
SELECT capture_id, conv_id FROM e WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.scope = e.scope AND c.d = e.n AND c.k = e.k)"""
)
def prefix_user_scope(spark, sf_dir):
    return Fold(_scoped(spark, sf_dir)).leaves().select("capture_id", "conv_id")


@query(
    PREFIX.replace("covers AS (SELECT capture_id, scope,", "covers AS (SELECT capture_id, capture_id % 2 AS sig, scope,").replace("c.scope = ends.scope", "c.scope = ends.scope AND c.sig = ends.capture_id % 2")
    + "SELECT capture_id, scope AS conv_id FROM leaves"
)
def prefix_compaction_isolation(spark, sf_dir):
    marked = captures(spark, sf_dir).withColumn("signature", (F.col("capture_id") % 2).cast("string"))
    return Fold(marked, signature="signature").leaves().select("capture_id", "conv_id")


@query(PREFIX + "SELECT scope AS conv_id, n, count(*) AS equal_leaves FROM leaves GROUP BY scope, n, k HAVING count(*) > 1")
def prefix_equal_terminals(spark, sf_dir):
    leaves = Fold(captures(spark, sf_dir)).leaves()
    return leaves.groupBy("conv_id", "tokens").agg(F.count("*").alias("equal_leaves")).where("equal_leaves > 1").select("conv_id", F.size("tokens").cast("long").alias("n"), "equal_leaves")


@query(PREFIX + "SELECT count(*) AS eligible, (SELECT count(*) FROM covered) AS intermediates, (SELECT count(*) FROM leaves) AS leaves FROM ends")
def pipeline_stats(spark, sf_dir):
    fold = Fold(captures(spark, sf_dir))
    kind = fold.leaves().select("capture_id", F.lit("leaf").alias("kind")).union(fold.intermediates().select("capture_id", F.lit("intermediate").alias("kind")))
    return kind.agg(F.count("*").alias("eligible"), F.count_if(F.col("kind") == "intermediate").alias("intermediates"), F.count_if(F.col("kind") == "leaf").alias("leaves"))


# --- tokens

DUCK_TOKEN = tokens.TOKEN


@query("SELECT doc_id, len(regexp_extract_all(text, '" + DUCK_TOKEN + "'))::BIGINT AS n_tokens FROM documents")
def token_estimate_documents(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents").select("doc_id", tokens.estimated_tokens(F.col("text")).alias("n_tokens"))


@query("SELECT conv_id, sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END)::BIGINT AS total_rounds, sum(len(regexp_extract_all(text, '" + DUCK_TOKEN + "')))::BIGINT AS total_tokens FROM conversations GROUP BY conv_id")
def token_estimate_turns(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "conversations")
    return rows.groupBy("conv_id").agg(F.count_if(F.col("role") == "assistant").alias("total_rounds"), F.sum(tokens.estimated_tokens(F.col("text"))).alias("total_tokens"))


# --- tool calls


@query(
    f"""WITH calls AS ({inputs.CALLS}), results AS ({inputs.RESULTS}), numbered AS (SELECT *, row_number() OVER (PARTITION BY node_id, call_id ORDER BY pos, name) AS nth FROM calls),
first AS (SELECT * FROM numbered WHERE nth = 1), per AS (SELECT node_id, call_id, count(*) AS n, list(pos ORDER BY pos, name) AS ps FROM results GROUP BY ALL)
SELECT node_id, call_id, 'duplicate_tool_call_id' AS code, pos FROM numbered WHERE nth > 1
UNION ALL SELECT f.node_id, f.call_id, 'missing_tool_result', f.pos FROM first f LEFT JOIN per p USING (node_id, call_id) WHERE p.n IS NULL
UNION ALL SELECT f.node_id, f.call_id, 'duplicate_tool_result', p.ps[2] FROM first f JOIN per p USING (node_id, call_id) WHERE p.n > 1
UNION ALL SELECT f.node_id, f.call_id, 'tool_result_before_call', r.pos FROM first f JOIN results r USING (node_id, call_id) WHERE r.pos < f.pos
UNION ALL SELECT f.node_id, f.call_id, 'tool_result_name_mismatch', r.pos FROM first f JOIN results r USING (node_id, call_id) WHERE r.name <> f.name
UNION ALL SELECT p.node_id, p.call_id, 'orphan_tool_result', p.ps[1] FROM per p LEFT JOIN first f USING (node_id, call_id) WHERE f.node_id IS NULL"""
)
def tool_pairing_issues(spark, sf_dir):
    return tools.pairing_issues(derive(spark, sf_dir, inputs.CALLS), derive(spark, sf_dir, inputs.RESULTS))


def definitions(spark, sf_dir) -> DataFrame:
    """Tools 0 to 4 of every node; 3 has no properties, 4 takes any ``a`` and asks for ``b`` and ``c``."""
    own = [
        *[(f"tool_{k}", "", '{"properties":{"a":{"type":"integer"},"b":{"type":"string","default":""},"z":{"type":["boolean","null"]}},"required":["a","b"]}') for k in range(2)],
        ("tool_2", "", '{"properties":{"a":{"type":"number"}},"required":["a"]}'),
        ("tool_3", "", "{}"),
        ("tool_4", "", '{"properties":{"a":{},"b":{"type":"string"},"c":{}},"required":["b","c"]}'),
    ]
    each = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("name", "description", "parameters"), t, strict=True)]) for t in own])).alias("t")
    return derive(spark, sf_dir, inputs.LINES).select("node_id").distinct().select("node_id", each).select("node_id", "t.*")


@query(f"SELECT node_id, pos, call_id, name FROM ({inputs.CALLS}) WHERE name IN ('tool_5', 'tool_6')")
def tool_def_lookup(spark, sf_dir):
    return tools.undefined_calls(derive(spark, sf_dir, inputs.CALLS), definitions(spark, sf_dir)).select("node_id", "pos", "call_id", "name")


CHECKED = f"""WITH lines AS ({inputs.LINES}), c AS (SELECT node_id, 'tool_' || (part % 7) AS name, part % 7 AS t, CASE WHEN supp % 4 = 0 THEN 'string' WHEN supp % 4 = 1 THEN 'number' ELSE 'integer' END AS kind, flag = 'A' AS z, line % 2 = 0 AS b FROM lines),
k AS (SELECT *, t >= 5 AS undefined, t = 3 AS unverifiable, CASE WHEN t < 2 THEN false WHEN t = 2 THEN b OR z WHEN t = 4 THEN z ELSE false END AS extra, t = 4 AS missing, t < 2 AND NOT b AS defaulted, CASE WHEN t < 2 THEN kind <> 'integer' WHEN t = 2 THEN kind = 'string' ELSE false END AS mistyped FROM c)
"""


@query(
    CHECKED
    + """SELECT node_id, count(*) AS total_calls, count(*) FILTER (undefined) AS undefined_tool_calls, count(*) FILTER (unverifiable) AS unverifiable_calls, count(*) FILTER (NOT undefined AND NOT unverifiable) AS checked_calls,
count(*) FILTER (extra) AS extra_arg_calls, count(*) FILTER (missing) AS missing_required_calls, count(*) FILTER (mistyped) AS type_mismatch_calls, count(*) FILTER (defaulted) AS defaulted_missing_calls,
count(*) FILTER (undefined OR extra OR missing OR mistyped) AS mismatch_calls, greatest(count(*) FILTER (undefined OR extra OR missing OR mistyped) - 50, 0) AS mismatches_truncated,
coalesce(string_agg(DISTINCT name, ',' ORDER BY name) FILTER (undefined), '') AS missing_tool_defs FROM k GROUP BY node_id"""
)
def tool_check_counters(spark, sf_dir):
    checked = tools.check_calls(derive(spark, sf_dir, inputs.CALLS), definitions(spark, sf_dir))
    return tools.call_counters(checked).withColumn("missing_tool_defs", F.array_join("missing_tool_defs", ","))


@query(f"SELECT node_id, sum(n)::BIGINT AS total_tool_calls, string_agg(name || '=' || n, ',' ORDER BY name) AS tool_counts FROM (SELECT node_id, name, count(*) AS n FROM ({inputs.CALLS}) GROUP BY ALL) GROUP BY node_id")
def tool_counts(spark, sf_dir):
    out = tools.tool_counts(derive(spark, sf_dir, inputs.CALLS))
    return out.withColumn("tool_counts", F.array_join(F.transform(F.map_entries("tool_counts"), lambda e: F.concat_ws("=", e["key"], e["value"])), ","))


@query(f"SELECT node_id, pos, call_id, row_number() OVER (PARTITION BY node_id, call_id ORDER BY pos, name) - 1 AS occurrence FROM ({inputs.CALLS})")
def occurrence_ordinal(spark, sf_dir):
    return tools.occurrences(derive(spark, sf_dir, inputs.CALLS)).select("node_id", "pos", "call_id", F.col("occurrence").cast("long"))


STEPS = f"SELECT node_id AS capture_id, line AS pos, CASE WHEN line % 3 = 0 THEN 'agent_message' WHEN line % 3 = 1 THEN 'spawn_result' ELSE 'other' END AS kind, 'k' || CAST(line AS STRING) AS call_id FROM ({inputs.LINES}) AS lines"


@query(f"SELECT m.capture_id, m.pos, coalesce((SELECT string_agg(DISTINCT b.call_id, ',' ORDER BY b.call_id) FROM ({STEPS}) b WHERE b.capture_id = m.capture_id AND b.pos < m.pos AND b.kind = 'spawn_result'), '') AS completed FROM ({STEPS}) m WHERE kind = 'agent_message'")
def completed_spawn_running_set(spark, sf_dir):
    return tools.completed_before(derive(spark, sf_dir, STEPS)).select("capture_id", "pos", F.array_join("completed", ",").alias("completed"))


SERVER_CALLS = f"SELECT node_id AS capture_id, 2 * line AS pos, CASE WHEN supp % 4 = 0 THEN NULL ELSE 'v' || CAST(part % 3 AS STRING) END AS call_id, 'web' AS name FROM ({inputs.LINES}) AS lines WHERE line % 2 = 0"
SERVER_RESULTS = f"SELECT node_id AS capture_id, 2 * line + 1 AS pos, CASE WHEN supp % 4 = 0 THEN NULL ELSE 'v' || CAST(part % 3 AS STRING) END AS call_id, 'r' || CAST(line AS STRING) AS result FROM ({inputs.LINES}) AS lines WHERE line % 2 = 0 AND part % 5 <> 0"


@query(
    f"""WITH c AS (SELECT *, count(*) OVER (PARTITION BY capture_id, call_id) AS n FROM ({SERVER_CALLS})), r AS (SELECT *, count(*) OVER (PARTITION BY capture_id, call_id) AS n FROM ({SERVER_RESULTS}))
SELECT c.capture_id, c.pos, c.call_id, c.name, CASE WHEN c.call_id IS NULL THEN a.result WHEN c.n = 1 THEN b.result END AS result FROM c LEFT JOIN r a ON a.call_id IS NULL AND a.capture_id = c.capture_id AND a.pos = c.pos + 1 LEFT JOIN r b ON b.call_id = c.call_id AND b.capture_id = c.capture_id AND b.n = 1"""
)
def server_call_pairs(spark, sf_dir):
    return tools.server_pairs(derive(spark, sf_dir, SERVER_CALLS), derive(spark, sf_dir, SERVER_RESULTS))


# --- identity, routing and names


@query("SELECT event_id, coalesce(nullif(a, ''), nullif(b, ''), nullif(c, ''), '') AS session_id, len(list_distinct(list_filter([a, b, c], lambda v: v IS NOT NULL AND v <> ''))) > 1 AS metadata_conflict FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN 'm' || (event_id % 7) END AS a, CASE WHEN event_id % 2 = 0 THEN json_extract_string(props, '$.k') END AS b, CASE WHEN event_id % 5 <> 0 THEN event_type END AS c FROM events)")
def identity_resolution(spark, sf_dir):
    e = inputs.table(spark, sf_dir, "events")
    a = F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, F.concat(F.lit("m"), (F.col("event_id") % 7).cast("string")))
    b, c = F.when(F.col("event_id") % 2 == 0, F.get_json_object("props", "$.k")), F.when(F.col("event_id") % 5 != 0, F.col("event_type"))
    return e.select("event_id", names.first_real(a, b, c).alias("session_id"), names.conflicting(a, b, c).alias("metadata_conflict"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN json_extract_string(props, '$.k') WHEN event_id % 4 = 1 THEN 'plain' || user_id WHEN event_id % 4 = 2 THEN '' ELSE 'z' || user_id END AS user_id FROM events")
def user_id_unwrap(spark, sf_dir):
    e = inputs.table(spark, sf_dir, "events")
    raw = (
        F.when(F.col("event_id") % 4 == 0, F.replace("props", F.lit('"k"'), F.lit('"id"')))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit("plain"), F.col("user_id").cast("string")))
        .when(F.col("event_id") % 4 == 2, F.col("props"))
        .otherwise(F.concat(F.lit('{"user_id":"z'), F.col("user_id").cast("string"), F.lit('","id":"no"}')))
    )
    return e.select("event_id", names.unwrapped_user(raw).alias("user_id"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 't' || user_id WHEN event_type = 'click' THEN '__isolated_subagent__:p' || event_id ELSE 's' || user_id END AS thread_id FROM events")
def thread_derivation(spark, sf_dir):
    e, s = inputs.table(spark, sf_dir, "events"), F.col("user_id").cast("string")
    explicit = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("t"), s))
    return e.select("event_id", names.thread_of(explicit, F.col("event_type") == "click", F.concat(F.lit("p"), F.col("event_id").cast("string")), F.concat(F.lit("s"), s)).alias("thread_id"))


@query("SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'responses' WHEN 1 THEN 'chat_completions' WHEN 2 THEN 'messages' WHEN 3 THEN 'count_tokens' END AS operation FROM pages")
def endpoint_router(spark, sf_dir):
    ends = F.array(*[F.lit(x) for x in ("/v1/responses/", "/v1/chat/completions?x=1", "/v1/messages", "/v1/messages/count_tokens//?a=/b", "/v1/models")])
    return inputs.table(spark, sf_dir, "pages").select("page_id", names.operation(F.get(ends, (F.col("page_id") % 5).cast("int"))).alias("operation"))


@query("SELECT p_partkey, p_partkey % 4 IN (0, 1) OR (p_partkey % 4 = 2 AND p_size % 2 = 0) AS is_spawn, CASE WHEN p_size % 2 = 0 THEN p_brand || '.' || p_type ELSE p_type END AS qualified FROM part")
def tool_names(spark, sf_dir):
    p = inputs.table(spark, sf_dir, "part")
    even, turn = F.col("p_size") % 2 == 0, F.col("p_partkey") % 4
    name = F.when(turn == 0, "Agent").when(turn == 1, F.concat(F.col("p_brand"), F.lit(".spawn_agent"))).when((turn == 2) & even, "spawn_agent").when(turn == 2, ".spawn_agent").otherwise("spawn_agents")
    full = names.qualified(F.when(even, F.col("p_brand")), F.when(even & (turn == 0), F.concat_ws(".", "p_brand", "p_type")).otherwise(F.col("p_type")))
    return p.select("p_partkey", names.is_spawn(name).alias("is_spawn"), full.alias("qualified"))


@query("SELECT s_suppkey, s_suppkey % 5 < 2 AS redacted, s_suppkey % 5 = 4 AS safe FROM supplier")
def redacted_identities(spark, sf_dir):
    s = inputs.table(spark, sf_dir, "supplier")
    value = F.get(F.array(F.lit(" <sensitive> "), F.lit("***"), F.lit("a/b"), F.lit(""), F.concat(F.lit("s-"), F.col("s_suppkey").cast("string"))), (F.col("s_suppkey") % 5).cast("int"))
    return s.select("s_suppkey", names.is_redacted(value).alias("redacted"), names.is_safe_session(value).alias("safe"))


@query("SELECT o_orderkey, strftime(make_timestamp(epoch_ms(o_orderdate) * 1000 + (o_orderkey % 1000) * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS at, 'c' || o_custkey || '.jsonl.zst' AS file, o_orderkey % 50 AS line, '/root/c' || o_custkey AS parent, 'a' || o_orderkey AS base FROM orders")
def instants_and_paths(spark, sf_dir):
    o, key = inputs.table(spark, sf_dir, "orders"), F.col("o_orderkey").cast("string")
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 1000
    agent = F.concat(F.lit("/root/c"), F.col("o_custkey").cast("string"), F.lit("/a"), key)
    mark = F.when(F.col("o_orderkey") % 50 > 0, F.concat(F.lit("#L"), F.lpad((F.col("o_orderkey") % 50).cast("string"), 8, "0"))).otherwise("")
    ref = F.concat(F.lit("in/x/c"), F.col("o_custkey").cast("string"), F.lit(".jsonl.zst"), mark)
    return o.select("o_orderkey", names.iso_millis(ms).alias("at"), names.source_file(ref).alias("file"), names.line_number(ref).alias("line"), names.parent_path(agent).alias("parent"), names.base_name(agent).alias("base"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE strftime(time_bucket(INTERVAL 8 HOUR, ts) + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S+08:00') END AS start FROM events")
def session_window_8h(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    value = F.when(F.col("event_id") % 3 == 0, text).otherwise(F.concat(text, F.lit("Z")))
    return inputs.table(spark, sf_dir, "events").select("event_id", names.eight_hours(value).alias("start"))


# --- eligibility, quality and accounting


@query(f"SELECT event_id FROM ({inputs.FLAGS}) WHERE operation <> 'count_tokens' AND wire_complete AND (outcome = 'success' OR codes IN ('orphan_tool_result', 'orphan_tool_result,duplicate_tool_result'))")
def eligibility_filter(spark, sf_dir):
    codes = F.filter(F.split("codes", ","), lambda c: c != "")
    return derive(spark, sf_dir, inputs.FLAGS).where(quality.eligible(F.col("operation"), F.col("wire_complete"), F.col("outcome"), codes)).select("event_id")


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(codes, ',')) AS reason FROM ({inputs.FLAGS})) WHERE reason <> '' GROUP BY reason")
def reason_counts(spark, sf_dir):
    return accounting.reason_counts(derive(spark, sf_dir, inputs.FLAGS).select(F.filter(F.split("codes", ","), lambda c: c != "").alias("reason_codes")))


NODES = "SELECT o_orderkey AS node_id, o_custkey % 300 AS root_id, o_orderkey % 2 = 0 AS local_ok, o_custkey % 3 = 0 AS has_sub, o_orderkey % 5 <> 0 AS subtree, o_orderkey % 31 = 0 AS orphan, o_orderkey % 4 AS missing, o_orderkey % 3 AS mismatches, o_custkey % 7 = 0 AS child_bad, o_orderkey % 10 <> 0 AS top FROM {orders}"
NODE_TAGS = f"""SELECT *, CASE WHEN orphan THEN 'orphan_sub' WHEN NOT has_sub THEN CASE WHEN local_ok THEN 'complete_main_no_sub' ELSE 'incomplete_main_no_sub' END ELSE CASE WHEN local_ok THEN 'complete' ELSE 'incomplete' END || '_main_with_' || CASE WHEN subtree THEN 'complete' ELSE 'incomplete' END || '_sub' END AS tag,
CASE WHEN missing > 0 THEN 'incomplete' WHEN top AND child_bad THEN 'complete_with_incomplete_sub' ELSE 'complete' END AS defs, CASE WHEN mismatches > 0 THEN 'inconsistent' WHEN top AND child_bad THEN 'consistent_with_inconsistent_sub' ELSE 'consistent' END AS calls FROM ({NODES}) AS n"""


def _tags(spark, sf_dir) -> DataFrame:
    c = F.col
    return derive(spark, sf_dir, NODES).select("node_id", quality.completeness_tag(c("local_ok"), c("has_sub"), c("subtree"), c("orphan")).alias("tag"), quality.tool_defs_tag(c("missing"), c("child_bad"), c("top")).alias("defs"), quality.tool_call_tag(c("mismatches"), c("child_bad"), c("top")).alias("calls"))


@query(f"SELECT node_id, tag, defs, calls FROM ({NODE_TAGS})")
def completeness_tags(spark, sf_dir):
    return _tags(spark, sf_dir)


@query(f"SELECT node_id FROM ({NODE_TAGS}) WHERE tag IN ('complete_main_no_sub', 'complete_main_with_complete_sub') AND defs = 'complete' AND calls = 'consistent' AND node_id % 7 <> 0")
def strict_gate(spark, sf_dir):
    reasons = F.when(F.col("node_id") % 7 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return _tags(spark, sf_dir).where(quality.strict(reasons, F.col("defs"), F.col("calls"), F.lit(0), F.col("tag"))).select("node_id")


@query("SELECT o_custkey % 300 AS root_id, bool_or(o_orderkey % 50 = 0) AS has_tool_calls FROM orders GROUP BY 1")
def has_tool_calls_tree(spark, sf_dir):
    return labels.has_tool_calls(inputs.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 300).alias("root_id"), F.when(F.col("o_orderkey") % 50 == 0, 3).otherwise(0).alias("total_tool_calls")))


@query(
    """WITH n AS (SELECT o_custkey % 300 AS root_id, o_orderkey AS node_id, o_orderkey = min(o_orderkey) OVER (PARTITION BY o_custkey % 300) AS is_root, o_orderkey % 11 = 0 AS d, o_orderkey % 13 = 0 AS c, o_orderkey % 17 = 0 AS q, o_orderkey % 19 <> 0 AS ok, o_orderkey % 2 AS u FROM orders)
SELECT min(node_id) AS root_id, bool_or(d AND NOT is_root) AS child_defs_bad, bool_or(c AND NOT is_root) AS child_calls_bad, bool_or(q AND NOT is_root) AS child_quality_bad, bool_and(ok) AS subtree_complete, sum(u)::BIGINT AS unkeyed_mounts FROM n GROUP BY n.root_id"""
)
def tree_rollup(spark, sf_dir):
    o = inputs.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    nodes = o.select(key.alias("node_id"), (key % 11 == 0).alias("defs_bad"), (key % 13 == 0).alias("calls_bad"), (key % 17 == 0).alias("quality_bad"), (key % 19 != 0).alias("complete"), (key % 2).alias("unkeyed"))
    group = o.groupBy((F.col("o_custkey") % 300).alias("g")).agg(F.min("o_orderkey").alias("root_id"))
    roots = o.select((F.col("o_custkey") % 300).alias("g"), key.alias("node_id")).join(group, "g").select("root_id", "node_id")
    return quality.tree_rollup(nodes, roots)


@query(f"WITH c AS ({inputs.CALLS}), r AS ({inputs.RESULTS}), last AS (SELECT node_id, max(pos) AS last FROM c WHERE pos % 4 = 0 GROUP BY node_id) SELECT m.node_id FROM (SELECT c.node_id, max(c.pos) AS pos FROM c LEFT JOIN (SELECT DISTINCT node_id, call_id FROM r) x USING (node_id, call_id) WHERE x.node_id IS NULL GROUP BY c.node_id) m LEFT JOIN last USING (node_id) WHERE coalesce(last, -1) <= m.pos")
def trailing_unanswered_call(spark, sf_dir):
    calls = derive(spark, sf_dir, inputs.CALLS)
    missing = calls.join(derive(spark, sf_dir, inputs.RESULTS).select("node_id", "call_id").distinct(), ["node_id", "call_id"], "left_anti")
    said = calls.select("node_id", "pos", F.when(F.col("pos") % 4 == 0, "assistant").otherwise("user").alias("role"))
    return quality.trailing_unanswered(said, missing)


@query("SELECT event_id, CASE event_type WHEN 'view' THEN event_id % 2 = 0 AND event_id % 3 <> 0 WHEN 'click' THEN event_id % 5 <> 0 ELSE true END AS valid FROM events")
def message_validity(spark, sf_dir):
    e, key = inputs.table(spark, sf_dir, "events"), F.col("event_id")
    view, click = F.col("event_type") == "view", F.col("event_type") == "click"
    role = F.when(view, "assistant").when(click, "tool").otherwise("user")
    valid = quality.message_fields_valid(role, view & (key % 2 == 0), F.when(view, F.when(key % 3 == 0, 0).otherwise(1)), F.when(click, F.when(key % 5 == 0, "").otherwise("c")), F.when(click, "n"))
    return e.select("event_id", valid.alias("valid"))


TRAJ = inputs.TRAJECTORIES


@query(
    f"""SELECT trajectory_id, arg_min(disposition, k) AS disposition, arg_min(captured_at, k) AS captured_at, arg_min(path, k) AS path, arg_min(sha, k) AS sha, count(DISTINCT path || captured_at || sha) AS origin_count FROM
(SELECT *, CASE disposition WHEN 'pass' THEN '0' WHEN 'quarantined' THEN '1' ELSE '2' END || captured_at || chr(31) || path || chr(31) || sha AS k FROM ({TRAJ})) GROUP BY trajectory_id"""
)
def semantic_dedup_representative(spark, sf_dir):
    return merge.representatives(derive(spark, sf_dir, TRAJ))


@query(f"SELECT md5(text) AS semantic_key, arg_min(conv_id * 1000 + turn, lpad(turn::VARCHAR, 6, '0') || lpad(conv_id::VARCHAR, 9, '0')) AS leaf_id, count(*) - 1 AS copies FROM ({inputs.TURNS}) GROUP BY text")
def retransmission_merge(spark, sf_dir):
    rows = derive(spark, sf_dir, inputs.TURNS)
    leaves = rows.select((F.col("conv_id") * 1000 + F.col("turn")).alias("leaf_id"), F.col("turn").alias("captured_at"), F.col("conv_id").alias("path"), "text")
    return merge.retransmissions(leaves, F.md5("text"))


@query(f"SELECT count(*) FILTER (disposition = 'pass') AS accepted, count(*) FILTER (disposition = 'quarantined') AS quarantined, count(*) FILTER (disposition = 'excluded') AS excluded, sum(n - 1)::BIGINT AS duplicates FROM (SELECT trajectory_id, CASE WHEN bool_or(disposition = 'pass') THEN 'pass' WHEN bool_or(disposition = 'quarantined') THEN 'quarantined' ELSE 'excluded' END AS disposition, count(*) AS n FROM ({TRAJ}) GROUP BY trajectory_id)")
def export_stats(spark, sf_dir):
    return accounting.export_stats(merge.representatives(derive(spark, sf_dir, TRAJ)))


@query(f"SELECT 'SUCCEEDED' AS status, count(*) FILTER (d <> 'excluded') AS record_count, count(*) FILTER (d = 'pass') AS accepted_trajectory_count, count(*) FILTER (d = 'quarantined') AS quarantined_trajectory_count, 3::BIGINT AS parse_failure_count, 1000::BIGINT AS total_bytes, 25::BIGINT AS started_at_ms, 25::BIGINT AS completed_at_ms FROM (SELECT trajectory_id, CASE WHEN bool_or(disposition = 'pass') THEN 'pass' WHEN bool_or(disposition = 'quarantined') THEN 'quarantined' ELSE 'excluded' END AS d FROM ({TRAJ}) GROUP BY trajectory_id)")
def feedback_counters(spark, sf_dir):
    long = lambda v: F.lit(v).cast("long")
    return accounting.feedback(accounting.export_stats(merge.representatives(derive(spark, sf_dir, TRAJ))), long(1000), long(3), long(25), long(5))


@query("SELECT o_orderkey AS trajectory_id, CASE WHEN o_custkey % 10 = 0 THEN 0 ELSE row_number() OVER (PARTITION BY o_custkey % 10 = 0, o_custkey ORDER BY o_orderdate, o_orderkey, o_orderpriority) - 1 END AS sub_session_id FROM orders")
def sub_session_numbering(spark, sf_dir):
    o = inputs.table(spark, sf_dir, "orders")
    roots = o.select(F.col("o_orderkey").alias("trajectory_id"), F.col("o_custkey").alias("session_id"), (F.col("o_custkey") % 10 == 0).alias("synthesized"), F.col("o_orderdate").alias("created_at"), F.col("o_orderpriority").alias("source_file"))
    return accounting.sub_session_numbers(roots).select("trajectory_id", F.col("sub_session_id").cast("long"))


@query(f"SELECT node_id, line, row_number() OVER (PARTITION BY node_id ORDER BY 1) * 0 + coalesce(n, -1) AS sub_session_id FROM (SELECT l.node_id, l.line, o.n FROM ({inputs.LINES}) l JOIN (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_orderpriority) - 1 AS n FROM orders) o ON o.o_orderkey = l.node_id)")
def inherited_numbers(spark, sf_dir):
    o = inputs.table(spark, sf_dir, "orders")
    roots = o.select(F.col("o_orderkey").alias("trajectory_id"), F.col("o_custkey").alias("session_id"), F.lit(False).alias("synthesized"), F.col("o_orderdate").alias("created_at"), F.col("o_orderpriority").alias("source_file"))
    nodes = derive(spark, sf_dir, inputs.LINES).select(F.col("node_id").alias("trajectory_id"), "line")
    return accounting.inherited(nodes, accounting.sub_session_numbers(roots)).select(F.col("trajectory_id").alias("node_id"), "line", F.col("sub_session_id").cast("long"))


@query(f"SELECT DISTINCT CASE WHEN session_id IN ('', 'no_session_id') THEN 'user' ELSE 'session' END AS kind, CASE WHEN session_id IN ('', 'no_session_id') THEN user_id ELSE session_id END AS id FROM ({inputs.CAPTURES})")
def scope_enumeration(spark, sf_dir):
    return accounting.scopes(derive(spark, sf_dir, inputs.CAPTURES))


BEFORE = f"SELECT * FROM ({inputs.INVENTORY}) AS i WHERE length(source_ref) % 2 = 0 OR sha > 'O'"
NOW = f"SELECT source_ref, CASE WHEN sha < 'F2' THEN sha || '!' ELSE sha END AS sha FROM ({inputs.INVENTORY}) AS i WHERE sha < 'P3'"


@query(f"SELECT source_ref, CASE WHEN n.sha IS NULL THEN 'deleted' WHEN b.sha IS NULL THEN 'added' WHEN b.sha = n.sha THEN 'unchanged' ELSE 'changed' END AS state FROM ({BEFORE}) b FULL JOIN ({NOW}) n USING (source_ref)")
def resume_diff(spark, sf_dir):
    return accounting.resume_diff(derive(spark, sf_dir, BEFORE), derive(spark, sf_dir, NOW))


@query(f"SELECT source_ref AS path FROM ({BEFORE}) EXCEPT SELECT source_ref FROM ({NOW})")
def stale_outputs(spark, sf_dir):
    path = F.col("source_ref").alias("path")
    return accounting.stale(derive(spark, sf_dir, BEFORE).select(path), derive(spark, sf_dir, NOW).select(path))


FRAMES = "SELECT user_id AS stream_id, event_id % 400 + CASE WHEN event_id % 400 > 300 THEN 5 ELSE 0 END AS seq, CASE WHEN event_id % 9 = 0 THEN event_type ELSE 'same' END AS payload FROM {events}"


@query(
    f"""WITH p AS (SELECT stream_id, seq, count(DISTINCT payload) AS kinds, count(*) AS n FROM ({FRAMES}) GROUP BY ALL), g AS (SELECT *, seq - lag(seq) OVER (PARTITION BY stream_id ORDER BY seq) - 1 AS gap FROM p)
SELECT stream_id, seq, 'conflicting_sse_sequence' AS code, kinds AS n FROM g WHERE kinds > 1 UNION ALL SELECT stream_id, seq, 'replayed_sse_sequence', n FROM g WHERE kinds = 1 AND n > 1 UNION ALL SELECT stream_id, seq, 'sse_sequence_gap', gap FROM g WHERE gap > 0"""
)
def sse_sequence_audit(spark, sf_dir):
    return accounting.sequence_audit(derive(spark, sf_dir, FRAMES))


@query("SELECT user_id AS stream_id, string_agg(DISTINCT 'i' || (event_id % 20), ',' ORDER BY 'i' || (event_id % 20)) AS items FROM events e WHERE event_id % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM events d WHERE d.user_id = e.user_id AND d.event_id % 20 = e.event_id % 20 AND d.event_id % 3 = 0) GROUP BY user_id")
def unfinished_stream_items(spark, sf_dir):
    e = inputs.table(spark, sf_dir, "events")
    rows = e.select(F.col("user_id").alias("stream_id"), F.concat(F.lit("i"), (F.col("event_id") % 20).cast("string")).alias("item"), F.when(F.col("event_id") % 3 == 0, "done").otherwise("added").alias("kind"))
    return accounting.unfinished_items(rows).withColumn("items", F.array_join("items", ","))


LINEAGE = f"SELECT trajectory_id FROM ({TRAJ}) AS t WHERE length(path) % 3 <> 0 UNION ALL SELECT 'extra' || path FROM ({TRAJ}) AS t WHERE length(trajectory_id) = 3"


@query(f"SELECT trajectory_id, CASE WHEN a IS NULL THEN 'missing_trajectory' WHEN b IS NULL THEN 'missing_lineage' WHEN a > 1 THEN 'duplicate_trajectory' ELSE 'duplicate_lineage' END AS code FROM (SELECT trajectory_id, count(*) AS a FROM ({TRAJ}) GROUP BY 1) FULL JOIN (SELECT trajectory_id, count(*) AS b FROM ({LINEAGE}) GROUP BY 1) USING (trajectory_id) WHERE a IS NULL OR b IS NULL OR a > 1 OR b > 1")
def lineage_parity(spark, sf_dir):
    return accounting.lineage_mismatch(derive(spark, sf_dir, TRAJ), derive(spark, sf_dir, LINEAGE))


@query("SELECT count(*) AS input_files, count(*) FILTER (o_orderkey % 4 > 1) AS covered, count(*) FILTER (o_orderkey % 4 = 0) AS skipped, count(*) FILTER (o_orderkey % 4 = 1) AS quarantined_records, true AS balanced FROM orders")
def coverage_equation(spark, sf_dir):
    o = inputs.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_ref"))
    part = lambda test: o.where(test)
    return accounting.coverage(o, part("source_ref % 4 > 1"), part("source_ref % 4 = 0"), part("source_ref % 4 = 1"))


MEDIA = "SELECT 'm' || CAST(p_partkey % 400 AS STRING) AS part_id, CASE WHEN p_partkey % 9 = 0 THEN p_brand ELSE 'one' END AS object_name FROM {part}"


@query(f"SELECT r.key, r.part_id, CASE WHEN n = 1 THEN o END AS object_name, CASE WHEN n IS NULL THEN 'missing_media_object' WHEN n > 1 THEN 'ambiguous_media_object' END AS code FROM (SELECT l_orderkey * 10 + l_linenumber AS key, 'm' || (min(l_partkey) % 500) AS part_id FROM lineitem GROUP BY l_orderkey, l_linenumber) r LEFT JOIN (SELECT part_id, count(DISTINCT object_name) AS n, min(object_name) AS o FROM ({MEDIA}) GROUP BY 1) USING (part_id)")
def media_objects(spark, sf_dir):
    refs = derive(spark, sf_dir, inputs.LINES).select((F.col("node_id") * 10 + F.col("line")).alias("key"), F.concat(F.lit("m"), (F.col("part") % 500).cast("string")).alias("part_id"))
    return accounting.media_objects(refs, derive(spark, sf_dir, MEDIA))


@query("SELECT doc_id, n_chars, (SELECT count(*) FROM documents) - 50 AS omitted FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50")
def first_details(spark, sf_dir):
    d = inputs.table(spark, sf_dir, "documents").select("doc_id", "n_chars", (-F.col("n_chars")).alias("o"))
    return accounting.first_rows(d, 50, "o", "doc_id").select("doc_id", "n_chars", "omitted")


# --- merging contributors

DEFINED = "SELECT s_suppkey % 20 AS leaf_id, 't' || CAST(s_nationkey % 5 AS STRING) AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'about ' || s_name ELSE '' END AS description, CASE s_suppkey % 4 WHEN 0 THEN '{}' WHEN 1 THEN '{\"a\":1}' WHEN 2 THEN '{\"a\":1,\"b\":2}' ELSE '{\"c\":3}' END AS parameters FROM {supplier}"


@query(
    f"""SELECT leaf_id, name, arg_max(parameters, lpad(length(parameters)::VARCHAR, 5, '0') || lpad(length(description)::VARCHAR, 5, '0') || parameters) AS parameters, arg_max(description, lpad(length(description)::VARCHAR, 5, '0') || description) AS description,
bool_or(parameters = '{{"c":3}}') AND bool_or(parameters LIKE '{{"a"%') AS conflict FROM ({DEFINED}) GROUP BY leaf_id, name"""
)
def tool_union_richest(spark, sf_dir):
    return merge.richest_tools(derive(spark, sf_dir, DEFINED))


FILES = "SELECT p_partkey % 300 AS leaf_id, 'm' || CAST(p_size % 6 AS STRING) AS part_id, p_name AS object_name, p_partkey % 11 = 0 AS is_leaf, p_partkey AS source_order, p_size AS ordinal FROM {part}"


@query(f"SELECT leaf_id, part_id, arg_min(object_name, CASE WHEN is_leaf THEN 0 ELSE 1000000000000 END + source_order) AS object_name FROM ({FILES}) GROUP BY leaf_id, part_id")
def media_first_wins(spark, sf_dir):
    return merge.first_media(derive(spark, sf_dir, FILES)).select("leaf_id", "part_id", "object_name")


@query("SELECT DISTINCT l.o_custkey AS leaf_id, f.field FROM orders l JOIN (SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS s, arg_min(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY 1) b USING (o_custkey), LATERAL (SELECT CASE WHEN l.o_orderstatus <> b.s THEN 'model' END AS field UNION ALL SELECT CASE WHEN l.o_orderpriority <> b.p THEN 'harness' END) f WHERE f.field IS NOT NULL")
def contributor_changed(spark, sf_dir):
    o = inputs.table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_custkey").alias("leaf_id"), F.col("o_orderstatus").alias("model"), F.col("o_orderpriority").alias("harness"), "o_orderkey")
    leaves = rows.groupBy("leaf_id").agg(F.min_by("model", "o_orderkey").alias("model"), F.min_by("harness", "o_orderkey").alias("harness"))
    return merge.changed_fields(rows, leaves, ("model", "harness"))


RECORDS = "SELECT user_id AS leaf_id, CASE WHEN event_id % 2 = 0 THEN 'history' ELSE 'response' END AS origin, event_id % 6 AS item_index, event_type AS item FROM {events}"


@query(f"SELECT leaf_id, string_agg(origin || item_index || item, ',' ORDER BY origin, item_index, item) AS records FROM (SELECT DISTINCT * FROM ({RECORDS})) GROUP BY leaf_id")
def distinct_unions(spark, sf_dir):
    out = merge.distinct_records(derive(spark, sf_dir, RECORDS))
    return out.select("leaf_id", F.array_join(F.transform("records", lambda r: F.concat(r["origin"], r["item_index"].cast("string"), r["item"])), ",").alias("records"))


# --- mounting sub-agents

COUNTED = f"""events AS ({inputs.SPAWNS}), holds AS ({inputs.HOLDS}), counted AS (SELECT e.session_id, e.thread_id, e.turn_id, e.call_id, count(DISTINCT h.leaf_id) AS n, min(h.leaf_id) AS parent_leaf FROM events e LEFT JOIN holds h ON h.session_id = e.session_id AND h.thread_id = e.thread_id AND h.call_id = e.call_id AND h.arguments = e.arguments GROUP BY ALL),
bound AS (SELECT e.*, c.parent_leaf FROM events e JOIN counted c USING (session_id, thread_id, turn_id, call_id) WHERE c.n = 1)"""
ROUTED = f"""{COUNTED}, kids AS ({inputs.CHILDREN}), good AS (SELECT * FROM kids WHERE parent_thread_id <> '' AND parent_turn_id <> ''),
pairs AS (SELECT k.child_id, b.*, b.call_id IS NOT NULL AND (k.marker_call_id = '' OR k.marker_call_id = b.call_id) AND (k.marker_task = '' OR k.marker_task = b.task_name) AS fits,
  CASE WHEN k.recipient = '' OR k.recipient = b.agent_name THEN 0 WHEN b.agent_name = '' AND regexp_extract(k.recipient, '([^/]*)$', 1) = b.task_name THEN 1 END AS tier FROM good k LEFT JOIN bound b ON b.session_id = k.session_id AND b.thread_id = k.parent_thread_id AND b.turn_id = k.parent_turn_id),
best AS (SELECT *, min(CASE WHEN fits THEN tier END) OVER (PARTITION BY child_id) AS low FROM pairs),
per AS (SELECT child_id, count(call_id) AS on_turn, count(*) FILTER (fits) AS fitting, count(*) FILTER (fits AND tier = low) AS n FROM best GROUP BY child_id),
edges AS (SELECT b.child_id, b.session_id, b.thread_id, b.turn_id, b.call_id, b.parent_leaf FROM best b JOIN per USING (child_id) WHERE per.n = 1 AND b.fits AND b.tier = b.low)"""


def _bound(spark, sf_dir):
    return mounts.bind_parents(derive(spark, sf_dir, inputs.SPAWNS), derive(spark, sf_dir, inputs.HOLDS))


@query(f"WITH {COUNTED} SELECT session_id, thread_id, turn_id, call_id, parent_leaf, NULL::VARCHAR AS code FROM bound UNION ALL SELECT session_id, thread_id, turn_id, call_id, NULL, CASE WHEN n = 0 THEN 'missing_parent_leaf' ELSE 'ambiguous_parent_leaf' END FROM counted WHERE n <> 1")
def mount_bind_parent(spark, sf_dir):
    bound, lost = _bound(spark, sf_dir)
    key, none = list(mounts.EVENT), F.lit(None).cast("string")
    return bound.select(*key, "parent_leaf", none.alias("code")).unionByName(lost.select(*key, none.alias("parent_leaf"), "code"))


@query(f"WITH {ROUTED} SELECT child_id, call_id, parent_leaf, NULL::VARCHAR AS code FROM edges UNION ALL SELECT child_id, NULL, NULL, CASE WHEN parent_thread_id = '' THEN 'missing_parent_thread_id' ELSE 'missing_parent_turn_id' END FROM kids WHERE parent_thread_id = '' OR parent_turn_id = '' UNION ALL SELECT child_id, NULL, NULL, CASE WHEN on_turn = 0 THEN 'missing_spawn_call' WHEN fitting = 0 OR n = 0 THEN 'spawn_routing_mismatch' ELSE 'ambiguous_spawn_call' END FROM per WHERE n <> 1")
def mount_route_child(spark, sf_dir):
    edges, lost = mounts.route_children(derive(spark, sf_dir, inputs.CHILDREN), _bound(spark, sf_dir)[0])
    none = F.lit(None).cast("string")
    return edges.select("child_id", "call_id", "parent_leaf", none.alias("code")).unionByName(lost.select("child_id", none.alias("call_id"), none.alias("parent_leaf"), "code"))


@query(f"WITH {ROUTED} SELECT child_id, count(*) OVER (PARTITION BY parent_leaf, call_id) > 1 AS conflict FROM edges")
def mount_conflicts(spark, sf_dir):
    edges, _ = mounts.route_children(derive(spark, sf_dir, inputs.CHILDREN), _bound(spark, sf_dir)[0])
    alone, shared = mounts.single_claims(edges)
    return alone.select("child_id", F.lit(False).alias("conflict")).union(shared.select("child_id", F.lit(True).alias("conflict")))


REACH = f"WITH RECURSIVE e AS ({inputs.EDGES}), walk(node, root) AS (SELECT c_custkey, c_custkey FROM customer WHERE c_custkey % 10 = 0 UNION SELECT e.node, w.root FROM e JOIN walk w ON e.up = w.node) "


@query(REACH + "SELECT node, root FROM walk")
def mount_reachability(spark, sf_dir):
    roots = inputs.table(spark, sf_dir, "customer").where("c_custkey % 10 = 0").select(F.col("c_custkey").alias("node"))
    return mounts.reachable(derive(spark, sf_dir, inputs.EDGES), roots)


@query(f"WITH RECURSIVE e AS ({inputs.EDGES}), walk(start, node, d) AS (SELECT node, up, 1 FROM e UNION SELECT w.start, e.up, d + 1 FROM walk w JOIN e ON e.node = w.node WHERE w.node <> w.start AND d < 200) SELECT DISTINCT start AS node FROM walk WHERE node = start")
def mount_cycles(spark, sf_dir):
    return mounts.cycles(derive(spark, sf_dir, inputs.EDGES))


#: Spawn calls of responses, some without turn or id, with arguments that are no object, told twice, or of several agents.
TOLD = f"""SELECT 's' || CAST(node_id % 50 AS STRING) AS session_id, 't' || CAST(node_id % 3 AS STRING) AS thread_id, CASE WHEN supp % 13 = 0 THEN '' ELSE 'r' || CAST(node_id AS STRING) END AS turn_id, CASE WHEN supp % 11 = 0 THEN '' ELSE 'k' || CAST(line % 3 AS STRING) END AS call_id,
  'Agent' AS name, CASE WHEN supp % 7 = 0 THEN '[1]' ELSE '{{"task_name":"n' || CAST(line % 3 AS STRING) || CASE WHEN part % 9 = 0 THEN 'x' ELSE '' END || '"}}' END AS arguments, CASE WHEN supp % 5 = 0 THEN '' WHEN supp % 5 = 1 THEN '/a' ELSE '/a,/b' END AS listed FROM ({inputs.LINES}) AS lines"""


@query(
    f"""WITH c AS (SELECT *, turn_id = '' OR call_id = '' AS bare, arguments LIKE '{{%' AS whole FROM ({TOLD})), t AS (SELECT *, CASE WHEN whole THEN json_extract_string(arguments, '$.task_name') ELSE '' END AS task FROM c),
per AS (SELECT session_id, thread_id, turn_id, call_id, count(DISTINCT CASE WHEN whole THEN arguments ELSE '{{}}' END) AS told, min(task) AS task, count(DISTINCT n) FILTER (n <> '') AS agents, min(n) FILTER (n <> '') AS agent FROM t, LATERAL (SELECT unnest(string_split(listed, ',')) AS n) WHERE NOT bare GROUP BY 1, 2, 3, 4)
SELECT session_id, thread_id, turn_id, call_id, task AS task_name, CASE WHEN agents = 1 THEN agent ELSE '' END AS agent_name, NULL::VARCHAR AS code FROM per WHERE told = 1
UNION ALL SELECT session_id, thread_id, turn_id, call_id, NULL, NULL, 'conflicting_spawn_evidence' FROM per WHERE told > 1
UNION ALL SELECT DISTINCT session_id, thread_id, turn_id, call_id, NULL, NULL, CASE WHEN turn_id = '' THEN 'spawn_missing_turn_id' ELSE 'spawn_missing_call_id' END FROM t WHERE bare
UNION ALL SELECT DISTINCT session_id, thread_id, turn_id, call_id, NULL, NULL, 'malformed_spawn_arguments' FROM t WHERE NOT bare AND NOT whole
UNION ALL SELECT DISTINCT session_id, thread_id, turn_id, call_id, NULL, NULL, 'conflicting_spawn_agent_name' FROM t WHERE NOT bare AND listed LIKE '%,%'"""
)
def mount_spawn_evidence(spark, sf_dir):
    events, bad = mounts.spawn_evidence(derive(spark, sf_dir, TOLD).withColumn("names", F.filter(F.split("listed", ","), lambda n: n != "")))
    key, none = list(mounts.EVENT), F.lit(None).cast("string")
    return events.select(*key, "task_name", "agent_name", none.alias("code")).unionByName(bad.select(*key, none.alias("task_name"), none.alias("agent_name"), "code"))


LINKAGE = "SELECT o_orderkey AS child_id, o_custkey % 40 AS session_id, o_custkey AS thread_id, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'm' END AS subagent_marker, CASE WHEN o_custkey % 9 = 0 AND o_orderkey % 2 = 0 THEN 'other' WHEN o_custkey % 13 = 0 THEN '' ELSE 'p' END AS parent_thread_id, 'r' AS parent_turn_id, '' AS forked_from_thread_id, CASE WHEN o_orderkey % 6 = 0 THEN 'q' ELSE '' END AS said_parent_thread_id, CASE WHEN o_orderkey % 4 = 0 THEN 'r' ELSE '' END AS said_parent_turn_id, '' AS said_forked_from_thread_id FROM {orders}"


@query(
    f"""WITH e AS ({LINKAGE}), v AS (SELECT session_id, thread_id, count(DISTINCT parent_thread_id) > 1 AS a, count(DISTINCT subagent_marker) > 1 AS b FROM e GROUP BY 1, 2), j AS (SELECT * FROM e JOIN v USING (session_id, thread_id)),
codes AS (SELECT child_id, 'missing_subagent_marker' AS code FROM j WHERE subagent_marker = '' UNION ALL SELECT child_id, 'missing_parent_thread_id' FROM j WHERE parent_thread_id = ''
  UNION ALL SELECT child_id, 'conflicting_marker_metadata' FROM j WHERE b OR (said_parent_thread_id <> '' AND said_parent_thread_id <> parent_thread_id) UNION ALL SELECT child_id, 'conflicting_parent_thread' FROM j WHERE a)
SELECT child_id, code FROM codes UNION ALL SELECT child_id, NULL FROM e ANTI JOIN codes USING (child_id)"""
)
def mount_admission(spark, sf_dir):
    rows = derive(spark, sf_dir, LINKAGE)
    good, bad = mounts.admitted(rows, rows)
    return good.select("child_id", F.lit(None).cast("string").alias("code")).unionByName(bad)


LEAVES = "SELECT o_orderkey AS leaf_id, o_custkey % 40 AS session_id, o_custkey AS thread_id, CAST(floor(o_totalprice) AS BIGINT) % 7 AS length, o_orderkey AS leaf_key FROM {orders}"


@query(f"SELECT leaf_id, length FROM (SELECT *, row_number() OVER (PARTITION BY session_id, thread_id ORDER BY length DESC, leaf_key) AS n FROM ({LEAVES})) WHERE n = 1")
def longest_child_leaf(spark, sf_dir):
    return mounts.longest_children(derive(spark, sf_dir, LEAVES))[0].select("leaf_id", "length")


LINKS = "SELECT o_custkey % 40 AS session_id, o_custkey AS thread_id, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'p' || CAST(o_custkey % 5 AS STRING) || CASE WHEN o_orderkey % 97 = 0 THEN 'x' ELSE '' END END AS parent_thread_id, o_orderstatus AS marker FROM {orders}"


@query(f"SELECT session_id, thread_id, 'parent_thread_id' AS field FROM ({LINKS}) GROUP BY 1, 2 HAVING count(DISTINCT nullif(parent_thread_id, '')) > 1 UNION ALL SELECT session_id, thread_id, 'marker' FROM ({LINKS}) GROUP BY 1, 2 HAVING count(DISTINCT marker) > 1")
def inconsistent_linkage(spark, sf_dir):
    return mounts.inconsistent_threads(derive(spark, sf_dir, LINKS), ("parent_thread_id", "marker"))


TASKS = f"SELECT node_id AS capture_id, CASE WHEN supp % 5 = 0 THEN 2 * line - 3 ELSE 2 * line + 1 END AS pos, 'c' || CAST(line % 3 AS STRING) AS call_id, CASE WHEN part % 4 = 0 THEN '' ELSE 'n' || CAST(part % 2 AS STRING) END AS task_name FROM ({inputs.LINES}) AS lines"
SPAWN_CALLS = f"SELECT node_id AS capture_id, min(2 * line) AS pos, 'c' || CAST(line % 3 AS STRING) AS call_id FROM ({inputs.LINES}) AS lines GROUP BY node_id, line % 3"


@query(f"SELECT c.capture_id, c.call_id, count(DISTINCT t.task_name) AS names, CASE WHEN count(DISTINCT t.task_name) = 1 THEN min(t.task_name) END AS agent_name FROM ({SPAWN_CALLS}) c JOIN ({TASKS}) t ON t.capture_id = c.capture_id AND t.call_id = c.call_id AND t.pos > c.pos AND t.task_name <> '' GROUP BY ALL")
def spawn_result_names(spark, sf_dir):
    return mounts.result_names(derive(spark, sf_dir, TASKS), derive(spark, sf_dir, SPAWN_CALLS))


DIAGNOSTICS = "SELECT 'code' || CAST(o_orderkey % 5 AS STRING) AS code, o_custkey % 40 AS session_id, o_custkey AS parent_thread_id, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey + 40 END AS child_thread_id FROM {orders} WHERE o_orderkey % 20 = 0"


@query(f"SELECT DISTINCT l.leaf_id, d.code FROM ({DIAGNOSTICS}) d JOIN ({LEAVES}) l ON l.session_id = d.session_id AND (l.thread_id = d.parent_thread_id OR l.thread_id = d.child_thread_id)")
def diagnostics_affected(spark, sf_dir):
    return mounts.affected_leaves(derive(spark, sf_dir, DIAGNOSTICS), derive(spark, sf_dir, LEAVES).select("leaf_id", "session_id", "thread_id"))


RELAY_EDGES = f"SELECT 'child' || CAST(node_id AS STRING) || '-' || CAST(line AS STRING) AS child_id, node_id AS parent_leaf, 'k' || CAST(line AS STRING) AS call_id, CASE WHEN supp % 6 = 0 THEN '' ELSE '/root/a' || CAST(line AS STRING) END AS agent_name FROM ({inputs.LINES}) AS lines WHERE line <= 3"
RELAY_MESSAGES = f"SELECT node_id AS leaf_id, 'm' || CAST(part % 2 AS STRING) || '-' || CAST(line AS STRING) AS message_id, '/root/a' || CAST(line % 4 AS STRING) AS author, CASE WHEN part % 5 = 0 THEN '/other' ELSE '/root' END AS recipient, CASE WHEN supp % 3 = 0 THEN '' ELSE 'k1,k2,k3' END AS done FROM ({inputs.LINES}) AS lines"


@query(
    f"""WITH e AS ({RELAY_EDGES}), m AS ({RELAY_MESSAGES}), c AS (SELECT e.child_id, e.parent_leaf, count(m.message_id) AS w, count(*) FILTER (m.recipient = '/root') AS a, count(*) FILTER (m.recipient = '/root' AND m.done <> '') AS n, min(m.message_id) FILTER (m.recipient = '/root' AND m.done <> '') AS relay FROM e LEFT JOIN m ON m.leaf_id = e.parent_leaf AND m.author = e.agent_name WHERE e.agent_name <> '' GROUP BY ALL),
s AS (SELECT *, count(relay) OVER (PARTITION BY parent_leaf, relay) AS shared FROM c), k AS (SELECT *, CASE WHEN w = 0 THEN 'unmatched_agent_message' WHEN a = 0 THEN 'agent_relay_recipient_mismatch' WHEN n = 0 THEN 'agent_relay_before_spawn' WHEN n > 1 THEN 'ambiguous_agent_relay' WHEN shared > 1 THEN 'relay_id_conflict' END AS code FROM s)
SELECT child_id, CASE WHEN code IS NULL THEN relay END AS relay_id, code FROM k UNION ALL SELECT child_id, NULL, 'missing_child_agent_name' FROM e WHERE agent_name = ''"""
)
def relay_attach(spark, sf_dir):
    messages = derive(spark, sf_dir, RELAY_MESSAGES).withColumn("preceding", F.split("done", ","))
    good, bad = mounts.attach_relays(derive(spark, sf_dir, RELAY_EDGES), messages)
    none = F.lit(None).cast("string")
    return good.select("child_id", "relay_id", none.alias("code")).unionByName(bad.select("child_id", none.alias("relay_id"), "code"))


KEY = "concat_ws('/', session_id, thread_id, turn_id, call_id)"


@query(
    f"""WITH {ROUTED}, claims AS (SELECT *, count(*) OVER (PARTITION BY parent_leaf, call_id) AS m FROM edges), kept AS (SELECT * FROM claims WHERE m = 1)
SELECT child_id AS subject, parent_leaf, call_id, NULL::VARCHAR AS code FROM kept
UNION ALL SELECT {KEY}, NULL, NULL, CASE WHEN n = 0 THEN 'missing_parent_leaf' ELSE 'ambiguous_parent_leaf' END FROM counted WHERE n <> 1
UNION ALL SELECT child_id, NULL, NULL, CASE WHEN parent_thread_id = '' THEN 'missing_parent_thread_id' ELSE 'missing_parent_turn_id' END FROM kids WHERE parent_thread_id = '' OR parent_turn_id = ''
UNION ALL SELECT child_id, NULL, NULL, CASE WHEN on_turn = 0 THEN 'missing_spawn_call' WHEN fitting = 0 OR n = 0 THEN 'spawn_routing_mismatch' ELSE 'ambiguous_spawn_call' END FROM per WHERE n <> 1
UNION ALL SELECT child_id, NULL, NULL, 'multiple_children_for_spawn' FROM claims WHERE m > 1
UNION ALL SELECT {KEY}, NULL, NULL, 'unmounted_spawn_call' FROM bound ANTI JOIN kept USING (session_id, thread_id, turn_id, call_id)"""
)
def mount_plan(spark, sf_dir):
    found = mounts.plan(derive(spark, sf_dir, inputs.SPAWNS), derive(spark, sf_dir, inputs.HOLDS), derive(spark, sf_dir, inputs.CHILDREN))
    none = F.lit(None).cast("string")
    return found["edges"].select(F.col("child_id").alias("subject"), "parent_leaf", "call_id", none.alias("code")).unionByName(found["diagnostics"].select("subject", none.alias("parent_leaf"), none.alias("call_id"), "code"))


# --- labels

CATALOGUE = labels.Taxonomy(("s0", "s1"), ("c0", "c1", "c2"), ("j0", "j1", "j2", "j3"))


@query("SELECT doc_id, quality < 2 AND doc_id % 3 <> 2 AND doc_id % 4 <> 3 AS valid FROM labels")
def label_contract_check(spark, sf_dir):
    one = lambda p, k: F.concat(F.lit(p), k.cast("string"))
    row = inputs.table(spark, sf_dir, "labels")
    capabilities = F.when(F.col("doc_id") % 3 == 2, F.array(F.lit("c0"), F.lit("c0"))).otherwise(F.array(F.lit("c2"), one("c", F.col("toxic"))))
    subjects = F.when(F.col("doc_id") % 4 == 3, F.array(F.lit("other"))).otherwise(F.array(one("j", F.col("doc_id") % 4)))
    return row.select("doc_id", CATALOGUE.valid(F.array(one("s", F.col("quality"))), capabilities, subjects).alias("valid"))


def answering():
    """A client that knows its answer from the length of the requests in a prompt, and fails where it can't."""
    import json

    def complete(prompt: str) -> str:
        prompt = prompt.split("<<<\n", 1)[1].rsplit("\n>>>", 1)[0]
        if len(prompt) % 5 == 4:
            return "no labels"
        return json.dumps({"scenarios": [f"s{len(prompt) % 2}"], "capabilities": ["c1"], "subjects": [f"j{len(prompt) % 4}"]})

    return complete


def _labelled(spark, sf_dir) -> DataFrame:
    docs, job = inputs.table(spark, sf_dir, "documents"), labels.LabelJob(CATALOGUE, answering, "v1")
    projections = docs.select(F.col("doc_id").cast("string").alias("trajectory_id"), (F.col("doc_id") % 4 != 0).alias("has_tool_calls"), F.concat(F.repeat(F.lit("x"), (F.col("doc_id") % 100).cast("int")), F.lit("y")).alias("projection"))
    cache = projections.where("length(projection) % 10 = 1").select(job.key(F.col("projection")).alias("cache_key"), F.lit("{}").alias("decision"))
    return job.run(projections, cache)


@query("WITH d AS (SELECT doc_id % 4 <> 0 AS calls, doc_id % 100 + 1 AS n FROM documents), c AS (SELECT DISTINCT n FROM d WHERE n % 10 = 1) SELECT count(*) AS input_trajectories, count(*) FILTER (calls AND (d.n % 5 <> 4 OR c.n IS NOT NULL)) AS classified, count(*) FILTER (calls AND d.n % 5 = 4 AND c.n IS NULL) AS failed, count(*) FILTER (NOT calls) AS skipped_no_toolcall, count(*) FILTER (calls AND c.n IS NOT NULL) AS cache_hits, 0::BIGINT AS context_truncated FROM d LEFT JOIN c USING (n)")
def label_counts(spark, sf_dir):
    return labels.LabelJob.counts(_labelled(spark, sf_dir))


@query("SELECT doc_id::VARCHAR AS trajectory_id, CASE WHEN doc_id % 4 = 0 THEN 'skipped' WHEN (doc_id % 100 + 1) % 5 = 4 THEN 'failed' ELSE 'accepted' END AS status, doc_id % 4 <> 0 AND (doc_id % 100 + 1) % 10 = 1 AS cache_hit FROM documents")
def label_cache_lookup(spark, sf_dir):
    return _labelled(spark, sf_dir).select("trajectory_id", "status", "cache_hit")


# --- order


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events")
def capture_order(spark, sf_dir):
    """The stable order of all captures of each user."""
    e = inputs.table(spark, sf_dir, "events")
    return e.select("event_id", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long").alias("place"))
