"""Queries over whole captures: wire formats, envelopes, projections, normalization and the stream."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import canonical, markers, names, projection, tokens
from ..operators import accounting, merge, mounts
from ..operators.storage import settled
from ..sources import captures, envelopes
from ..streaming import fold
from . import inputs
from .normalize import normalize_snapshots
from .queries import PREFIX, query
from .queries import captures as derived


@F.pandas_udf(T.StringType())
def _bodies(rows: pd.DataFrame) -> pd.Series:
    """The capture of an assistant's turn in one of three formats, from the turns before it."""

    def of(conv: int, turn: int, kind: int, roles, texts) -> str:
        said = [{"role": r, "content": t} for r, t in zip(roles, texts, strict=True)]
        base = {"session_id": f"s{conv}", "captured_at": f"{turn:06d}", "request_id": f"{conv}-{turn}", "status_code": 200, "request_headers": {}}
        if kind == 0:
            return json.dumps(base | {"path": "/v1/chat/completions", "request_body": {"model": "m", "messages": said[:-1]}, "response_body": {"object": "chat.completion", "model": "m", "choices": [{"index": 0, "finish_reason": "stop", "message": said[-1]}]}})
        if kind == 1:
            system = [m["content"] for m in said[:-1] if m["role"] == "system"]
            return json.dumps(base | {"path": "/v1/messages", "request_body": {"model": "m", "messages": [m for m in said[:-1] if m["role"] != "system"], **({"system": system[0]} if system else {})}, "response_body": {"type": "message", "model": "m", "stop_reason": "end_turn", "content": [{"type": "text", "text": said[-1]["content"]}]}})
        item = lambda m: {"type": "message", "role": m["role"], "content": [{"type": "input_text", "text": m["content"]}]}
        return json.dumps(base | {"path": "/v1/responses", "request_body": {"model": "m", "input": [item(m) for m in said[:-1]]}, "response_body": {"status": "completed", "model": "m", "output": [item(said[-1])]}})

    return pd.Series([of(*r) for r in zip(rows["conv_id"], rows["turn"], rows["kind"], rows["roles"], rows["texts"], strict=True)])


def raw_captures(spark, sf_dir) -> DataFrame:
    """Each assistant's turn of the conversations as a raw capture, in a format that goes by its conversation."""
    rows = inputs.derive(spark, sf_dir, f"SELECT a.conv_id, a.turn, t.turn AS pos, t.role, t.text FROM ({inputs.TURNS}) AS a JOIN ({inputs.TURNS}) AS t ON t.conv_id = a.conv_id AND t.turn <= a.turn WHERE a.role = 'assistant'")
    own = F.array_sort(F.collect_list(F.struct("pos", "role", "text")))
    rows = rows.groupBy("conv_id", "turn").agg(own.alias("x")).select("conv_id", "turn", (F.col("conv_id") % 3).alias("kind"), F.col("x.role").alias("roles"), F.col("x.text").alias("texts"))
    body = rows.select("conv_id", "turn", _bodies(F.struct("conv_id", "turn", "kind", "roles", "texts")).alias("payload"))
    return body.select(F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("source_ref"), "payload", F.sha2("payload", 256).alias("sha256"))


SAID = f"SELECT a.conv_id, a.turn, count(*) AS n, sum(length(t.text))::BIGINT AS chars FROM ({inputs.TURNS}) a JOIN ({inputs.TURNS}) t ON t.conv_id = a.conv_id AND t.turn <= a.turn WHERE a.role = 'assistant' GROUP BY a.conv_id, a.turn"


@query(f"SELECT 'c-' || conv_id || '-' || turn AS source_path, CASE conv_id % 3 WHEN 0 THEN 'chat_completions' WHEN 1 THEN 'messages' ELSE 'responses' END AS operation, 'success' AS outcome, 's' || conv_id AS session_id, n, chars FROM ({SAID})")
def wire_parse(spark, sf_dir):
    out = captures.parse_captures(raw_captures(spark, sf_dir), "freerouter")
    said = F.concat("history", "response")
    return out.select("source_path", "operation", "outcome", "session_id", F.size(said).cast("long").alias("n"), F.aggregate(said, F.lit(0).cast("long"), lambda a, m: a + F.length(m["content"])).alias("chars"))


@query(f"SELECT 's' || conv_id AS session_id, 0::BIGINT AS sub_session_id, n_rounds AS total_rounds, n_rounds AS origin_count, 'pass' AS disposition FROM (SELECT conv_id, count(*) FILTER (role = 'assistant') AS n_rounds FROM ({inputs.TURNS}) GROUP BY conv_id) WHERE n_rounds > 0")
def normalize_end_to_end(spark, sf_dir):
    run = normalize_snapshots(settled(captures.parse_captures(raw_captures(spark, sf_dir), "freerouter")))
    origins = run.lineage.select("trajectory_id", F.size("origins").cast("long").alias("origin_count"))
    return run.trajectories.drop("origin_count").join(origins, "trajectory_id").select("session_id", F.col("sub_session_id").cast("long"), "total_rounds", "origin_count", "disposition")


@query(PREFIX + "SELECT capture_id, scope AS conv_id, n FROM leaves")
def stream_fold(spark, sf_dir):
    """The fold as a stream that is read to its end, in small triggers and by no order."""
    rows = settled(derived(spark, sf_dir).select(F.col("capture_id").cast("string"), "scope", "tokens", "history").repartition(6, F.md5(F.col("capture_id").cast("string"))))
    path = rows.inputFiles()[0].rsplit("/", 1)[0]
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)
    work = f"{path}-stream"
    job = fold.fold_stream(stream).writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{work}/updates/{n}")).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()
    job.awaitTermination()
    found = fold.current(spark.read.schema(fold.UPDATES).option("recursiveFileLookup", "true").parquet(f"{work}/updates"))
    return found.where("kind = 'leaf'").select(F.col("capture_id").cast("long"), F.col("scope").cast("long").alias("conv_id"), "n")


@query("SELECT time_bucket(INTERVAL 8 HOUR, ts) AS start, user_id, count(*) AS n FROM events WHERE event_id % 3 = 0 GROUP BY ALL")
def sessionless_counts(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "events").select(F.col("ts").alias("at"), "user_id", F.when(F.col("event_id") % 3 == 0, "no_session_id").otherwise("s").alias("session_id"))
    return fold.window_counts(rows)


@query("SELECT doc_id, len(regexp_extract_all(text, '" + tokens.TOKEN + "'))::BIGINT AS n_tokens FROM documents")
def visible_tokens(spark, sf_dir):
    """Texts with media and opaque payloads put in, of which nothing may count."""
    noise = F.concat(F.lit('{"type":"image","data":"'), F.md5("text"), F.lit('"} '), F.col("text"), F.lit(" data:image/png;base64,AAAA <audio src=x>y</audio>"))
    return inputs.table(spark, sf_dir, "documents").select("doc_id", tokens.estimated_tokens(tokens.visible_text(noise)).alias("n_tokens"))


@query("SELECT event_id, '{\"a\":[1,' || ((event_id + 1) * 1000000007) || '00000000000000000000],\"k\":' || json_extract_string(props, '$.k') || ',\"ü\":null}' AS text FROM events")
def canonical_json(spark, sf_dir):
    own = F.concat(F.lit('{ "ü" : null, "k": 0, "a": [1, '), ((F.col("event_id") + 1) * 1000000007).cast("string"), F.lit('00000000000000000000], "k": '), F.get_json_object("props", "$.k"), F.lit("}"))
    return inputs.table(spark, sf_dir, "events").select("event_id", canonical.canonical_json(own).alias("text"))


@query("SELECT s_suppkey, 'key [REDACTED] for ' || s_name || ' at [REDACTED] v1.2.3.999' AS detail FROM supplier")
def redact_diagnostics(spark, sf_dir):
    raw = F.concat(F.lit("key sk-"), F.lpad(F.col("s_suppkey").cast("string"), 12, "a"), F.lit(" for "), F.col("s_name"), F.lit(" at 10.0.0."), (F.col("s_suppkey") % 250).cast("string"), F.lit(" v1.2.3.999"))
    return inputs.table(spark, sf_dir, "supplier").select("s_suppkey", canonical.redacted(raw).alias("detail"))


@query("SELECT conv_id, count(*) FILTER (trim(text, ' \t\r\n') <> '') AS n, string_agg(trim(text, ' \t\r\n'), chr(30) ORDER BY turn) AS said FROM (SELECT conv_id, turn, min(text) AS text FROM conversations WHERE role = 'user' GROUP BY ALL) GROUP BY conv_id")
def user_projection(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "conversations").where("role = 'user'").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    framed = F.concat(F.lit("<system-reminder>a <system-reminder>b</system-reminder></system-reminder>"), "text", F.lit("<environment_context>\nx\n</environment_context>"))
    own = rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", framed.alias("text")))), lambda x: x["text"]).alias("turns"))
    said = F.from_json(projection.requests("turns"), "array<string>")
    return own.select("conv_id", F.size(said).cast("long").alias("n"), F.array_join(said, "\x1e").alias("said"))


MARK = "chr(10) || '[... ' || (length(text) - k) || ' characters omitted ...]' || chr(10)"


@query(
    f"""WITH d AS (SELECT doc_id, text, list_max(list_filter(range(0, 1000), lambda k: k + length({MARK}) <= 1000)) AS k FROM documents)
SELECT doc_id, CASE WHEN length(text) <= 1000 THEN text ELSE left(text, (k + 1) // 2) || {MARK} || right(text, k - (k + 1) // 2) END AS text FROM d"""
)
def truncate_budget(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents").select("doc_id", projection.within(1000)("text").alias("text"))


@F.pandas_udf(T.StringType())
def _stream_of(texts: pd.Series) -> pd.Series:
    """A chat stream that says a text word by word."""
    chunk = lambda d, end=None: "data: " + json.dumps({"object": "chat.completion.chunk", "model": "m", "choices": [{"index": 0, "delta": d, "finish_reason": end}]}) + "\r\n\r\n"
    return texts.map(lambda t: ": hi\n\n" + "".join(chunk({"content": w}) for w in (t or "").split(" ")) + chunk({}, "stop") + "data: [DONE]\n\n")


@F.pandas_udf(T.StringType())
def _folded(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: envelopes.body("/v1/chat/completions", t)["choices"][0]["message"]["content"])


@query("SELECT conv_id, turn, replace(text, ' ', '') AS text FROM conversations")
def chat_chunk_fold(spark, sf_dir):
    return inputs.table(spark, sf_dir, "conversations").select("conv_id", "turn", _folded(_stream_of("text")).alias("text"))


REPLAYS = "SELECT CAST(user_id % 20 AS STRING) AS leaf_id, 'f' || CAST(user_id AS STRING) AS source_path, user_id % 40 < 20 AS is_leaf, event_id AS pos, 'v' || CAST(event_id % 6 AS STRING) AS call_id, CASE WHEN event_id % 4 = 0 THEN '' ELSE 'web' END AS name, '{}' AS arguments, CASE WHEN event_id % 2 = 0 THEN 'history' ELSE 'response' END AS origin, CASE WHEN event_id % 5 = 0 THEN 'r' END AS result FROM {events}"


@query(f"SELECT leaf_id, call_id, occurrence, count(*) OVER (PARTITION BY leaf_id, call_id, occurrence) * 0 AS variant, CASE WHEN named THEN 'web' ELSE '' END AS name, CASE WHEN answered THEN 'r' END AS result, false AS conflict FROM (SELECT leaf_id, call_id, occurrence, bool_or(name = 'web') AS named, bool_or(result IS NOT NULL) AS answered FROM (SELECT *, row_number() OVER (PARTITION BY leaf_id, source_path, call_id ORDER BY pos) - 1 AS occurrence FROM ({REPLAYS})) GROUP BY ALL)")
def server_call_merge(spark, sf_dir):
    return merge.merge_server_calls(inputs.derive(spark, sf_dir, REPLAYS)).select("leaf_id", "call_id", "occurrence", "variant", "name", "result", "conflict")


MARKED = "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '{\"call_id\":\"c1\",\"task_name\":\"t\"}' WHEN 1 THEN '{\"routing\":{\"spawn_call_id\":\"c2\"},\"forked_from\":\"f\"}' WHEN 2 THEN 'call_id=c3; task_name = x' WHEN 3 THEN 'opaque' WHEN 4 THEN '{broken' ELSE '' END AS raw FROM {orders}"


@query("SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'c1' WHEN 1 THEN 'c2' WHEN 2 THEN 'c3' ELSE '' END AS spawn_call_id, CASE o_orderkey % 6 WHEN 0 THEN 't' WHEN 2 THEN 'x' ELSE '' END AS task_name, CASE WHEN o_orderkey % 6 = 1 THEN 'f' ELSE '' END AS forked, CASE o_orderkey % 6 WHEN 3 THEN 'opaque' WHEN 4 THEN '{broken' ELSE '' END AS opaque FROM orders")
def routing_markers(spark, sf_dir):
    m = markers.marker(F.col("raw"))
    return inputs.derive(spark, sf_dir, MARKED).select("o_orderkey", m["spawn_call_id"].alias("spawn_call_id"), m["task_name"].alias("task_name"), m["forked_from_thread_id"].alias("forked"), m["opaque"].alias("opaque"))


MAIL = "SELECT user_id % 30 AS session_id, user_id % 3 AS thread_id, event_id % 7 AS capture_id, 'm' || CAST(event_id % 211 AS STRING) AS message_id, CASE WHEN event_id % 13 = 0 THEN event_type ELSE 'same' END AS item FROM {events}"


@query(f"WITH m AS ({MAIL}), p AS (SELECT session_id, thread_id, message_id, max(n) AS n, count(DISTINCT item) AS k FROM (SELECT *, count(*) OVER (PARTITION BY session_id, thread_id, message_id, capture_id) AS n FROM m) GROUP BY ALL) SELECT session_id, thread_id, message_id, 'duplicate_agent_message_id' AS code FROM p WHERE n > 1 UNION ALL SELECT session_id, thread_id, message_id, 'conflicting_agent_message_evidence' FROM p WHERE k > 1 UNION ALL SELECT session_id, thread_id, message_id, NULL FROM p WHERE n = 1 AND k = 1")
def agent_message_index(spark, sf_dir):
    good, bad = mounts.message_index(inputs.derive(spark, sf_dir, MAIL))
    return good.drop("item").withColumn("code", F.lit(None).cast("string")).unionByName(bad)


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_custkey % 3 = 0 THEN o_custkey ELSE -1 END AS note FROM orders WHERE o_orderpriority = '1-URGENT'")
def snapshots_of_user(spark, sf_dir):
    o = inputs.table(spark, sf_dir, "orders")
    path = F.col("o_orderkey").alias("source_path")
    snapshots = o.select(path, F.col("o_orderpriority").alias("user_id"))
    notes = o.where("o_custkey % 3 = 0").select(path, F.col("o_custkey").alias("note"))
    out = accounting.with_metadata(accounting.of_user(o.select(path, "o_orderstatus"), snapshots, "1-URGENT"), notes)
    return out.select(F.col("source_path").alias("o_orderkey"), "o_orderstatus", F.coalesce("note", F.lit(-1)).alias("note"))


@query("SELECT o_orderkey AS trajectory_id, given, n AS sub_session_id FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 4 END AS given, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_orderpriority) - 1 AS n FROM orders) WHERE given IS NOT NULL AND given <> n")
def label_renumber(spark, sf_dir):
    o = inputs.table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderkey").alias("trajectory_id"), F.col("o_custkey").alias("session_id"), F.lit(False).alias("synthesized"), F.col("o_orderdate").alias("created_at"), F.col("o_orderpriority").alias("source_file"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") % 4).alias("sub_session_id"))
    return accounting.renumbering_errors(rows).select("trajectory_id", F.col("_given").alias("given"), F.col("sub_session_id").cast("long"))


@query("SELECT key, CASE WHEN count(*) > 1 THEN 'duplicate_key' ELSE 'unsafe_key' END AS code FROM (SELECT CASE event_id % 50 WHEN 0 THEN 'in/twice' || (event_id // 100) WHEN 1 THEN 'out/' || event_id WHEN 2 THEN 'in//' || event_id WHEN 3 THEN 'in/../' || event_id ELSE 'in/a/' || event_id END AS key, event_id FROM events) GROUP BY key HAVING count(*) > 1 OR key NOT LIKE 'in/a/%' AND key NOT LIKE 'in/twice%'")
def inventory_errors(spark, sf_dir):
    k, key = F.col("event_id"), F.col("event_id").cast("string")
    named = F.when(k % 50 == 0, F.concat(F.lit("in/twice"), F.floor(k / 100).cast("string"))).when(k % 50 == 1, F.concat(F.lit("out/"), key)).when(k % 50 == 2, F.concat(F.lit("in//"), key)).when(k % 50 == 3, F.concat(F.lit("in/../"), key)).otherwise(F.concat(F.lit("in/a/"), key))
    return accounting.inventory_errors(inputs.table(spark, sf_dir, "events").select(named.alias("key")), "in/")


@query("SELECT event_id, 'HTTP ' || (400 + event_id % 200) || CASE event_id % 4 WHEN 0 THEN ' (type=' || event_type || '; code=k-1)' WHEN 1 THEN ' (type=' || event_type || ')' WHEN 2 THEN ' (code=c)' ELSE '' END AS detail FROM events")
def error_summaries(spark, sf_dir):
    k = F.col("event_id")
    kind, code = F.when(k % 4 < 2, F.col("event_type")).when(k % 4 == 2, "two words"), F.when(k % 4 == 0, "k-1").when(k % 4 == 2, "c").when(k % 4 == 3, "x/y")
    return inputs.table(spark, sf_dir, "events").select("event_id", names.error_summary(400 + k % 200, kind, code).alias("detail"))


@query("SELECT event_id FROM events ORDER BY ts, event_id LIMIT 20 OFFSET 35")
def positional_access(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").orderBy("ts", "event_id").offset(35).limit(20).select("event_id")
