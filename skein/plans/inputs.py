"""Inputs of the registered queries, derived from the given tables in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
_NAMED = re.compile(r"\{(%s)\}" % "|".join(TABLES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """``sql`` over the tables that it names in braces; other braces stand for themselves."""
    names = set(_NAMED.findall(sql))
    own = re.sub(_NAMED.pattern + "|([{}])", lambda m: m[0] if m[1] else m[0] * 2, sql)
    return spark.sql(own, **{n: table(spark, sf_dir, n) for n in names})


def duck(sql: str) -> str:
    return _NAMED.sub(r"\1", sql)


#: One row for each line of an order.
LINES = "SELECT l_orderkey AS node_id, CAST(l_linenumber AS BIGINT) AS line, min(l_partkey) AS part, min(l_suppkey) AS supp, min(l_returnflag) AS flag, min(l_quantity) AS quantity FROM {lineitem} GROUP BY l_orderkey, l_linenumber"
CALLS = f"""SELECT node_id, 2 * line AS pos, 'c' || CAST(line % 5 AS STRING) AS call_id, 'tool_' || CAST(part % 7 AS STRING) AS name,
  '{{"a":' || CASE WHEN supp % 4 = 0 THEN '"s"' WHEN supp % 4 = 1 THEN '2.5' ELSE CAST(part % 3 AS STRING) END || CASE WHEN flag = 'A' THEN ',"z":true' ELSE '' END || CASE WHEN line % 2 = 0 THEN ',"b":"x"' ELSE '' END || '}}' AS arguments
  FROM ({LINES}) AS lines"""
RESULTS = f"""SELECT node_id, CASE WHEN supp % 9 = 0 THEN 2 * line - 3 ELSE 2 * line + 1 END AS pos,
  CASE WHEN node_id % 10 = 0 THEN 'x' ELSE 'c' END || CAST(line % 5 AS STRING) AS call_id,
  CASE WHEN part % 11 = 0 THEN 'other' ELSE 'tool_' || CAST(part % 7 AS STRING) END AS name
  FROM ({LINES}) AS lines WHERE (node_id + line) % 6 <> 0"""
#: Captures of conversations, one for each assistant turn: the turns before it are history, it is the response.
TURNS = "SELECT conv_id, turn, min(role) AS role, min(text) AS text FROM {conversations} GROUP BY conv_id, turn"
CAPTURES = f"""SELECT a.conv_id * 1000 + a.turn AS capture_id, a.conv_id, a.turn,
  CASE WHEN a.conv_id % 7 = 0 THEN 'no_session_id' WHEN a.conv_id % 11 = 0 THEN '' ELSE 's' || CAST(a.conv_id AS STRING) END AS session_id,
  CAST(a.conv_id % 2 AS STRING) AS thread_id, 'u' || CAST(a.conv_id % 4 AS STRING) AS user_id, a.conv_id % 77 = 0 AS masked,
  'file-' || CAST(a.conv_id AS STRING) || '-' || CAST(a.turn AS STRING) AS source_path FROM ({TURNS}) AS a WHERE a.role = 'assistant'"""
#: The same with a branch that ends differently, for every third conversation, and the last turn sent again, for every fifth.
BRANCHED = f"""SELECT capture_id, conv_id, turn, '' AS suffix FROM ({CAPTURES}) AS x
  UNION ALL SELECT capture_id + 500, conv_id, turn, ' (branch)' FROM ({CAPTURES}) AS x WHERE conv_id % 3 = 0 AND turn >= 3
  UNION ALL SELECT capture_id + 700, conv_id, turn, '' FROM ({CAPTURES}) AS x WHERE conv_id % 5 = 0"""
SIMPLE_TOKEN = "role || ':' || text"
TOKENS = f"""SELECT b.capture_id, b.conv_id, t.turn AS pos, CASE WHEN t.turn = b.turn THEN t.role || ':' || t.text || b.suffix ELSE t.role || ':' || t.text END AS token, CASE WHEN t.turn < b.turn THEN 1 ELSE 0 END AS is_history
  FROM ({BRANCHED}) AS b JOIN ({TURNS}) AS t ON t.conv_id = b.conv_id AND t.turn <= b.turn"""
#: Flags of captures.
FLAGS = """SELECT event_id, user_id, CASE WHEN event_type = 'view' THEN 'count_tokens' ELSE 'responses' END AS operation, event_id % 13 <> 0 AS wire_complete,
  CASE WHEN event_type = 'error' THEN 'capture_invalid' WHEN event_type = 'signup' THEN 'api_error' ELSE 'success' END AS outcome,
  CASE WHEN event_type <> 'error' THEN '' WHEN event_id % 3 = 0 THEN 'orphan_tool_result' WHEN event_id % 3 = 1 THEN 'orphan_tool_result,duplicate_tool_result' ELSE 'duplicate_tool_result,invalid_messages' END AS codes FROM {events}"""
#: Spawn events, the leaves that hold them, and linked children, from orders and their lines.
SPAWNS = f"""SELECT DISTINCT 's' || CAST(node_id % 50 AS STRING) AS session_id, 't' || CAST(node_id % 3 AS STRING) AS thread_id, 'r' || CAST(node_id AS STRING) AS turn_id, 'k' || CAST(node_id AS STRING) || '-' || CAST(line AS STRING) AS call_id,
  'a' || CAST(part % 2 AS STRING) AS arguments, 'task' || CAST(line % 3 AS STRING) AS task_name, CASE WHEN line % 4 = 0 THEN '' ELSE '/root/task' || CAST(line % 3 AS STRING) END AS agent_name FROM ({LINES}) AS lines WHERE line <= 4"""
HOLDS = f"""SELECT DISTINCT 'leaf' || CAST(node_id AS STRING) || CASE WHEN supp % 8 = 0 THEN 'b' ELSE '' END AS leaf_id, 's' || CAST(node_id % 50 AS STRING) AS session_id, 't' || CAST(node_id % 3 AS STRING) AS thread_id, 'k' || CAST(node_id AS STRING) || '-' || CAST(line AS STRING) AS call_id,
  CASE WHEN supp % 7 = 0 THEN 'a9' ELSE 'a' || CAST(part % 2 AS STRING) END AS arguments FROM ({LINES}) AS lines WHERE line <= 4
  UNION SELECT 'twin' || CAST(node_id AS STRING), 's' || CAST(node_id % 50 AS STRING), 't' || CAST(node_id % 3 AS STRING), 'k' || CAST(node_id AS STRING) || '-' || CAST(line AS STRING), 'a' || CAST(part % 2 AS STRING) FROM ({LINES}) AS lines WHERE line <= 4 AND node_id % 9 = 0"""
CHILDREN = f"""SELECT 'child' || CAST(node_id AS STRING) || '-' || CAST(line AS STRING) AS child_id, 's' || CAST(node_id % 50 AS STRING) AS session_id, CASE WHEN supp % 17 = 0 THEN '' ELSE 't' || CAST(node_id % 3 AS STRING) END AS parent_thread_id, CASE WHEN supp % 19 = 0 THEN '' ELSE 'r' || CAST(node_id AS STRING) END AS parent_turn_id,
  CASE WHEN line % 2 = 0 THEN 'k' || CAST(node_id AS STRING) || '-' || CAST(line % 4 + 1 AS STRING) ELSE '' END AS marker_call_id, CASE WHEN line % 3 = 1 THEN 'task' || CAST(part % 3 AS STRING) ELSE '' END AS marker_task, CASE WHEN line % 3 = 2 THEN '/root/task' || CAST(line % 3 AS STRING) ELSE '' END AS recipient FROM ({LINES}) AS lines WHERE line <= 5"""
#: A graph in which every customer points to at most one other.
EDGES = "SELECT c_custkey AS node, CASE WHEN c_custkey % 40 IN (1, 2, 3) THEN c_custkey - c_custkey % 40 + (c_custkey % 40) % 3 + 1 ELSE (c_custkey * 7 + 3) % (SELECT count(*) FROM {customer}) END AS up FROM {customer} WHERE c_custkey % 10 <> 0"
#: Trajectories with origins.
TRAJECTORIES = "SELECT 'd' || CAST(n_chars AS STRING) AS trajectory_id, CASE WHEN doc_id % 3 = 0 THEN 'quarantined' WHEN doc_id % 7 = 0 THEN 'excluded' ELSE 'pass' END AS disposition, '2024-01-' || CAST(10 + doc_id % 20 AS STRING) AS captured_at, 'f' || CAST(doc_id AS STRING) AS path, 'h' || CAST(doc_id % 100 AS STRING) AS sha FROM {documents}"
INVENTORY = "SELECT 'o' || CAST(o_orderkey AS STRING) AS source_ref, o_orderstatus || CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) AS sha FROM {orders}"
