"""Numbers, windows, inventories, counters and the equations that outputs must satisfy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import real_session

ORDER = ("captured_at", "turn_id", "request_id", "source_path", "sha")


def sub_session_numbers(roots: DataFrame) -> DataFrame:
    """``roots(trajectory_id, session_id, synthesized, created_at, source_file)`` with ``sub_session_id``: from 0 within a
    session by creation, id and file; 0 where the session is synthesized."""
    place = Window.partitionBy("synthesized", "session_id").orderBy("created_at", "trajectory_id", "source_file")
    return roots.withColumn("sub_session_id", F.when(F.col("synthesized"), F.lit(0)).otherwise(F.row_number().over(place) - 1))


def inherited(nodes: DataFrame, numbered: DataFrame) -> DataFrame:
    """Every node of a tree with its root's number: ``nodes(trajectory_id, node_id)``."""
    return nodes.join(numbered.select("trajectory_id", "sub_session_id"), "trajectory_id")


def scopes(captures: DataFrame) -> DataFrame:
    """The distinct sessions, and the users of captures without one: ``(kind, id)``."""
    real = real_session(F.col("session_id"))
    named = captures.where(real != "").select(F.lit("session").alias("kind"), F.col("session_id").alias("id")).distinct()
    return named.unionByName(captures.where(real == "").select(F.lit("user").alias("kind"), F.coalesce("user_id", F.lit("")).alias("id")).distinct())


def resume_diff(before: DataFrame, now: DataFrame) -> DataFrame:
    """``(source_ref, state)`` of inventories ``(source_ref, sha)``: unchanged, changed, added or deleted."""
    both = before.select("source_ref", F.col("sha").alias("_old")).join(now.select("source_ref", F.col("sha").alias("_new")), "source_ref", "full_outer")
    state = F.when(F.col("_new").isNull(), "deleted").when(F.col("_old").isNull(), "added").when(F.col("_old") == F.col("_new"), "unchanged").otherwise("changed")
    return both.select("source_ref", state.alias("state"))


def stale(listed: DataFrame, published: DataFrame) -> DataFrame:
    """Files that an older output lists and a new one doesn't."""
    return listed.select("path").distinct().join(published.select("path"), "path", "left_anti")


def sequence_audit(events: DataFrame) -> DataFrame:
    """``events(stream_id, seq, payload)`` to gaps, replays and conflicts: ``(stream_id, seq, code, n)``."""
    per = events.groupBy("stream_id", "seq").agg(F.count_distinct("payload").alias("kinds"), F.count("*").alias("n"))
    before = F.lag("seq").over(Window.partitionBy("stream_id").orderBy("seq"))
    marked = per.withColumn("gap", F.col("seq") - before - 1)
    code = F.array_compact(F.array(F.when(F.col("kinds") > 1, F.struct(F.lit("conflicting_sse_sequence").alias("code"), F.col("kinds").alias("n"))), F.when((F.col("kinds") == 1) & (F.col("n") > 1), F.struct(F.lit("replayed_sse_sequence").alias("code"), F.col("n"))), F.when(F.col("gap") > 0, F.struct(F.lit("sse_sequence_gap").alias("code"), F.col("gap").cast("long").alias("n")))))
    return marked.select("stream_id", "seq", F.explode(code).alias("x")).select("stream_id", "seq", "x.code", "x.n")


def unfinished_items(events: DataFrame) -> DataFrame:
    """Items that a stream added and never finished: ``events(stream_id, item, kind)`` with kinds added and done."""
    names = lambda k: F.collect_set(F.when(F.col("kind") == k, F.col("item")))
    return events.groupBy("stream_id").agg(F.array_sort(F.array_except(names("added"), names("done"))).alias("items")).where("size(items) > 0")


def export_stats(trajectories: DataFrame) -> DataFrame:
    """One row of counts over ``trajectories(disposition, origin_count)``."""
    is_ = lambda d: F.count_if(F.col("disposition") == d)
    return trajectories.agg(is_("pass").alias("accepted"), is_("quarantined").alias("quarantined"), is_("excluded").alias("excluded"), F.coalesce(F.sum(F.col("origin_count") - 1), F.lit(0)).cast("long").alias("duplicates"))


def reason_counts(rows: DataFrame) -> DataFrame:
    """``(reason, n)`` over arrays ``reason_codes``."""
    return rows.select(F.explode("reason_codes").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def feedback(stats: DataFrame, total_bytes: Column, failures: Column, started_ms: Column, completed_ms: Column) -> DataFrame:
    """The feedback fields of a manifest from :func:`export_stats`: published roots, not origins or nested agents; failures
    count inputs that could not be parsed; a clock that ran back ends where it started."""
    total = F.col("accepted") + F.col("quarantined")
    return stats.select(
        F.lit("SUCCEEDED").alias("status"), total.alias("record_count"), F.col("accepted").alias("accepted_trajectory_count"), F.col("quarantined").alias("quarantined_trajectory_count"),
        failures.cast("long").alias("parse_failure_count"), total_bytes.cast("long").alias("total_bytes"), started_ms.alias("started_at_ms"), F.greatest(started_ms, completed_ms).alias("completed_at_ms"),
    )


def lineage_mismatch(trajectories: DataFrame, lineage: DataFrame) -> DataFrame:
    """Ids that only one side has, and those that one side repeats: ``(trajectory_id, code)``."""
    a = trajectories.groupBy("trajectory_id").agg(F.count("*").alias("_a"))
    b = lineage.groupBy("trajectory_id").agg(F.count("*").alias("_b"))
    code = F.when(F.col("_a").isNull(), "missing_trajectory").when(F.col("_b").isNull(), "missing_lineage").when(F.col("_a") > 1, "duplicate_trajectory").when(F.col("_b") > 1, "duplicate_lineage")
    return a.join(b, "trajectory_id", "full_outer").select("trajectory_id", code.alias("code")).where("code IS NOT NULL")


def coverage(inputs: DataFrame, origins: DataFrame, skipped: DataFrame, quarantined: DataFrame) -> DataFrame:
    """One row: whether every input is the origin of some trajectory, skipped, or a record in quarantine."""
    n = lambda df, c, name: df.agg(c.alias(name))
    parts = n(inputs, F.countDistinct("source_ref"), "input_files").join(n(origins, F.countDistinct("source_ref"), "covered")).join(n(skipped, F.count("*"), "skipped")).join(n(quarantined, F.count("*"), "quarantined_records"))
    return parts.withColumn("balanced", F.col("input_files") == F.col("covered") + F.col("skipped") + F.col("quarantined_records"))


def media_objects(references: DataFrame, media: DataFrame) -> DataFrame:
    """Each reference with the one object of its part; parts without, or with several, are errors."""
    named = media.groupBy("part_id").agg(F.collect_set("object_name").alias("names"))
    code = F.when(F.col("names").isNull(), "missing_media_object").when(F.size("names") > 1, "ambiguous_media_object")
    return references.join(named, "part_id", "left").select(*references.columns, F.when(F.size("names") == 1, F.col("names")[0]).alias("object_name"), code.alias("code"))


def first_rows(df: DataFrame, most: int, *order: str) -> DataFrame:
    """The first ``most`` rows and, on each, how many were left out."""
    total = df.agg(F.greatest(F.count("*") - most, F.lit(0).cast("long")).alias("omitted"))
    return df.orderBy(*order).limit(most).join(F.broadcast(total))


def of_user(captures: DataFrame, snapshots: DataFrame, user_id: str) -> DataFrame:
    """The snapshots of a user's captures, in capture order: ``captures(source_path, status)``."""
    return snapshots.where(F.col("user_id") == user_id).join(captures, "source_path").orderBy(*[c for c in ORDER if c in snapshots.columns])


def with_metadata(snapshots: DataFrame, metadata: DataFrame) -> DataFrame:
    """Snapshots with the metadata that there is of them."""
    return snapshots.join(metadata, "source_path", "left")


def of_paths(snapshots: DataFrame, paths: DataFrame) -> DataFrame:
    return snapshots.join(paths.select("source_path").distinct(), "source_path", "left_semi")


def inventory_errors(objects: DataFrame, prefix: str) -> DataFrame:
    """``objects(key)`` that a listing must not have: keys it has twice, and keys outside ``prefix`` or with empty or dotted parts."""
    wrong = ~F.startswith("key", F.lit(prefix)) | F.exists(F.split(F.substr(F.col("key"), F.lit(len(prefix) + 1)), "/"), lambda p: p.isin("", ".", ".."))
    code = F.when(F.col("n") > 1, "duplicate_key").when(wrong, "unsafe_key")
    return objects.groupBy("key").agg(F.count("*").alias("n")).select("key", code.alias("code")).where("code IS NOT NULL")


def changed_while_read(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files whose length or time differs between two listings ``(path, modificationTime, length)``."""
    return before.join(after.select("path", F.col("modificationTime").alias("_m"), F.col("length").alias("_l")), "path", "left").where(F.col("_m").isNull() | (F.col("_m") != F.col("modificationTime")) | (F.col("_l") != F.col("length"))).select("path")


def renumbering_errors(published: DataFrame) -> DataFrame:
    """Published roots whose ``sub_session_id`` isn't what their order gives; a number that an older row lacks is no error."""
    given = published.withColumnRenamed("sub_session_id", "_given")
    return sub_session_numbers(given).where("_given IS NOT NULL AND _given <> sub_session_id").select("trajectory_id", "_given", "sub_session_id")
