"""Labels for published trajectories."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import projection
from ..operators.labels import LabelJob
from ..operators.storage import settled
from ..sources import captures
from ..sources.sinks import Store


def projections(spark: SparkSession, root: str) -> DataFrame:
    """``(path, body, trajectory_id, has_tool_calls, projection)`` of the intact trajectory files that a manifest lists."""
    manifest = json.loads(Store(spark, root).read("manifest.json"))
    files = captures.verified(spark, root, manifest)
    broken = [r["path"] for r in files.where("NOT intact").select("path").limit(5).collect()]
    if broken:
        raise ValueError(f"files differ from the manifest: {broken}")
    body = F.rtrim(F.decode("content", "UTF-8"), F.lit("\n"))
    rows = files.where("path <> 'lineage.jsonl'").select("path", body.alias("body"))
    said = F.from_json(F.get_json_object("body", "$.messages"), "array<struct<role:string,content:string>>")
    asked = F.transform(F.filter(said, lambda m: m["role"] == "user"), lambda m: m["content"])
    counts = F.regexp_extract_all("body", F.lit('"total_tool_calls":([0-9]+)'), F.lit(1))
    return rows.select("path", "body", F.sha2("body", 256).alias("trajectory_id"), F.exists(counts, lambda n: n != "0").alias("has_tool_calls"), projection.requests(asked).alias("projection"))


def label(spark: SparkSession, root: str, out: str, job: LabelJob, cache_path: str) -> dict:
    """Label the trajectories at ``root`` and write each with its ``classification`` to ``out``; accepted decisions join the cache.

    Returns the counts, which also end up in the manifest of ``out``."""
    rows = settled(projections(spark, root))
    cache = spark.read.parquet(cache_path) if Store(spark, cache_path).exists("") else spark.createDataFrame([], "cache_key string, decision string")
    done = settled(job.run(rows.select("trajectory_id", "has_tool_calls", "projection"), cache))
    fresh = done.where("status = 'accepted' AND NOT cache_hit").select("cache_key", "decision").dropDuplicates(["cache_key"])
    fresh.write.mode("append").parquet(cache_path)
    told = F.to_json(F.struct("status", "reason"))
    told = F.when(F.col("status") == "accepted", F.concat(F.substr(told, F.lit(1), F.length(told) - 1), F.lit(',"labels":'), "decision", F.lit("}"))).otherwise(told)
    both = rows.join(done.select("trajectory_id", told.alias("classification")), "trajectory_id")
    merged = F.concat(F.substr(F.col("body"), F.lit(1), F.length("body") - 1), F.lit(',"classification":'), "classification", F.lit("}"))
    both.select(merged.alias("value")).write.mode("overwrite").text(f"{out.rstrip('/')}/trajectories")
    counts = LabelJob.counts(done).first().asDict()
    if counts["input_trajectories"] != counts["classified"] + counts["failed"] + counts["skipped_no_toolcall"]:
        raise ValueError(f"labels don't add up: {counts}")
    Store(spark, out).write("manifest.json", json.dumps({"schema_version": "v2", "taxonomy": job.taxonomy.digest, "counts": counts}, sort_keys=True))
    return counts
