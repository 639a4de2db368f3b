"""Publishing trajectories: one file each, lineage, a manifest last, and checks that read it all again."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import accounting
from ..plans.normalize import Normalized
from ..plans.published import documents, record_errors
from .store import Store

SCHEMA_VERSION = "v4"
LARGEST = 512 << 20


def publish_rows(run: Normalized, root: str, rows_a_file: int = 100_000) -> None:
    """The same documents as compressed JSON lines, many to a file, with lineage beside them: no name or count goes by the driver."""
    documents(run.trajectories, run.messages).write.option("compression", "gzip").option("maxRecordsPerFile", rows_a_file).mode("overwrite").json(f"{root.rstrip('/')}/trajectories")
    run.lineage.write.option("maxRecordsPerFile", rows_a_file).mode("overwrite").json(f"{root.rstrip('/')}/lineage")


def publish(spark: SparkSession, run: Normalized, root: str, input_root: str, input_format: str, config: dict | None = None, started_ms: int | None = None) -> dict:
    """Write the files of a run to ``root``: staged first, moved, the manifest last; what only an older manifest lists goes after that."""
    started_ms = started_ms or int(time.time() * 1000)
    store = Store(spark, root)
    store.delete("_staging")
    before = json.loads(store.read("manifest.json") or '{"files":[]}')
    docs = documents(run.trajectories, run.messages)
    stage = f"{store.root}/_staging"
    twice = docs.groupBy("path").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two trajectories for {twice[0]['path']}")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as fs

        system, base = fs.FileSystem.from_uri(stage if "://" in stage else f"file://{stage}")
        system.create_dir(base, recursive=True)
        for rows in batches:
            out = []
            for path, body in zip(rows["path"], rows["body"], strict=True):
                payload = body.encode() + b"\n"
                if len(payload) > LARGEST:
                    raise ValueError(f"{path} is too large")
                with system.open_output_stream(f"{base}/{path}") as f:
                    f.write(payload)
                out.append((path, hashlib.sha256(payload).hexdigest(), len(payload)))
            yield pd.DataFrame(out, columns=["path", "sha256", "bytes"])

    files = [r.asDict() for r in docs.select("path", "body").mapInPandas(write, "path string, sha256 string, bytes long").collect()]
    # one sorted file, written by one task as it comes; what reaches the driver is its name and hash
    run.lineage.select("trajectory_id", F.to_json(F.struct("*")).alias("value")).orderBy("trajectory_id").select("value").coalesce(1).write.mode("overwrite").text(f"{stage}/_lineage")
    part = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{stage}/_lineage").select("path", F.sha2("content", 256).alias("sha256"), F.octet_length("content").alias("bytes")).collect()
    if part:
        store.move(f"_staging/_lineage/{part[0]['path'].rsplit('/', 1)[1]}", "_staging/lineage.jsonl")
    else:
        store.write("_staging/lineage.jsonl", "")
    store.delete("_staging/_lineage")
    files.append({"path": "lineage.jsonl", "sha256": part[0]["sha256"] if part else hashlib.sha256(b"").hexdigest(), "bytes": part[0]["bytes"] if part else 0})
    roots = run.trajectories.where("parent_id IS NULL")
    reasons = {r["reason"]: r["n"] for r in accounting.reason_counts(roots).collect()}
    left = {(r["disposition"], r["reason"]): r["count"] for r in run.quarantine.groupBy("disposition", "reason").count().collect()}
    of = lambda *kinds: sum(n for (kind, _), n in left.items() if kind in kinds)
    covered = run.lineage.select(F.explode("origins.source_ref").alias("source_ref")).agg(F.count_distinct("source_ref")).first()[0]
    stats = accounting.export_stats(roots)
    whole = F.lit(sum(f["bytes"] for f in files if f["path"] != "lineage.jsonl"))
    counted, feedback = stats.first().asDict(), accounting.feedback(stats, whole, F.lit(of("skipped")), F.lit(started_ms).cast("long"), F.lit(int(time.time() * 1000)).cast("long")).first().asDict()
    for f in files:
        store.replace(f"_staging/{f['path']}", f["path"])
    manifest = {
        "schema_version": SCHEMA_VERSION, "created_at": datetime.now(UTC).isoformat(), "input_root": input_root, "input_format": input_format, "config_hash": hashlib.sha256(json.dumps(config or {}, sort_keys=True).encode()).hexdigest(), "token_estimator": "unicode-word-v1",
        "counts": {
            "accepted": counted["accepted"], "quarantined_trajectories": counted["quarantined"], "quarantined_records": of("quarantined", "excluded"), "excluded_records": of("excluded"), "duplicate_trajectories": counted["duplicates"],
            "input_files": covered + of("skipped", "quarantined", "excluded"), "reason_counts": reasons, "skipped_inputs": of("skipped"), "skip_reason_counts": {reason: n for (kind, reason), n in sorted(left.items()) if kind == "skipped"},
        },
        "files": sorted(files, key=lambda f: f["path"]), **feedback,
    }
    store.write("_staging/manifest.json", json.dumps(manifest, sort_keys=True))
    store.replace("_staging/manifest.json", "manifest.json")
    for path in sorted({f["path"] for f in before["files"]} - {f["path"] for f in files}):
        store.delete(path)
    store.delete("_staging")
    return manifest


def rewrite_clock(spark: SparkSession, root: str) -> dict:
    """The manifest again with the time at which its validation ended, replaced as a whole."""
    store = Store(spark, root)
    manifest = json.loads(store.read("manifest.json"))
    manifest["completed_at_ms"] = max(manifest["started_at_ms"], int(time.time() * 1000))
    store.write("_manifest", json.dumps(manifest, sort_keys=True))
    store.replace("_manifest", "manifest.json")
    return manifest


def validate(spark: SparkSession, root: str) -> list[str]:
    """What is wrong with a published folder: files that differ from the manifest, rows that aren't whole, ids that don't agree, files that nothing lists."""
    store = Store(spark, root)
    text = store.read("manifest.json")
    if text is None:
        return ["manifest is missing"]
    manifest = json.loads(text)
    errors = [] if manifest.get("schema_version") == SCHEMA_VERSION else ["unknown schema version"]
    listed = spark.createDataFrame(pd.DataFrame(manifest["files"], columns=["path", "sha256", "bytes"]), "path string, sha256 string, bytes long")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(store.root).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("path"), "content").where("path <> 'manifest.json'").withColumns({"_sha": F.sha2("content", 256), "_bytes": F.octet_length("content")})
    both = listed.join(found, "path", "full_outer")
    code = F.when(F.col("sha256").isNull(), "unlisted file").when(F.col("_sha").isNull(), "missing file").when((F.col("sha256") != F.col("_sha")) | (F.col("bytes") != F.col("_bytes")), "changed file")
    errors += [f"{r['code']}: {r['path']}" for r in both.select("path", code.alias("code")).where("code IS NOT NULL").orderBy("path").limit(100).collect()]
    lines = found.select("path", F.explode(F.split(F.rtrim(F.decode("content", "UTF-8"), F.lit("\n")), "\n")).alias("line"))
    rows = lines.where("path <> 'lineage.jsonl'")
    errors += [f"not one row: {r['path']}" for r in rows.groupBy("path").agg(F.count("*").alias("n")).where("n <> 1").limit(100).collect()]
    errors += [f"{r['path']}: {r['error']}" for r in rows.mapInPandas(_broken, "path string, error string").limit(100).collect()]
    lineage = lines.where("path = 'lineage.jsonl' AND line <> ''").select(F.from_json("line", "trajectory_id string, origin_count long, origins array<struct<source_ref:string>>").alias("x")).select("x.*")
    twice = lineage.groupBy("trajectory_id").count().where("count > 1 OR trajectory_id IS NULL")
    errors += [f"repeated or missing id: {r['trajectory_id']}" for r in twice.limit(100).collect()]
    errors += [f"origin count differs: {r['trajectory_id']}" for r in lineage.where("origin_count <> size(origins)").limit(100).collect()]
    counts, sources = manifest["counts"], lineage.select(F.explode("origins.source_ref").alias("s")).agg(F.count_distinct("s")).first()[0]
    data = [f for f in manifest["files"] if f["path"] != "lineage.jsonl"]
    equal = {
        "record_count": (manifest["record_count"], len(data)), "accepted and quarantined": (manifest["record_count"], counts["accepted"] + counts["quarantined_trajectories"]), "total_bytes": (manifest["total_bytes"], sum(f["bytes"] for f in data)),
        "input_files": (counts["input_files"], sources + counts["skipped_inputs"] + counts["quarantined_records"]), "excluded": (True, counts["excluded_records"] <= counts["quarantined_records"]), "clock": (True, manifest["started_at_ms"] <= manifest["completed_at_ms"]),
    }
    errors += [f"{name} differs: {a} and {b}" for name, (a, b) in equal.items() if a != b]
    return errors


def _broken(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out = []
        for path, line in zip(rows["path"], rows["line"], strict=True):
            try:
                out += [(path, e) for e in record_errors(json.loads(line))]
            except ValueError:
                out.append((path, "not JSON"))
        yield pd.DataFrame(out, columns=["path", "error"])


def inspect(spark: SparkSession, root: str, trajectory_id: str) -> dict | None:
    """The lineage of one trajectory."""
    found = spark.read.text(f"{root.rstrip('/')}/lineage.jsonl").where(F.get_json_object("value", "$.trajectory_id") == trajectory_id).limit(1).collect()
    return json.loads(found[0]["value"]) if found else None
