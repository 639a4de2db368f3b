"""Readers: files of a format to raw captures, raw captures to snapshots."""

from __future__ import annotations

import hashlib
import io
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import canonical_text, parse, redacted_text
from .envelopes import FORMATS, EnvelopeError, adapt
from .schema import SNAPSHOT
from .wires import WireError, snapshot

RAW = "source_ref string, payload binary, sha256 string"
LINE_ROWS, LINE_BYTES = 256, 64 << 20
OBJECT_URI = re.compile(r"s3a?://(?P<bucket>[a-z0-9][a-z0-9.-]{1,61}[a-z0-9])(?:/(?P<key>[^?#]*))?")


def object_location(uri: str) -> tuple[str, str]:
    """Bucket and key of an object store's URI; keys must be relative, without empty, ``.`` or ``..`` parts."""
    found = OBJECT_URI.fullmatch(uri)
    parts = (found["key"] or "").rstrip("/").split("/") if found else [".."]
    if parts != [""] and any(p in ("", ".", "..") for p in parts):
        raise ValueError(f"not an object location: {uri}")
    return found["bucket"], "/".join(parts)


def discover(spark: SparkSession, root: str, source: str) -> DataFrame:
    """The files of a format below ``root``, at any depth: ``(path, modificationTime, length)``."""
    return _files(spark, root, source).select("path", "modificationTime", "length")


def _files(spark: SparkSession, root: str, source: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", FORMATS[source]).load(root)


def read(spark: SparkSession, root: str, source: str) -> DataFrame:
    """Raw captures ``(source_ref, payload, sha256)``: a file each, or for ``sxf`` a line each with ``file#L00000001`` as its reference.

    References are relative to ``root``. A compressed file is decoded as a stream, a batch of lines at a time."""
    files = _files(spark, root, source)
    base = F.lit(root.split("://", 1)[-1].rstrip("/") + "/")
    plain = F.regexp_replace("path", r"^[a-zA-Z0-9]+:/{1,3}(?=/)|^[a-zA-Z0-9]+:", "")
    named = files.withColumn("source_ref", F.when(F.contains(plain, base), F.substring_index(plain, root.split("://", 1)[-1].rstrip("/") + "/", -1)).otherwise(plain))
    if source != "sxf":
        return named.select("source_ref", F.col("content").alias("payload"), F.sha2("content", 256).alias("sha256"))
    return named.select("source_ref", F.col("content").alias("payload")).mapInArrow(_lines, RAW)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    rows, size = [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.binary()), pa.array([hashlib.sha256(r[1]).hexdigest() for r in rows])], ["source_ref", "payload", "sha256"])

    for batch in batches:
        for name, content in zip(batch.column("source_ref").to_pylist(), batch.column("payload"), strict=True):
            stream = zstandard.ZstdDecompressor().stream_reader(pa.BufferReader(content.as_buffer()), read_across_frames=True)
            for k, line in enumerate(io.BufferedReader(stream), 1):
                own = line.rstrip(b"\r\n")
                if own.strip():
                    rows.append((f"{name}#L{k:08d}", own))
                    size += len(own)
                if len(rows) >= LINE_ROWS or size >= LINE_BYTES:
                    yield flush()
                    rows, size = [], 0
    if rows:
        yield flush()


def _parsed(source: str):
    def one(ref: str, payload: bytes, sha: str) -> tuple:
        try:
            own = parse(payload.decode("utf-8"))
            made = snapshot(adapt(own, source), ref, sha, source)
            for issue in made["issues"]:
                issue["detail"] = redacted_text(issue["detail"])
            return ref, sha, canonical_text(made), None
        except (EnvelopeError, WireError) as error:
            return ref, sha, None, str(error)
        except (UnicodeDecodeError, json.JSONDecodeError, ValueError):
            return ref, sha, None, "invalid_json"
        except (KeyError, TypeError, AttributeError, RecursionError):
            return ref, sha, None, "invalid_capture"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), LINE_ROWS):
                part = batch.slice(k, LINE_ROWS)
                out = [one(*row) for row in zip(*(part.column(c).to_pylist() for c in ("source_ref", "payload", "sha256")), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], pa.string()) for n in range(4)], ["source_ref", "sha256", "snapshot", "reason"])

    return run


def parse_captures(raw: DataFrame, source: str) -> DataFrame:
    """``(source_ref, sha256, reason)`` and the columns of a snapshot, null where ``reason`` tells why there is none."""
    out = raw.select("source_ref", F.col("payload").cast("binary").alias("payload"), "sha256").mapInArrow(_parsed(source), "source_ref string, sha256 string, snapshot string, reason string")
    return out.withColumn("s", F.from_json("snapshot", SNAPSHOT)).select("source_ref", "sha256", "reason", "s.*")


def verified(spark: SparkSession, root: str, manifest: dict) -> DataFrame:
    """The files that a manifest lists, with whether bytes and hash still agree: ``(path, content, intact)``."""
    listed = spark.createDataFrame(pd.DataFrame(manifest["files"], columns=["path", "sha256", "bytes"]), "path string, sha256 string, bytes long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    found = files.select(F.substring_index("path", root.rstrip("/").split("://")[-1] + "/", -1).alias("path"), "content", F.sha2("content", 256).alias("_sha"), "length")
    return listed.join(found, "path", "left").select("path", "content", (F.coalesce(F.col("_sha") == F.col("sha256"), F.lit(False)) & (F.col("length") == F.col("bytes"))).alias("intact"))
