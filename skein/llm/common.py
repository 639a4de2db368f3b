"""Tables, scratch storage and word hashing shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _place(names: list[str], name: str) -> int:
    """Where a column is; of columns whose names differ in case alone, the exact name counts first, then the first one."""
    return names.index(name) if name in names else [n.lower() for n in names].index(name.lower())


def carry(df: DataFrame, **types: str) -> DataFrame:
    """The named columns, cast, and behind them the other columns of ``df`` by place as ``_c0``, ``_c1``, ..., with those
    that the cast changes; so names that clash don't matter, and no text is there twice."""
    wide = df.toDF(*[f"_c{k}" for k in range(len(df.columns))])
    at = {n: _place(df.columns, n) for n in types}
    named = wide.select(*[F.col(f"_c{at[n]}").cast(t).alias(n) for n, t in types.items()], *wide.columns)
    same = {f"_c{k}" for n, k in at.items() if named.schema[n].dataType == wide.schema[f"_c{k}"].dataType}
    return named.drop(*same)


def columns(df: DataFrame, **types: str) -> DataFrame:
    """The named columns alone, cast; extra columns, whatever their names, take no part."""
    return carry(df, **types).select(*types)  # what is not selected is not read


def carried(df: DataFrame, like: DataFrame, **changed: Column) -> DataFrame:
    """What ``df``, made from :func:`carry` of ``like``, still holds of its columns, under their names, with some changed."""
    new = {_place(like.columns, n): c for n, c in changed.items()}
    kept = [new.get(k, F.col(f"_c{k}" if f"_c{k}" in df.columns else n.lower())) for k, n in enumerate(like.columns)]
    return df.select(*[c.cast(f.dataType).alias(f"_c{k}") for k, (c, f) in enumerate(zip(kept, like.schema, strict=True))]).toDF(*like.columns)


# --- scratch tables -------------------------------------------------------


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; in local mode alone an unset one gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), f"skein-{os.getuid()}", uuid.uuid4().hex)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._skein_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files behind scratch tables that no later plan reads."""
    for df in frames:
        path = getattr(df, "_skein_path", None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


# --- text as bytes --------------------------------------------------------

#: Odd multiplier of the polynomial word hash, its inverse modulo 2**64, and the multipliers of the final mixing.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
WORDS_AT_ONCE = 1 << 15


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 18)
        for k, base in enumerate((BASE, INVERSE)):
            out = np.full(size, np.uint64(base))
            out[0] = 1
            _POWERS[k] = np.cumprod(out, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its offsets; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``size`` bytes of text, a row at least."""
    ends = buffers(batch.column(column))[1]
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, whose bytes are ``data``."""
    full = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = full.copy()
    start[1:] &= ~full[:-1] | first[1:-1]
    end = full.copy()
    end[:-1] &= ~full[1:] | first[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+``, A-Z in lower case, of all texts in order, and for each text the place of its first one (with the end last)."""
    data, offsets = buffers(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts, ends = spans(data, offsets)
    hashes = np.empty(len(starts), np.uint64)
    for k in range(0, len(starts), WORDS_AT_ONCE):
        s, e = starts[k : k + WORDS_AT_ONCE], ends[k : k + WORDS_AT_ONCE]
        a, b = int(s[0]), int(e[-1])
        up, down = _powers(b - a + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum((_LOWER[data[a:b]].astype(np.uint64) + np.uint64(1)) * up[: b - a], out=sums[1:])
        hashes[k : k + WORDS_AT_ONCE] = mix((sums[e - a] - sums[s - a]) * down[s - a] + (e - s).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of one text's runs of ``size`` words; with fewer words, the whole sequence is one."""
    n = len(hashes)
    if n == 0:
        return hashes
    size, salt = min(size, n), np.uint64(size if n >= size else n + 1_000_003)
    out = np.full(n - size + 1, salt)
    for k in range(size):
        out = mix(out * np.uint64(BASE) + hashes[k : n - size + 1 + k])
    return out
