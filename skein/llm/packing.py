"""Packing: BM25 neighbours of a seed document fill its window of tokens."""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns, slices, stored, table
from .neighbours import Tree

WINDOW, END = 2048, 1
#: Rows and bytes of a shard at most.
SHARD_ROWS, SHARD_BYTES = 1024, 32 << 20
K1, B = 1.2, 0.75
#: Dimensions of the sketch by which rows of like content come to one shard, rows to which its weights and its tree are
#: fitted and those of them in a cell at least, and bits that order the rows of a cell.
SKETCH, SAMPLE, SAMPLE_CELL, BITS = 16, 4096, 8, 62
#: A run of white space this long is more than the regular expressions of ``tiktoken`` stand.
LONG_BLANK = re.compile(r"\s{50000}")


@lru_cache(maxsize=2)
def _encoder(path: str):
    """The tokenizer of a vocabulary file. For a byte-level BPE of the ``tokenizers`` library that has its ranks
    beside it, the same ids come from ``tiktoken``, which takes a quarter of the time; texts that it can't bear go to
    ``tokenizers`` itself."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True

    def plain(text: str) -> list[int]:
        return own.encode(text, add_special_tokens=False).ids

    try:
        import public_tokenizers
        import tiktoken

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    except (FileNotFoundError, ImportError):
        return plain
    fast = tiktoken.Encoding("byte level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={}).encode_ordinary
    return lambda text: plain(text) if len(text) >= 50_000 and LONG_BLANK.search(text) else fast(text)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Places:
    """Where documents stand among others: their BM25 weights, with the idf of a sample, projected to SKETCH dimensions, in
    which a kd-tree of the sample has cells and hyperplanes order what is in one."""

    def __init__(self, documents: list[np.ndarray], rows: int, shard_rows: int):
        seen = [np.unique(d, return_counts=True) for d in documents]
        size = max((int(ids[-1]) for ids, _ in seen), default=0) + 1
        held = np.bincount(np.concatenate([ids for ids, _ in seen]), minlength=size) if seen else np.zeros(1)
        self.idf, self.mean = idf_of(held, len(seen)), float(np.mean([len(d) for d in documents])) if documents else 1.0
        self.ready = False
        points = np.array([self.sketch(ids, n, len(d)) for (ids, n), d in zip(seen, documents, strict=True)]).reshape(-1, SKETCH)
        self.tree = Tree(points, min(-(-rows // shard_rows), len(points) // SAMPLE_CELL))

    def __getstate__(self) -> dict:
        return {"idf": self.idf, "mean": self.mean, "tree": self.tree, "ready": False}

    def sketch(self, ids: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
        if not self.ready:
            self.axes = np.random.default_rng(7).normal(size=(len(self.idf) + 1, SKETCH)).astype(np.float32)
            self.weight = np.append(self.idf, self.idf.max())  # of a token that the sample lacks
            self.planes = np.random.default_rng(8).normal(size=(SKETCH, BITS))
            self.ready = True
        ids = np.minimum(ids, len(self.idf))
        out = (self.weight[ids] * weights(count, length, self.mean)) @ self.axes[ids]
        return out / max(float(np.linalg.norm(out)), 1e-12)

    def place(self, sketches: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each sketch and its bits."""
        points = np.array(sketches).reshape(-1, SKETCH)
        return self.tree.place(points), (points @ self.planes > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _tokenized(path: str, window: int, end: int, places):
    """Documents as tokens, with their place; the last row of a task, of -1 tokens, says in how many of its documents each token
    occurs, for which the ids of a vocabulary are a bound."""
    names = ["doc_id", "doc_tokens", "full", "tail", "terms", "cell", "bits"]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, where = _encoder(path), places.value
        held = np.zeros(0, np.int64)
        for batch in (x for whole in batches for x in slices(whole)):
            n, full, tail, terms, sketches = [], [], [], [], []
            for text in batch.column("text"):
                ids = array("I", encode(text.as_py() or ""))
                ids.append(end)
                ids = np.frombuffer(ids, np.uint32).astype("<u4", copy=False)
                cut = len(ids) // window * window
                n.append(len(ids))
                full.append([zlib.crc32(ids[a : a + window].tobytes()) for a in range(0, cut, window)])
                tail.append(ids[cut:].tobytes())
                own, count = np.unique(ids, return_counts=True)
                terms.append(np.concatenate([own, count]).astype("<u4").tobytes() if cut else None)
                if own[-1] >= len(held):
                    held = np.concatenate([held, np.zeros(int(own[-1]) + 1 - len(held), np.int64)])
                held[own] += 1
                sketches.append(where.sketch(own, count, len(ids)))
            if sketches:
                columns_ = batch.column("doc_id"), n, full, tail, terms, *where.place(sketches)
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(columns_, types, strict=True)], names)
        at = np.flatnonzero(held)
        if len(at):
            told = np.concatenate([at, held[at]]).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((None, -1, [], b"", told, 0, 0), types, strict=True)], names)

    return run


def counted(tail: bytes, terms: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """The different tokens of a whole document, ascending, and how often each occurs; a document without full windows is its tail."""
    if terms is None:
        return np.unique(np.frombuffer(tail, "<u4"), return_counts=True)
    both = np.frombuffer(terms, "<u4")
    return both[: len(both) // 2], both[len(both) // 2 :]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for told in batch.column("terms").to_pylist():
            both = np.frombuffer(told, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(both[: len(both) // 2]), pa.array(both[len(both) // 2 :])], ["token", "n"])


def idf_of(held: np.ndarray, n: int) -> np.ndarray:
    return np.log1p((n - held + 0.5) / (held + 0.5))


def weights(count: np.ndarray, length, mean: float) -> np.ndarray:
    """What BM25 gives for a token that a document of ``length`` tokens holds ``count`` times, but for the token's idf."""
    return count * (K1 + 1) / (count + K1 * (1 - B + B * length / max(mean, 1)))


class Index:
    """A BM25 inverted index over the documents of one shard: postings by token, with the weight that each adds."""

    def __init__(self, terms: list[tuple[np.ndarray, np.ndarray]], lengths: list[int], idf: np.ndarray, mean: float):
        row = np.repeat(np.arange(len(terms)), [len(c[0]) for c in terms])
        token = np.concatenate([c[0] for c in terms]).astype(np.int64)
        weight = idf[token] * weights(np.concatenate([c[1] for c in terms]), np.array(lengths)[row], mean)
        order = np.argsort(token, kind="stable")
        self.rows, self.weights = row[order], weight[order]
        self.known, self.first = np.unique(token[order], return_index=True)
        self.ends = np.append(self.first[1:], len(token))
        self.terms, self.size = terms, len(terms)

    def scores(self, row: int) -> np.ndarray:
        """BM25 of all documents for all different tokens of one of them."""
        spans = np.searchsorted(self.known, self.terms[row][0])
        first, n = self.first[spans], self.ends[spans] - self.first[spans]
        at = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
        return np.bincount(self.rows[at], self.weights[at], self.size)


def fill(tails: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW, terms: list[tuple[np.ndarray, np.ndarray]] | None = None, lengths: list[int] | None = None) -> list[list[tuple[int, int, int]]]:
    """Windows of ``(row, start, length)`` pieces that hold every token of ``tails`` once.

    The first row with tokens left is the seed of a window. Rows with tokens left are taken by their BM25 score for the
    seed, best first, ties to the first row, until the window is full; the last one is cut, and what is left of it
    stays to be found by later seeds. So every window but the last is full. ``terms`` and ``lengths`` are those of the whole
    documents whose last parts the tails are; without them a tail is a document.
    """
    left = np.array([len(t) for t in tails])
    taken = np.zeros(len(tails), np.int64)
    terms, lengths = terms or [np.unique(t, return_counts=True) for t in tails], lengths or left.tolist()

    def indexed(rows: np.ndarray) -> Index:
        return Index([terms[r] for r in rows], [lengths[r] for r in rows], idf, mean)

    rows = np.arange(len(tails))
    index, out = indexed(rows), []
    for seed in range(len(tails)):
        while left[seed]:
            pieces, room = [], window

            def take(row: int) -> None:
                nonlocal room
                n = min(room, int(left[row]))
                pieces.append((row, int(taken[row]), n))
                taken[row] += n
                left[row] -= n
                room -= n

            take(seed)
            unused = np.flatnonzero(left)
            if room and len(unused):
                if 2 * len(unused) < len(rows):  # what is used up needs no postings
                    rows = np.union1d(unused, [seed])
                    index = indexed(rows)
                elif not left[seed] and rows[min(np.searchsorted(rows, seed), len(rows) - 1)] != seed:
                    rows = np.union1d(unused, [seed])
                    index = indexed(rows)
                scores = index.scores(int(np.searchsorted(rows, seed)))[np.searchsorted(rows, unused)]
                while room and len(unused):
                    # the best few at a time: a window seldom needs more
                    few = min(len(unused), 16)
                    best = np.argpartition(-scores, few - 1)[:few]
                    least = scores[best].min()
                    best = np.flatnonzero(scores >= least)
                    best = best[np.lexsort((best, -scores[best]))]
                    for k in best:
                        if room:
                            take(int(unused[k]))
                    rest = np.ones(len(unused), bool)
                    rest[best] = False
                    unused, scores = unused[rest], scores[rest]
            out.append(pieces)
    return out


def _packed(idf: np.ndarray, mean: float, window: int, shard_rows: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    types = [pa.int64()] * len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 36
        held: list[dict] = []
        size = 0

        def shard() -> pa.RecordBatch:
            nonlocal number
            out = []
            for r in held:
                for k, crc in enumerate(r["full"]):
                    out.append((r["doc_id"], k * window, window, crc, r["doc_tokens"], number, 0))
                    number += 1
            tails = [np.frombuffer(r["tail"], "<u4") for r in held]
            for pieces in fill(tails, idf, mean, window, [counted(r["tail"], r["terms"]) for r in held], [r["doc_tokens"] for r in held]):
                at = 0
                for row, start, n in pieces:
                    r = held[row]
                    out.append((r["doc_id"], r["doc_tokens"] - len(tails[row]) + start, n, zlib.crc32(tails[row][start : start + n].tobytes()), r["doc_tokens"], number, at))
                    at += n
                number += 1
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)

        for batch in batches:
            for r in batch.select(["doc_id", "doc_tokens", "full", "tail", "terms"]).to_pylist():
                held.append(r)
                size += len(r["tail"]) + len(r["terms"] or b"")
                if len(held) >= shard_rows or size >= SHARD_BYTES:
                    yield shard()
                    held, size = [], 0
        if held:
            yield shard()

    return run


def dealt(docs: DataFrame, path: str | None = None, window: int = WINDOW, end: int = END, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, np.ndarray, float]:
    """The rows as tokens, in an order in which those of like content stand together, the idf of each token and the mean
    length: what shards are cut from."""
    spark = docs.sparkSession
    docs = columns(docs, doc_id="long", text="string")
    n, path = docs.count(), path or vocabulary()
    some = docs.select("text").sample(min(1.0, SAMPLE / n), 7).limit(2 * SAMPLE) if n > shard_rows else docs.select("text").limit(0)
    encoded = some.mapInArrow(_ids(path), "ids binary").toArrow().column("ids").to_pylist()
    places = spark.sparkContext.broadcast(Places([np.frombuffer(x, "<u4") for x in encoded if x], n, shard_rows))
    kind = "doc_id long, doc_tokens long, full array<long>, tail binary, terms binary, cell long, bits long"
    rows = stored(docs.mapInArrow(_tokenized(path, window, end, places), kind).withColumn("row", F.monotonically_increasing_id()), "tokens")
    found = rows.where("doc_tokens < 0").select("terms").mapInArrow(_frequencies, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    rows = rows.where("doc_tokens >= 0")
    mean = rows.agg(F.avg("doc_tokens")).first()[0] or 0.0
    seen = np.zeros(int(found["token"].max()) + 1 if len(found) else 1)
    seen[found["token"].to_numpy(np.int64)] = found["n"].to_numpy()
    order = ["cell", "bits", "row"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order), idf_of(seen, n), mean


def _ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([np.array(encode(t or ""), "<u4").tobytes() for t in batch.column("text").to_pylist()], pa.binary())], ["ids"])

    return run


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end: int = END, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``: the pieces of all rows of
    ``docs(doc_id, text)``, in sequences of ``window`` tokens.

    A document is its tokens, then ``end``. Its full windows are sequences of their own; its tail is packed with others. The
    BM25 index holds the tokens of whole documents, a seed asks with all of its own, and document frequencies and the mean
    length are those of the corpus. The index is cut into shards of at most ``shard_rows`` rows: rows are sorted by
    content (the cell of a kd-tree over sketches of their BM25 weights, both fitted to some SAMPLE of them, then the bits of
    their sketch), so a seed's neighbours stand in its shard, and copies, however many, fill as many shards as they need. In
    a shard, :func:`fill` has unused neighbours fill each seed's window. All sequences but one a shard are full.

    Null text counts as empty (one token); null ids pass through; rows that repeat are packed one by one; an empty
    table gives no rows. The driver gets the document frequencies, a number for each id of the vocabulary, and the sample.
    """
    rows, idf, mean = dealt(docs, path, window, end, shard_rows)
    return rows.mapInArrow(_packed(idf, mean, window, shard_rows), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
