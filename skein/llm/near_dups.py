"""Near duplicates: banded MinHash candidates, sequential Bayesian pruning, exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import buffers, carried, carry, columns, discard, mix, shingles, slices, stored, table, words
from .components import components

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
BATCH = 32
#: Rows of a bucket's block, on average.
BLOCK_ROWS = 1024
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = (_SEEDS >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_MASKS = (_SEEDS & np.uint64(0xFFFFFFFF)).astype(np.uint32)
SHINGLES_AT_ONCE = 1 << 12


def signature(items: np.ndarray) -> np.ndarray:
    """The ``HASHES`` minima of a set of 64-bit hashes."""
    low = (items >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), SHINGLES_AT_ONCE):
        np.minimum(out, ((low[k : k + SHINGLES_AT_ONCE, None] ^ _MASKS) * _FACTORS).min(axis=0), out=out)
    return out


def least_matches(similarity: float, miss: float) -> list[tuple[int, int]]:
    """For 32, 64, ... compared hashes, the fewest equal ones with which similarity ``similarity`` or more keeps a posterior probability of ``miss`` or more.

    With a uniform prior the posterior after m of n is Beta(m + 1, n - m + 1), and its upper tail at s is the
    chance that a binomial of n + 1 trials at s is at most m.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        out.append((n, m))
    return out


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole)):
            hashes, at = words(batch.column("text"))
            n, high, low, signatures = [], [], [], []
            for a, b in zip(at[:-1], at[1:], strict=True):
                own = np.unique(shingles(hashes[a:b], size))
                digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                n.append(len(own))
                high.append(int.from_bytes(digest[:8], "little", signed=True))
                low.append(int.from_bytes(digest[8:], "little", signed=True))
                signatures.append(signature(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(signatures, pa.binary())], ["doc_id", "n_shingles", "high", "low", "signature"]).append_column("text_hash", batch.column("text_hash"))

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        rows = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
        keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2])
        for k in range(ROWS):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
        ids = np.repeat(batch.column("rep").to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)], ["band", "rep"])


def _prune(limits: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sa", "sb"))
            left, same = np.arange(len(batch)), np.zeros(len(batch), np.int64)
            for n, least in limits:
                same[left] += (x[left, n - BATCH : n] == y[left, n - BATCH : n]).sum(axis=1)
                left = left[same[left] >= least]
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(left)), batch.column("b").take(pa.array(left))], ["a", "b"])

    return run


def _word_lists(texts: pa.Array) -> Iterator[list[bytes]]:
    data, at = buffers(texts)
    for a, b in zip(at[:-1], at[1:], strict=True):
        # bytes.split() parts at \x09-\x0D and \x20, bytes.lower() lowers A-Z alone
        yield data[a:b].tobytes().lower().split()


def shingle_set(found: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    if not found:
        return set()
    return set(zip(*(found[k:] for k in range(min(size, len(found)))), strict=False))


def _verify(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(_word_lists(batch.column("ta")), _word_lists(batch.column("tb")), strict=True):
                x, y = shingle_set(x, size), shingle_set(y, size)
                both = len(x & y)
                good.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            keep = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)], ["a", "b"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each ``block``, of batches sorted by it; only the block under way is held over."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column("block").to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and len(batch) and held[-1].column("block")[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        for x, y in zip(np.append(0, cuts), np.append(cuts, len(batch)), strict=True):
            if y > x:
                held.append(batch.slice(x, y - x))
                if y < len(batch):
                    yield pa.Table.from_batches(held)
                    held = []
    if held:
        yield pa.Table.from_batches(held)


def _open_pairs(rows: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block that a link may join: of different components, of sizes that allow it, and of both sides where it has two."""
    n, side, component, rep = (rows.column(c).to_numpy() for c in ("n_shingles", "side", "component", "rep"))
    one = side.min() == side.max() and rows.column("single")[0].as_py()
    x, y = np.triu_indices(len(rep), 1) if one else (np.repeat(np.flatnonzero(side == side.min()), (side != side.min()).sum()), np.tile(np.flatnonzero(side != side.min()), (side == side.min()).sum()))
    keep = (component[x] != component[y]) & (rep[x] != rep[y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
    return x[keep], y[keep]


def _survivors(limits: list[tuple[int, int]], percent: int):
    """Of each block the rows that keep a partner after the sequential test."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            x, y = _open_pairs(rows, percent)
            signs = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
            same = np.zeros(len(x), np.int64)
            for n, least in limits:
                for k in range(0, len(x), 1 << 16):
                    cut = slice(k, k + (1 << 16))
                    same[cut] += (signs[x[cut], n - BATCH : n] == signs[y[cut], n - BATCH : n]).sum(axis=1)
                keep = same >= least
                x, y, same = x[keep], y[keep], same[keep]
            if len(x):
                yield from rows.drop_columns("signature").take(pa.array(np.unique(np.concatenate([x, y])))).combine_chunks().to_batches()

    return run


def _hashed_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole)):
            hashes, at = words(batch.column("text"))
            found = [np.unique(shingles(hashes[a:b], size)).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["rep", "items"])

    return run


def _links(percent: int):
    """Links of each block by the size of the intersection of its rows' sets of shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            x, y = _open_pairs(rows, percent)
            sets = [np.frombuffer(v, np.uint64) for v in rows.column("items").to_pylist()]
            sizes = np.array([len(v) for v in sets])
            universe, place = np.unique(np.concatenate(sets), return_inverse=True)
            ends = np.cumsum(sizes)
            places = [place[e - n : e] for e, n in zip(ends, sizes, strict=True)]
            a, b = [], []
            held = np.zeros(len(universe), bool)
            firsts, starts = np.unique(x, return_index=True)  # x ascends
            for k, others in zip(firsts, np.split(y, starts[1:]), strict=True):
                held[places[k]] = True
                for other in others:
                    both = np.count_nonzero(held[places[other]])
                    if 100 * both >= percent * (sizes[k] + sizes[other] - both):
                        a.append(k)
                        b.append(other)
                held[places[k]] = False
            if a:
                reps = rows.column("rep").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(reps[a], reps[b])), pa.array(np.maximum(reps[a], reps[b]))], ["a", "b"])

    return run


def _one_text(sets: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets and texts with one of each for every doc_id, and all rows with the set that their doc_id has."""
    own = F.struct("high", "low", "text_hash", "n_shingles")
    several = sets.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(own).alias("c"), F.max(own).alias("d")).where("c <> d")
    several = stored(several.select(F.col("doc_id").alias("id"), "c"), "several")
    if several.isEmpty():
        return sets, docs, sets
    own_text = lambda df: df.join(several, df["doc_id"] == several["id"], "left").where("id IS NULL OR text_hash = c.text_hash").drop("id", "c")
    told = sets.join(several, sets["doc_id"] == several["id"], "left")
    told = told.select("doc_id", *[F.coalesce(f"c.{n}", n).alias(n) for n in ("n_shingles", "high", "low")])
    return own_text(sets), own_text(docs), told


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``.

    A document's set holds the distinct runs of ``size`` words (A-Z lowered, parted at ASCII white space); shorter
    documents count as one run, those without words or text have an empty set and no link. Documents are linked when
    100 * intersection >= percent * union; a component is named by its smallest doc_id and keeps that document.

    Equal sets become one node first, so a hot group of copies costs one node. A bucket of equal bands compares its
    members with its smallest one; the components found so far then leave only pairs across components in a bucket.
    Those are compared too, so no link that joins two components is skipped: a bucket is dealt to blocks of bounded
    size, each pair of blocks is compared within one task, and rows leave it for links alone. Pairs whose posterior
    chance of the wanted similarity falls under ``miss`` are pruned batch by batch; the rest are verified on their
    sets, and links on the texts' own words. A pair at 0.8 shares no band with probability 3e-6.

    Rows with the same doc_id count as one document: if their sets differ, that of the least digest is its set, and the
    text that of the least hash. A row without doc_id links nothing, has no component and is kept; an empty table gives
    no rows.
    """
    docs = columns(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    whole_rows = stored(docs.mapInArrow(_sets(size), "doc_id long, n_shingles long, high long, low long, signature binary, text_hash long"), "sets")
    sets, docs, told = _one_text(whole_rows, docs)
    # aggregates that are joined back are tables of their own, so adaptive execution can split the rows of a hot key
    classes = stored(sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("high", "low").agg(F.min("doc_id").alias("rep")), "classes")
    reps = sets.join(classes.select(F.col("rep").alias("doc_id"), "high", "low"), ["doc_id", "high", "low"], "left_semi").select(F.col("doc_id").alias("rep"), "n_shingles", "signature").dropDuplicates(["rep"])
    reps = stored(reps, "reps")
    bands = reps.mapInArrow(_bands, "band long, rep long")
    shared = stored(bands.groupBy("band").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1").select("band", "head"), "shared")
    buckets = stored(bands.join(shared, "band"), "buckets")
    involved = buckets.select(F.col("rep").alias("doc_id")).distinct()
    texts = stored(docs.join(involved, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
    limits = least_matches(percent / 100, miss)

    def confirmed(pairs: DataFrame) -> DataFrame:
        read = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        return stored(read.select("a", "b", "ta", "tb").mapInArrow(_verify(size, percent), "a long, b long"), "confirmed")

    pairs = buckets.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct()
    signed = pairs.join(reps.select(F.col("rep").alias("a"), F.col("signature").alias("sa")), "a").join(reps.select(F.col("rep").alias("b"), F.col("signature").alias("sb")), "b")
    first = confirmed(stored(signed.select("a", "b", "sa", "sb").mapInArrow(_prune(limits), "a long, b long"), "likely"))
    found = components(first)
    named = stored(buckets.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("band", "rep", F.coalesce("component", "rep").alias("component")), "named")
    mixed = named.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).where("x < y").select("band", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks"))
    mixed = stored(mixed, "mixed")
    side = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    dealt = named.join(mixed, "band").withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select(F.xxhash64("band", F.least("side", "other"), F.greatest("side", "other")).alias("block"), "rep", "component", "side", (F.col("side") == F.col("other")).alias("single"))
    kind = "block long, rep long, component long, side long, single boolean, n_shingles long"
    likely = stored(dealt.join(reps, "rep").select(*(x.split()[0] for x in kind.split(", ")), "signature").repartition("block").sortWithinPartitions("block").mapInArrow(_survivors(limits, percent), kind), "likely")
    sets_of = texts.join(likely.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").mapInArrow(_hashed_sets(size), "rep long, items binary")
    linked = likely.join(sets_of, "rep").repartition("block").sortWithinPartitions("block").mapInArrow(_links(percent), "a long, b long")
    second = confirmed(stored(linked.distinct(), "links"))
    discard(named)
    # round two joins whole components: its ends are renamed to what round one found
    ends = second.join(found.select(F.col("node").alias("a"), F.col("component").alias("x")), "a", "left").join(found.select(F.col("node").alias("b"), F.col("component").alias("y")), "b", "left")
    merged = components(ends.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")))
    whole = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("node", F.coalesce("component", "rep")).drop("component")
    whole = stored(whole.join(merged, "node", "left").select("high", "low", F.coalesce("component", "node").alias("component_id")), "whole")
    out = told.select("doc_id", "n_shingles", "high", "low").join(whole, ["high", "low"], "left")
    group = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", group.alias("component_id"), F.coalesce(F.col("doc_id") == group, F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are the first of their group of near duplicates; rows without
    doc_id are in no group, and of rows with the same doc_id one stays."""
    kept = near_duplicates(docs, size, percent).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    own = carry(docs, doc_id="long")
    first = own.join(kept, "doc_id", "left_semi")
    first = first.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64(*own.columns)))).where("place = 1").drop("place")
    return carried(first.union(own.where("doc_id IS NULL")), docs)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=2)


ORACLE = {
    "op3_near_duplicates": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w), 2))) AS i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(reach.other) AS component_id, d.doc_id = min(reach.other) AS kept
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id
""",
}
