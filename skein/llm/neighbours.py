"""Approximate nearest neighbours: stable projections to few dimensions, indexed by a kd-tree, with a chi-square stop.

Largest inner product becomes least distance when every vector gets one more coordinate that brings it to the largest
norm R: |q' - x'|^2 = |q|^2 + R^2 - 2 q.x. Gaussian projections to m dimensions are 2-stable: the squared
projected distance over the squared distance follows a chi-square law with m degrees of freedom.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import columns, discard, stored, table

NEIGHBOURS, EVERY = 20, 20
PROJECTED = 16
#: Chance, for each true neighbour, that the stopping test has not given it up.
CONFIDENCE = 0.85
#: Vectors of a cell on average, of a block of a cell and queries of a block at most; vectors to which the tree of cells is
#: fitted, and those of them in a cell at least; cells that a query visits first, and by how much that grows a round.
CELL_ROWS, BLOCK_ROWS, QUERY_ROWS = 8192, 8192, 2048
SAMPLE, SAMPLE_CELL = 16_384, 16
FIRST, WIDER = 4, 4
#: Distances up to which projected neighbours are verified at once, as shares of that where the test ends at the latest; pairs
#: of queries and vectors worked on together; and the relative error that sums of products are taken to have at most.
SHARES, PAIRS_AT_ONCE, ROUNDING = (0.25, 0.5, 1.0), 1 << 20, 1e-13


def chi_square_quantile(p: float, m: int) -> float:
    """Of the chi-square law with an even number ``m`` of degrees of freedom."""

    def cdf(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))

    low, high = 0.0, 1.0
    while cdf(high) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


def projected(vectors: np.ndarray, longest: float, query: bool = False, m: int = PROJECTED) -> np.ndarray:
    """Vectors with the coordinate that lifts them to the norm ``longest`` (queries: with 0), projected to ``m`` dimensions."""
    matrix = np.random.default_rng(20).normal(size=(vectors.shape[1] + 1, m))
    lift = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
    return np.column_stack([vectors, lift]) @ matrix


class Tree:
    """A kd-tree: every node is split along its widest side, in the shares of the cells below, until ``count`` cells are made."""

    def __init__(self, points: np.ndarray, count: int):
        self.cells: list[np.ndarray] = []
        self.nodes: list[tuple[int, float, int, int]] = []  # axis, value, and what is below and from it on: a node or -1 - cell
        self.root = self._grow(points, np.arange(len(points)), max(count, 1))

    def _grow(self, points: np.ndarray, own: np.ndarray, count: int) -> int:
        if count == 1 or len(own) < 2:
            self.cells.append(own)
            return -len(self.cells)
        axis = int(np.ptp(points[own], axis=0).argmax())
        cut = min(max(len(own) * (count // 2) // count, 1), len(own) - 1)
        order = np.argpartition(points[own, axis], cut)
        value = float(points[own[order[cut]], axis])
        low = points[own, axis] < value
        if not low.any():  # all the same from the least on
            self.cells.append(own)
            return -len(self.cells)
        at = len(self.nodes)
        self.nodes.append((axis, value, 0, 0))
        below, above = self._grow(points, own[low], count // 2), self._grow(points, own[~low], count - count // 2)
        self.nodes[at] = (axis, value, below, above)
        return at

    def place(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        out = np.zeros(len(points), np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, own = todo.pop()
            if node < 0:
                out[own] = -1 - node
                continue
            axis, value, below, above = self.nodes[node]
            low = points[own, axis] < value
            todo += [(n, x) for n, x in ((below, own[low]), (above, own[~low])) if len(x)]
        return out


def box_distances(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least squared distance from each query to each box."""
    out = np.zeros((len(queries), len(low)))
    for k in range(queries.shape[1]):
        out += np.maximum(0, np.maximum(low[:, k] - queries[:, k, None], queries[:, k, None] - high[:, k])) ** 2
    return out


def search(queries: np.ndarray, far: np.ndarray, vectors: np.ndarray, ids: list[np.ndarray], longest: float, k: int = NEIGHBOURS, confidence: float = CONFIDENCE) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """``(query, vectors, scores, verified)``: for each query the found ones of different ``vectors`` and how many were verified.

    ``ids`` are the ids under which each vector stands; k + 1 of them are sought, so that k are left when one, the
    query's own, doesn't count. ``far`` is the squared distance within which the query has them elsewhere. A query's
    projected neighbours are verified one batch after the other, nearest first, on the original coordinates; it ends when
    the next one is so far that a vector nearer than the k + 1st id so far would be beyond it with a chance of
    1 - ``confidence`` at most. Alike queries, out of a cell of a kd-tree of them, are worked on together: one matrix product
    gives their projected distances, another the products with all vectors that the test may leave one of them.
    """
    points, asked = projected(vectors, longest), projected(queries, longest, query=True)
    lengths, asked_lengths, n = (points**2).sum(axis=1), (asked**2).sum(axis=1), len(points)
    limit, repeated = chi_square_quantile(confidence, PROJECTED), sum(map(len, ids)) > len(np.unique(np.concatenate(ids)))
    at_once = max(1, PAIRS_AT_ONCE // n)

    def reach(norm: float, found: np.ndarray, scores: np.ndarray) -> float:
        """Squared distance within which k + 1 ids are found."""
        if not repeated:
            return norm - 2 * np.partition(scores, -k - 1)[-k - 1] if len(scores) > k else np.inf
        seen: set[int] = set()
        for at in np.argsort(-scores, kind="stable"):
            seen.update(ids[found[at]].tolist())
            if len(seen) > k:
                return norm - 2 * scores[at]
        return np.inf

    alike = Tree(asked, -(-len(asked) // at_once)).cells
    for rows in (own[c : c + at_once] for own in alike for c in range(0, len(own), at_once)):
        q, norms, near = queries[rows], (queries[rows] ** 2).sum(axis=1) + longest**2, far[rows].copy()
        # less what rounding may have added, so that none is taken to be farther than it is
        apart = (asked_lengths[rows, None] + lengths) - 2 * (asked[rows] @ points.T) - ROUNDING * (asked_lengths[rows, None] + lengths.max())
        blind = np.flatnonzero(~np.isfinite(near))
        if len(blind):
            first = np.argpartition(apart[blind], min(2 * (k + 1), n) - 1, axis=1)[:, : 2 * (k + 1)]
            for j, own, scores in zip(blind.tolist(), first, np.einsum("rkd,rd->rk", vectors[first], q[blind]), strict=True):
                near[j] = reach(norms[j], own, scores)
                apart[j, own] = -np.inf
        ends = limit * np.maximum(near, ROUNDING * norms)
        open_ = np.flatnonzero((apart < ends[:, None]).any(axis=0))
        apart, products = apart[:, open_], q @ vectors[open_].T
        for r, own, scores, norm, within, end in zip(rows.tolist(), apart, products, norms.tolist(), near.tolist(), ends.tolist(), strict=True):
            for share in SHARES:
                to = share * end
                seen = own < to
                good = np.flatnonzero(seen & (scores >= (norm - within) / 2 - ROUNDING * norm))
                within = min(within, reach(norm, open_[good], scores[good]))
                if to >= limit * within:
                    break
            good = good[norm - 2 * scores[good] <= within + 1e-9 * (1 + abs(within)) + ROUNDING * norm]
            found = open_[good]
            yield r, found, (vectors[found] * queries[r]).sum(axis=1), int(np.count_nonzero(seen))


class Index:
    """Of the vectors of one length: the largest norm, the tree of cells, their boxes in the projected space and their blocks."""

    def __init__(self, longest: float, tree: Tree):
        self.longest, self.tree = longest, tree

    def close(self, cells: dict[int, tuple[np.ndarray, np.ndarray, int]]) -> None:
        self.numbers = np.array(sorted(cells), np.int64)
        self.low, self.high = (np.array([cells[c][k] for c in sorted(cells)]) for k in (0, 1))
        self.blocks = {c: -(-cells[c][2] // BLOCK_ROWS) for c in cells}


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _by_dims(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    dims = batch.column("dims").to_numpy()
    for d in np.unique(dims).tolist():
        own = np.flatnonzero(dims == d)
        yield d, own, _matrix(batch.column("embedding").take(pa.array(own)), d)


def _boxes(index):
    names = ["dims", "cell", "n", *(f"{s}{k}" for s in "lh" for k in range(PROJECTED))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for d, _, x in _by_dims(batch):
                points = projected(x, index.value[d].longest)
                cells = index.value[d].tree.place(points)
                for c in np.unique(cells).tolist():
                    own = points[cells == c]
                    n, low, high = held.get((d, c), (0, np.inf, -np.inf))
                    held[d, c] = [n + len(own), np.minimum(low, own.min(axis=0)), np.maximum(high, own.max(axis=0))]
        rows = [(d, c, n, *low, *high) for (d, c), (n, low, high) in held.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64() if k < 3 else pa.float64()) for k in range(len(names))], names)

    return run, "dims long, cell long, n long, " + ", ".join(f"{n} double" for n in names[3:])


def _celled(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros(len(batch), np.int64)
            for d, own, x in _by_dims(batch):
                cells[own] = index.value[d].tree.place(projected(x, index.value[d].longest))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], [*batch.schema.names, "cell"])

    return run


def _routed(index, first: int, last: int, limit: float):
    """For each query the blocks of its nearest cells, from the ``first`` to the ``last``, that its stopping test leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cells, blocks = [], [], []
            far = batch.column("far").to_numpy(zero_copy_only=False)
            for d, own, x in _by_dims(batch):
                i = index.value[d]
                away = box_distances(projected(x, i.longest, query=True), i.low, i.high)
                for k, r in enumerate(own.tolist()):
                    for c in np.argsort(away[k], kind="stable")[first:last]:
                        if away[k, c] < limit * far[r]:
                            cell = int(i.numbers[c])
                            rows += [r] * i.blocks[cell]
                            cells += [cell] * i.blocks[cell]
                            blocks += range(i.blocks[cell])
            if rows:
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(rows)) for c in ("qid", "dims", "embedding", "far")), pa.array(cells, pa.int64()), pa.array(blocks, pa.int64())], ["qid", "dims", "embedding", "far", "cell", "block"])

    return run


def nearest(vectors: DataFrame, every: int = EVERY, k: int = NEIGHBOURS, confidence: float = CONFIDENCE) -> DataFrame:
    """``(query_id, rank, vec_id, score, n_verified)``: for each row of ``vectors(vec_id, embedding)`` whose id is divisible
    by ``every``, its ``k`` nearest found by inner product among all rows but those with its own id, and how many different
    vectors were verified on their original coordinates.

    Equal vectors are one point, of which the k + 1 smallest ids are kept, each with its rows, k at most: whichever id
    asks, the k first others are among them. Points are dealt to cells of a kd-tree in the projected space, which is fitted
    to some SAMPLE of them; the cells' boxes cover all. A query visits its nearest cells first, then four times as many a
    round, as long as the chi-square test leaves one that may hold a nearer neighbour; in a cell (:func:`search`) its
    projected neighbours are verified, nearest first, until the test holds. Cells are worked on in blocks of bounded size, and so are
    the queries of a cell; equal queries are searched once. The driver gets the sample and two rows for each cell.

    Null ids, and vectors that are null, empty, zero or hold a null or a number that is not finite take no part; vectors of
    different length are not compared; of a repeated id every row is a candidate and the least vector asks; ties go to the
    smaller id; no query gives no rows.
    """
    spark = vectors.sparkSession
    own = columns(vectors, vec_id="long", embedding="array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    own = own.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", fine) & F.exists("embedding", lambda x: x != 0))
    own = own.withColumn("embedding", F.transform("embedding", lambda x: x + 0.0)).withColumn("a", F.xxhash64("embedding")).withColumn("b", F.xxhash64(F.lit(1), "embedding"))
    same = own.groupBy("a", "b", "vec_id").agg(F.least(F.count("*"), F.lit(k)).alias("n"), F.any_value("embedding").alias("embedding"))
    same = same.withColumn("r", F.row_number().over(Window.partitionBy("a", "b").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    points = same.groupBy("a", "b").agg(F.any_value("embedding").alias("embedding"), F.collect_list(F.struct("vec_id", "n")).alias("ids"))
    points = stored(points.select("embedding", F.size("embedding").alias("dims"), "ids", F.col("a").alias("salt")), "points")
    asking = own.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("a", F.xxhash64("embedding")).withColumn("b", F.xxhash64(F.lit(1), "embedding"))
    queries = asking.groupBy("a", "b").agg(F.any_value("embedding").alias("embedding"))
    queries = stored(queries.select("a", "b", F.monotonically_increasing_id().alias("qid"), F.size("embedding").alias("dims"), "embedding"), "queries")
    askers = stored(asking.select(F.col("vec_id").alias("query_id"), "a", "b").join(queries.select("a", "b", "qid"), ["a", "b"]).select("query_id", "qid"), "askers")

    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    sizes = points.join(queries.select("dims").distinct(), "dims", "left_semi").groupBy("dims").agg(F.count("*").alias("n"), F.sqrt(F.max(norm)).alias("longest")).collect()  # a row for each length of vectors
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, n_verified long")
    total = sum(r["n"] for r in sizes)
    points = points.where(F.col("dims").isin([r["dims"] for r in sizes]))
    share = points.where(F.pmod(F.xxhash64(F.lit(2), "salt"), F.lit(1 << 40)) < int(min(1.0, SAMPLE / total) * (1 << 40))) if total > CELL_ROWS else points.where("false")
    sample = share.select("dims", "embedding").toArrow()
    index = {}
    for r in sizes:
        seen = sample.filter(pc.equal(sample.column("dims"), r["dims"])).column("embedding")
        seen = projected(seen.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, r["dims"]), r["longest"])
        index[r["dims"]] = Index(r["longest"], Tree(seen, min(-(-r["n"] // CELL_ROWS), len(seen) // SAMPLE_CELL)))
    run, kind = _boxes(spark.sparkContext.broadcast(index))
    sides = [f"{s}{j}" for s in "lh" for j in range(PROJECTED)]
    boxes = points.select("dims", "embedding").mapInArrow(run, kind).groupBy("dims", "cell").agg(F.sum("n").alias("n"), *[(F.min if s[0] == "l" else F.max)(s).alias(s) for s in sides]).collect()
    for d, i in index.items():
        i.close({r["cell"]: (*(np.array([r[f"{s}{j}"] for j in range(PROJECTED)]) for s in "lh"), r["n"]) for r in boxes if r["dims"] == d})
    shared = spark.sparkContext.broadcast(index)
    most, limit = max(len(i.numbers) for i in index.values()), chi_square_quantile(confidence, PROJECTED)
    norms = F.create_map(*[x for d, i in index.items() for x in (F.lit(d), F.lit(float(i.longest**2)))])

    counts = spark.createDataFrame([(d, c, n) for d, i in index.items() for c, n in i.blocks.items()], "dims int, cell long, blocks long")
    celled = points.mapInArrow(_celled(shared), "embedding array<double>, dims int, ids array<struct<vec_id: long, n: long>>, salt long, cell long")
    celled = celled.join(F.broadcast(counts), ["dims", "cell"]).withColumn("block", F.pmod("salt", "blocks"))  # a row for each cell

    best, first, last = None, 0, FIRST
    while first < most:
        open_ = queries.withColumn("far", F.lit(float("inf"))) if best is None else queries.join(_reach(best, k), "qid", "left").withColumn("far", F.coalesce(norm + norms[F.col("dims")] - 2 * F.col("kth"), F.lit(float("inf"))))
        asks = stored(open_.select("qid", "dims", "embedding", "far").mapInArrow(_routed(shared, first, last, limit), "qid long, dims int, embedding array<double>, far double, cell long, block long"), "asks")
        per_cell = asks.groupBy("dims", "cell", "block").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("asking"))
        per_cell = stored(per_cell, "asking")
        side = F.pmod(F.xxhash64("qid"), "asking").alias("side")
        left = asks.join(per_cell, ["dims", "cell", "block"]).select("dims", "cell", "block", side, "qid", "embedding", "far")
        right = celled.join(per_cell, ["dims", "cell", "block"]).withColumn("side", F.explode(F.sequence(F.lit(0).cast("long"), F.col("asking") - 1))).select("dims", "cell", "block", "side", "embedding", "ids")
        key = ["dims", "cell", "block", "side"]
        found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_verified({d: i.longest for d, i in index.items()}, k, confidence), "qid long, vec_id long, n long, score double, verified long")
        found = stored(found, "found")  # read three times below
        held = stored(_best(found if best is None else best.union(found), k), "best")
        discard(asks, per_cell, found, *([best] if best is not None else []))
        best, first, last = held, last, last + (last - first) * WIDER
    seen = best.groupBy("qid").agg(F.sum("verified").alias("n_verified"))
    rows = askers.join(best.where("vec_id IS NOT NULL"), "qid").where("vec_id <> query_id").select("query_id", "qid", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    out = rows.withColumn("rank", rank).where(F.col("rank") <= k)
    return out.join(seen, "qid").select("query_id", "rank", "vec_id", "score", "n_verified")


def _verified(longest: dict[int, float], k: int, confidence: float):
    def run(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(x):
            ids = [np.array([m["vec_id"] for m in own], np.int64) for own in x["ids"]]
            times = [[m["n"] for m in own] for own in x["ids"]]
            matrix = np.stack(x["embedding"].to_list()).astype(float)
            asked = np.stack(q["embedding"].to_list()).astype(float)
            qids = q["qid"].tolist()
            for r, found, scores, verified in search(asked, q["far"].to_numpy(float), matrix, ids, longest[int(x["dims"].iloc[0])], k, confidence):
                out.append((qids[r], None, None, None, verified))
                out += [(qids[r], int(i), int(n), float(s), 0) for f, s in zip(found, scores, strict=True) for i, n in zip(ids[f], times[f], strict=True)]
        frame = pd.DataFrame(out, columns=["qid", "vec_id", "n", "score", "verified"])
        return frame.astype({"qid": "int64", "vec_id": "Int64", "n": "Int64", "score": "Float64", "verified": "int64"})

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """Of each query the k + 1 ids with the best scores, k rows of each at most, and one row with the count of verified vectors."""
    rows = found.where("vec_id IS NOT NULL")
    ids = rows.groupBy("qid", "vec_id").agg(F.max("score").alias("top"))
    ids = ids.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("top"), "vec_id"))).where(F.col("r") <= k + 1).select("qid", "vec_id")
    rows = rows.join(ids, ["qid", "vec_id"], "left_semi").groupBy("qid", "vec_id", "score").agg(F.least(F.sum("n"), F.lit(k)).alias("n"))
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("qid", "vec_id").orderBy(F.desc("score")))).where(F.col("r") <= k)
    counted = found.groupBy("qid").agg(F.sum("verified").alias("verified"))
    none = [F.lit(None).cast(t) for t in ("long", "long", "double")]
    return rows.select("qid", "vec_id", "n", "score", F.lit(0).cast("long")).union(counted.select("qid", *none, "verified")).toDF("qid", "vec_id", "n", "score", "verified")


def _reach(best: DataFrame, k: int) -> DataFrame:
    """The score of the k + 1st id of each query that has so many."""
    tops = best.where("vec_id IS NOT NULL").groupBy("qid", "vec_id").agg(F.max("score").alias("top"))
    return tops.groupBy("qid").agg(F.min("top").alias("kth"), F.count("*").alias("many")).where(F.col("many") > k).select("qid", "kth")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
