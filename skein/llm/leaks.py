"""Benchmark decontamination: latent semantic retrieval of passages, then longest common subsequence and answer checks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, carry, columns, mix, slices, table, words

#: Hashed terms, dimensions of the latent space, further random directions, words of a passage that the space is fitted to, words of a step.
TERMS, RANK, MORE, PASSAGE, STEP = 4096, 48, 16, 32, 8
#: Share of the passages from which a term counts as common and says next to nothing.
COMMON = 0.02
#: Cosine in the latent space, then share of an item's TF-IDF weight on terms that the passage holds, from which it is a candidate.
COSINE, WEIGHT = 0.7, 0.45
#: Share of an item's words, in order, that make a leak if its answer is there too, and by itself; share of the answer.
PART, WHOLE, ANSWER = 0.6, 0.8, 0.5
ANSWER_WORDS = 8
#: Items of a block, and blocks that a task keeps ready.
ITEMS_AT_ONCE, BLOCKS_READY = 1024, 4
#: Hits among an item's rarest words from which a passage is looked at, whatever its cosine.
SURE = 4
ROWS_AT_ONCE, STEPS_AT_ONCE = 512, 1 << 13


def term(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> np.uint64(40)).astype(np.int64) % TERMS


def directions(seed: int = 8) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(TERMS, RANK + MORE)).astype(np.float32)


def parts(at: np.ndarray, size: int) -> np.ndarray:
    """First words of the runs of ``size`` words of each text, the last of a text shorter."""
    n = -(-np.diff(at) // size)
    first = np.repeat(at[:-1], n)
    return first + size * (np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n))


def padded(ids: np.ndarray, at: np.ndarray, size: int, filler: int) -> np.ndarray:
    """The ids of each text in rows of ``size``, its last row filled up with ``filler``."""
    n = -(-np.diff(at) // size)
    out = np.full(int(n.sum()) * size, filler, ids.dtype)
    out[np.repeat((np.cumsum(n) - n) * size - at[:-1], np.diff(at)) + np.arange(len(ids))] = ids
    return out.reshape(-1, size)


def sums(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Sums of ``rows[ids]`` over each row of ids; an id of ``len(rows)`` adds nothing."""
    rows = np.vstack([rows, np.zeros((1, rows.shape[1]), rows.dtype)])
    out = np.empty((len(ids), rows.shape[1]), rows.dtype)
    for k in range(0, len(ids), ROWS_AT_ONCE):
        own = ids[k : k + ROWS_AT_ONCE]
        total = rows[own[:, 0]]
        for j in range(1, ids.shape[1]):
            total += rows[own[:, j]]
        out[k : k + ROWS_AT_ONCE] = total
    return out


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each term the passages that hold it, and its row of T'(T G): T counts terms by passage, G are the random directions."""
    random = directions()
    held, holding, passages = np.zeros(random.shape), np.zeros(TERMS, np.int64), 0
    for batch in (x for whole in batches for x in slices(whole)):
        hashes, at = words(batch.column("text"))
        if not len(hashes):
            continue
        ids = term(hashes)
        own = padded(ids, at, PASSAGE, TERMS)
        seen = sums(random, own)
        ordered = np.sort(own, axis=1)
        new = np.ones(own.shape, bool)
        new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
        holding += np.bincount(ordered[new], minlength=TERMS + 1)[:TERMS]
        passages += len(own)
        of = np.repeat(np.arange(len(own)), (own < TERMS).sum(axis=1))
        order = np.argsort(ids.astype(np.uint16), kind="stable")
        ends = np.searchsorted(ids[order], np.arange(TERMS + 1))
        by_term = padded(of[order], ends, PASSAGE, len(seen))
        rows = -(-np.diff(ends) // PASSAGE)
        found = np.flatnonzero(rows)
        held[found] += np.add.reduceat(sums(seen, by_term), (np.cumsum(rows) - rows)[found], axis=0)
    names = ["term", "passages", "n", *(f"y{k}" for k in range(random.shape[1]))]
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS)), pa.array(np.full(TERMS, passages)), pa.array(holding), *(pa.array(np.ascontiguousarray(c)) for c in held.T)], names)


def latent(holding: np.ndarray, passages: int, product: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a word of each term adds to a passage's place in the latent space: idf times the right singular vectors of
    the TF-IDF matrix A = T D over its singular values, so a passage stands at its left singular vectors, in which no
    direction outweighs another. They come from the randomised sketch A'A (D^-1 G) = D T'T G by Nystrom's method. Also the idf."""
    idf = np.where(holding > COMMON * passages, 0.01, np.maximum(np.log((passages + 1) / (holding + 1)), 0.01))
    sketch = idf[:, None] * product
    core = (directions().astype(float) / idf[:, None]).T @ sketch
    core = (core + core.T) / 2
    values, vectors = np.linalg.eigh(core)
    good = values > max(values[-1], 0) * 1e-9
    if not good.any():
        return np.zeros((TERMS, RANK), np.float32), idf
    u, strength, _ = np.linalg.svd(sketch @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    u, strength = u[:, :RANK], strength[:RANK]
    out = np.zeros((TERMS, RANK), np.float32)
    out[:, : len(strength)] = idf[:, None] * u / np.maximum(strength, strength[0] * 1e-6)
    return out, idf


def common_subsequence(own: list, other: list) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    where: dict = {}
    for k, x in enumerate(own):
        where[x] = where.get(x, 0) | 1 << k
    full = (1 << len(own)) - 1
    row = full
    for x in other:
        if m := where.get(x, 0):
            both = row & m
            row = ((row + both) | (row - both)) & full
    return len(own) - row.bit_count()


class Items:
    """Items of a benchmark as word hashes; those without words are left out."""

    def __init__(self, ids: list, texts: list):
        hashes, at = words(pa.array(texts, pa.string()))
        self.ids = [i for i, a, b in zip(ids, at[:-1], at[1:], strict=True) if b > a]
        self.words = [hashes[a:b] for a, b in zip(at[:-1], at[1:], strict=True) if b > a]


class Benchmark:
    """Items ready to be looked for, grouped by how many steps of words hold them wherever they begin."""

    def __init__(self, items: Items, space: np.ndarray, idf: np.ndarray):
        self.ids, self.words = items.ids, items.words
        self.space, self.idf = space, idf
        self.listed = [own.tolist() for own in self.words]
        #: what each term of an item adds to its share of weight; the last column is that of a filler
        self.weight = np.zeros((len(self.words), TERMS + 1), np.float32)
        for row, own in zip(self.weight, self.words, strict=True):
            own = term(own)
            row[own] = idf[own] / idf[own].sum()
        self.by_steps: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k, own in enumerate(self.words):
            self.by_steps.setdefault(-(-(len(own) + STEP - 1) // STEP), []).append(k)
        for steps, rows in self.by_steps.items():
            x = np.array([space[term(self.words[k])].sum(axis=0) for k in rows])
            self.by_steps[steps] = (np.array(rows), (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32))

    def candidates(self, hashes: np.ndarray, at: np.ndarray, cosine: float, weight: float) -> Iterator[tuple[np.ndarray, ...]]:
        """Arrays of item, text, first word and number of words of the passages near an item, and the cosine."""
        starts = parts(at, STEP)
        terms = padded(term(hashes), at, STEP, TERMS)
        added = sums(self.space, terms)
        text = np.searchsorted(at, starts, "right") - 1
        for k in range(0, len(starts), STEPS_AT_ONCE):
            own = text[k : k + STEPS_AT_ONCE]
            x = np.zeros((len(own), self.space.shape[1]), np.float32)
            for steps in range(1, max(self.by_steps, default=0) + 1):
                more = added[k + steps - 1 : k + steps - 1 + len(own)]
                x[: len(more)] += more * (text[k + steps - 1 : k + steps - 1 + len(own)] == own[: len(more)])[:, None]
                if steps not in self.by_steps:
                    continue
                rows, near = self.by_steps[steps]
                length = np.sqrt(np.einsum("ij,ij->i", x, x))
                found = x @ near.T
                a, b = np.nonzero(found >= cosine * np.maximum(length, 1e-12)[:, None])
                near_by, item, a = found[a, b] / length[a], rows[b], a + k
                held = np.zeros(len(a), np.float32)
                for j in range(-1, steps + 1):
                    step = np.clip(a + j, 0, len(starts) - 1)
                    held += np.where(text[step] == text[a], self.weight[item[:, None], terms[step]].sum(axis=1), 0)
                keep = held >= weight
                item, a = item[keep], a[keep]
                yield item, text[a], starts[a], np.minimum(steps * STEP, at[text[a] + 1] - starts[a]), near_by[keep]

    def _rarest(self, part: float) -> tuple[np.ndarray, ...]:
        """Words, ascending, that are among the rarest of an item, where the items of each begin, the items, and the hits that an item needs."""
        word, item, least = [], [], np.zeros(len(self.words), np.int64)
        for k, own in enumerate(self.words):
            need = max(int(np.ceil(part * len(own) - 1e-9)), 1)
            least[k] = min(SURE, need)
            own = own[np.argsort(-self.idf[term(own)], kind="stable")][: len(own) - need + least[k]]
            word.append(np.unique(own))
            item.append(np.full(len(word[-1]), k))
        word, item = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((word, np.uint64), (item, np.int64)))
        order = np.argsort(word, kind="stable")
        found, first = np.unique(word[order], return_index=True)
        return found, np.append(first, len(word)), item[order], least

    def holding(self, hashes: np.ndarray, at: np.ndarray, part: float) -> Iterator[tuple[int, int, int, int, float]]:
        """Item, text, first word, number of words and cosine of every passage that, with a step on either side, holds
        ``part`` of an item's words: it lacks at most the rest, so of as many of the item's rarest words and SURE more
        it holds SURE. No passage that the checks could confirm fails this."""
        found, ends, items, least = self._rarest(part)
        if not len(found) or not len(hashes):
            return
        near = np.minimum(np.searchsorted(found, hashes), len(found) - 1)
        place = np.flatnonzero(found[near] == hashes)
        near = near[place]
        many = ends[near + 1] - ends[near]
        item = items[np.repeat(ends[near] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        text = np.searchsorted(at, place, "right") - 1
        n = -(-np.diff(at) // STEP)
        first = np.cumsum(n) - n
        starts = parts(at, STEP)
        step = np.repeat(first[text] + (place - at[text]) // STEP, many)
        text = np.repeat(text, many)
        steps = np.array([-(-(len(w) + STEP - 1) // STEP) for w in self.words])
        order = np.lexsort((step, text, item))
        item, text, step = item[order], text[order], step[order]
        # hits from one step to those that the longest passage with its two outer steps still covers
        wide = len(starts) + steps.max() + 3
        key = (item * len(n) + text) * wide + (step - first[text])
        # a word that an item has once may hit many times, so hits are an upper bound of the words held
        ahead = np.searchsorted(key, key + steps[item] + 2) - np.arange(len(key))
        good = np.flatnonzero(ahead >= least[item])
        good = good[np.flatnonzero(np.diff(key[good], prepend=-1))]
        done: set[tuple[int, int, int]] = set()
        for k in good.tolist():
            i, t, s = int(item[k]), int(text[k]), int(step[k])
            own = self.words[i]
            need = int(np.ceil(part * len(own) - 1e-9))
            low, high = max(s - int(steps[i]) - 1, int(first[t])), min(s + 2 * int(steps[i]) + 2, int(first[t] + n[t]))
            around = set(hashes[starts[low] : starts[high - 1] + STEP].tolist())
            if sum(w in around for w in self.listed[i]) < need:
                continue
            # passages whose outer steps begin at this hit, or earlier with it as their first hit
            for b in range(max(s - int(steps[i]), int(first[t])), min(s + 1, int(first[t] + n[t]) - 1) + 1):
                if (i, t, b) in done:
                    continue
                done.add((i, t, b))
                a = int(starts[b])
                size = int(min(steps[i] * STEP, at[t + 1] - a))
                other = hashes[max(a - STEP, at[t]) : min(a + size + STEP, at[t + 1])]
                if np.isin(own, other).sum() >= need:
                    x = self.space[term(hashes[a : a + size])].sum(axis=0)
                    y = self.space[term(own)].sum(axis=0)
                    yield i, t, a, size, float(x @ y / max(np.linalg.norm(x) * np.linalg.norm(y), 1e-12))

    def leaks(self, hashes: np.ndarray, at: np.ndarray, cosine: float = COSINE, weight: float = WEIGHT, part: float = PART, whole: float = WHOLE, answer: float = ANSWER) -> list[tuple[int, float, int, float]]:
        """``(text, share, item, cosine)`` of the candidates that the checks confirm."""
        out = []
        near_by = (row for found in self.candidates(hashes, at, cosine, weight) for row in zip(*(x.tolist() for x in found), strict=True))
        for rows in (near_by, self.holding(hashes, at, min(part, whole))):
            for item, text, start, n, near in rows:
                own = self.words[item].tolist()
                other = hashes[max(start - STEP, at[text]) : min(start + n + STEP, at[text + 1])].tolist()
                share = common_subsequence(own, other) / len(own)
                if share < part:
                    continue
                if share < whole:
                    said = own[-ANSWER_WORDS:]
                    if common_subsequence(said, other) < answer * len(said):
                        continue
                out.append((text, share, self.ids[item], near))
        return out


def _passing(blocks: list, space) -> Iterator[Benchmark]:
    """The blocks one after the other, none of them kept."""
    for block in blocks:
        yield Benchmark(block.value, *space.value)
        vars(block).pop("_value", None)  # read again from its file when the next texts need it


def _search(blocks: list, space, *limits: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Benchmark(b.value, *space.value) for b in blocks[:BLOCKS_READY]]
        for batch in (x for full in batches for x in slices(full)):
            hashes, at = words(batch.column("text"))
            hits: dict[int, dict] = {}
            for items in chain(ready, _passing(blocks[BLOCKS_READY:], space)) if len(hashes) else ():
                for text, share, item, near in items.leaks(hashes, at, *limits):
                    own = hits.setdefault(text, {})
                    own[item] = max(own.get(item, (0.0, 0.0)), (share, near))
            best = [(None, None, None, 0)] * len(batch)
            for text, own in hits.items():
                item, (share, near) = min(own.items(), key=lambda x: (-x[1][0], x[0]))
                best[text] = (share, item, near, len(own))
            types = (pa.float64(), pa.int64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([b[k] for b in best], t) for k, t in enumerate(types))], [*batch.schema.names, "share", "item_id", "cosine", "n_items"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, weight: float = WEIGHT, part: float = PART, whole: float = WHOLE, answer: float = ANSWER) -> DataFrame:
    """``(doc_id, text, contaminated, item_id, share, cosine, n_items)`` for every row of ``docs(doc_id, text)``.

    The latent space is that of a randomised singular value decomposition of the TF-IDF matrix of all passages of 32
    words (A-Z lowered, terms hashed), from sums over every text. For each of ``benchmark(item_id, text)``, the passages
    just long enough to hold it, at every eighth word, are candidates from a cosine of ``cosine`` on if they hold terms of
    ``weight`` of the item's TF-IDF weight; and, whatever these say, so is every one that with the eight words on either side
    holds the least of ``part`` and ``whole`` of the item's words, which is found exactly from its rarest ones. A candidate with the eight words on either side is a leak if a common subsequence has ``whole`` of the item's words, or ``part`` of them and
    ``answer`` of the item's last eight, where its answer stands. ``item_id`` is that of the largest share, ties to the least.

    Null or empty text has no passage and null or empty items have no leak; null doc ids and repeated rows pass through; of
    items with the same id each is looked for and the id counts once; without items nothing is contaminated. Items are
    broadcast as word hashes in blocks of 1,024, which one pass over the documents takes in turn: what grows with a benchmark
    is the files of its blocks (half a kilobyte an item), not the memory of a task. Documents are never moved.
    """
    out = _marked(columns(docs, doc_id="long", text="string"), benchmark, cosine, weight, part, whole, answer)
    return out.select("doc_id", "text", (F.col("n_items") > 0).alias("contaminated"), "item_id", "share", "cosine", "n_items")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item of the benchmark."""
    return carried(_marked(carry(docs, text="string"), benchmark, COSINE, WEIGHT, PART, WHOLE, ANSWER).where("n_items = 0"), docs)


def _marked(docs: DataFrame, benchmark: DataFrame, *limits: float) -> DataFrame:
    spark = docs.sparkSession
    benchmark = columns(benchmark, item_id="long", text="string").where("item_id IS NOT NULL AND text IS NOT NULL")
    kind = ", ".join(["term long", "passages long", "n long", *(f"y{k} double" for k in range(RANK + MORE))])
    total = docs.select("text").mapInArrow(_gram, kind).groupBy("term").agg(*[F.sum(x.split()[0]).alias(x.split()[0]) for x in kind.split(", ")[1:]]).toPandas()
    product, holding, passages = np.zeros((TERMS, RANK + MORE)), np.zeros(TERMS), 0
    if len(total):
        at = total["term"].to_numpy(np.int64)
        holding[at], passages = total["n"], int(total["passages"].max())
        product[at] = total[[f"y{k}" for k in range(RANK + MORE)]].to_numpy()
    space, idf = latent(holding, passages, product)
    shared, blocks, held = spark.sparkContext.broadcast((space, idf)), [], []
    for row in chain(benchmark.orderBy("item_id", "text").toLocalIterator(), [None]):
        if held and (row is None or len(held) == ITEMS_AT_ONCE):
            blocks.append(spark.sparkContext.broadcast(Items([r["item_id"] for r in held], [r["text"] for r in held])))
            held = []
        held.append(row)
    found = [T.StructField("share", T.DoubleType()), T.StructField("item_id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("n_items", T.LongType())]
    return docs.mapInArrow(_search(blocks, shared, *limits), T.StructType([*docs.schema.fields, *found]))


def op8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text")
