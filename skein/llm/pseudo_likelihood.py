"""Masked pseudo-likelihood: a network that sees the words on both sides predicts each word of a document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buffers, columns, lowered, slices, spans, stored, table, words

#: Tokens that rare words share by hash, words that a window has on either side, units of the hidden layer, steps of training
#: that a small corpus gets at least.
SHARED, REACH, HIDDEN, STEPS = 16, 2, 24, 32
#: Count from which a word has a token of its own; in large corpora that is the root of their words over ROOT.
LEAST, ROOT = 5, 100
#: Tokens of a step, parts of the corpus between which models are averaged, sweeps over a part at most, and tokens of the
#: texts that one task trains on, in all and for each row of the network that it returns.
BATCH, ROUNDS, SWEEPS, TASK_TOKENS, ROW_TOKENS = 1 << 17, 2, 8, 1 << 23, 32
HASHES_AT_ONCE = 1_000_000
#: Tokens that a step works on at once, so that their rows stay in the cache.
ROWS_AT_ONCE = 1 << 13
#: Slopes of one word in a step that are summed one after the other; more are summed as a product.
SHORT = 24


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        found, where = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        return found, np.bincount(where, np.concatenate([h[1] for h in held])).astype(np.int64)

    for batch in (x for whole in batches for x in slices(whole)):
        held.append(np.unique(words(batch.column("text"))[0], return_counts=True))
        size += len(held[-1][0])
        if size > HASHES_AT_ONCE:
            held[:] = [merged()]
            size = len(held[0][0])
            if size > HASHES_AT_ONCE // 2:
                yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], ["word", "n"])
                held.clear()
                size = 0
    if held:
        found, n = merged()
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["word", "n"])


class Vocabulary:
    """The hashes of the words that have a token, ascending, and a table in which most of them are found at once."""

    def __init__(self, known: np.ndarray, shared: int):
        self.known, self.shared = known, shared
        self.size = len(known) + shared
        self.shift = np.uint64(64 - max(10, int(4 * len(known)).bit_length()))
        self.table = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        self.table[known >> self.shift] = np.arange(len(known))  # of words in one place the last stands
        place = known >> self.shift
        self.crowded = np.unique(place[1:][place[1:] == place[:-1]])

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        out = len(self.known) + (hashes % np.uint64(self.shared)).astype(np.int64)
        if not len(self.known):
            return out
        place = hashes >> self.shift
        first = self.table[place]
        hit = (first >= 0) & (self.known[first] == hashes)
        out[hit] = first[hit]
        if len(self.crowded):
            rest = np.flatnonzero(~hit & (first >= 0))
            rest = rest[np.isin(place[rest], self.crowded)]
            where = np.minimum(np.searchsorted(self.known, hashes[rest]), len(self.known) - 1)
            good = self.known[where] == hashes[rest]
            out[rest[good]] = where[good]
        return out


def tokens(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts in order and each text's first place."""
    hashes, at = words(texts)
    return vocabulary.ids(hashes), at


def windows(ids: np.ndarray, at: np.ndarray, size: int, reach: int = REACH) -> np.ndarray:
    """For each token the ids of the words ``reach`` to 1 before it and 1 to ``reach`` behind it, a row for each place;
    ``size`` stands beyond a text's ends."""
    out = np.full((2 * reach, len(ids)), size, np.int64)
    of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for row, away in zip(out, [*range(-reach, 0), *range(1, reach + 1)], strict=True):
        here, there = slice(max(0, -away), len(ids) - max(0, away)), slice(max(0, away), len(ids) - max(0, -away))
        row[here] = np.where(of[here] == of[there], ids[there], size)
    return out


class Network:
    """A window network whose softmax is a tree of three levels: a token's probability is that of its branch of
    ``branches``, of the twig in it and of the token in that, so a step costs the cube root of the vocabulary.

    ``par`` has a row for each word at each place of a window and for each node, the bias of a node in its last column.
    """

    def __init__(self, size: int, par: np.ndarray, reach: int = REACH):
        self.size, self.par = size, par
        self.branches = branches(size)
        first = 2 * reach * (size + 1)
        self.levels = [(first, self.branches**2), (first + self.branches, self.branches), (first + self.branches + self.branches**2, 1)]
        self.moved = np.zeros(len(par), np.float32)
        self.held = [np.empty((ROWS_AT_ONCE, par.shape[1]), np.float32) for _ in range(2)]
        self.starts = np.arange(ROWS_AT_ONCE) * self.branches
        self.slopes: np.ndarray | None = None  # of the nodes
        self.tame: bool | None = None

    def walk(self, around: np.ndarray, ids: np.ndarray, rate: float = 0.0) -> np.ndarray:
        """Log-probability of each token in its window; with a ``rate``, an Adagrad step is taken on their sum.

        Tokens are worked on in the order of the tree, some thousand at a time, whose rows stay in the cache; the slopes
        of all are summed before the step, those of a window's words once for each place, in the order of the words.
        """
        order, own = ranked(ids)
        around, nodes = around[:, order] + (self.size + 1) * np.arange(len(around))[:, None], self.levels[0][0]
        said, met, ones = np.zeros(len(own)), set(), np.ones(self.branches, np.float32)
        if not rate and self.tame is None:
            self.tame = bool(np.abs(self.par[nodes:]).sum(axis=1).max() <= 60)  # no x is beyond 1
        tame = not rate and self.tame
        if rate:
            self.tame = None
            back = np.empty((len(own), self.par.shape[1]), np.float32)
            if self.slopes is None:
                self.slopes = np.zeros_like(self.par[nodes:])
        for c in range(0, len(own), ROWS_AT_ONCE):
            n = min(ROWS_AT_ONCE, len(own) - c)
            x, spare = (h[:n] for h in self.held)
            sides = around[:, c : c + n]
            np.take(self.par, sides[0], axis=0, out=x, mode="clip")  # no place is beyond; other modes copy
            for side in sides[1:]:
                np.take(self.par, side, axis=0, out=spare, mode="clip")
                x += spare
            np.tanh(x, out=x)
            x[:, -1] = 1
            for first, below in self.levels:
                node = own[c : c + n] // below
                group = node // self.branches
                starts = np.flatnonzero(np.diff(group, prepend=-1))
                branch = node - group * self.branches
                for a, b, at in zip(starts.tolist(), [*starts[1:].tolist(), n], (first + group[starts] * self.branches).tolist(), strict=True):
                    w, own_x, chosen = self.par[at : at + self.branches], x[a:b], self.starts[: b - a] + branch[a:b]
                    z = own_x @ w.T
                    if not tame and z.max() > 60:  # beyond what a sum of exponentials bears
                        z -= z.max(axis=1, keepdims=True)
                    flat = z.reshape(-1)
                    one = flat[chosen]
                    e = np.exp(z, out=z)
                    total = e @ ones
                    said[c + a : c + b] += one - np.log(total)
                    if rate:
                        e *= (1 / total)[:, None]
                        flat[chosen] -= 1
                        if first == nodes:  # all have the root: the first slopes there are
                            np.matmul(e, w, out=back[c : c + n])
                        else:
                            back[c + a : c + b] += e @ w
                        self.slopes[at - nodes : at - nodes + self.branches] += e.T @ own_x
                        met.add(at)
            if rate:
                np.multiply(x, x, out=x)
                np.subtract(1, x, out=x)  # the last column is that of the bias: 0
                back[c : c + n] *= x
        if rate and len(own):
            for side in around:
                by, rows = ranked(side)
                at = np.flatnonzero(np.diff(rows, prepend=-1))
                self._step(rows[at], summed(back, by, at), rate)
            rows = (np.array(sorted(met))[:, None] + np.arange(self.branches)).ravel()
            self._step(rows, self.slopes[rows - nodes], rate)
            self.slopes[rows - nodes] = 0
        out = np.empty_like(said)
        out[order] = said
        return out

    def _step(self, rows: np.ndarray, slope: np.ndarray, rate: float) -> None:
        """Adagrad on different ``rows`` whose summed slopes are ``slope``, which is overwritten."""
        moved = self.moved[rows] + np.einsum("ij,ij->i", slope, slope) / np.float32(slope.shape[1])
        self.moved[rows] = moved
        slope *= (np.float32(rate) / np.sqrt(moved + 1))[:, None]
        self.par[rows] -= slope


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of numbers from 0 on in their order, equal ones by place, and the numbers in that order; sorting numbers with
    their place behind takes a fraction of the time of a stable ``argsort``."""
    bits = len(values).bit_length()
    both = np.sort(values.astype(np.int64) << bits | np.arange(len(values)))
    return both & ((1 << bits) - 1), both >> bits


def summed(rows: np.ndarray, by: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sums of the runs of ``rows[by]`` that begin at ``at``: of short runs one row after the other, of long ones as a product."""
    n = np.diff(at, append=len(by))
    def of(places) -> np.ndarray:
        return np.take(rows, by[places], axis=0, mode="clip")

    out, live, ones = of(at), np.flatnonzero((n > 1) & (n <= SHORT)), np.ones(int(n.max()), np.float32)
    k = 1
    while len(live):
        out[live] += of(at[live] + k)
        k += 1
        live = live[n[live] > k]
    long = np.flatnonzero(n > SHORT)
    for j, a, b in zip(long.tolist(), at[long].tolist(), (at[long] + n[long]).tolist(), strict=True):
        np.dot(ones[: b - a], of(slice(a, b)), out=out[j])
    return out


def branches(size: int) -> int:
    n = 1
    while n**3 < size:
        n += 1
    return n


def untrained(counts: np.ndarray, hidden: int = HIDDEN, reach: int = REACH, seed: int = 7) -> np.ndarray:
    """Rows of a network that gives every token its share of the corpus, whatever its window."""
    size, n = len(counts), branches(len(counts))
    mass = np.zeros(n**3)
    mass[:size] = counts + 0.5
    bias = np.concatenate([np.log(np.maximum(mass.reshape(-1, w).sum(axis=1), 1e-9)) for w in (n * n, n, 1)])
    par = np.random.default_rng(seed).normal(0, 0.1, (2 * reach * (size + 1) + len(bias), hidden + 1)).astype(np.float32)
    par[:, -1] = 0
    par[2 * reach * (size + 1) :, -1] = bias
    return par


def _train_part(known, shared: int, par, sweeps: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(known.value, shared)
        net = Network(own.size, par.value.copy())
        for batch in (x for whole in batches for x in slices(whole)):
            ids, at = tokens(batch.column("text"), own)
            around = windows(ids, at, own.size)
            for _ in range(sweeps):
                for k in range(0, len(ids), BATCH):
                    net.walk(around[:, k : k + BATCH], ids[k : k + BATCH], rate)
        # for each run of rows their weights, then how far each row moved, in half precision
        for k in range(0, len(net.par), ROWS_AT_ONCE):
            at = slice(k, k + ROWS_AT_ONCE)
            if net.moved[at].any():
                moved = (net.par[at] - par.value[at]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([net.moved[at].tobytes()], pa.binary()), pa.array([moved.tobytes()], pa.binary())], ["row", "weight", "moved"])

    return run


def _averaged(width: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, total = np.zeros(1), np.zeros(1)
        for batch in batches:
            for w, x in zip(batch.column("weight").to_pylist(), batch.column("moved").to_pylist(), strict=True):
                own = np.frombuffer(w, np.float32).astype(np.float64)
                weight, total = weight + own, total + own[:, None] * np.frombuffer(x, np.float16).reshape(-1, width)
        mean = total / np.maximum(weight, 1e-30)[:, None]
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([mean.astype(np.float32).tobytes()], pa.binary())], ["row", "moved"])

    return run


def train_parts(texts: DataFrame, known: np.ndarray, counts: np.ndarray, hidden: int = HIDDEN, steps: int = STEPS, rate: float = 0.1) -> np.ndarray:
    """Rows of a :class:`Network` trained on every window of ``texts(text)``: each task takes mini-batch steps on its
    texts, and what it moved is averaged row by row, weighted by its squared slopes, after each of ROUNDS parts."""
    spark, par = texts.sparkSession, untrained(counts, hidden)
    sweeps = int(min(SWEEPS, max(1, -(-steps * BATCH // max(counts.sum(), 1)))))
    words_at = spark.sparkContext.broadcast(known)
    tasks = max(spark.sparkContext.defaultParallelism, int(counts.sum()) // max(TASK_TOKENS, ROW_TOKENS * len(par)))
    for part in range(ROUNDS):
        held = spark.sparkContext.broadcast(par)
        own = texts.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == part).coalesce(tasks)
        moved = own.mapInArrow(_train_part(words_at, len(counts) - len(known), held, sweeps, rate), "row long, weight binary, moved binary")
        moved = moved.groupBy("row").applyInArrow(_averaged(hidden + 1), "row long, moved binary").toArrow()
        par = par.copy()
        for k, x in zip(moved.column("row").to_pylist(), moved.column("moved").to_pylist(), strict=True):
            par[k : k + ROWS_AT_ONCE] += np.frombuffer(x, np.float32).reshape(-1, hidden + 1)
        held.destroy()
    return par


def spelt(texts: pa.Array, rare: np.ndarray) -> np.ndarray:
    """For the words of all texts at the places ``rare``: their bytes (A-Z lowered) and a blank behind, each with the two before it."""
    data, offsets = buffers(texts)
    starts, ends = (x[rare] for x in spans(data, offsets))
    n = ends - starts + 1
    first = np.cumsum(n) - n
    k = np.arange(n.sum()) - np.repeat(first, n)
    own = lowered(data)[np.minimum(np.repeat(starts, n) + k, max(len(data) - 1, 0))].astype(np.int64)
    own[first + n - 1] = 32
    one, two = np.full(len(own), 32), np.full(len(own), 32)
    one[1:], two[2:] = own[:-1], own[:-2]
    one[k < 1], two[k < 2] = 32, 32
    return two << 16 | one << 8 | own


def _spelling(known, shared: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = np.zeros(1 << 24, np.int32), Vocabulary(known.value, shared)
        for batch in (x for whole in batches for x in slices(whole)):
            ids, _ = tokens(batch.column("text"), own)
            code, n = np.unique(spelt(batch.column("text"), np.flatnonzero(ids >= len(known.value))).astype(np.uint32), return_counts=True)
            held[code] += n.astype(np.int32)
        code = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(held[code].astype(np.int64))], ["code", "n"])

    return run


def letters(code: np.ndarray, n: np.ndarray, kept: float = 4.0) -> np.ndarray:
    """Log-probability of each byte after any two, by counts of the three, backed by those of the last two and of the byte."""
    three = np.zeros(1 << 24, np.float32)
    three[code] = n
    three = three.reshape(256, 256, 256)
    two = three.sum(axis=0)
    one = (two.sum(axis=0) + 1) / (two.sum() + 256)
    two = (two + kept * one) / (two.sum(axis=1, keepdims=True) + kept)
    three += kept * two
    three /= three.sum(axis=2, keepdims=True)
    return np.log(three, out=three).ravel()


def _score_all(known, shared: int, par, counted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, letter = Vocabulary(known.value, shared), letters(*counted.value)
        net = Network(own.size, par.value)
        for batch in (x for whole in batches for x in slices(whole)):
            ids, at = tokens(batch.column("text"), own)
            around = windows(ids, at, own.size)
            said = np.zeros(len(ids))
            for k in range(0, len(ids), BATCH):
                said[k : k + BATCH] = net.walk(around[:, k : k + BATCH], ids[k : k + BATCH])
            rare = np.flatnonzero(ids >= len(known.value))
            if len(rare):
                code = spelt(batch.column("text"), rare)
                ends = np.flatnonzero(code & 255 == 32)
                sums = np.concatenate(([0.0], np.cumsum(letter[code], dtype=np.float64)[ends]))
                said[rare] += np.diff(sums) + np.log(shared)
            yield _scored(batch.column("doc_id"), np.concatenate(([0.0], np.cumsum(said))), at)

    return run


def _scored(doc_id: pa.Array, sums: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    n, said = np.diff(at), sums[at[1:]] - sums[at[:-1]]
    mean = np.divide(said, n, out=np.zeros(len(n)), where=n > 0)
    return pa.RecordBatch.from_arrays([doc_id, pa.array(n), pa.array(said), pa.array(mean, mask=n == 0), pa.array(np.exp(-mean), mask=n == 0)], ["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood", "perplexity"])


SCORES = "doc_id long, n_tokens long, log_likelihood double, mean_log_likelihood double, perplexity double"


def score_documents(docs: DataFrame, shared: int = SHARED, hidden: int = HIDDEN, steps: int = STEPS) -> DataFrame:
    """``(doc_id, n_tokens, log_likelihood, mean_log_likelihood, perplexity)`` for every row of ``docs(doc_id, text)``.

    Tokens are words (A-Z lowered). Every word that occurs LEAST times, or in large corpora the root of their words over
    ROOT, has one, so the vocabulary grows with the corpus; rarer words share ``shared`` by hash in windows, and each is
    scored by its letters, with a model of those of all rare words. The network predicts every token of the corpus from
    the two words on either side, and is trained on all windows where they are (:func:`train_parts`), ``steps`` times at
    least; a document's score is the sum of the log-probabilities of its tokens, each given all of its window but itself.

    Word counts cover every text and meet as partial sums; the driver gets the words with a token and the rows of the
    network, about five a word. Null or empty text has no tokens, a sum of 0 and no mean; null ids and repeated rows pass
    through; an empty table gives no rows.
    """
    docs = columns(docs, doc_id="long", text="string")
    spark = docs.sparkSession
    counted = docs.select("text").mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stored(counted, "words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    own = counted.where(F.col("n") >= max(LEAST, int(total**0.5 / ROOT))).toArrow()
    known, n = own.column("word").to_numpy().astype(np.int64).view(np.uint64), own.column("n").to_numpy().astype(float)
    order = np.argsort(known)
    known, n = known[order], n[order]
    counts = np.concatenate([n, np.full(shared, (total - n.sum()) / shared)])
    words_at = spark.sparkContext.broadcast(known)
    three = docs.select("text").mapInArrow(_spelling(words_at, shared), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    letter = spark.sparkContext.broadcast((three.column("code").to_numpy(), three.column("n").to_numpy()))
    par = spark.sparkContext.broadcast(train_parts(docs.select("text").where("text IS NOT NULL"), known, counts, hidden, steps))
    return docs.mapInArrow(_score_all(words_at, shared, par, letter), SCORES)


def op4_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
