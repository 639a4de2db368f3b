"""Chat formatting: a hidden Markov model over speaker markers and line features recovers the roles of a transcript.

Viterbi decoding is spread by pieces: a piece of a conversation is a bounded run of segments, its best paths from any
state before it to any state at its end form one small matrix, matrices of a conversation are chained, and then each
piece is decoded between known states. The most probable path is that of one pass over the whole conversation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buffers, columns, stored, table

STATES = ("system", "user", "assistant", "tool")
#: Speaker names as transcripts write them, by state.
NAMES = {"system": ("system", "instructions?"), "user": ("user", "human", "customer", "q", "question"), "assistant": ("assistant", "ai", "bot", "gpt", "model", "a", "answer"), "tool": ("tool", "function", "observation")}
#: A marker is a name at the start of a line, maybe bracketed or emphasised, and a colon or closing bracket.
OPEN, CLOSE = r"(?:[#*\[<|]{1,4}[\x20]?(?:im_start\|>)?)?", r"(?:[\x20]?[*\]|>]{0,3}:[*]{0,2}|[\x20]?[\]|>]{1,2})"
MARKER_WEIGHT = 6.0  # log-odds by which a marker favours its state
#: Segments of a piece, and bytes of their texts, from which it ends.
PIECE, PIECE_BYTES = 4096, 8 << 20
FEATURES = ("length", "lines", "asks", "first")
FOLDS = 5


def marker(state: str) -> str:
    return rf"(?i)^[\x20\t]*{OPEN}(?:{'|'.join(NAMES[state])}){CLOSE}[\x20\t]*"


def segments(turns: DataFrame, *carried: str) -> DataFrame:
    """Rows of ``turns(conv_id, turn, text)`` parted before every line that begins with a speaker marker:
    ``(conv_id, turn, segment, text, said, length, lines, asks, first)``; ``said`` is the state that a marker names."""
    every = "|".join(n for names in NAMES.values() for n in names)
    parts = F.filter(F.split(F.coalesce("text", F.lit("")), rf"(?im)(?=^[\x20\t]*{OPEN}(?:{every}){CLOSE})"), lambda x: F.trim(x) != "")
    parts = F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("")))
    out = turns.select("conv_id", "turn", *carried, F.posexplode(parts).alias("segment", "raw"))
    said = F.lit(None).cast("string")
    for state in STATES:
        said = F.coalesce(said, F.when(F.col("raw").rlike(marker(state)), F.lit(state)))
    out = out.withColumn("said", said)
    plain = F.col("raw")
    for state in STATES:
        plain = F.when(F.col("said") == state, F.regexp_replace(F.col("raw"), marker(state), "")).otherwise(plain)
    out = out.withColumn("text", F.trim(plain, F.lit(" \t\r\n"))).drop("raw")
    bucket = lambda n, most: F.least(F.floor(F.log2(1 + n)), F.lit(most)).cast("int")
    return out.select(
        "*",
        bucket(F.length("text"), 15).alias("length"),
        bucket(F.size(F.split("text", "\n", -1)), 8).alias("lines"),
        F.col("text").rlike(r"\?\s*$").cast("int").alias("asks"),
        ((F.coalesce("turn", F.lit(0)) == 0) & (F.col("segment") == 0)).cast("int").alias("first"),
    )


def canonical_role(role: Column) -> Column:
    """The state of a role as a table names it; null for a name that no state has."""
    out = F.lit(None).cast("string")
    for state in STATES:
        out = F.coalesce(out, F.when(F.lower(F.trim(role)).rlike(f"^(?:{'|'.join(NAMES[state])})$"), F.lit(state)))
    return out


class Model:
    """Log-probabilities: of the first state, of transitions, and of each feature's values in each state."""

    def __init__(self, start: np.ndarray, moves: np.ndarray, values: dict[str, np.ndarray]):
        self.start, self.moves = np.log(start / start.sum()), np.log(moves / moves.sum(axis=1, keepdims=True))
        self.values = {k: np.log(v / v.sum(axis=1, keepdims=True)) for k, v in values.items()}

    def emissions(self, rows: dict[str, list]) -> np.ndarray:
        """[row, state] log-likelihoods."""
        out = sum(self.values[f][:, np.array(rows[f], np.int64)].T for f in FEATURES)
        for k, said in enumerate(rows["said"]):
            if said is not None:
                out[k, STATES.index(said)] += MARKER_WEIGHT
        return out

    def forward(self, best: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Scores of the best paths, one row of ``best`` for each beginning, after one more row."""
        return (best[:, :, None] + self.moves).max(axis=1) + seen

    def decode(self, before: int | None, seen: np.ndarray, last: int | None) -> list[int]:
        """The best states of rows with emissions ``seen``, after state ``before`` (None: first rows), ending in ``last`` (None: any); ties to the first state."""
        best = (self.start if before is None else self.moves[before]) + seen[0]
        back = np.zeros(seen.shape, np.int64)
        for k in range(1, len(seen)):
            ways = best[:, None] + self.moves
            back[k] = ways.argmax(axis=0)
            best = ways.max(axis=0) + seen[k]
        out = [int(best.argmax()) if last is None else last]
        for k in range(len(seen) - 1, 0, -1):
            out.append(int(back[k][out[-1]]))
        return out[::-1]


def learn(turns: DataFrame) -> Model:
    """A model from ``turns(conv_id, turn, role, text)`` with known roles: counts over all of them, each plus one half."""
    known = turns.withColumn("role", canonical_role(F.col("role"))).where("role IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL")
    n = len(STATES)
    start, moves = np.full(n, 0.5), np.full((n, n), 0.5)
    values = {"length": np.full((n, 16), 0.5), "lines": np.full((n, 9), 0.5), "asks": np.full((n, 2), 0.5), "first": np.full((n, 2), 0.5)}
    seen = segments(known.select("conv_id", "turn", "text")).where("segment = 0").join(known.select("conv_id", "turn", "role").distinct(), ["conv_id", "turn"])
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES])).alias("x")
    for r in seen.select("role", pairs).groupBy("role", "x.feature", "x.value").count().collect():
        values[r["feature"]][STATES.index(r["role"]), r["value"]] += r["count"]
    here = known.select("conv_id", "turn", "role").distinct()
    ahead = here.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    for r in here.join(ahead, ["conv_id", "turn"]).groupBy("role", "next").count().collect():
        moves[STATES.index(r["role"]), STATES.index(r["next"])] += r["count"]
    for r in here.where("turn = 0").groupBy("role").count().collect():
        start[STATES.index(r["role"])] += r["count"]
    return Model(start, moves, values)


_PLACE = "conv_id long, turn long, segment long, text string, said string, length int, lines int, asks int, first int"


def _seen(rows: pa.RecordBatch | pa.Table) -> dict[str, list]:
    """What the model looks at; texts stay in their Arrow buffers."""
    return rows.select(["said", *FEATURES]).to_pydict()


def _pieces(model: Model, most: int):
    """Sorted rows with the number of their piece, in order all over, and on the last row of each its matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        piece, n, size, conv, ways = (TaskContext.get().partitionId() << 32) - 1, 0, 0, object(), None
        held: pa.RecordBatch | None = None

        def marked(batch: pa.RecordBatch, next_conv) -> pa.RecordBatch:
            nonlocal piece, n, size, conv, ways
            convs, seen = batch.column("conv_id").to_pylist(), model.emissions(_seen(batch))
            sizes = np.diff(buffers(batch.column("text"))[1])
            numbers, places, matrices = [], [], []
            for k, own in enumerate(convs):
                if own != conv or n >= most or size >= PIECE_BYTES:
                    piece, n, size, conv = piece + 1, 0, 0, own
                    # a row for each state before the piece, and one more for none
                    ways = np.vstack([model.moves, model.start]) + seen[k]
                else:
                    ways = model.forward(ways, seen[k])
                n, size = n + 1, size + int(sizes[k])
                after = convs[k + 1] if k + 1 < len(seen) else next_conv
                numbers.append(piece)
                places.append(n)
                matrices.append(ways.ravel().tolist() if after != own or n >= most or size >= PIECE_BYTES else None)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64()), pa.array(places, pa.int64()), pa.array(matrices, pa.list_(pa.float64()))], [*batch.schema.names, "piece", "place", "matrix"])

        for batch in batches:
            if len(batch):
                if held is not None:
                    yield marked(held, batch.column("conv_id")[0].as_py())
                held = batch
        if held is not None:
            yield marked(held, object())

    return run


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each value of ``key``, of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_pylist()
        at = 0
        for k in range(1, len(keys) + 1):
            if k == len(keys) or keys[k] != keys[at]:
                if held and held[-1].column(key)[-1].as_py() != keys[at]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(at, k - at))
                at = k
    if held:
        yield pa.Table.from_batches(held)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the pieces of each conversation, in order, the states before them and at their ends."""
    n = len(STATES)
    out: list[tuple] = []
    for rows in (x.to_pydict() for x in _runs(batches, "conv_id")):
        ways = [np.array(m).reshape(n + 1, n) for m in rows["matrix"]]
        best, back = ways[0][n], []
        for w in ways[1:]:
            paths = best[:, None] + w[:n]
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0)
        last = [int(best.argmax())]
        for b in reversed(back):
            last.append(int(b[last[-1]]))
        last.reverse()
        out += zip(rows["piece"], [None, *last[:-1]], last, strict=True)
        if len(out) > 10_000:
            yield _rows(out, ("piece", "before", "last"))
            out = []
    yield _rows(out, ("piece", "before", "last"))


def _rows(out: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(len(names))], list(names))


def _decode(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "piece"):
            states = model.decode(rows.column("before")[0].as_py(), model.emissions(_seen(rows)), rows.column("last")[0].as_py())
            yield from rows.select(["conv_id", "turn", "segment", "text"]).append_column("role", pa.array([STATES[s] for s in states])).to_batches()

    return run


def render(role: Column, text: Column) -> Column:
    """One canonical turn."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>\n"))


def format_chats(turns: DataFrame, model: Model, piece: int = PIECE) -> DataFrame:
    """``(conv_id, turn, segment, role, text, rendered)`` for every segment of ``turns(conv_id, turn, text)``.

    A turn's text is parted before every line that begins with a speaker marker; markers are taken off. Roles are the most
    probable path of ``model`` over a conversation's segments in the order of turn (null first), text and segment; a
    marker adds weight to its role, it does not decide. A conversation is its turns' ``rendered`` in that order.

    Null text is one empty segment; rows without conv_id make up one conversation of their own; repeated rows are
    segments of their own; an empty table gives no rows. Rows are dealt by ranges of (conv_id, turn, ...), so a long
    conversation spreads; no step holds more than ``piece`` rows of it or, but for a last text, PIECE_BYTES of their
    texts, which stay in Arrow buffers, or one matrix for each of those.
    """
    turns = columns(turns, conv_id="long", turn="long", text="string")
    names = [x.split()[0] for x in _PLACE.split(", ")]
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("tie"), F.asc("segment"), F.asc("id")]
    cut = segments(turns.withColumn("tie", F.xxhash64("text")), "tie").withColumn("id", F.monotonically_increasing_id())
    sorted_ = cut.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = stored(sorted_.select(*[F.col(c).cast(t) for c, t in (x.split() for x in _PLACE.split(", "))]).mapInArrow(_pieces(model, piece), _PLACE + ", piece long, place long, matrix array<double>"), "pieces")
    ends = cut.where("matrix IS NOT NULL").select("conv_id", "piece", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    ends = ends.mapInArrow(_chain, "piece long, before long, last long")
    both = cut.drop("matrix").join(ends, "piece").select(*names, "piece", "place", "before", "last").repartition("piece").sortWithinPartitions("piece", "place")
    out = both.mapInArrow(_decode(model), "conv_id long, turn long, segment long, text string, role string")
    return out.select("conv_id", "turn", "segment", "role", "text", render(F.col("role"), F.col("text")).alias("rendered"))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = columns(table(spark, sf_dir, "conversations"), conv_id="long", turn="long", role="string", text="string")
    return format_chats(turns, learn(turns.where(~held_out())))
