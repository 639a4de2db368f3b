"""The fold over a stream of captures, and event-time counts of captures without a session."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

UPDATES = "scope string, capture_id string, kind string, n long, turn long"


def _chain(scope: str, tokens) -> list[bytes]:
    out = [hashlib.sha256(scope.encode()).digest()[:16]]
    for t in tokens if tokens is not None else ():
        out.append(hashlib.sha256(out[-1] + t.encode()).digest()[:16])
    return out


def _step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    ends, covers, turn = pickle.loads(state.get[0]) if state.exists else ({}, set(), 0)
    out = []
    for rows in batches:
        for capture, tokens, history in zip(rows["capture_id"], rows["tokens"], rows["history"], strict=True):
            chain = _chain(key[0], tokens)
            n = len(chain) - 1
            turn += 1
            covered = chain[-1] in covers
            out.append((key[0], capture, "intermediate" if covered else "leaf", n, turn))
            if not covered:
                ends.setdefault(chain[-1], []).append((capture, n))
            for digest in chain[: min(history, n - 1) + 1] if n else ():
                covers.add(digest)
                out += [(key[0], c, "intermediate", m, turn) for c, m in ends.pop(digest, ())]
    state.update((pickle.dumps((ends, covers, turn)),))
    yield pd.DataFrame(out, columns=["scope", "capture_id", "kind", "n", "turn"])


def fold_stream(captures: DataFrame) -> DataFrame:
    """Updates ``(scope, capture_id, kind, n, turn)`` of a stream ``(capture_id string, scope string, tokens, history int)``.

    A capture comes out as a leaf, or as an intermediate if a history of its scope already covers it, and once more as an
    intermediate when one does later; the update of the greatest turn holds, whatever the order of arrival. State is a
    digest for each message of each history and each leaf of a scope: it grows with a scope, and is kept for good."""
    return captures.groupBy("scope").applyInPandasWithState(_step, UPDATES, "held binary", "update", GroupStateTimeout.NoTimeout)


def current(updates: DataFrame) -> DataFrame:
    """The last state of every capture of a table of updates."""
    return updates.groupBy("scope", "capture_id").agg(F.max_by(F.struct("kind", "n"), F.struct("turn", (F.col("kind") == "intermediate").alias("late"))).alias("s")).select("scope", "capture_id", "s.*")


def window_counts(captures: DataFrame, late: str = "1 hour") -> DataFrame:
    """Captures without a session by user and eight-hour block, of a stream or table with a timestamp ``at``; blocks that a
    watermark of ``late`` has passed are final."""
    timed = captures.withWatermark("at", late) if captures.isStreaming else captures
    return timed.where(F.coalesce("session_id", F.lit("")).isin("", "no_session_id")).groupBy(F.window("at", "8 hours"), "user_id").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "user_id", "n")
