"""Cumulative captures folded to their maximal transcripts, as equi-joins on chained digests.

A capture's transcript is its history, then its response; each message is one token. The digest of the first k tokens is
chained from that of the first k - 1, and starts from the capture's scope and signature. A capture is covered when its
whole transcript is a strict part of some history in its scope: its last digest equals one of that history's. As an
extender's own extender covers too, one pass finds all leaves.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import real_session
from .storage import settled


def token(role: Column, content: Column, name: Column | None = None, call_id: Column | None = None, calls: Column | None = None) -> Column:
    """The fields of a message that a replay repeats, as canonical JSON; reasoning takes no part."""
    none = F.lit(None).cast("string")
    quoted = lambda v: F.to_json(F.array(v))
    text = lambda v: F.substr(quoted(v), F.lit(2), F.length(quoted(v)) - 2)
    name, call_id, calls = name if name is not None else none, call_id if call_id is not None else none, calls if calls is not None else none
    assistant = F.concat(F.lit('{"content":'), text(content), F.lit(',"role":"assistant","tool_calls":'), F.coalesce(calls, F.lit("null")), F.lit("}"))
    tool = F.concat(F.lit('{"content":'), text(content), F.lit(',"name":'), text(name), F.lit(',"role":"tool","tool_call_id":'), text(call_id), F.lit("}"))
    other = F.concat(F.lit('{"content":'), text(content), F.lit(',"role":'), text(role), F.lit("}"))
    return F.when(role == "assistant", assistant).when(role == "tool", tool).otherwise(other)


def scope(session: Column, thread: Column, user: Column, masked: Column, source: Column) -> Column:
    """Where a capture may be part of another: its session and thread; its own source if its session is masked; else its user."""
    parts = lambda *x: F.to_json(F.array(*x))
    return F.when(real_session(session) != "", parts(F.lit("session"), session, F.coalesce(thread, F.lit("")))).when(masked, parts(F.lit("source"), source)).otherwise(parts(F.lit("user"), F.coalesce(user, F.lit(""))))


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def chain(start: pd.Series, tokens: pd.Series) -> pd.Series:
    """Digests of the first 0, 1, ... tokens."""

    def of(first: str, own) -> list[bytes]:
        out = [hashlib.sha256(first.encode()).digest()]
        for t in own if own is not None else ():
            t = t.encode()
            out.append(hashlib.sha256(out[-1] + len(t).to_bytes(8, "big") + t).digest())
        return out

    return pd.Series([of(a, b) for a, b in zip(start, tokens, strict=True)])


class Fold:
    """The fold of ``captures(capture_id, scope string, tokens array<string>, history int, order ...)``.

    ``history`` is how many tokens are history. ``order`` names the columns that rank captures; ``signature``, if
    given, is a column that must be equal too. Equal transcripts never cover each other, and an empty one covers nothing.
    """

    def __init__(self, captures: DataFrame, order: tuple[str, ...] = ("capture_id",), signature: str | None = None):
        start = F.concat_ws("\x1f", F.col("scope"), F.col(signature)) if signature else F.col("scope")
        self.order = order
        # written once: leaves, contributors and witnesses all read it, and the digests are Python's work
        self.chained = settled(captures.withColumn("_chain", chain(start, F.col("tokens"))).withColumn("_n", F.size("_chain") - 1))
        self.ends = self.chained.withColumn("_end", F.element_at("_chain", -1))
        depth = F.least(F.col("history"), F.col("_n") - 1)
        self.covers = self.chained.where("_n > 0").select("capture_id", *[c for c in order if c != "capture_id"], "_n", F.explode(F.slice("_chain", F.lit(1), depth + 1)).alias("_end"))

    def _plain(self, df: DataFrame) -> DataFrame:
        return df.drop("_chain", "_n", "_end")

    def leaves(self) -> DataFrame:
        return self._plain(self.ends.join(self.covers.select("_end").distinct(), "_end", "left_anti"))

    def intermediates(self) -> DataFrame:
        return self._plain(self.ends.join(self.covers.select("_end").distinct(), "_end", "left_semi"))

    def contributors(self) -> DataFrame:
        """``(leaf_id, capture_id)``: each leaf itself, and every capture whose transcript ends on its history's path."""
        leaves = self.leaves().select("capture_id")
        paths = self.covers.join(leaves, "capture_id", "left_semi").select(F.col("capture_id").alias("leaf_id"), "_end")
        return paths.join(self.ends.select("capture_id", "_end"), "_end").select("leaf_id", "capture_id").union(leaves.select(F.col("capture_id").alias("leaf_id"), "capture_id")).distinct()

    def witnesses(self) -> DataFrame:
        """``(capture_id, witness_id)``: for each capture that is covered, its shortest extender, ties by order."""
        rank = F.struct(F.col("_n"), *[F.col(c) for c in self.order], F.col("capture_id"))
        best = self.covers.groupBy("_end").agg(F.min_by("capture_id", rank).alias("witness_id"))
        return self.ends.join(best, "_end").select("capture_id", "witness_id")
