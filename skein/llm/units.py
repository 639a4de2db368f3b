"""Exact substring dedup by unit: sentences, lines or paragraphs that an earlier document holds are removed."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns, slices, stored, table

#: How each kind of unit ends; a sentence ends with its line, or at a blank behind a full stop, ``!`` or ``?``.
ENDS = {"sentence": re.compile(r"\n|(?<=[.!?])[\t\f\r ]"), "line": re.compile(r"\n"), "paragraph": re.compile(r"\n[^\S\n]*\n\s*")}
WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
#: Words of a unit that is compared, of a line that goes by itself, and of a passage that goes wherever it stands. A copied
#: passage loses the sentence at either seam, so this is less than the 50 words from which passages are sought.
UNIT_WORDS, LINE_WORDS, PASSAGE_WORDS = 3, 5, 30
ROWS_AT_ONCE = 50_000


def units(text: str, kind: str) -> Iterator[tuple[int, int, int]]:
    """Code point spans of the units of a text, without what parts them, and the line that each is in (other kinds than
    sentences: a line for each unit)."""
    at = line = 0
    for end in ENDS[kind].finditer(text):
        yield at, end.start(), line
        at = end.end()
        line += kind != "sentence" or end[0] == "\n"
    yield at, len(text), line


def _digests(kind: str, least: int):
    names = ["doc_id", "row_hash", "high", "low", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(5)], names)

        rows: list[tuple] = []
        for batch in (x for whole in batches for x in slices(whole)):
            for doc_id, row_hash, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row_hash", "text")), strict=True):
                for start, end, _ in units(text, kind) if text else ():
                    found = WORD.findall(text[start:end].lower())
                    if len(found) >= least:
                        digest = hashlib.blake2b(" ".join(found).encode("utf-8", "surrogatepass"), digest_size=16).digest()
                        rows.append((doc_id, row_hash, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True), start))
                if len(rows) >= ROWS_AT_ONCE:
                    yield flush()
                    rows.clear()
        if rows:
            yield flush()

    return run


def cut(text: str, firsts: dict[int, int | None], kind: str, least: int, line_words: int, passage_words: int) -> dict:
    """What is left of a text whose units at ``firsts`` (start to the doc_id of the earliest copy) stand elsewhere before."""
    spans = list(units(text, kind))
    n = [len(WORD.findall(text[a:b].lower())) for a, b, _ in spans]
    told = [k for k, w in enumerate(n) if w >= least]
    gone, passages, words, run = set(), 0, 0, []
    for k in [*told, None]:
        if k is not None and spans[k][0] in firsts:
            run.append(k)
            continue
        if run and (long := sum(n[j] for j in run)) >= passage_words:
            gone.update(run)
            passages, words = passages + 1, words + long
        run = []
    lines: dict[int, list[int]] = {}
    for k in told:
        lines.setdefault(spans[k][2], []).append(k)
    for own in lines.values():
        if all(spans[k][0] in firsts for k in own) and sum(n[k] for k in own) >= line_words:
            gone.update(own)
    removed = [f"{spans[k][0]}:{spans[k][1]}:{'' if firsts[spans[k][0]] is None else firsts[spans[k][0]]}" for k in sorted(gone)]
    # what is too short to compare goes with the units around it
    for a, b in zip(told, told[1:], strict=False):
        if a in gone and b in gone:
            gone.update(range(a + 1, b))
    kept: list[list[int]] = []
    for k, (start, _, _) in enumerate(spans):
        end = spans[k + 1][0] if k + 1 < len(spans) else len(text)
        if k in gone or start == end:
            continue
        if kept and kept[-1][1] == start:
            kept[-1][1] = end
        else:
            kept.append([start, end])
    return {"text": "".join(text[a:b] for a, b in kept), "n_removed": len(removed), "n_passages": passages, "passage_words": words, "removed": ",".join(removed), "kept_spans": ",".join(f"{a}:{b}" for a, b in kept)}


def _cut_all(*how):
    types = {"doc_id": pa.int64(), "text": pa.string(), "n_removed": pa.int64(), "n_passages": pa.int64(), "passage_words": pa.int64(), "removed": pa.string(), "kept_spans": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole)):
            out = []
            for doc_id, text, repeated in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "repeated")), strict=True):
                if repeated:
                    own = cut(text, {x["start"]: x["first_doc_id"] for x in repeated}, *how)
                else:
                    own = {"text": text, "n_removed": 0, "n_passages": 0, "passage_words": 0, "removed": "", "kept_spans": f"0:{len(text)}" if text else ""}
                out.append(own | {"doc_id": doc_id})
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in types.items()], list(types))

    return run


def dedup_units(docs: DataFrame, kind: str = "sentence", least_words: int = UNIT_WORDS, line_words: int = LINE_WORDS, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """Remove what occurs earlier, by (doc_id, start), in this or another row of ``docs(doc_id, text)``.

    Units are sentences, lines or paragraphs of ``least_words`` words or more, compared in lower case by their words alone,
    so neither punctuation nor other line ends hide a copy. Of the units that stand elsewhere before, those go that make up
    a whole line of ``line_words`` words or more, and those in a passage: a run of them, with nothing but shorter units
    between, of ``passage_words`` words or more in all. A shorter repeat inside a line is common speech and stays. What is
    too short to compare goes where the units on both sides go.

    Returns for every row ``(doc_id, text, n_removed, n_passages, passage_words, removed, kept_spans)``: the remaining text,
    the units that went, the passages and their words, ``removed`` as ``start:end:doc_id of the earliest copy`` of each
    unit, and ``kept_spans`` as ``start:end`` of the stretches that the remaining text joins, in code points of the original.

    Null text stays null; a null doc_id ranks after all others; rows that repeat both doc_id and text count once and get the
    same result; an empty table gives no rows. A hot unit meets as partial minima, and its rows join as a sort-merge join
    that adaptive execution splits. No step holds more than one document's units.
    """
    docs = columns(docs, doc_id="long", text="string").withColumn("row_hash", F.xxhash64("text"))
    found = stored(docs.mapInArrow(_digests(kind, least_words), "doc_id long, row_hash long, high long, low long, start long"), "units")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash", "start")
    first = found.groupBy("high", "low").agg(F.min(place).alias("first"), F.max(place).alias("other")).where("first <> other").select("high", "low", "first")
    first = stored(first, "first")  # a table of its own, so adaptive execution can split the rows of a hot unit
    again = found.join(first, ["high", "low"]).where(place != F.col("first"))
    again = again.groupBy("doc_id", "row_hash").agg(F.collect_set(F.struct("start", F.col("first.doc_id").alias("first_doc_id"))).alias("repeated"))
    again = again.select(F.col("doc_id").alias("d"), F.col("row_hash").alias("r"), "repeated")
    both = docs.join(again, docs["doc_id"].eqNullSafe(again["d"]) & (docs["row_hash"] == again["r"]), "left").select("doc_id", "text", "repeated")
    return both.mapInArrow(_cut_all(kind, least_words, line_words, passage_words), "doc_id long, text string, n_removed long, n_passages long, passage_words long, removed string, kept_spans string")


def op10_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_units(table(spark, sf_dir, "documents"))


ORACLE = {
    "op10_unit_dedup": rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(regexp_replace(coalesce(text, ''), '([.!?])[\t\f\r ]', '\1' || chr(10), 'g'), chr(10)) AS u FROM documents
), units AS (
  SELECT doc_id, t, unnest(u) AS unit, unnest(range(1, len(u) + 1)) AS i FROM texts
), placed AS (
  SELECT *, sum(length(unit) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(unit) - 1 AS s, regexp_extract_all(lower(unit), '[0-9a-z\x{{80}}-\x{{10ffff}}]+') AS w FROM units
), lined AS (
  SELECT *, len(w) AS n, s + length(unit) AS e, coalesce(sum(CASE WHEN substr(t, (s + length(unit) + 1)::BIGINT, 1) = chr(10) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line FROM placed
), told AS (
  SELECT *, first_value(doc_id) OVER k AS first_doc, row_number() OVER k > 1 AS again FROM lined WHERE n >= {UNIT_WORDS}
  WINDOW k AS (PARTITION BY w ORDER BY doc_id, s)
), runs AS (
  SELECT *, sum(CASE WHEN again THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run,
    bool_and(again) OVER (PARTITION BY doc_id, line) AND sum(n) OVER (PARTITION BY doc_id, line) >= {LINE_WORDS} AS whole_line FROM told
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id, run, again) AS run_words FROM runs
), judged AS (
  SELECT *, again AND run_words >= {PASSAGE_WORDS} AS passage, again AND (whole_line OR run_words >= {PASSAGE_WORDS}) AS gone FROM summed
), spread AS (
  SELECT l.doc_id, l.i, l.s, l.e, l.t, coalesce(j.gone, coalesce(last_value(j.gone IGNORE NULLS) OVER before AND first_value(j.gone IGNORE NULLS) OVER after, FALSE)) AS out
  FROM lined l LEFT JOIN judged j USING (doc_id, i)
  WINDOW before AS (PARTITION BY l.doc_id ORDER BY l.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), after AS (PARTITION BY l.doc_id ORDER BY l.i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
), islands AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM spread WHERE NOT out
), kept AS (
  SELECT doc_id, min(s)::BIGINT AS a, least(max(e) + 1, length(any_value(t)))::BIGINT AS b, any_value(t) AS t FROM islands GROUP BY doc_id, island
), left_over AS (
  SELECT doc_id, string_agg(substr(t, a + 1, b - a), '' ORDER BY a) AS text, string_agg(a || ':' || b, ',' ORDER BY a) FILTER (b > a) AS kept_spans FROM kept GROUP BY doc_id
), lost AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(DISTINCT run) FILTER (passage) AS n_passages, coalesce(sum(n) FILTER (passage), 0)::BIGINT AS passage_words,
    coalesce(string_agg(s::BIGINT || ':' || e::BIGINT || ':' || first_doc, ',' ORDER BY i) FILTER (gone), '') AS removed FROM judged GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(left_over.text, '') END AS text, coalesce(n_removed, 0) AS n_removed, coalesce(n_passages, 0) AS n_passages,
  coalesce(passage_words, 0) AS passage_words, coalesce(removed, '') AS removed, coalesce(kept_spans, '') AS kept_spans
FROM documents d LEFT JOIN left_over USING (doc_id) LEFT JOIN lost USING (doc_id)
""",
}
