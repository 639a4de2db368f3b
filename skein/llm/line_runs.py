"""Line dedup: repeated runs of lines, found by prefix doubling over line-ID sequences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import carried, carry, columns, discard, stored, table

#: Lines of a run that is looked for, and words from which a line that repeats is a run by itself.
LEAST_LINES, LONG_LINE = 2, 50
PLACE = ["doc_id", "row_hash", "pos"]


def _ranked(classes: DataFrame, *key: str) -> DataFrame:
    """``classes`` with ``rank``: longs in the order of ``key``, which is unique, after a global sort by range."""
    return stored(classes.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("rank", F.monotonically_increasing_id()), "ranks")


def suffix_levels(docs: DataFrame, long_line: int) -> list[DataFrame]:
    """For the depths 1, 2, 4, ... the suffixes ``(doc_id, row_hash, pos, rank, fd, fr, fp)`` of the line sequences of
    ``docs(doc_id, row_hash, text)`` that share their first ``depth`` lines with another one.

    Suffixes are sorted by their first line, then by twice as many lines a round: the key of a round is the rank of
    a suffix and the rank of the one ``depth`` lines on. Equal keys are an interval of the suffix array whose longest
    common prefix has that depth at least, and ``fd, fr, fp`` is its earliest member. An interval of one is final and drops
    out, so each round carries only what still repeats; doubling ends when no interval is left, after as many rounds as the
    binary digits of the longest repeated run. The first table also has ``line_no`` and whether the line is ``long``.
    """
    split = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("line_no"), F.rtrim(x).alias("line")))
    lines = docs.select("doc_id", "row_hash", F.posexplode(F.filter(split, lambda x: F.trim(x["line"]) != "")).alias("pos", "x"))
    words = F.size(F.split(F.trim("x.line"), "[\\t ]+"))
    lines = lines.select(*PLACE, F.col("x.line_no").alias("line_no"), (words > long_line).alias("long"), F.xxhash64("x.line").alias("a"), F.xxhash64(F.lit(1), F.col("x.line")).alias("b"))
    lines = stored(lines, "lines")
    place = F.struct(*PLACE)

    def level(rows: DataFrame, *key: str, repeated: bool = False) -> DataFrame:
        classes = rows.groupBy(*key).agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
        ranks = _ranked(classes, *key)
        out = rows.join(ranks, list(key)).drop(*key)
        out = out.select("*", *[F.col(f"first.{c}").alias(n) for c, n in zip(PLACE, ("fd", "fr", "fp"), strict=True)]).drop("first")
        out = stored(out.dropDuplicates(PLACE) if repeated else out, "suffixes")
        discard(ranks)
        return out

    depth, levels = 1, [level(lines, "a", "b", repeated=True)]  # rows may repeat
    discard(lines)
    while True:
        now = levels[-1]
        ahead = now.select("doc_id", "row_hash", (F.col("pos") - depth).alias("pos"), F.col("rank").alias("next"))
        pairs = stored(now.select(*PLACE, F.col("rank").alias("own")).join(ahead, PLACE), "pairs")
        longer = level(pairs, "own", "next")
        discard(pairs)
        if longer.isEmpty():
            discard(longer)
            return levels
        levels.append(longer)
        depth *= 2


def later_copies(levels: list[DataFrame], least_lines: int) -> DataFrame:
    """The maximal later copies ``(doc_id, row_hash, pos, size, fd, fr, fp)``: lines ``pos`` to ``pos + size - 1`` stand at
    ``(fd, fr, fp)`` before.

    A suffix that is not the earliest of its interval at some depth is a later copy. Of its deepest such interval the
    earliest member is its first copy, and their longest common prefix, less than twice that depth, is put together from the
    shallower levels: it grows by each depth, from the greatest on, at which both rest on one interval. Where a copy would
    overlap its first copy it ends before. Copies of ``least_lines`` lines, or of one long line, count; one that the copy
    a line before holds whole, of the same first copy, is not maximal.
    """
    later = [x.where("doc_id <> fd OR row_hash <> fr OR pos <> fp").select(*PLACE, F.struct(F.lit(k).alias("level"), "fd", "fr", "fp").alias("x")) for k, x in enumerate(levels)]
    top = reduce(DataFrame.union, later).groupBy(*PLACE).agg(F.max("x").alias("x"))
    runs = stored(top.select(*PLACE, "x.*", F.expr("shiftleft(1L, x.level)").alias("size")), "copies")
    for k in reversed(range(len(levels) - 1)):
        ranks = levels[k].select(*PLACE, "rank")
        own = ranks.select("doc_id", "row_hash", F.col("pos").alias("at"), F.col("rank").alias("own"))
        other = ranks.select(F.col("doc_id").alias("fd"), F.col("row_hash").alias("fr"), F.col("pos").alias("fat"), F.col("rank").alias("other"))
        open_ = runs.where(F.col("level") > k).withColumn("at", F.col("pos") + F.col("size")).withColumn("fat", F.col("fp") + F.col("size"))
        grown = open_.join(own, ["doc_id", "row_hash", "at"], "left").join(other, ["fd", "fr", "fat"], "left")
        size = F.col("size") + F.when(F.col("own") == F.col("other"), 1 << k).otherwise(0)
        grown = stored(grown.select(*PLACE, "level", "fd", "fr", "fp", size.alias("size")).union(runs.where(F.col("level") <= k).select(*PLACE, "level", "fd", "fr", "fp", "size")), "copies")
        discard(runs)
        runs = grown
    apart = F.when((F.col("doc_id") == F.col("fd")) & (F.col("row_hash") == F.col("fr")), F.col("pos") - F.col("fp"))
    runs = runs.withColumn("size", F.least("size", apart))  # a null apart is passed over
    if least_lines > 1:
        alone = levels[0].where("long").select(*PLACE).withColumn("alone", F.lit(True))
        runs = runs.join(alone, PLACE, "left").where((F.col("size") >= least_lines) | F.col("alone"))
        runs = runs.withColumn("size", F.when(F.col("size") >= least_lines, F.col("size")).otherwise(1))
    before = Window.partitionBy("doc_id", "row_hash").orderBy("pos")
    held = F.lag(F.struct("pos", "fd", "fr", "fp", "size")).over(before)
    inside = (held["pos"] == F.col("pos") - 1) & (held["fd"] == F.col("fd")) & (held["fr"] == F.col("fr")) & (held["fp"] == F.col("fp") - 1) & (held["size"] > F.col("size"))
    return stored(runs.withColumn("inside", F.coalesce(inside, F.lit(False))).where("NOT inside").select(*PLACE, "size", "fd", "fr", "fp"), "runs")


def _lines_of(runs: DataFrame, *start: str) -> DataFrame:
    own = runs.select(*[F.col(c).alias(n) for c, n in zip(start, ("doc_id", "row_hash", "at"), strict=True)], "size").distinct()
    return own.select("doc_id", "row_hash", F.explode(F.sequence(F.col("at"), (F.col("at") + F.col("size") - 1).cast("int"))).alias("pos")).distinct()


def dedup_line_runs(docs: DataFrame, least_lines: int = LEAST_LINES, long_line: int = LONG_LINE) -> DataFrame:
    """Delete from ``docs(doc_id, text)`` the later copies of every repeated run of ``least_lines`` lines or more, or of one
    line of more than ``long_line`` words.

    Lines are compared without trailing blanks; blank lines take no part and stay where they are. Runs are the maximal ones
    of :func:`later_copies`. The first copy of a run, by (doc_id, position), stays whole, even where it shares lines with
    a later copy of another run; every other line of a later copy goes. Returns for every row ``(doc_id, text, n_lines,
    n_removed, n_runs, longest_run)``: the remaining text, its lines that are not blank, how many of them went, its
    maximal later copies and the lines of the longest one.

    Null text stays null and has no lines; rows without doc_id are left as they are; rows that repeat both doc_id and text
    count once and get the same result; an empty table gives no rows. A hot line meets as a partial aggregate, and joins
    on it are sort-merge joins that adaptive execution splits.
    """
    return _cut(columns(docs, doc_id="long", text="string"), least_lines, long_line).select("doc_id", "text", "n_lines", "n_removed", "n_runs", "longest_run")


def without_line_runs(docs: DataFrame, least_lines: int = LEAST_LINES, long_line: int = LONG_LINE) -> DataFrame:
    """The rows of ``docs``, with all their columns, without the later copies of repeated runs of lines; ``n_chars``
    follows the text. Rows of which nothing but blank lines is left are copies from end to end and go."""
    out = _cut(carry(docs, doc_id="long", text="string"), least_lines, long_line)
    out = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    changed = F.col("n_removed") > 0
    low = [n.lower() for n in docs.columns]
    n_chars = {"n_chars": F.when(changed, F.length("text")).otherwise(F.col(f"_c{low.index('n_chars')}"))} if "n_chars" in low else {}
    return carried(out, docs, text=F.col("text"), **n_chars)


def _cut(docs: DataFrame, least_lines: int, long_line: int) -> DataFrame:
    rest = docs.columns[2:]
    docs = docs.withColumn("row_hash", F.xxhash64("text"))
    levels = suffix_levels(docs.select("doc_id", "row_hash", "text").where("doc_id IS NOT NULL"), long_line)
    runs = later_copies(levels, least_lines)
    gone = _lines_of(runs, *PLACE).join(_lines_of(runs, "fd", "fr", "fp"), PLACE, "left_anti")
    gone = levels[0].join(gone, PLACE, "left_semi").groupBy("doc_id", "row_hash").agg(F.collect_set("line_no").alias("gone"))
    told = runs.groupBy("doc_id", "row_hash").agg(F.count("*").alias("n_runs"), F.max("size").cast("long").alias("longest_run"))
    hit = stored(told.join(gone, ["doc_id", "row_hash"], "left"), "hit")
    discard(*levels, runs)
    # a merge join at any size: what goes grows with the corpus and must not be broadcast
    out = docs.join(hit.hint("merge"), ["doc_id", "row_hash"], "left").withColumn("l", F.split("text", "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size("l") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get("l", i)), "\n"))
    n = F.coalesce(F.size(F.filter("l", lambda x: F.trim(x) != "")), F.lit(0))
    zero = F.lit(0).cast("long")
    return out.select("doc_id", text.alias("text"), *rest, F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"), F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_runs", zero).alias("n_runs"), F.coalesce("longest_run", zero).alias("longest_run"))


def op6_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_line_runs(table(spark, sf_dir, "documents"))


def _oracle(depths: list[int]) -> str:
    """Every run of a power of two of lines is spelt out and counted; the first copy of the longest later one of a place is
    then compared with it line by line."""
    windows = " UNION ALL ".join(
        f"SELECT doc_id, pos, {d} AS d, first_value({{'doc_id': doc_id, 'pos': pos}}) OVER w AS f, row_number() OVER w AS rn FROM seq WHERE pos + {d} <= len(ids) WINDOW w AS (PARTITION BY ids[pos + 1 : pos + {d}] ORDER BY doc_id, pos)"
        for d in depths
    )
    return rf"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS full_line, unnest(range(0, len(string_split(text, chr(10))))) AS line_no FROM documents
), told AS (
  SELECT doc_id, line_no, rtrim(full_line) AS line, len(string_split_regex(trim(full_line), '[\t ]+')) > {LONG_LINE} AS long,
    row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS pos, dense_rank() OVER (ORDER BY rtrim(full_line)) AS id FROM raw WHERE trim(full_line) <> ''
), lists AS (
  SELECT doc_id, list(id ORDER BY pos) AS ids FROM told GROUP BY doc_id
), seq AS (
  SELECT told.*, ids FROM told JOIN lists USING (doc_id)
), later AS (
  SELECT doc_id, pos, max(d) AS d, max_by(f, d) AS f FROM ({windows}) WHERE rn > 1 GROUP BY doc_id, pos
), matched AS (
  SELECT l.doc_id, l.pos, l.f, l.d, a.ids AS x, b.ids AS y, least(len(a.ids) - l.pos, len(b.ids) - l.f.pos, 2 * l.d) AS most
  FROM later l JOIN lists a ON a.doc_id = l.doc_id JOIN lists b ON b.doc_id = l.f.doc_id
), sized AS (
  SELECT doc_id, pos, f, least(coalesce(list_position(list_transform(range(1, most + 1), lambda k: x[pos + k] = y[f.pos + k]), FALSE) - 1, most), CASE WHEN f.doc_id = doc_id THEN pos - f.pos ELSE most END) AS size FROM matched
), counted AS (
  SELECT s.doc_id, s.pos, s.f, CASE WHEN s.size >= {LEAST_LINES} THEN s.size ELSE 1 END AS size FROM sized s JOIN told USING (doc_id, pos) WHERE s.size >= {LEAST_LINES} OR long
), runs AS (
  SELECT c.* FROM counted c LEFT JOIN counted p ON p.doc_id = c.doc_id AND p.pos = c.pos - 1 AND p.f.doc_id = c.f.doc_id AND p.f.pos = c.f.pos - 1 AND p.size > c.size WHERE p.pos IS NULL
), copies AS (SELECT DISTINCT doc_id, pos + unnest(range(0, size)) AS pos FROM runs),
firsts AS (SELECT DISTINCT f.doc_id AS doc_id, f.pos + unnest(range(0, size)) AS pos FROM runs),
gone AS (SELECT doc_id, line_no FROM told SEMI JOIN copies USING (doc_id, pos) ANTI JOIN firsts USING (doc_id, pos)),
stats AS (SELECT doc_id, count(*) AS n_runs, max(size)::BIGINT AS longest_run FROM runs GROUP BY doc_id)
SELECT doc_id,
  CASE WHEN any_value(documents.text) IS NULL THEN NULL ELSE coalesce(string_agg(raw.full_line, chr(10) ORDER BY raw.line_no) FILTER (gone.line_no IS NULL), '') END AS text,
  count(*) FILTER (trim(raw.full_line) <> '') AS n_lines,
  count(gone.line_no) AS n_removed,
  coalesce(any_value(n_runs), 0) AS n_runs,
  coalesce(any_value(longest_run), 0) AS longest_run
FROM documents LEFT JOIN raw USING (doc_id) LEFT JOIN gone USING (doc_id, line_no) LEFT JOIN stats USING (doc_id)
GROUP BY doc_id
"""


ORACLE = {"op6_line_runs": _oracle([1 << k for k in range(13)])}
