"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, carry, columns, slices, stored, table

#: n-grams that a profile keeps, which is also the distance of one that it lacks.
PROFILE = 400
UNDETERMINED = "und"
#: Score under which a text is of none of the languages: held-out documents have 0.42 at least, random letters 0.19 at most.
LEAST = 0.25
#: Languages that profiles are learnt of at most.
LANGUAGES = 10_000
#: Documents of one in so many remainders of crc32(doc_id) are held out.
FOLDS = 5
GRAMS_AT_ONCE = 2_000_000
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes, ascending, and counts of a text's n-grams of one to three lower-case letters; whatever parts words is one mark, in n-grams of two at either end and of three at an outer place."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[points]
    marks = np.ones(len(points) + 2, np.int64)
    marks[1:-1][letter] = points[letter]
    full = marks != 1
    marks = marks[np.concatenate(([True], full[1:] | full[:-1]))]
    if len(marks) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    two = (marks[:-1] << 21) | marks[1:]
    three = (two[:-1] << 21) | marks[2:]
    codes = np.sort(np.concatenate((marks[marks != 1], two, three[marks[1:-1] != 1])))
    at = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[at], np.diff(np.append(at, len(codes)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged() -> None:
        for lang, parts in held.items():
            codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            held[lang] = [(codes, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64))]

    def rows() -> Iterator[pa.RecordBatch]:
        merged()
        for lang, [(codes, counts)] in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], ["lang", "code", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            found = ngrams(text.as_py())
            held.setdefault(lang, []).append(found)
            size += len(found[0])
            if size > GRAMS_AT_ONCE:
                merged()
                size = sum(len(p[0][0]) for p in held.values())
                if size > GRAMS_AT_ONCE // 2:
                    yield from rows()
                    size = 0
    if held:
        yield from rows()


def learn(docs: DataFrame, profile: int = PROFILE) -> dict[str, list[int]]:
    """The ``profile`` most frequent n-grams of each language in ``docs(text, lang)``, most frequent first, ties by code.

    Counts cover every row with a language. What comes to the driver is ``profile`` codes for each language; more than
    LANGUAGES of them are refused, as ``lang`` then holds something else.
    """
    grams = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").mapInArrow(_count, "lang string, code long, n long")
    grams = grams.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = stored(grams.withColumn("place", place).where(F.col("place") <= profile).select("lang", "code", "place"), "profiles")
    if top.select("lang").distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"lang has more than {LANGUAGES} values")
    out: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "place").collect():
        out.setdefault(r["lang"], []).append(r["code"])
    return out


def distances(text: str | None, codes: np.ndarray, ranks: np.ndarray, profile: int = PROFILE) -> np.ndarray | None:
    """Mean out-of-place distance, from 0 to 1, of a text's most frequent n-grams to each profile; None without letters."""
    found, counts = ngrams(text)
    if not len(found):
        return None
    top = found[np.argsort(-counts, kind="stable")[:profile]]
    where = np.minimum(np.searchsorted(codes, top), max(len(codes) - 1, 0))
    own = np.arange(len(top))[:, None]
    away = np.where((codes[where] == top)[:, None], np.minimum(np.abs(ranks[where] - own), profile), profile)
    return away.sum(axis=0) / (profile * len(top))


def _predict(profiles: dict[str, list[int]], profile: int):
    names = sorted(profiles)
    codes = np.array(sorted({c for x in profiles.values() for c in x}), np.int64)
    ranks = np.full((len(codes), len(names)), 2 * profile, np.int64)
    for k, name in enumerate(names):
        ranks[np.searchsorted(codes, np.array(profiles[name], np.int64)), k] = np.arange(len(profiles[name]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole)):
            said, score = [], []
            for text in batch.column("text"):
                away = distances(text.as_py(), codes, ranks, profile) if names else None
                said.append(UNDETERMINED if away is None else names[int(away.argmin())])
                score.append(0.0 if away is None else float(1 - away.min()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c not in ("lang_pred", "score")), pa.array(said, pa.string()), pa.array(score, pa.float64())], [*(c for c in batch.schema.names), "lang_pred", "score"])

    return run


def identify(docs: DataFrame, profiles: dict[str, list[int]], profile: int = PROFILE) -> DataFrame:
    """``docs(doc_id, text)`` with ``lang_pred``, the language whose profile is nearest (ties: the first by name), and
    ``score``, one less its mean out-of-place distance. Null text, text without a letter and an empty set of profiles
    give ``und`` and 0. Nothing but the text is looked at; every row gets a row."""
    docs = columns(docs, doc_id="long", text="string")
    return docs.mapInArrow(_predict(profiles, profile), "doc_id long, text string, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text has letters and is no further from every language than
    1 - ``least``. The profiles are learnt from the rows of ``docs`` that are not held out; where these have no language,
    nothing tells the texts apart and all that have letters stay."""
    seen = columns(docs, doc_id="long", text="string", lang="string")
    own = carry(docs, text="string")
    profiles = learn(seen.where(~held_out()))
    if not profiles:
        return carried(own.where(F.col("text").rlike(r"\p{L}")), docs)
    said = own.mapInArrow(_predict(profiles, PROFILE), T.StructType([*own.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    return carried(said.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)), docs)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns(table(spark, sf_dir, "documents"), doc_id="long", text="string", lang="string")
    profiles = learn(docs.where(~held_out()))
    return identify(docs, profiles).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
