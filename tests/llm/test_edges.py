"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from skein.llm import chat, language, leaks, line_runs, near_dups, neighbours, packing, pii, pseudo_likelihood, units

LONG = " ".join(random.Random(1).choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60_000))
ROWS = [(1, "one two three four five six\nseven eight nine ten eleven twelve", "en"), (2, None, "en"), (3, "", None), (4, "   \n\t ", "fr"), (5, LONG, "en"), (6, "one two three four five six\nseven eight nine ten eleven twelve", "en"), (6, "one two three four five six\nseven eight nine ten eleven twelve", "en"), (None, "one two three four five six\nseven eight nine ten eleven twelve", None), (7, "x", "fr"), (8, "¿qué? 12 +34 600 000 000", "es")]
KIND = "doc_id long, text string, lang string"


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "s", 1) for r in rows], KIND + ", source string, n_chars long")


def clashing(spark, rows=ROWS):
    """Columns that operators use inside, and one whose name differs in case alone."""
    out = documents(spark, rows).select("*", *[F.lit("x").alias(c) for c in ("rep", "row_hash", "share", "component_id", "pos", "shard", "TEXT", "high", "lang_pred", "findings", "l")])
    return out


OPERATORS = {
    "pii": lambda d, b: pii.find_pii(d),
    "near_dups": lambda d, b: near_dups.near_duplicates(d),
    "likelihood": lambda d, b: pseudo_likelihood.score_documents(d, steps=3),
    "line_runs": lambda d, b: line_runs.dedup_line_runs(d),
    "leaks": lambda d, b: leaks.find_leaks(d, b),
    "language": lambda d, b: language.identify(d, {"en": [97, 98], "fr": [99]}),
    "units": lambda d, b: units.dedup_units(d),
    "paragraphs": lambda d, b: units.dedup_units(d, "paragraph"),
}


def items(spark, rows=((1, "seven eight nine ten eleven twelve"), (2, None), (3, ""), (None, "a b"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(spark, name):
    for docs in (documents(spark), clashing(spark)):
        out = OPERATORS[name](docs, items(spark)).collect()
        assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](documents(spark, []), items(spark, [])).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_all_null(spark, name):
    assert OPERATORS[name](documents(spark, [(None, None, None)] * 2), items(spark)).count() == 2


def test_packing_edges(spark):
    for docs in (documents(spark), clashing(spark)):
        out = packing.pack(docs, window=64).toPandas()
        assert out.groupby(["sequence_id"])["length"].sum().max() <= 64
        whole = out.groupby(out["doc_id"].fillna(-1)).agg(n=("length", "sum"), d=("doc_tokens", "max"))
        assert (whole["n"][whole.index != 6] == whole["d"][whole.index != 6]).all() and whole["n"][6] == 2 * whole["d"][6]
        assert whole["n"][2] == whole["n"][3] == 1
    assert packing.pack(documents(spark, [])).count() == 0


def test_neighbour_edges(spark):
    kind = "vec_id long, embedding array<float>, label int, rank string, dims string"
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (1, None), (None, [1.0, 1.0]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [None, 1.0]), (5, []), (6, [1.0, 0.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 2.0, 3.0]), (40, [-1.0, 0.5])]
    out = neighbours.nearest(spark.createDataFrame([(*r, 0, "x", "x") for r in rows], kind)).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out] == [(0, 1, 6, 1.0), (0, 2, 7, 1.0), (0, 3, 7, 1.0), (0, 4, 40, -1.0), (40, 1, 0, -1.0), (40, 2, 6, -1.0), (40, 3, 7, -1.0), (40, 4, 7, -1.0)]
    assert neighbours.nearest(spark.createDataFrame([], kind)).count() == 0


def test_chat_edges(spark):
    rows = [Row(conv_id=1, turn=0, role="user", text="hi"), Row(conv_id=1, turn=0, role="user", text="hi"), Row(conv_id=None, turn=1, role=None, text=None), Row(conv_id=2, turn=None, role="robot", text=""), Row(conv_id=2, turn=1, role="assistant", text="User: a\nAssistant: b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    model = chat.learn(turns)
    out = chat.format_chats(turns.withColumn("piece", F.lit(1)).withColumn("said", F.lit("x")), model).collect()
    assert len(out) == 6
    assert [(r["role"], r["text"]) for r in sorted(out, key=lambda r: r["segment"]) if r["conv_id"] == 2 and r["turn"] == 1] == [("user", "a"), ("assistant", "b")]
    assert chat.format_chats(turns.where("false"), chat.learn(turns.where("false"))).count() == 0


def test_stages_keep_columns(spark, tmp_path):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (documents(spark), documents(spark, []), documents(spark).withColumn("rep", F.lit(1)).withColumn("share", F.lit(1))):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            out.count()
    kept = {n: {r["doc_id"] for r in f(spark, documents(spark), str(tmp_path)).collect()} for n, f in corpus_pipeline.STAGES[:-1]}
    assert kept["language"] == {1, 5, 6, None, 7, 8}
    assert kept["line_dedup"] == {1, 2, 3, 4, 5, None, 7, 8}
    assert kept["near_dedup"] == {1, 2, 3, 4, 5, None, 7, 8}
    assert kept["decontamination"] == {2, 3, 4, 5, 7, 8}
