"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import chat, language, leaks, line_runs, near_dups, neighbours, packing, pii, pseudo_likelihood, units

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_chat": chat.op2_chat,
    "op3_near_duplicates": near_dups.op3_near_duplicates,
    "op4_pseudo_likelihood": pseudo_likelihood.op4_pseudo_likelihood,
    "op5_neighbours": neighbours.op5_neighbours,
    "op6_line_runs": line_runs.op6_line_runs,
    "op7_packing": packing.op7_packing,
    "op8_leaks": leaks.op8_leaks,
    "op9_language": language.op9_language,
    "op10_unit_dedup": units.op10_unit_dedup,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = pii.ORACLE | near_dups.ORACLE | line_runs.ORACLE | units.ORACLE
