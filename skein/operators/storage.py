"""Intermediate tables, written once where all executors read them."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame


def settled(df: DataFrame, root: str | None = None) -> DataFrame:
    """``df`` written as Parquet below ``root`` or the folder of ``spark.checkpoint.dir`` and read back, so plans stay
    small and a lost executor costs nothing. Where neither is set, local mode alone falls back on a temporary folder."""
    spark = df.sparkSession
    root = root or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), f"skein-{os.getuid()}")
    path = f"{root.rstrip('/')}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
