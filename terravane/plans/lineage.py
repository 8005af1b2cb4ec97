"""Cutting lineage in iterative plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df as a written table in the shared folder (spark.checkpoint.dir; a local master gets a new one where that is unset)."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = found.get() if found.isDefined() else None
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='terravane-')}"
        spark.sparkContext.setCheckpointDir(folder)
    path = f"{folder.rstrip('/')}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
