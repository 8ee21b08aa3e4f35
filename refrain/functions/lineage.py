"""Cutting lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and forget its lineage.

    The folder is the cluster's ``spark.checkpoint.dir``. A local session without
    one (a test) gets a temporary folder; a cluster's must name it.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="refrain-"))
    return df.checkpoint()
