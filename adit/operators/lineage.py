"""Cutting the lineage of results that are read several times."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The application's folder that driver and executors share: under the session's ``spark.checkpoint.dir``.

    Only on a single machine (as in tests) may that be unset; a temporary folder then takes its place.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="adit-checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df``, written to and read from the folder that driver and executors share."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
