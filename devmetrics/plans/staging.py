"""Cutting lineage between two uses of an expensive intermediate result."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Spark's own setting; a query takes it from the session where its DataFrame is made.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, so that data outlives any executor.

    A temporary folder is used only where the setting is absent and the session is local.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="devmetrics-checkpoint-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is made and run herein removes its shuffle files as it ends.

    Else they stay until the driver happens to collect its garbage. A DataFrame
    made herein and run again computes them again.
    """
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


def stage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and read it from there; its shuffles are removed."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    with shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint()
