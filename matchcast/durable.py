"""Cutting lineage through reliable storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _set_folder(spark: SparkSession) -> None:
    """Use the folder the session names; where it names none, one in the warehouse, which is shared too."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    folder = context.getCheckpointDir()
    if folder.startswith("file:") and not context.master.startswith("local"):
        _try_folder(spark, folder)


def _try_folder(spark: SparkSession, folder: str) -> None:
    """Have tasks write to a ``file:`` folder of a cluster once: it may be mounted on all machines, or be of one alone."""
    context = spark.sparkContext
    if getattr(context, "_matchcast_tried", None) == folder:
        return
    tasks = context.defaultParallelism
    try:  # Spark fails unless the driver sees what every task wrote
        spark.range(0, tasks, 1, tasks).checkpoint(eager=True)
    except Exception as unseen:
        raise RuntimeError(f"{folder} is a folder of one machine; set spark.checkpoint.dir to one all executors share") from unseen
    context._matchcast_tried = folder


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return the written rows.

    The folder is the one the session names in ``spark.checkpoint.dir``. On a cluster a ``file:``
    folder is tried first: one that all machines mount serves, a folder of one machine is an error, because
    it would not survive its loss. Spark deletes what is no longer referred to if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    _set_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    _set_folder(spark)
    return spark.sparkContext.getCheckpointDir()
