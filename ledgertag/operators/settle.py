"""Cutting the plan of a relation that is used several times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where it is unset, as in local sessions, a folder in the session's warehouse
    stands in; on a cluster the folder must be named.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there.

    What is measured must be what is broadcast, so rules are always frozen before.
    Checkpoints are files in the folder the cluster names, so they outlive lost
    executors.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
