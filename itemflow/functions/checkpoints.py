"""Reliable checkpoints: results that survive the loss of an executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    It is the one the cluster names in ``spark.checkpoint.dir``; without that
    setting it is one inside the warehouse, which has to be shared as well.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/_checkpoints")
    return context.getCheckpointDir()


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame read back from the checkpoint folder of the session."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def stored(frame: DataFrame) -> DataFrame:
    """The frame, written once as Parquet to the checkpoint folder and read back.

    For rows that are read several times, each time a few columns of them. The folder
    belongs to the run; whoever named it clears it afterwards.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/rows-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
