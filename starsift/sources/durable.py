"""Cutting lineage into durable storage.

Iterative fits read their input many times. Checkpoints go to the shared folder
the cluster names in ``spark.checkpoint.dir``, so they survive lost executors.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; outside a cluster a temporary one is set if none is named."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Compute once, store reliably, and continue from the stored rows."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def folder(spark: SparkSession, name: str) -> str:
    """A new place in the checkpoint folder."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the checkpoint folder and read it back: computed once, where ``checkpoint`` computes twice."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
