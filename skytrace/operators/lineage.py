"""Cutting lineage with reliable checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; make a local one only for a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="skytrace-checkpoints-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder now; later plans read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sized(df: DataFrame) -> DataFrame:
    """Like ``cut``, for loops: later plans also know the true size of ``df``.

    A plan cut by ``checkpoint()`` keeps its estimated size. Estimates multiply in joins, so after some
    rounds of a loop they are numbers of thousands of digits, and planning takes longer than running.
    """
    return stored(df, "sized")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet next to the checkpoints, which every executor reaches; read it back.

    Like a checkpoint it survives lost executors, but it is columnar and compressed. The files go
    with the checkpoint folder, whose retention is the cluster's.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
