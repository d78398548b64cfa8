"""Cutting lineage into the folder the cluster names."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use `spark.checkpoint.dir`; only a local session without it (tests) gets a folder of its own."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def shared_folder(spark: SparkSession) -> str:
    """The folder `spark.checkpoint.dir` names. A cluster must name one: a folder of this machine would not be shared."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="millrace-checkpoint-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
