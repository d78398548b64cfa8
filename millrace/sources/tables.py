"""Parquet tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read `<sf_dir>/<name>.parquet`; columns and filters are pruned by the scan.

    With `spread`, a table of fewer scan tasks than the cluster has cores is dealt out over the
    cores first, for work that is heavy per row; columns and filters still reach the scan. Large
    tables have more tasks than cores and are read as they are, without a shuffle.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if not spread:
        return df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
