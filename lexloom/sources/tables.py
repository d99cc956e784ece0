"""Parquet tables of a corpus folder. Scans stay lazy, so filters and columns reach the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


FEW = 16


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if its files make only a FEW partitions or less, fewer than there are cores (a single
    small file would leave the others idle); larger inputs stay as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < min(cores, FEW) else df
