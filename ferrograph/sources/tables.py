"""Parquet table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Table ``name`` of the directory; with ``cols``, only those columns reach the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def spread(df: DataFrame, per_core: int = 1) -> DataFrame:
    """Round-robin a scan over the cores when it has fewer partitions than the cluster has cores.

    A table of many files keeps its own partitions and nothing is shuffled; only an input of one or two
    row groups, which one task would otherwise read and compute alone, is spread.
    """
    want = df.sparkSession.sparkContext.defaultParallelism * per_core
    return df.repartition(want) if df.rdd.getNumPartitions() < want // 2 else df
