"""Loading the driver's parquet tables (column-pruned, filter-pushed reads)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# tables whose rows carry long texts: per-row work is CPU-heavy
TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer partitions than there are cores.

    A parquet file with one row group is read by one task however many cores
    there are; the text work that follows (regex n-grams, tokenising) would
    then run single-threaded.  A scan with at least as many partitions as
    cores (the normal case on a cluster) is returned unchanged, with no
    shuffle.  Column pruning and filters still reach the scan below the
    round-robin repartition."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if name in TEXT_TABLES else df
