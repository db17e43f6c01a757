"""Session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames.  These helpers exist for tests, the bench and the entry file.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "lexis") -> SparkSession:
    """A local session tuned like the cluster one: AQE on, UI off."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or max(8, cpus * 2)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LEXIS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables: the
    cluster's ``spark.checkpoint.dir``, or what the session was given.  Only a
    plain local master (tests) gets a fresh scratch folder; on a cluster a
    missing setting is an error, since no executor sees a driver-local path."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.getCheckpointDir():
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lexis-ckpt-"))
    return sc.getCheckpointDir()


def written(df: DataFrame, name: str = "t", by: list[str] | None = None) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and
    read back: cuts lineage, is computed once, and survives lost executors.
    ``by`` names columns whose values become folders."""
    return written_at(df, name, by)[0]


def written_at(df: DataFrame, name: str = "t", by: list[str] | None = None) -> tuple[DataFrame, str]:
    """``written`` with the table's path, for ``drop_written``."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lexis-{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_written(spark: SparkSession, path: str) -> None:
    """Delete a table of ``written_at`` that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
