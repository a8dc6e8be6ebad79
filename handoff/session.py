"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("handoff")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this names a shared file system. Where it is unset a scratch folder is made for a
    local master only (tests); on any other master that is an error, because each executor would
    write to its own disk.
    """
    configured = (spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
                  or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="handoff-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return path


def reliable_checkpoint(df):
    """``df.checkpoint()`` into the shared checkpoint folder (set up on first use); eager.

    Cuts the lineage with a reliable write: survives a lost executor, unlike a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, label: str, group_bytes: int | None = None) -> DataFrame:
    """The table written once to the shared folder, and a reader of it (lineage cut; a lost executor reads it again).

    ``group_bytes`` is the size of its row groups, for tables that tasks read by parts.
    """
    path = shared_path(df.sparkSession, label)
    out = df.write if group_bytes is None else df.write.option("parquet.block.size", group_bytes)
    out.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
