"""Folders for intermediate tables, checkpoints and stream state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder; elsewhere that would lose data with an executor.
    """
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="medvoice-")
    spark.conf.set(SETTING, root)
    context.setCheckpointDir(root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Compute a table once, into the shared folder, and return it read from there.

    For results used several times whose plan Spark would otherwise run again:
    what is written survives the loss of executors, and its real size is known
    when the joins after it are planned.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def spread(df: DataFrame) -> DataFrame:
    """Spread a table over all cores if it arrives in fewer parts than there are cores.

    For heavy work per row on small or badly cut files. A table with more parts,
    as any large one has, is returned as it is, without a shuffle. Meant for
    tables read from files: asking a plan with shuffles for its parts runs them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
