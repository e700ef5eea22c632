"""Shared-folder helpers: stage tables and lineage cuts that survive a lost executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a checkpoint folder given to the running context counts, and else a folder below the
    warehouse, which all executors share too.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used, below a folder of this run."""
    run = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/{run}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet stage table in the shared folder and read it back.

    Three things follow: later readers do not recompute it, a lost executor costs a re-read rather
    than a recompute, and the optimizer sees the real file size. The last one is what makes a
    following join safe: it is broadcast only when that size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffled (with adaptive skew splitting) otherwise.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; keeps the partition layout of ``df``."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
