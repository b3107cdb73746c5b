"""The driver's tables, and the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a folder of this machine in local mode; a cluster has to name one."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    have = context._jsc.sc().getCheckpointDir()
    if not found and have.isDefined():
        found = have.get()
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quillgate-")
    if not have.isDefined():
        context.setCheckpointDir(found)
    return found.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df without its lineage, in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
