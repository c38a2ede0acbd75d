"""Cuts of long plans: a table is written once to the shared folder and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one is made only where none is set in a local session, as executors elsewhere can't read it."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="meshloom-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The same rows from Parquet files in the shared folder.

    Kernels whose result several later steps read run once this way, and survive lost executors.
    """
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
