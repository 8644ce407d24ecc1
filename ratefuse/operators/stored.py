"""Intermediate tables written to the shared folder of the cluster."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ratefuse-"))
    return context.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several later steps read, and read it back.

    The steps behind it start from files: nothing is computed twice, each step reads
    only its columns, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
