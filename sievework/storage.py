"""Cutting lineage with written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a local folder only where none is set."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="sievework-")
        sc.setCheckpointDir(found)
    return found


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read back: a lost executor costs no recomputation of what came before."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
