"""Folders for what a job writes on its way: below the shared folder that the session names."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED = "spark.checkpoint.dir"


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI below ``spark.checkpoint.dir``.

    Where that is unset a temporary folder is used if all of Spark runs in this
    process; on a cluster, whose machines would not see it, that is a ValueError.
    """
    base = spark.conf.get(SHARED, None) or spark.sparkContext.getConf().get(SHARED)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"{SHARED} has to name a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="tallyfold-")
        spark.conf.set(SHARED, base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet and read again; cuts the lineage."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
