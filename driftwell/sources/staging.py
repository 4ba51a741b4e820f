"""Cutting lineage with tables in the cluster's shared folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the cluster set it, or a folder below the warehouse.

    A warehouse on a machine's own disk will do for local mode only; on a cluster it is refused, since executors would not
    see each other's files.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    below = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/driftwell-staging"
    if store(spark, below)[0].getScheme() == "file" and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return below


def fresh_path(spark: SparkSession, name: str = "table") -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/driftwell-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """df as written Parquet: computed once, readable by every executor, safe from lost ones."""
    path = fresh_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(spark: SparkSession, path: str):
    """The file system of a path, and the path as that system knows it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, root: str, name: str = "version") -> list[int]:
    """Numbers of the folders name=N that are there, in order. Only folder names are read."""
    fs, path = store(spark, root)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{name}="))
