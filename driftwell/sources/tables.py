"""Parquet and CSV tables: reading, writing, snapshots, compaction."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evaluate import running
from ..operators.joins import merge_insert
from ..operators.windows import numbered
from .schemas import BRONZE
from .staging import stage, versions  # noqa: F401
from .staging import store as _files

#: Bytes that may be broadcast.
BROADCAST_BYTES = 4 << 20


def read_bronze(spark: SparkSession, root: str, table: str, foreign: bool = False) -> DataFrame:
    """A bronze table by its fixed schema; foreign=True unions the parts' own columns by name instead."""
    if foreign:
        return spark.read.option("mergeSchema", True).parquet(f"{root}/{table}")
    return spark.read.schema(BRONZE[table]).parquet(f"{root}/{table}")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", max_records: int | None = None, partition_by: Sequence[str] = ()) -> None:
    """zstd Parquet. The commit protocol makes files visible only when the whole job is done."""
    writer = df.write.mode(mode).option("compression", "zstd")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_seed(spark: SparkSession, path: str, schema: str = "causer_name string, weapon_name string, weapon_class string") -> DataFrame:
    """A curated CSV under declared types. Seeds are small by nature; the optimizer broadcasts them by their file size."""
    return spark.read.schema(schema).option("header", True).csv(path)


def materialize(df: DataFrame, name: str, kind: str = "table", path: str | None = None) -> DataFrame:
    """A table (a Parquet folder where path is given) or a temporary view."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if path:
        write_table(df, path)
        return spark.read.parquet(path)
    df.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def write_predictions(df: DataFrame, path: str, version: str) -> int:
    """Feature key, match, player, probability, label and the model's version, as the next part below path.

    A part becomes visible as a whole: a run that dies midway leaves no row. read_predictions() reads all parts.
    """
    spark, hidden = df.sparkSession, f"{path}/_writing-{uuid.uuid4().hex}"
    out = df.select("feature_sk", "match_id", "account_id", "match_start_ts", F.col("probability").alias("predicted_top_half_prob"), F.col("label").cast("int").alias("actual_top_half"), F.lit(version).alias("model_version"))
    write_table(out, hidden)
    part = max(versions(spark, path, "part"), default=-1) + 1
    publish(spark, hidden, f"{path}/part={part}")
    return part


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """All predictions, with the number of the part they came in."""
    return spark.read.parquet(path)


# ---- snapshots: a folder root/version=N for each state of a table


def publish(spark: SparkSession, written: str, final: str) -> None:
    """Give a finished folder its name, all at once: until then no reader sees any of it, and it never replaces another.

    That is one rename, atomic where the store has atomic renames.
    """
    fs, source = _files(spark, written)
    target = spark._jvm.org.apache.hadoop.fs.Path(final)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(source, target):
        raise FileExistsError(final)


def snapshot_write(df: DataFrame, root: str, kept: DataFrame | None = None) -> int:
    """Write the table's next version; earlier ones stay readable. A write that dies leaves no version behind.

    kept: paths of earlier versions' files that belong to the new version as they are.
    """
    spark = df.sparkSession
    new = max(versions(spark, root), default=-1) + 1
    hidden = f"{root}/_writing-{uuid.uuid4().hex}"
    write_table(df, f"{hidden}/version", mode="errorifexists")
    if kept is not None:
        write_table(kept.select("path"), f"{hidden}/kept", mode="errorifexists")
        publish(spark, f"{hidden}/kept", f"{root}/kept/version={new}")
    publish(spark, f"{hidden}/version", f"{root}/version={new}")
    return new


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version of the table, the newest unless one is named."""
    version = max(versions(spark, root)) if version is None else version
    fs, listed = _files(spark, f"{root}/kept/version={version}")
    paths = [r.path for r in spark.read.schema("path string").parquet(listed.toString()).collect()] if fs.exists(listed) else []  # names of files, as any scan lists them
    rows = spark.read.parquet(f"{root}/version={version}")
    return spark.read.schema(rows.schema).parquet(f"{root}/version={version}", *paths) if paths else rows


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """The rows that stay: those for which the condition is false or null."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def upsert_new(spark: SparkSession, root: str, source: DataFrame, keys: Sequence[str]) -> int:
    """Insert the source rows whose key the newest version lacks, as a new version."""
    return snapshot_write(merge_insert(read_version(spark, root), source, keys), root)


def file_sizes(df: DataFrame) -> DataFrame:
    """path, bytes of each file that df reads rows from. No column is read, only what the scan knows of its files."""
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).groupBy("path").agg(F.max("bytes").alias("bytes"))


def packed(sizes: DataFrame, target_bytes: int) -> DataFrame:
    """path, bytes, bin: files in an order of their own (by hash of the path), cut where ``target_bytes`` are full.

    Running sums come from ranges of the order, not from one task. A bin holds at most the target and one file more.
    """
    rows = sizes.withColumn("at", F.xxhash64("path"))
    return running(rows, "at", ["bytes"]).select("path", "bytes", F.floor(F.col("before_bytes") / target_bytes).cast("long").alias("bin"))


def compact(spark: SparkSession, root: str, target_bytes: int = 128 << 20) -> tuple[int, int, int]:
    """Put the newest version's small files together: version, files before, files after.

    Files of three quarters of the target and more stay where they are, and so does a file that finds no company; the new
    version names them. The others are packed by their bytes, and each bin is written as one file, however many cores
    there are. If there is nothing to put together, no version is written. Never more files than before.
    """
    df = read_version(spark, root)
    sizes = stage(file_sizes(df))
    bins = stage(packed(sizes.filter(F.col("bytes") < target_bytes * 3 // 4), target_bytes))
    full = bins.groupBy("bin").agg(F.count(F.lit(1)).alias("files")).filter("files > 1")
    full = stage(numbered(full, ["bin"], "to"))  # bins from 0 without gaps
    before, after = sizes.count(), full.count()
    if after == 0:
        return max(versions(spark, root)), before, before
    moved = stage(bins.join(full, "bin").select("path", "to"))
    kept = sizes.join(moved, "path", "left_anti")
    small = sum_of(moved, F.octet_length("path") + 16) <= BROADCAST_BYTES
    rows = df.withColumn("_path", F.col("_metadata.file_path")).join((F.broadcast(moved) if small else moved).withColumnRenamed("path", "_path"), "_path")
    version = snapshot_write(rows.repartitionById(after, F.col("to").cast("int")).select(*df.columns), root, kept)
    return version, before, after + kept.count()


def sum_of(df: DataFrame, size: Column) -> int:
    """The sum of an expression over all rows, 0 for none."""
    return df.agg(F.sum(size)).first()[0] or 0
