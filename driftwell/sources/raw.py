"""Raw nested JSON files."""

from __future__ import annotations

import gzip
import re
import uuid
import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import EVENT, MANIFEST
from .staging import stage, store

CORRUPT = "_corrupt"


def file_key(path=None):
    """Match id from a file's name: what comes before '.json' in its last part."""
    path = F.col("_metadata.file_path") if path is None else path
    return F.regexp_extract(path, r"([^/]+?)\.json(?:\.gz)?$", 1)


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row a manifest file, with its directories' partition columns; corrupt files keep their text in ``_corrupt``."""
    df = spark.read.schema(f"{MANIFEST}, {CORRUPT} string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(root)
    return df.withColumn("file_match_id", file_key())


def read_telemetry(spark: SparkSession, root: str) -> DataFrame:
    """One row an event: files hold arrays of events of many types, read under one schema of all their fields."""
    df = spark.read.schema(f"{EVENT}, {CORRUPT} string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(root)
    return df.withColumn("match_id", file_key())


def write_files(rows: DataFrame, root: str, name: str = "name", body: str = "body", by: Sequence[str] = (), suffix: str = ".json", compression: str = "none") -> None:
    """A file for each row: root/<by>=.../<name><suffix>, holding the row's text or bytes as they are (and a line's end).

    Tasks write the files to a hidden folder; once all are there, tasks give each its name. The driver sees none of them,
    but where Arrow doesn't know the store or the compression: there Spark writes, and the driver renames file by file.
    """
    fs, at = store(rows.sparkSession, root)
    uri = fs.makeQualified(at).toUri()
    place = f"file://{uri.getPath()}" if uri.getScheme() == "file" else uri.toString()
    if compression in ("none", "gzip") and _arrow_store(place):
        _write_by_tasks(rows, place, name, body, by, suffix, compression)
    else:
        _write_and_rename(rows, root, name, body, by, suffix, compression)


def _arrow_store(uri: str) -> bool:
    from pyarrow import ArrowException
    from pyarrow.fs import FileSystem

    try:
        return bool(FileSystem.from_uri(uri))
    except (ArrowException, OSError):
        return False


def _folder_name(value: str | None) -> str:
    """A value as Spark spells it in a folder's name."""
    return re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda c: f"%{ord(c[0]):02X}", value) if value else "__HIVE_DEFAULT_PARTITION__"


def _write_by_tasks(rows: DataFrame, place: str, name: str, body: str, by: Sequence[str], suffix: str, compression: str) -> None:
    import pyarrow as pa
    from pyarrow.fs import FileSystem, FileType

    by, hidden = list(by), f"_writing-{uuid.uuid4().hex}"

    def write(batches):
        store, root = FileSystem.from_uri(place)
        store.create_dir(f"{root}/{hidden}")
        for batch in batches:
            *folders, names, bodies = (batch.column(k) for k in range(batch.num_columns))
            sources, targets = [], []
            for k in range(batch.num_rows):
                text = (bodies[k].as_py() or b"") + b"\n"
                sources.append(f"{hidden}/{uuid.uuid4().hex}")
                with store.open_output_stream(f"{root}/{sources[-1]}", compression=None) as f:
                    f.write(gzip.compress(text, 6, mtime=0) if compression == "gzip" else text)
                parts = [f"{c}={_folder_name(v[k].as_py())}" for c, v in zip(by, folders)]
                targets.append("/".join([*parts, _folder_name(names[k].as_py()) + suffix]))
            yield pa.RecordBatch.from_arrays([pa.array(sources, pa.string()), pa.array(targets, pa.string())], names=["source", "target"])

    def give_names(batches):
        store, root = FileSystem.from_uri(place)
        made = set()
        for batch in batches:
            for source, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folder = target.rpartition("/")[0]
                if folder not in made:
                    store.create_dir(f"{root}/{folder}")
                    made.add(folder)
                old, new = (x.type != FileType.NotFound for x in store.get_file_info([f"{root}/{source}", f"{root}/{target}"]))
                if old and new:
                    raise FileExistsError(target)
                if old or not new:  # else an earlier attempt of this task has done it
                    store.move(f"{root}/{source}", f"{root}/{target}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    spark = rows.sparkSession
    parts = rows.select(*(F.col(c).cast("string") for c in by), F.col(name).cast("string"), F.col(body).cast("binary"))
    written = stage(parts.mapInArrow(write, "source string, target string"))
    tasks = 4 * spark.sparkContext.defaultParallelism  # rows of one target meet in a task
    written.repartition(tasks, "target").mapInArrow(give_names, "n bigint").agg(F.sum("n")).collect()
    fs, at = store(spark, f"{place}/{hidden}")
    fs.delete(at, True)


def _write_and_rename(rows: DataFrame, root: str, name: str, body: str, by: Sequence[str], suffix: str, compression: str) -> None:
    spark = rows.sparkSession
    hidden = f"{root}/_writing-{uuid.uuid4().hex}"
    parts = rows.select(*by, F.col(name).alias("_name"), F.col(body).cast("string").alias("value"))
    parts.write.partitionBy(*by, "_name").option("compression", compression).text(hidden)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.listFiles(path(hidden), True)
    while found.hasNext():
        at = found.next().getPath()
        parts = at.toString().partition(f"{hidden.rpartition('/')[2]}/")[2].split("/")
        if parts[-1].startswith("part-"):
            target = path("/".join([root, *parts[:-2], parts[-2].partition("=")[2] + suffix]))
            fs.mkdirs(target.getParent())
            if not fs.rename(at, target):
                raise FileExistsError(target.toString())
    fs.delete(path(hidden), True)


def gunzip_layers(data: bytes) -> bytes:
    """Unwrap gzip as long as the magic bytes stand at the beginning; bytes that only look like gzip stay as they are."""
    while data[:2] == b"\x1f\x8b":
        try:
            d = zlib.decompressobj(31)
            out, rest = d.decompress(data) + d.flush(), d.unused_data
            while rest[:2] == b"\x1f\x8b":  # members one after another
                d = zlib.decompressobj(31)
                out, rest = out + d.decompress(rest) + d.flush(), d.unused_data
        except zlib.error:
            return data
        data = out
    return data


def read_gz_layers(spark: SparkSession, root: str, glob: str = "*.gz") -> DataFrame:
    """Events of files that were compressed more than once: path, match_id and the event's fields. A file is a task's unit."""
    import pyarrow as pa

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root).select("path", "content")

    def run(batches):
        for batch in batches:
            texts = [gunzip_layers(x).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["path", "body"])

    rows = files.mapInArrow(run, "path string, body string")
    parsed = rows.withColumn("e", F.explode_outer(F.from_json("body", f"array<struct<{EVENT}>>")))
    return parsed.select("path", file_key(F.col("path")).alias("match_id"), "e.*")


def event_counts(events: DataFrame, key: str = "match_id") -> DataFrame:
    """Events of each file; -1 for one that can't be parsed."""
    bad = F.bool_or(F.col(CORRUPT).isNotNull())
    return events.groupBy(key).agg(F.when(bad, F.lit(-1)).otherwise(F.count_if(F.col("_T").isNotNull() | F.col(CORRUPT).isNull())).alias("n_events"))


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Paths and sizes without contents."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root).select("path", "length", "modificationTime")


def orphan_files(files: DataFrame, known: DataFrame, key: str = "path") -> DataFrame:
    """Files that no record knows."""
    return files.join(known.select(key), key, "left_anti")


def new_inputs(files: DataFrame, done: DataFrame, key: str = "match_id", order: str = "modificationTime") -> DataFrame:
    """Inputs not yet in the output, oldest first."""
    return files.join(done.select(key).distinct(), key, "left_anti").orderBy(order, key)
