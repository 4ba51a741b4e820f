"""Ingestion by a ledger: which files an output has taken in is written with the rows, in one commit a part."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import numbered, sequence
from .raw import CORRUPT, event_counts, file_key, list_files, read_telemetry
from .staging import stage, store
from .tables import publish, versions, write_table

#: Files that are listed, read and shredded by the same jobs.
WAVE = 20_000

LEDGER = "path string, match_id string, n_events bigint, adopted boolean, part int"


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """A row for each file that an output's finished parts hold: path, match_id, n_events, adopted, part."""
    parts = versions(spark, out, "part")
    return spark.read.schema(LEDGER).parquet(*[f"{out}/part={n}/files" for n in parts]) if parts else spark.createDataFrame([], LEDGER)


def ingested(spark: SparkSession, out: str, schema) -> DataFrame:
    """The rows of an output's finished parts."""
    parts = versions(spark, out, "part")
    return spark.read.schema(schema).parquet(*[f"{out}/part={n}/rows" for n in parts]) if parts else spark.createDataFrame([], schema)


def pending(spark: SparkSession, root: str, out: str, glob: str = "*.json*") -> DataFrame:
    """Files below root that the output's ledger doesn't know, by path, with match_id, place (0 for the oldest) and length."""
    files = list_files(spark, root, glob).withColumn("match_id", file_key(F.col("path")))
    return numbered(files.join(ledger(spark, out).select("path"), "path", "left_anti"), ["modificationTime", "path"], "place")


def ingest(
    spark: SparkSession, root: str, out: str, shred: Callable[[DataFrame], DataFrame], known: DataFrame | None = None, matches: int = 500, limit: int | None = None, glob: str = "*.json*",
    read: Callable = read_telemetry,
) -> int:
    """Take in what is pending, oldest first, in parts of ``matches`` files at most; how many files were taken in.

    A part's rows and its ledger rows become visible together, by one rename. The parts of up to ``WAVE`` files are
    written by the same jobs, so that jobs don't grow with the number of parts; a run that dies leaves none of the parts
    that it hadn't named yet, and the next run takes them in again. Files that can't be parsed stay pending and stop
    nothing. Files of one match (by name) are taken in one after another. Each output has a ledger of its own, so that one
    can be redone without the others. shred: its rows keep match_id. known: match_id of what was asked for; files of other
    matches are taken in too, and marked as adopted.
    """
    todo = pending(spark, root, out, glob)
    todo = stage(sequence(todo if limit is None else todo.filter(F.col("place") < limit), ["match_id"], ["place"], "nth"))
    known = known if known is None else stage(known.select("match_id").distinct())
    wave, taken = max(1, WAVE // matches) * matches, 0
    for nth, first, last in todo.groupBy("nth").agg(F.min("place"), F.max("place")).orderBy("nth").collect():  # one row, but for matches with several files
        for start in range(first, last + 1, wave):
            chunk = todo.filter((F.col("nth") == nth) & F.col("place").between(start, start + wave - 1))
            paths = [r.path for r in chunk.select("path").collect()]  # ``WAVE``, or ``matches``, at most
            if paths:
                part = F.floor((F.col("place") - start) / matches).cast("int")
                taken += _take(spark, out, shred, known, chunk.withColumn("part", part), read(spark, paths))
    return taken


def _take(spark: SparkSession, out: str, shred: Callable, known: DataFrame | None, chunk: DataFrame, events: DataFrame) -> int:
    """Write chunk's files (path, match_id, part from 0) as the next parts; how many could be parsed."""
    done, adopted = chunk.join(event_counts(events).filter("n_events >= 0"), "match_id"), F.lit(False)
    if known is not None:
        done, adopted = done.join(known.withColumn("_known", F.lit(True)), "match_id", "left"), F.col("_known").isNull()
    base = max(versions(spark, out, "part"), default=-1) + 1
    done = stage(done.select("path", "match_id", "n_events", adopted.alias("adopted"), (F.col("part") + base).alias("part")))
    good = done.select("match_id", F.col("part").alias("_part"))
    rows = shred(events.filter(F.col(CORRUPT).isNull()))
    hidden = f"{out}/_writing-{uuid.uuid4().hex}"
    for name, df in (("rows", rows.join(good, "match_id").select(*rows.columns, "_part")), ("files", done.withColumn("_part", F.col("part")))):
        write_table(df.repartition("_part"), f"{hidden}/{name}", partition_by=["_part"])
    for part, _ in (counts := done.groupBy("part").count().orderBy("part").collect()):
        for name in ("rows", "files"):
            fs, made = store(spark, f"{hidden}/{name}/_part={part}")
            fs.mkdirs(made)  # a part without rows has none
            publish(spark, f"{hidden}/{name}/_part={part}", f"{hidden}/part={part}/{name}")
        publish(spark, f"{hidden}/part={part}", f"{out}/part={part}")
    fs, left = store(spark, hidden)
    fs.delete(left, True)
    return sum(n for _, n in counts)
