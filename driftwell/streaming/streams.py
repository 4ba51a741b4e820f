"""Incremental ingestion and event-time operators by Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.tables import snapshot_write, versions, write_table


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", max_files: int | None = None, **options) -> DataFrame:
    """Files of a folder as they arrive."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def shred_stream(source: DataFrame, shred: Callable[[DataFrame], DataFrame], dst: str, checkpoint: str) -> StreamingQuery:
    """Shred what arrived since the last call, exactly once: the checkpoint knows the files, the sink its batches.

    Each table, positions too, has its own checkpoint, so that it restarts by itself.
    """
    out = shred(source).writeStream.format("parquet").option("path", dst).option("checkpointLocation", checkpoint).outputMode("append")
    return out.trigger(availableNow=True).start()


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """The first row seen of each key, with state kept for ``delay``. Which row that is depends on arrival."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def pulse(df: DataFrame, ts: str, width: str, delay: str, by: Sequence[str] = (), actor: str | None = None) -> DataFrame:
    """Events (and distinct actors, exactly) of each tumbling window; rows later than ``delay`` are dropped.

    Actors are counted by two chained aggregations: the first keeps a row a window and actor and hands it on once the
    window is closed, the second counts those rows. State is as large as the open windows' actors, and no group's actors
    meet in one row. Null actors aren't counted.
    """
    rows = df.withWatermark(ts, delay) if df.isStreaming else df
    if actor is None:
        out = rows.groupBy(F.window(ts, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("events"))
        return out.select(F.col("w.start").alias("window_start"), *by, "events")
    each = rows.groupBy(F.window(ts, width).alias("w"), *by, F.col(actor).alias("_actor")).agg(F.count(F.lit(1)).alias("n"))
    again = F.window(F.window_time("w"), width) if df.isStreaming else F.col("w")
    out = each.groupBy(again.alias("v"), *by).agg(F.sum("n").alias("events"), F.count("_actor").alias("actors"))
    return out.select(F.col("v.start").alias("window_start"), *by, "events", "actors")


def upsert_batch(root: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that inserts rows whose key is new. A batch writes its new rows alone, to a folder of its own
    number, so that running it again changes nothing. read_upserted() reads the table."""

    def write(batch: DataFrame, number: int) -> None:
        spark, new = batch.sparkSession, batch.dropDuplicates(list(keys))
        earlier = [f"{root}/batch={n}" for n in versions(spark, root, "batch") if n != number]
        if earlier:
            new = new.join(spark.read.schema(batch.schema).parquet(*earlier).select(*keys), list(keys), "left_anti")
        write_table(new, f"{root}/batch={number}")

    return write


def read_upserted(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The table that upsert_batch() keeps."""
    return spark.read.schema(schema).parquet(*[f"{root}/batch={n}" for n in versions(spark, root, "batch")])


def fold_upserted(spark: SparkSession, root: str, schema: StructType) -> int:
    """Write what upsert_batch() has left as one snapshot, for readers that want few files; the batches stay."""
    return snapshot_write(read_upserted(spark, root, schema), root)


def drain(query: StreamingQuery) -> None:
    """Wait for a query that stops when nothing is left; raise what stopped it otherwise."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()
