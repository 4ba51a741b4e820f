"""Helpers the training-data operators share: reading, Arrow batches, cutting lineage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import stage as cut  # noqa: F401

#: Ceiling on what one Arrow batch hands to a Python worker; long rows make batches shorter.
BATCH_ROWS, BATCH_BYTES = 1024, 16 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by rows and by bytes, so that long texts cannot exhaust a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One of the given tables, only the columns asked for."""
    df = tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def text_key() -> list:
    """Key of a row by content: rows that repeat both id and text are one document with one result."""
    return [F.col("doc_id"), F.xxhash64("text").alias("text_hash")]


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser over unsigned 64-bit integers."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8_column(array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of an Arrow string column, nulls as empty texts, without Python strings."""
    import pyarrow as pa
    import pyarrow.compute as pc

    array = array.cast(pa.large_utf8())
    array = pc.fill_null(array, "") if array.null_count else array
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data[:0], offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
