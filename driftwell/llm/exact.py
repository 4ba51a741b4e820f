"""Exact dedup by content sort, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

#: A text that more rows than this share is sorted in several salted runs, whose leaders then meet.
RUN_ROWS = 2000
#: Hot hashes (16 bytes each) that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 100_000
#: Leading characters that splitters are sampled from; equal beginnings are told apart by a hash.
LEAD = 48


def normalised(text="text"):
    """The text without any character of [\\x20\\x09-\\x0D]; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", "")


def content_sort(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """Group the rows of docs whose texts are equal apart from white space.

    Sampled splitters (of the leading characters and a hash) range-partition the normalised texts, each partition is
    sorted, externally where memory ends, and a window compares neighbours in full. Texts that more than ``run_rows``
    rows share are counted first, by hash, and dealt to salted runs; only the runs' leaders are compared again, so
    no task gets a hot text whole, not even where rows repeat an id too. Of equal texts the row with the most code points
    stays, then that with the smallest doc_id, then the smallest original text.

    Returns, a row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256 and text_hash (xxhash64 of the
    original text). Null texts count as empty; empty texts form a group like any other. Rows that repeat doc_id and
    text are equal rows: each is counted, and the first of them is the one kept. Other columns of docs are not read.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.length(F.coalesce("text", F.lit(""))).alias("size"), normalised().alias("norm"), F.monotonically_increasing_id().alias("line"))
    rows = rows.withColumn("norm_hash", F.xxhash64("norm"))
    hot = rows.groupBy("norm_hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > run_rows).withColumn("runs", F.ceil(F.col("n") / run_rows).cast("int"))
    # At most rows / run_rows hashes are hot. They are counted, so that few are broadcast and the texts stay where they are.
    hot = cut(hot.select("norm_hash", "runs"))
    rows = rows.join(F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot, "norm_hash", "left")
    rows = rows.withColumn("salt", F.when(F.col("runs").isNull(), 0).otherwise(F.pmod(F.xxhash64("line"), F.col("runs")).cast("int")))
    rows = rows.withColumn("lead", F.substring("norm", 1, LEAD))
    key = ["lead", "norm_hash", "salt"]
    placed = rows.repartitionByRange(*key)
    run = Window.partitionBy(*key, "norm").orderBy(F.col("size").desc(), F.col("doc_id").asc_nulls_last(), "text_hash")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = placed.select(
        "doc_id", "text_hash", "size", "salt", "norm_hash", F.col("runs").isNotNull().alias("salted"), F.row_number().over(run).alias("place"),
        F.first("doc_id").over(whole).alias("keep_id"), F.count(F.lit(1)).over(whole).alias("group_size"), F.sha2("norm", 256).alias("text_sha256"),
    )
    return runs


def exact_dedup(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """content_sort() with the leaders of salted runs merged. Its digests, without texts, are written between the two."""
    runs = cut(content_sort(docs, run_rows))
    leaders = runs.filter("salted and place = 1")
    order = Window.partitionBy("text_sha256").orderBy(F.col("size").desc(), F.col("keep_id").asc_nulls_last(), "text_hash", "salt")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    merged = leaders.select(
        "text_sha256", "salt", F.first("keep_id").over(whole).alias("final_id"), F.first("salt").over(whole).alias("final_salt"),
        F.sum("group_size").over(whole).alias("final_size"),
    )
    out = runs.join(merged, ["text_sha256", "salt"], "left")
    return out.select(
        "doc_id", F.when(F.col("salted"), F.col("final_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(F.col("salted"), F.col("final_size")).otherwise(F.col("group_size")).alias("group_size"),
        ((F.col("place") == 1) & (~F.col("salted") | (F.col("salt") == F.col("final_salt")))).alias("kept"), "text_sha256", "text_hash",
    )


def op7_content_sort(spark, sf_dir: str) -> DataFrame:
    """Exact duplicates among the whole texts of documents: doc_id, keep_id, group_size, kept, text_sha256."""
    return exact_dedup(table(spark, sf_dir, "documents", "doc_id", "text")).drop("text_hash")


OP7_SQL = r"""
with n as (
  select doc_id, length(coalesce(text, '')) as size, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as norm from documents
), r as (
  select doc_id, norm, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size, row_number() over w as place
  from n window w as (partition by norm order by size desc, doc_id)
)
select doc_id, keep_id, group_size, place = 1 as kept, sha256(norm) as text_sha256 from r
"""
