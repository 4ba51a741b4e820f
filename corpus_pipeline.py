"""The corpus pipeline: five stages over documents, each an operator of driftwell.llm.

In every stage, an empty table gives an empty table, texts of any length are read whole, and columns beyond those of
documents, whatever their names, are carried along.

Each stage works on all that the one before it kept, and its decisions take effect: texts without a language go, equal
texts go but one, near-duplicates go but one of each group, secrets are cut out of texts, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.llm.common import cut, table, tune
from driftwell.llm.exact import exact_dedup
from driftwell.llm.language import keep_identified
from driftwell.llm.minhash import near_duplicates
from driftwell.llm.packing import pack
from driftwell.llm.secrets import redact
from driftwell.llm.vocab import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. Null texts and texts without a letter go; null ids and repeated rows stay."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts; rows that repeat doc_id and text count one by one.

    Null and empty texts are one group. Of ties the smallest doc_id stays, null ids last.
    """
    rows = docs.withColumn("text_hash", F.xxhash64("text"))
    sums = cut(exact_dedup(docs).groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("k")).filter("n > k"))
    named = sums.select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash"), "k")
    same = F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("text_hash") == F.col("g_hash"))
    rest = rows.join(named.filter("k = 0"), same, "left_anti")
    if named.filter("k > 0").isEmpty():
        return rest.select(*docs.columns)
    repeated = named.filter("k > 0")
    once = rest.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return rest.join(repeated, same, "left_anti").unionByName(once).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; only keys are joined to the documents.

    The smallest doc_id of a group stays. Texts without words and rows with null ids link with nothing and stay.
    """
    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(cut(gone), "doc_id", "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts; n_chars follows the text. Null texts stay null."""
    return redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids and places in sequences: what a trainer reads, once written.

    Null and empty texts are documents of one id, the end; rows that repeat an id are documents of their own.
    """
    return pack(docs, vocabulary("word_bpe_49k.json"), keep_ids=True)


STAGES = [("language", language), ("exact", exact), ("near", near), ("secrets", secrets), ("packing", packing)]
#: Kernel scores, signatures and byte-pair encoding aren't SQL; tests compare each stage with brute force (tests/llm/test_brute.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each over all that the one before it kept."""
    docs = table(tune(spark), sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = cut(docs) if k + 1 < len(STAGES) else docs
    return docs
