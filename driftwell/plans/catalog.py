"""Queries over the given tables, each an operator of this library at work, with SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The given tables of one folder by name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of Tables."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, root: f(Tables(spark, root))
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


from . import q_aggregates, q_builders, q_chain, q_estimates, q_files, q_joins, q_quality, q_raw, q_shapes, q_streams, q_windows  # noqa: E402, F401
