"""Data-quality assertions. Each returns the rows, or keys, that violate it; none runs by itself."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def outside_values(column: str, values: Sequence) -> Column:
    """Whether a row has another value; nulls pass."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def outside_range(column: str, least=None, most=None) -> Column:
    """Whether a row lies outside the inclusive bounds; nulls pass."""
    bad = F.lit(False)
    if least is not None:
        bad = bad | (F.col(column) < least)
    if most is not None:
        bad = bad | (F.col(column) > most)
    return bad


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls pass."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with another value; nulls pass."""
    return df.filter(outside_values(column, values))


def accepted_range(df: DataFrame, column: str, least=None, most=None) -> DataFrame:
    """Rows outside the inclusive bounds; nulls pass."""
    return df.filter(outside_range(column, least, most))


def relationships(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose value no parent has; nulls pass."""
    keys = parent.select(F.col(key).alias("_parent")).filter("_parent is not null").distinct()
    return df.filter(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_parent"), "left_anti")


def run_checks(checks: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Name and number of violations of each check, as one frame."""
    rows = [v.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations") for name, v in checks]
    return reduce(DataFrame.unionByName, rows)


def row_checks(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """run_checks() for conditions that a row violates by itself: one scan and one aggregate for all of a table's checks."""
    counts = df.agg(*(F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions.values())))
    rows = [F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("violations")) for i, name in enumerate(conditions)]
    return counts.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def duplicate_rate(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Share of rows that repeat a key."""
    groups = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.groupBy(*by).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"), (1 - F.count(F.lit(1)) / F.sum("n").cast("double")).alias("duplicate_rate"))


def joinability(df: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Share of non-null foreign keys that resolve."""
    keys = dim.select(F.col(pk).alias("_pk")).filter("_pk is not null").distinct().withColumn("_hit", F.lit(1.0))
    values = df.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    rows = values.join(keys, F.col(fk) == F.col("_pk"), "left")
    return rows.agg(F.sum("n").alias("rows"), (F.sum(F.coalesce("_hit", F.lit(0.0)) * F.col("n")) / F.sum("n")).alias("share"))


def degenerate_rates(df: DataFrame, rate: str, n: str, min_n: int) -> DataFrame:
    """Rates of exactly 0 or 1 over many trials: usually a sign that only one side was observed."""
    return df.filter((F.col(n) >= min_n) & ((F.col(rate) == 0) | (F.col(rate) == 1)))


def reconcile(manifest: DataFrame, markers: DataFrame, output: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Compare what was to be loaded, what was marked as loaded and what is there.

    Returns a report (coverage: expected without a marker; accounting: marked but unexpected; parity: marked without
    output; containment: output without a marker) and the keys that are safe everywhere.
    """
    want, marked, there = (d.select(key).distinct() for d in (manifest, markers, output))
    checks = [("coverage", want.join(marked, key, "left_anti")), ("accounting", marked.join(want, key, "left_anti")), ("parity", marked.join(there, key, "left_anti")), ("containment", there.join(marked, key, "left_anti"))]
    return run_checks(checks), want.join(marked, key, "left_semi").join(there, key, "left_semi")


def window_mismatch(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, claimed: str, tolerance: float = 1e-9, block: int = 256) -> DataFrame:
    """Rows whose claimed mean of earlier values isn't what a join of each row with its earlier rows gives.

    A recomputation by sums and joins, for checking features; ``order`` must be total within a key. The rows of a key are
    cut into blocks of ``block`` neighbours: a row meets the earlier rows of its own block, and the sums of earlier
    blocks, so a key of n rows makes n * block + (n / block)^2 pairs rather than n^2.
    """
    ranked = df.select(*keys, *order, F.col(value).alias("_v"), F.col(claimed).alias("claimed"), F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("_n"))
    ranked = ranked.withColumn("_b", F.floor((F.col("_n") - 1) / block))
    total, count = lambda c: F.coalesce(F.sum(c), F.lit(0.0)), lambda c: F.count(c)
    sums = ranked.groupBy(*keys, "_b").agg(total("_v").alias("_s"), count("_v").alias("_c"))
    other = sums.select(*keys, F.col("_b").alias("_b2"), F.col("_s").alias("_s2"), F.col("_c").alias("_c2"))
    earlier = sums.join(other, list(keys)).filter("_b2 < _b").groupBy(*keys, "_b").agg(F.sum("_s2").alias("_s"), F.sum("_c2").alias("_c"))
    near = ranked.select(*keys, "_b", F.col("_n").alias("_n2"), F.col("_v").alias("_v2"))
    own = ranked.join(near, [*keys, "_b"]).groupBy(*keys, *order, "_b", "claimed").agg(
        total(F.when(F.col("_n2") < F.col("_n"), F.col("_v2"))).alias("_s1"), count(F.when(F.col("_n2") < F.col("_n"), F.col("_v2"))).alias("_c1")
    )
    number = F.col("_c1") + F.coalesce("_c", F.lit(0))
    mean = F.when(number > 0, (F.col("_s1") + F.coalesce("_s", F.lit(0.0))) / number)
    again = own.join(earlier, [*keys, "_b"], "left").select(*keys, *order, "claimed", mean.alias("recomputed"))
    return again.filter(~F.coalesce(F.abs(F.col("claimed") - F.col("recomputed")) <= tolerance, F.col("claimed").isNull() & F.col("recomputed").isNull()))
