"""Window operators over column names. Nulls sort last unless said otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.exprs import distance, seconds_between
from ..sources.staging import stage


def ordering(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]


def over(part: Sequence[str], order: Sequence[Column | str] = ()) -> WindowSpec:
    w = Window.partitionBy(*part)
    return w.orderBy(*ordering(order)) if order else w


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key. With a total order the result doesn't depend on partitioning."""
    return df.withColumn("_n", F.row_number().over(over(keys, order))).filter("_n = 1").drop("_n")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, by an aggregate that combines before it shuffles. order must be total within a key."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def sequence(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str = "seq") -> DataFrame:
    return df.withColumn(out, F.row_number().over(over(keys, order)))


def scaled_rank(df: DataFrame, part: Sequence[str], order: Sequence[Column | str], where: Column, out_rank: str, out_count: str, out_pct: str) -> DataFrame:
    """Dense rank among the rows with ``where``, the number of ranks, and the rank scaled to 0..1 (null for one rank)."""
    rank = F.dense_rank().over(over([*part, "_in"], order))
    ranked = df.withColumn("_in", F.coalesce(where, F.lit(False))).withColumn(out_rank, F.when(F.col("_in"), rank))
    ranked = ranked.withColumn(out_count, F.max(out_rank).over(over(part)))
    pct = F.when(F.col("_in") & (F.col(out_count) > 1), (F.col(out_rank) - 1) / (F.col(out_count) - 1).cast("double"))
    return ranked.withColumn(out_pct, pct).drop("_in")


def competition_rank(df: DataFrame, part: Sequence[str], order: Sequence[Column | str], out: str = "rank") -> DataFrame:
    """1, 1, 3 for ties."""
    return df.withColumn(out, F.rank().over(over(part, order)))


def duration_to_next(df: DataFrame, keys: Sequence[str], ts: str, next_ts: str, seconds: str) -> DataFrame:
    """Time of the next row of the key and the second boundaries until then. Ordered by typed time, not by its text."""
    out = df.withColumn(next_ts, F.lead(ts).over(over(keys, [ts])))
    return out.withColumn(seconds, seconds_between(ts, next_ts))


def step_distance(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], x: str, y: str, out: str = "step") -> DataFrame:
    """Distance from the key's row before; null for its first."""
    w = over(keys, order)
    return df.withColumn(out, distance(F.col(x), F.col(y), F.lag(x).over(w), F.lag(y).over(w)))


def prior_window(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], aggs: dict[str, Column]) -> DataFrame:
    """Aggregates over all rows of the key before the current one; no row sees itself."""
    w = over(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({name: agg.over(w) for name, agg in aggs.items()})


def leave_one_out_mean(df: DataFrame, part: Sequence[str], value: str, out: str, strict: bool = True) -> DataFrame:
    """Mean of the others' values. strict: a row without a value doesn't reduce the number of others (else one is
    subtracted either way)."""
    w = over(part)
    own = F.when(F.col(value).isNotNull(), 1).otherwise(0) if strict else F.lit(1)
    others = F.count(value).over(w) - own
    mean = (F.sum(value).over(w) - F.coalesce(F.col(value), F.lit(0.0))) / F.when(others != 0, others).cast("double")
    return df.withColumn(out, mean)


def others_in_group(df: DataFrame, part: Sequence[str], out: str) -> DataFrame:
    """How many other rows share the group."""
    return df.withColumn(out, F.count(F.lit(1)).over(over(part)) - 1)


def group_share(df: DataFrame, part: Sequence[str], value: str, out_total: str, out_share: str) -> DataFrame:
    """Share of a group's total, over an aggregated frame: no second scan."""
    return df.withColumn(out_total, F.sum(value).over(over(part))).withColumn(out_share, F.col(value) / F.col(out_total).cast("double"))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of a total order; each task keeps k."""
    return df.orderBy(*order).limit(k)


#: Rows that a task takes in after a shuffle, where its memory or its time grows with them.
TASK_ROWS = 500_000


def tasks_for(df: DataFrame, rows: int) -> list[int]:
    """The number of partitions to shuffle df to, none (adaptive execution finds it) for up to ``TASK_ROWS`` rows."""
    return [max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))] if rows > TASK_ROWS else []


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df by keys, in as many partitions as its ``rows`` ask for, so that tasks don't grow with the input.

    Joins, windows and aggregates by these keys, and more, take place in these partitions.
    """
    return df.repartition(*tasks_for(df, rows), *keys)


def numbered(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """df with each row's place in a total order, from 0.

    Rows are written and counted, then numbered within range partitions of bounded size, which are written once with their
    number; of the partitions only the row counts are summed in order, so no task sees all rows.
    """
    df = stage(df)
    ranges = stage(df.repartitionByRange(*tasks_for(df, df.count()), *order).withColumn("_p", F.spark_partition_id()))
    sizes = ranges.groupBy("_p").agg(F.count(F.lit(1)).alias("_rows"))  # a row a partition
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_p", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return ranges.withColumn("_own", own).join(F.broadcast(sizes), "_p").withColumn(out, F.col("_before") + F.col("_own") - 1).drop("_p", "_own", "_before")


def ordered_cut(df: DataFrame, key: str, order: Sequence[str], fraction: float) -> tuple[DataFrame, DataFrame]:
    """The first ``int(n * fraction)`` keys of an order, and the others, as two frames of df's rows."""
    order = [c for c in order if c != key]
    keys = stage(numbered(df.select(*order, key).distinct(), [*order, key], "_place"))
    cut = int(keys.count() * fraction)
    head = keys.filter(F.col("_place") < cut).select(key)
    return df.join(head, key, "left_semi"), df.join(head, key, "left_anti")
