"""Joins that Spark has no operator for, as plans of built-in ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage


#: Rows of one key that a task should sort; builders hand it on, so that keys with more are cut into stretches of time.
HOT_ROWS = 2_000_000
#: Keys that may be broadcast.
FEW_KEYS = 50_000


def asof_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str, how: str = "left", tiebreak: Sequence[str] = (), values: Sequence[str] | None = None, suffix: str = "",
    hot_rows: int | None = None,
) -> DataFrame:
    """Each left row with the latest right row of the same key at or before it.

    Both sides are shuffled and sorted once by key and time; a window carries the last right row, as one struct so that
    its nulls stay its own. At equal times the right row counts. ``tiebreak``: right columns that order rows of the same
    time; the last wins. Left rows with a null key or time come back with nulls (``how='inner'``: not at all); they take
    no part in the shuffle.

    ``hot_rows``: rows of one key that a window may hold. Keys are counted first; those with more are cut into stretches
    of time, sampled from their own rows, and each stretch begins with the last right row of the stretches before it.
    """
    values = [c for c in right.columns if c not in by] if values is None else list(values)
    payload = F.struct(*(F.col(c) for c in dict.fromkeys([*values, *tiebreak])))
    time = lambda c: F.col(c).cast("timestamp")
    keys = [F.col(c) for c in by]
    whole = lambda ts: reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in (*by, ts)])
    l = left.filter(whole(left_ts)).select(*keys, time(left_ts).alias("_ts"), F.lit(1).alias("_side"), F.struct(*map(F.col, left.columns)).alias("_left"))
    r = right.filter(whole(right_ts)).select(*keys, time(right_ts).alias("_ts"), F.lit(0).alias("_side"), payload.alias("_right"))
    ties = [F.col(f"_right.{c}") for c in tiebreak]
    both = l.unionByName(r, allowMissingColumns=True)
    hot = None if hot_rows is None else _hot_keys(l.select(*by).unionByName(r.select(*by)), by, hot_rows)
    if hot is None:
        joined = _carry(both, by, ties)
    else:
        calm, busy = both.join(hot, list(by), "left_anti"), both.join(hot, list(by), "left_semi")
        joined = _carry(calm, by, ties).unionByName(_carry(_stretches(busy, by, ties), [*by, "_bin"], ties).drop("_bin"))
    if how == "inner":
        joined = joined.filter(F.col("_last").isNotNull())
    joined = joined.select("_left.*", *(F.col(f"_last.{c}").alias(c + suffix) for c in values))
    if how == "inner":
        return joined
    return joined.unionByName(left.filter(~whole(left_ts)), allowMissingColumns=True).select(*joined.columns)


def _carry(both: DataFrame, part: Sequence[str], ties: Sequence[Column]) -> DataFrame:
    """The left rows with _last, the last right row before each within its part."""
    order = Window.partitionBy(*part).orderBy("_ts", "_side", *ties).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("_last", F.last("_right", ignorenulls=True).over(order)).filter("_side = 1")


def _hot_keys(rows: DataFrame, by: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Keys with more rows than ``hot_rows``, None if there are none. Counted before the shuffle; rows / hot_rows keys at most."""
    hot = stage(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(*by))
    n = hot.count()
    return None if n == 0 else F.broadcast(hot) if n <= FEW_KEYS else hot


def _stretches(both: DataFrame, by: Sequence[str], ties: Sequence[Column]) -> DataFrame:
    """Rows of hot keys with _bin: the range that each falls into by key and time, whatever the times' spread, and for each
    bin of a key, as its first row, the last right row of that key's earlier bins."""
    order = [*(F.col(c) for c in by), F.col("_ts"), F.col("_side"), *ties, F.monotonically_increasing_id()]
    both = stage(both.repartitionByRange(*order).withColumn("_bin", F.spark_partition_id()))
    part = [*by, "_bin"]
    lasts = both.groupBy(*part).agg(F.max_by("_right", F.when(F.col("_side") == 0, F.struct("_ts", *ties))).alias("_right"))  # a row a stretch
    earlier = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(*part, F.last("_right", True).over(earlier).alias("_right")).filter("_right is not null")
    carried = carried.withColumns({"_ts": F.lit(None).cast("timestamp"), "_side": F.lit(-1)})  # a null time comes first
    return both.unionByName(carried, allowMissingColumns=True)


def asof_lookup(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str, values: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """asof_join() for a right side with few rows a key: its rows become one sorted array, and the left side isn't sorted.

    A key's array must fit in memory many times over; use asof_join() where that isn't certain.
    """
    time = F.col(right_ts).cast("timestamp")
    row = F.struct(time.alias("_t"), *(F.col(c) for c in dict.fromkeys([*tiebreak, *values])))
    lists = right.filter(F.col(right_ts).isNotNull()).groupBy(*by).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    joined = left.join(lists, list(by), "left")
    before = F.filter("_rows", lambda x: x["_t"] <= F.col(left_ts).cast("timestamp"))
    joined = joined.withColumn("_last", F.try_element_at(before, F.lit(-1)))
    return joined.select(*left.columns, *(F.col(f"_last.{c}").alias(c) for c in values))


def interval_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str, before: float, after: float) -> DataFrame:
    """Pairs of one key whose right time lies from ``before`` seconds before the left time to ``after`` seconds after it.

    Time is cut into bins as wide as the interval. A left row looks into the two or three bins that its interval
    touches, a right row lies in one, and the bins join by equality: no key's rows meet all at once. Give the smaller
    side as left. Columns of both sides; the names must differ apart from ``by``.
    """
    width = max(1.0, float(before) + float(after))
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / F.lit(1e6)
    bin_of = lambda t: F.floor(t / F.lit(width))
    l = left.withColumn("_t", at(left_ts)).withColumn("_bin", F.explode(F.sequence(bin_of(F.col("_t") - before), bin_of(F.col("_t") + after))))
    r = right.withColumn("_u", at(right_ts)).withColumn("_bin", bin_of(F.col("_u")))
    pairs = l.join(r, [*by, "_bin"])
    return pairs.filter((F.col("_u") >= F.col("_t") - before) & (F.col("_u") <= F.col("_t") + after)).drop("_t", "_u", "_bin")


def since_join(events: DataFrame, starts: DataFrame, by: Sequence[str], ts: str, start_ts: str) -> DataFrame:
    """Events at or after the start of their key; events without a start go. starts: one row a key."""
    s = starts.select(*by, F.col(start_ts).alias("_start"))
    return events.join(s, list(by)).filter(F.col(ts) >= F.col("_start")).select(*events.columns)


def mirror_pairs(directed: DataFrame, a: str, b: str, by: Sequence[str], count: str, out: str) -> DataFrame:
    """Each directed pair with the count of the opposite direction (0 if there is none)."""
    back = directed.select(F.col(a).alias("_b"), F.col(b).alias("_a"), *by, F.col(count).alias(out))
    joined = directed.join(back.withColumnsRenamed({"_a": a, "_b": b}), [a, b, *by], "left")
    return joined.withColumn(out, F.coalesce(out, F.lit(0)))


def merge_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """target with the source rows whose key it lacks; of source rows with one key one comes in."""
    new = source.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def in_set(df: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is among members; the members never reach the driver."""
    return df.join(members.select(*keys), list(keys), "left_semi")


def not_in_set(df: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key isn't among members."""
    return df.join(members.select(*keys), list(keys), "left_anti")


def pair_inputs(manifests: DataFrame, events: DataFrame, key: str = "match_id") -> tuple[DataFrame, DataFrame]:
    """Manifests that have events, and a report of the keys that lack either side (they are skipped, not fatal)."""
    seen = events.select(key).distinct()
    paired = manifests.join(seen, key, "left_semi")
    no_events = manifests.select(key).distinct().join(seen, key, "left_anti").withColumn("missing", F.lit("events"))
    no_manifest = seen.join(manifests.select(key), key, "left_anti").withColumn("missing", F.lit("manifest"))
    return paired, no_events.unionByName(no_manifest)


def left_fill(left: DataFrame, right: DataFrame, by: Sequence[str], defaults: dict[str, object]) -> DataFrame:
    """Left join with defaults for what isn't found."""
    out = left.join(right, list(by), "left")
    for c, value in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(value)))
    return out


def null_safe_key(df: DataFrame, repairs: dict[str, object]) -> list[Column]:
    """Key columns with nulls replaced by their sentinel, for joins against sources that store the sentinel."""
    return [F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in repairs.items()]
