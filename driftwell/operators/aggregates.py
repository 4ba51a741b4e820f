"""Aggregates over column names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import grid_cell
from ..sources.staging import stage


def skew_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Least, mean and greatest group size, and the greatest over the mean."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    out = sizes.agg(F.min("n").alias("min_rows"), F.avg("n").alias("avg_rows"), F.max("n").alias("max_rows"))
    return out.withColumn("skew", F.col("max_rows") / F.when(F.col("avg_rows") > 0, F.col("avg_rows")))


def grid_heatmap(df: DataFrame, x: str, y: str, size: float, by: Sequence[str] = ()) -> DataFrame:
    """Rows of each square cell."""
    return df.withColumn("cell", grid_cell(x, y, size)).filter("cell is not null").groupBy(*by, "cell").agg(F.count(F.lit(1)).alias("n"))


def quantiles(value: str, probabilities: Sequence[float], exact: bool = True):
    """Interpolated quantiles; with exact=False a sketch of bounded memory, for groups that are very large."""
    if exact:
        return F.percentile(value, [float(p) for p in probabilities])
    return F.percentile_approx(value, [float(p) for p in probabilities], 10_000)


#: Rows of a group whose values a task may hold; pieces that a larger group's values are cut into, time and again.
HOT_ROWS, PIECES = 1_000_000, 256
#: Accuracy of approximate quantiles (their ranks are off by a row in so many), and how far from a rank the first two are taken.
ACCURACY, MARGIN = 10_000, 1.5 / 10_000


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float], hot_rows: int = HOT_ROWS) -> DataFrame:
    """by, n, q: each group's interpolated quantiles, equal to percentile(), with no group's values in one task.

    Groups are counted first. Up to ``hot_rows`` values, percentile() takes them. A larger group's values are written once,
    and two approximate quantiles close to each rank are taken; what lies below and between them is counted exactly. What
    lies between, some 5 of 10,000 values, is cut into pieces, of which one or two hold the rank, until few are left, or
    all are equal; so are all values, should a rank not lie between. The approximation only decides how fast that goes.
    Null values aren't counted; groups may have null keys. A group without values has no row.
    """
    g = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    rows = df.select(g.alias("g"), F.col(value).cast("double").alias("v")).filter("v is not null")
    counts = stage(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")))
    ps = [float(p) for p in probabilities]
    hot = counts.filter(F.col("n") > hot_rows)
    if hot.isEmpty():
        out = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.percentile("v", ps).alias("q"))
    else:
        out = _selected(stage(rows.join(hot.select("g"), "g")), hot, ps, hot_rows)
        if not counts.filter(F.col("n") <= hot_rows).isEmpty():
            out = out.unionByName(rows.join(hot, "g", "left_anti").groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.percentile("v", ps).alias("q")))
    return out.select(*(F.col(f"g.{c}").alias(c) for c in by), "n", "q")


def _selected(rows: DataFrame, hot: DataFrame, ps: Sequence[float], hot_rows: int) -> DataFrame:
    """g, n, q of the hot groups (g, n), by selection of ranks."""
    wanted = F.array(*(F.struct(F.lit(j).alias("j"), F.lit(p).alias("p")) for j, p in enumerate(ps)))
    goals = hot.withColumn("w", F.explode(wanted)).select("g", "n", "w.j", (F.col("w.p") * (F.col("n") - 1)).alias("at"))
    goals = goals.withColumns({"low": F.floor("at"), "high": F.ceil("at"), "below": F.lit(0).cast("long"), "inside": F.col("n"), "least": F.lit(None).cast("double"), "most": F.lit(None).cast("double")})
    goals, inside = _aimed(rows, goals, ps)
    grid = [k / PIECES for k in range(1, PIECES)]
    while not (open_ := goals.filter((F.col("inside") > hot_rows) & ~F.col("least").eqNullSafe(F.col("most")) | F.col("least").isNull())).isEmpty():
        again = inside.join(open_.select("g", "j"), ["g", "j"], "left_semi")
        cuts = stage(again.groupBy("g", "j").agg(F.array_distinct(F.percentile_approx("v", grid, ACCURACY)).alias("cuts")))
        placed = again.join(cuts, ["g", "j"]).withColumn("piece", F.size(F.filter("cuts", lambda c: c < F.col("v"))))
        pieces = placed.groupBy("g", "j", "piece").agg(F.count(F.lit(1)).alias("size"), F.min("v").alias("first"), F.max("v").alias("last"))
        before = Window.partitionBy("g", "j").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
        pieces = pieces.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).join(open_.select("g", "j", "low", "high", F.col("below").alias("b")), ["g", "j"])
        hit = pieces.filter((F.col("b") + F.col("before") <= F.col("high")) & (F.col("b") + F.col("before") + F.col("size") > F.col("low")))
        narrowed = hit.groupBy("g", "j").agg((F.min("b") + F.min("before")).alias("below"), F.sum("size").alias("inside"), F.min("first").alias("least"), F.max("last").alias("most"))
        narrowed = goals.drop("below", "inside", "least", "most").join(narrowed, ["g", "j"])
        goals = stage(goals.join(narrowed.select("g", "j"), ["g", "j"], "left_anti").unionByName(narrowed))
        limits = goals.select("g", "j", "least", "most")
        inside = stage(inside.join(limits, ["g", "j"]).filter(F.col("v").between(F.col("least"), F.col("most"))).select("g", "v", "j"))
    many = goals.filter("least < most").select("g", "j", "below", "low", "high")
    sizes = inside.join(many.select("g", "j"), ["g", "j"], "left_semi").groupBy("g", "j", "v").agg(F.count(F.lit(1)).alias("size"))
    upto = F.sum("size").over(Window.partitionBy("g", "j").orderBy("v"))
    found = sizes.withColumn("upto", upto).join(many, ["g", "j"]).groupBy("g", "j").agg(*(F.min(F.when(F.col("upto") > F.col(k) - F.col("below"), F.col("v"))).alias(f"v_{k}") for k in ("low", "high")))
    rows = goals.join(found, ["g", "j"], "left").withColumns({f"v_{k}": F.coalesce(f"v_{k}", "least") for k in ("low", "high")})
    between = (F.col("high") - F.col("at")) * F.col("v_low") + (F.col("at") - F.col("low")) * F.col("v_high")
    rows = rows.withColumn("q", F.when(F.col("v_low") == F.col("v_high"), F.col("v_low")).when(F.col("low") == F.col("high"), F.col("v_low")).otherwise(between))
    return rows.groupBy("g").agg(F.max("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("j", "q"))), lambda x: x["q"]).alias("q"))


def _aimed(rows: DataFrame, goals: DataFrame, ps: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """Goals with the values that surely hold their ranks, and these values: g, v, j.

    Two passes: one takes approximate quantiles on both sides of each rank, one counts below and between them. Rows aren't
    repeated a goal, nor compared with more than these.
    """
    around = [min(max(p + d, 0.0), 1.0) for p in ps for d in (-MARGIN, MARGIN)]
    aims = stage(rows.groupBy("g").agg(F.percentile_approx("v", around, ACCURACY).alias("c")))
    sides = [(F.col("c")[2 * j], F.col("c")[2 * j + 1]) for j in range(len(ps))]
    aimed = rows.join(aims, "g")
    counts = aimed.groupBy("g").agg(*(F.count_if(F.col("v") < low).alias(f"b{j}") for j, (low, _) in enumerate(sides)), *(F.count_if(F.col("v").between(low, high)).alias(f"i{j}") for j, (low, high) in enumerate(sides)))
    each = F.array(*(F.struct(F.lit(j).alias("j"), F.col(f"b{j}").alias("below"), F.col(f"i{j}").alias("inside"), low.alias("least"), high.alias("most")) for j, (low, high) in enumerate(sides)))
    cut = counts.join(aims, "g").select("g", F.explode(each).alias("e")).select("g", "e.*")
    kept = ["g", "n", "j", "at", "low", "high"]
    held = goals.select(*kept).join(cut, ["g", "j"]).filter((F.col("below") <= F.col("low")) & (F.col("below") + F.col("inside") > F.col("high")))
    goals = stage(goals.join(held.select("g", "j"), ["g", "j"], "left_anti").unionByName(held.select(*goals.columns)))
    near = [F.when(F.col("v").between(low, high), F.lit(j)) for j, (low, high) in enumerate(sides)]
    inside = aimed.filter(F.coalesce(*near).isNotNull()).select("g", "v", F.explode(F.array_compact(F.array(*near))).alias("j"))
    inside = inside.join(goals.filter(F.col("least").isNotNull() & (F.col("least") < F.col("most"))).select("g", "j"), ["g", "j"], "left_semi").select("g", "v", "j")
    missed = goals.filter("least is null").select("g", "j")
    return goals, stage(inside if missed.isEmpty() else inside.unionByName(rows.join(missed, "g").select("g", "v", "j")))


def with_distincts(df: DataFrame, by: Sequence[str], aggs: Sequence, distincts: dict[str, str]) -> DataFrame:
    """Aggregates with counts of distinct values (output name: column).

    A count of distinct values beside others makes Spark repeat each row once a column, and carry the other aggregates'
    buffers through two shuffles. Here values are made distinct first, each column by itself, and the small results are
    joined by group. Groups may have null keys.
    """
    out = df.groupBy(*by).agg(*aggs)
    for name, column in distincts.items():
        seen = df.select(*by, F.col(column).alias("_v")).distinct().groupBy(*(F.col(c).alias(f"_{c}") for c in by)).agg(F.count("_v").alias(name))
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
        out = out.join(seen, same).drop(*(f"_{c}" for c in by))
    return out


def nested_teams(df: DataFrame, match: str, team: str, player: str, placement: str) -> DataFrame:
    """Each match's teams with their best placement and their players in order."""
    teams = df.groupBy(match, team).agg(F.min(placement).alias("best"), F.sort_array(F.collect_list(player)).alias("players"))
    return teams.groupBy(match).agg(F.sort_array(F.collect_list(F.struct("best", team, "players"))).alias("teams"))
