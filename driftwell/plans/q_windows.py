"""Windows, ranks, dedup, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import metres, seconds_between
from ..operators.windows import competition_rank, dedup_first, duration_to_next, group_share, latest, leave_one_out_mean, others_in_group, over, prior_window, scaled_rank, sequence, spread, step_distance, top_k
from .catalog import query

LINE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("dedup_keep_first", f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(LINE)}) = 1""")
def dedup_keep_first(t):
    """One row for each order and line, the first of a total order."""
    return dedup_first(t.lineitem, ["l_orderkey", "l_linenumber"], LINE).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("latest_per_key", "select o_custkey, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1")
def latest_per_key(t):
    """Each customer's last order, by an aggregate."""
    return latest(t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("sequence_number", "select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as seq from orders")
def sequence_number(t):
    return sequence(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", F.col("seq").cast("long").alias("seq"))


@query("conditional_dense_rank_scaled", """
with r as (select s_suppkey, s_nationkey, s_acctbal > 0 as ok, case when s_acctbal > 0 then dense_rank() over (partition by s_nationkey, s_acctbal > 0 order by s_acctbal) end as rk from supplier),
m as (select *, max(rk) over (partition by s_nationkey) as ranks from r)
select s_suppkey, cast(rk as bigint) as rk, cast(ranks as bigint) as ranks, case when ok and ranks > 1 then (rk - 1) / cast(ranks - 1 as double) end as pct from m""")
def conditional_dense_rank_scaled(t):
    """Suppliers with money ranked within their nation, the rank scaled to 0..1."""
    rows = scaled_rank(t.supplier, ["s_nationkey"], ["s_acctbal"], F.col("s_acctbal") > 0, "rk", "ranks", "pct")
    return rows.select("s_suppkey", F.col("rk").cast("long").alias("rk"), F.col("ranks").cast("long").alias("ranks"), "pct")


@query("lead_duration", "select event_id, date_diff('second', ts, lead(ts) over (partition by user_id order by ts)) as seconds_to_next from events")
def lead_duration(t):
    return duration_to_next(t.events, ["user_id"], "ts", "next_ts", "seconds_to_next").select("event_id", "seconds_to_next")


STEPS = """with s as (select user_id, sqrt(pow(value - lag(value) over w, 2) + pow(k - lag(k) over w, 2)) as step
from (select user_id, ts, event_id, value, cast(json_extract_string(props, '$.k') as double) as k from events) window w as (partition by user_id order by ts, event_id))"""


@query("lag_step_distance", STEPS + """ select user_id, count(*) as ticks, round(sum(case when step <= 100 then step else 0 end), 3) as moved, round(max(case when step <= 100 then step end), 3) as longest,
count(*) filter (where step > 100) as implausible from s group by 1""")
def lag_step_distance(t):
    """Distance moved, with steps beyond a bound counted but not summed."""
    points = t.events.select("user_id", "ts", "event_id", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    rows = step_distance(points, ["user_id"], ["ts", "event_id"], "value", "k")
    fair = F.when(F.col("step") <= 100, F.col("step"))
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("ticks"), F.round(F.coalesce(F.sum(fair), F.lit(0.0)), 3).alias("moved"), F.round(F.max(fair), 3).alias("longest"), F.count_if(F.col("step") > 100).alias("implausible"))


@query("contest_level", "select o_orderkey, count(*) over (partition by o_custkey, o_orderpriority) - 1 as others from orders where o_orderstatus <> 'P'")
def contest_level(t):
    """Other orders of the customer and priority, after the filter."""
    return others_in_group(t.orders.filter("o_orderstatus <> 'P'"), ["o_custkey", "o_orderpriority"], "others").select("o_orderkey", "others")


LOO = """with b as (select o_orderkey, o_custkey, o_orderpriority, case when o_orderstatus = 'P' then null else o_totalprice end as v from orders)
select o_orderkey, round((sum(v) over w - coalesce(v, 0)) / nullif(count(v) over w - {0}, 0), 4) as others_mean from b window w as (partition by o_custkey, o_orderpriority)"""


def priced(t):
    return t.orders.withColumn("v", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))


@query("leave_one_out", LOO.format("case when v is null then 0 else 1 end"))
def leave_one_out(t):
    """Mean of the others; a row without a value leaves the number of others alone."""
    return leave_one_out_mean(priced(t), ["o_custkey", "o_orderpriority"], "v", "m").select("o_orderkey", F.round("m", 4).alias("others_mean"))


@query("leave_one_out_plain", LOO.format("1"))
def leave_one_out_plain(t):
    """The same with one subtracted either way."""
    return leave_one_out_mean(priced(t), ["o_custkey", "o_orderpriority"], "v", "m", strict=False).select("o_orderkey", F.round("m", 4).alias("others_mean"))


PRIOR = """select o_orderkey, round(avg(o_totalprice) over w, 7) as prior_mean, count(*) over w as prior_orders, min(o_totalprice) over w as prior_least
from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding)"""


@query("prior_window", PRIOR)
def expanding(t):
    """What was known of a customer before each order."""
    aggs = {"m": F.avg("o_totalprice"), "prior_orders": F.count(F.lit(1)), "prior_least": F.min("o_totalprice")}
    return prior_window(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], aggs).select("o_orderkey", F.round("m", 7).alias("prior_mean"), "prior_orders", "prior_least")


@query("competition_rank", "select l_orderkey, l_suppkey, best, rank() over (partition by l_orderkey order by best) as place from (select l_orderkey, l_suppkey, min(l_linenumber) as best from lineitem group by 1, 2)")
def team_places(t):
    """Suppliers of an order by their first line; ties 1, 1, 3."""
    best = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.min("l_linenumber").alias("best"))
    return competition_rank(best, ["l_orderkey"], ["best"], "place").withColumn("place", F.col("place").cast("long"))


@query("games_before", "select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as before from orders where o_orderstatus = 'F'")
def games_before(t):
    return sequence(t.orders.filter("o_orderstatus = 'F'"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", (F.col("seq") - 1).cast("long").alias("before"))


@query("share_of_total", """
with g as (select o_orderpriority, o_orderstatus, round(sum(o_totalprice), 2) as revenue from orders group by 1, 2)
select *, round(sum(revenue) over (partition by o_orderpriority), 2) as total, round(revenue / sum(revenue) over (partition by o_orderpriority), 8) as share from g""")
def share_of_total(t):
    """Share of a group's total by a window over the aggregate."""
    g = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    out = group_share(g, ["o_orderpriority"], "revenue", "total", "share")
    return out.withColumns({"total": F.round("total", 2), "share": F.round("share", 8)})


@query("topk_two_keys", "select c_custkey, c_acctbal, c_mktsegment from customer where c_nationkey <> 0 order by c_acctbal desc, c_custkey desc limit 25")
def topk_two_keys(t):
    return top_k(t.customer.filter("c_nationkey <> 0"), [F.desc("c_acctbal"), F.desc("c_custkey")], 25).select("c_custkey", "c_acctbal", "c_mktsegment")


@query("top1_group", "select p_brand, count(*) as n from part group by 1 order by n desc, p_brand limit 1")
def top1_group(t):
    return top_k(t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), F.asc("p_brand")], 1)


@query("work_queue", "select o_orderkey, o_orderdate is not null as dated from orders where o_orderstatus = 'O' order by o_orderpriority, o_orderdate, o_orderkey limit 40")
def work_queue(t):
    """Fewest attempts first, then oldest, limited."""
    return top_k(t.orders.filter("o_orderstatus = 'O'"), [F.asc("o_orderpriority"), F.asc("o_orderdate"), F.asc("o_orderkey")], 40).select("o_orderkey", F.col("o_orderdate").isNotNull().alias("dated"))


@query("set_ops", """
select 'both' as part, count(*) as n from (select c_custkey from customer intersect select o_custkey from orders)
union all select 'without', count(*) from (select c_custkey from customer except select o_custkey from orders)
union all select 'any', count(*) from (select c_custkey from customer union select user_id from events)
union all select 'distinct', count(distinct o_custkey) from orders""")
def set_ops(t):
    """Union, intersection, difference and distinct of keys."""
    c, o, e = t.customer.select(F.col("c_custkey").alias("k")), t.orders.select(F.col("o_custkey").alias("k")), t.events.select(F.col("user_id").alias("k"))
    one = lambda name, df: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return one("both", c.intersect(o)).unionByName(one("without", c.subtract(o))).unionByName(one("any", c.union(e).distinct())).unionByName(one("distinct", o.distinct()))


@query("rotation", """
with l as (select user_id, min(ts) as t0 from events where event_type = 'signup' group by 1),
p as (select e.*, cast(json_extract_string(props, '$.k') as double) as k from events e join l on l.user_id = e.user_id and e.ts >= l.t0 where event_type <> 'error'),
z as (select user_id, ts, value as radius from events where event_type = 'error' and value > 20),
a as (select p.user_id, p.ts, p.event_id, p.value, p.k, z.radius, p.event_type = 'click' as driving from p asof left join z on p.user_id = z.user_id and p.ts >= z.ts),
s as (select *, sqrt(pow(value - lag(value) over w, 2) + pow(k - lag(k) over w, 2)) as step from a window w as (partition by user_id order by ts, event_id))
select user_id, count(*) as ticks, count(*) * 10 as seconds, round(sum(case when step <= 60 then step else 0 end), 2) as moved, count(*) filter (where step > 60) as implausible,
round(avg(case when value > radius then 1.0::double else 0.0::double end), 4) as share_outside, round(avg(case when driving then 1.0::double else 0.0::double end), 4) as driving_share from s group by 1""")
def rotation(t):
    """Movement after the first touch, against the state of the moment."""
    from ..functions.exprs import rate
    from ..operators.joins import asof_join, since_join

    e = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    starts = e.filter("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("t0"))
    points = since_join(e.filter("event_type <> 'error'"), starts, ["user_id"], "ts", "t0")
    zones = e.filter("event_type = 'error' and value > 20").select("user_id", F.col("ts").alias("zone_ts"), F.col("value").alias("radius"))
    rows = step_distance(asof_join(points, zones, ["user_id"], "ts", "zone_ts", values=["radius"]), ["user_id"], ["ts", "event_id"], "value", "k")
    fair = F.when(F.col("step") <= 60, F.col("step"))
    return rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("ticks"), (F.count(F.lit(1)) * 10).alias("seconds"), F.round(F.coalesce(F.sum(fair), F.lit(0.0)), 2).alias("moved"), F.count_if(F.col("step") > 60).alias("implausible"),
        F.round(rate(F.col("value") > F.col("radius")), 4).alias("share_outside"), F.round(rate(F.col("event_type") == "click"), 4).alias("driving_share"),
    )


@query("phase_summary", """
with e as (select event_id, user_id, ts, value, event_type, lead(ts) over (partition by user_id order by ts) as next_ts from events)
select event_type, count(*) as phases, sum(date_diff('second', ts, next_ts))::bigint as seconds, round(median(value), 3) as median_value,
case when sum(date_diff('second', ts, next_ts)) > 0 then round(count(*) * 60.0::double / sum(date_diff('second', ts, next_ts)), 4) end as per_minute from e group by 1""")
def phase_summary(t):
    """Length and density of phases."""
    rows = duration_to_next(t.events, ["user_id"], "ts", "next_ts", "s").groupBy("event_type").agg(F.count(F.lit(1)).alias("phases"), F.sum("s").alias("seconds"), F.round(F.median("value"), 3).alias("median_value"))
    return rows.withColumn("per_minute", F.when(F.col("seconds") > 0, F.round(F.col("phases") * F.lit(60.0) / F.col("seconds"), 4)))


@query("unit_scaling", "select l_orderkey, l_linenumber, l_partkey, l_quantity / 100.0::double as quantity_m, date_diff('second', timestamp '1990-01-01', l_shipdate) as ship_s from lineitem")
def unit_scaling(t):
    """Scaling in double, and second boundaries."""
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", metres("l_quantity").alias("quantity_m"), seconds_between(F.lit("1990-01-01").cast("timestamp"), "l_shipdate").alias("ship_s"))


@query("observed_team_size", "select l_orderkey, l_suppkey, count(*) as lines, max(n) as team_size from (select *, count(*) over (partition by l_orderkey) as n from lineitem) group by 1, 2")
def observed_team_size(t):
    rows = spread(t.lineitem.select("l_orderkey", "l_suppkey"), t.lineitem.count(), "l_orderkey").withColumn("n", F.count(F.lit(1)).over(over(["l_orderkey"])))
    return rows.groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("lines"), F.max("n").alias("team_size"))
