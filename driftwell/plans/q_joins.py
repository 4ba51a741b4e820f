"""As-of, interval, anti, semi, mirror and dimension joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import bucket, seconds_between
from ..operators.aggregates import skew_profile
from ..operators.joins import HOT_ROWS, asof_join, asof_lookup, in_set, interval_join, left_fill, merge_insert, mirror_pairs, not_in_set, null_safe_key, since_join
from .catalog import query

LAGS = [60, 3600, 21600, 86400]
LAG_LABELS = ["under a minute", "under an hour", "under 6 hours", "under a day", "longer"]
LAG_SQL = """case when {0} < 60 then 'under a minute' when {0} < 3600 then 'under an hour' when {0} < 21600 then 'under 6 hours'
 when {0} < 86400 then 'under a day' when {0} is null then 'never' else 'longer' end"""


def kind(t, name):
    return t.events.filter(F.col("event_type") == name)


@query("asof_event_state", f"""
select {LAG_SQL.format("date_diff('second', v.ts, p.ts)")} as lag_bucket, count(*) as purchases, count(v.ts) as with_view, round(sum(p.value), 2) as total_value
from (select * from events where event_type = 'purchase') p asof left join (select * from events where event_type = 'view') v on p.user_id = v.user_id and p.ts >= v.ts
group by 1""")
def asof_event_state(t):
    """Purchases by the time since the same user's latest view."""
    views = kind(t, "view").select("user_id", F.col("ts").alias("view_ts"))
    rows = asof_join(kind(t, "purchase"), views, ["user_id"], "ts", "view_ts", hot_rows=HOT_ROWS)
    label = bucket(seconds_between("view_ts", "ts"), LAGS, LAG_LABELS, null_label="never")
    return rows.groupBy(label.alias("lag_bucket")).agg(F.count(F.lit(1)).alias("purchases"), F.count("view_ts").alias("with_view"), F.round(F.sum("value"), 2).alias("total_value"))


@query("asof_hot_keys", """
select p.event_id, p.league, v.event_id as view_id from (select event_id, ts, case when user_id % 9 = 0 then 1 else 0 end as league from events where event_type = 'purchase') p
asof left join (select event_id, ts, case when user_id % 9 = 0 then 1 else 0 end as league from events where event_type = 'view') v on p.league = v.league and p.ts >= v.ts""")
def asof_hot_keys(t):
    """Purchases with their league's latest view; one league has most rows, and is cut into stretches of time by them."""
    league = F.expr("case when user_id % 9 = 0 then 1 else 0 end").alias("league")
    views = kind(t, "view").select(league, F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    return asof_join(kind(t, "purchase").select("event_id", "ts", league), views, ["league"], "ts", "view_ts", hot_rows=1_000).select("event_id", "league", "view_id")


@query("asof_two_states", """
select p.event_id, v.event_id as view_id, c.event_id as click_id
from (select * from events where event_type = 'purchase') p
asof left join (select * from events where event_type = 'view') v on p.user_id = v.user_id and p.ts >= v.ts
asof left join (select * from events where event_type = 'click') c on p.user_id = c.user_id and p.ts >= c.ts""")
def asof_two_states(t):
    """Each purchase with the latest view and the latest click, from one sort of the user's events each."""
    rows = kind(t, "purchase").select("event_id", "user_id", "ts")
    for name in ("view", "click"):
        state = kind(t, name).select("user_id", F.col("ts").alias(f"{name}_ts"), F.col("event_id").alias(f"{name}_id"))
        rows = asof_join(rows, state, ["user_id"], "ts", f"{name}_ts", values=[f"{name}_id"])
    return rows.select("event_id", "view_id", "click_id")


@query("asof_by_lookup", """
select p.event_id, v.event_id as view_id, v.value as view_value
from (select * from events where event_type = 'purchase') p asof left join (select * from events where event_type = 'view') v on p.user_id = v.user_id and p.ts >= v.ts""")
def asof_by_lookup(t):
    """The same by sorted arrays, for states that are few a key."""
    views = kind(t, "view").select("user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    return asof_lookup(kind(t, "purchase"), views, ["user_id"], "ts", "view_ts", ["view_id", "view_value"]).select("event_id", "view_id", "view_value")


@query("asof_collapsed", """
with o as (select o_custkey, o_orderdate, max(o_totalprice) as price, count(*) as n from orders group by 1, 2)
select e.event_id, o.n as orders_that_day, o.price as price
from (select event_id, user_id, cast(ts as timestamp) - interval 9000 day as t from events) e asof left join o on e.user_id = o.o_custkey and e.t >= o.o_orderdate""")
def asof_collapsed(t):
    """States of one time are made one before the join, so that none is chosen by chance."""
    states = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.max("o_totalprice").alias("price"), F.count(F.lit(1)).alias("orders_that_day"))
    states = states.withColumnRenamed("o_custkey", "user_id")
    events = t.events.select("event_id", "user_id", (F.col("ts") - F.expr("interval 9000 days")).alias("t"))
    return asof_join(events, states, ["user_id"], "t", "o_orderdate", values=["orders_that_day", "price"]).select("event_id", "orders_that_day", "price")


@query("asof_then_filter", """
select p.event_id, v.event_id as view_id
from (select * from events where event_type = 'purchase') p asof left join (select * from events where event_type = 'view') v on p.user_id = v.user_id and p.ts >= v.ts
where v.value > 40""")
def asof_then_filter(t):
    """A filter on the state after the join: rows whose latest state fails it drop out."""
    views = kind(t, "view").select("user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    return asof_join(kind(t, "purchase"), views, ["user_id"], "ts", "view_ts").filter("view_value > 40").select("event_id", "view_id")


@query("asof_prefiltered", """
select p.event_id, v.event_id as view_id
from (select * from events where event_type = 'purchase') p asof left join (select * from events where event_type = 'view' and value > 40) v on p.user_id = v.user_id and p.ts >= v.ts""")
def asof_prefiltered(t):
    """The same filter before the join: the latest state that passes it."""
    views = kind(t, "view").filter("value > 40").select("user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"))
    return asof_join(kind(t, "purchase"), views, ["user_id"], "ts", "view_ts").select("event_id", "view_id")


NEAR = "p.user_id = v.user_id and v.ts between p.ts - interval 12 hour and p.ts + interval 12 hour"
BOTH = "(select * from events where event_type = 'purchase') p join (select * from events where event_type = 'view') v"


def near(t):
    views = kind(t, "view").select("user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"))
    return interval_join(kind(t, "purchase").select("user_id", "ts", "event_id"), views, ["user_id"], "ts", "view_ts", 43200, 43200)


@query("interval_join_count", f"select p.user_id, count(*) as pairs, min(v.event_id) as first_view from {BOTH} on {NEAR} group by 1")
def interval_join_count(t):
    """Views within 12 hours of purchases, by user."""
    return near(t).groupBy("user_id").agg(F.count(F.lit(1)).alias("pairs"), F.min("view_id").alias("first_view"))


@query("interval_join_skew", f"select min(n) as min_rows, avg(n) as avg_rows, max(n) as max_rows, max(n) / avg(n) as skew from (select count(*) as n from {BOTH} on {NEAR} group by p.user_id)")
def interval_join_skew(t):
    """How uneven the pairs are."""
    return skew_profile(near(t), ["user_id"])


@query("after_first_touch", """
select e.user_id, count(*) as events_after, round(sum(e.value), 2) as value_after
from events e join (select user_id, min(ts) as t0 from events where event_type = 'signup' group by 1) s on s.user_id = e.user_id and e.ts >= s.t0 group by 1""")
def after_first_touch(t):
    """Events at or after each user's first signup."""
    starts = kind(t, "signup").groupBy("user_id").agg(F.min("ts").alias("t0"))
    return since_join(t.events, starts, ["user_id"], "ts", "t0").groupBy("user_id").agg(F.count(F.lit(1)).alias("events_after"), F.round(F.sum("value"), 2).alias("value_after"))


@query("anti_unprocessed", "select c_custkey, c_mktsegment from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')")
def anti_unprocessed(t):
    """Customers without a pending order."""
    pending = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return not_in_set(t.customer, pending, ["c_custkey"]).select("c_custkey", "c_mktsegment")


@query("semi_members", "select o_orderkey, o_totalprice from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def semi_members(t):
    """Orders of one segment's customers."""
    members = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return in_set(t.orders, members, ["o_custkey"]).select("o_orderkey", "o_totalprice")


@query("merge_insert", """
select o_orderkey, o_totalprice, 'old' as origin from orders where o_orderstatus = 'F'
union all select o_orderkey, o_totalprice, 'new' from orders where o_orderpriority = '1-URGENT' and o_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')""")
def merge_orders(t):
    """Insert-only upsert: urgent orders into finished ones."""
    part = lambda condition, origin: t.orders.filter(condition).select("o_orderkey", "o_totalprice", F.lit(origin).alias("origin"))
    return merge_insert(part("o_orderstatus = 'F'", "old"), part("o_orderpriority = '1-URGENT'", "new"), ["o_orderkey"])


def flows(t):
    c, s = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("a")), t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("b"))
    rows = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey").join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey").join(c, "o_custkey").join(s, "l_suppkey")
    return rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("a_to_b"))


FLOWS = "select c_nationkey as a, s_nationkey as b, count(*) as a_to_b from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join supplier on s_suppkey = l_suppkey group by 1, 2"


@query("mirror_self_join", f"with f as ({FLOWS}) select f.a, f.b, f.a_to_b, coalesce(r.a_to_b, 0) as b_to_a from f left join f r on r.a = f.b and r.b = f.a")
def mirror_self_join(t):
    """Flows between nations with the opposite flow."""
    return mirror_pairs(flows(t), "a", "b", [], "a_to_b", "b_to_a")


@query("left_multi_fill", """
select c_custkey, coalesce(n, 0) as orders_open, coalesce(spent, 0) as spent from customer left join
(select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as spent from orders where o_orderstatus = 'O' group by 1) on o_custkey = c_custkey""")
def left_multi_fill(t):
    """Customers with their open orders, zero where there are none."""
    totals = t.orders.filter("o_orderstatus = 'O'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders_open"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return left_fill(t.customer.select("c_custkey"), totals, ["c_custkey"], {"orders_open": 0, "spent": 0.0})


@query("dim_double_join", """
select a.n_name as customer_nation, b.n_name as supplier_nation, count(*) as lines, round(sum(l_extendedprice), 2) as revenue
from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join supplier on s_suppkey = l_suppkey
join nation a on a.n_nationkey = c_nationkey join nation b on b.n_nationkey = s_nationkey group by 1, 2""")
def dim_double_join(t):
    """One dimension joined twice, for either side."""
    side = lambda key, name: t.nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))
    c, s = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    rows = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_extendedprice").join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    rows = rows.join(c, "o_custkey").join(s, "l_suppkey").join(side("c_nationkey", "customer_nation"), "c_nationkey").join(side("s_nationkey", "supplier_nation"), "s_nationkey")
    return rows.groupBy("customer_nation", "supplier_nation").agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


@query("null_repair_join", """
with l as (select l_orderkey, l_linenumber, case when l_linenumber = 1 then null else l_linenumber end as slot from lineitem),
k as (select distinct l_orderkey, coalesce(case when l_linenumber = 1 then null else l_linenumber end, -1) as slot from lineitem where l_quantity > 25)
select count(*) as matched, count(distinct l.l_orderkey) as orders from l join k on k.l_orderkey = l.l_orderkey and k.slot = coalesce(l.slot, -1)""")
def null_repair_join(t):
    """Keys with nulls joined against sources that store a sentinel."""
    slot = F.nullif("l_linenumber", F.lit(1)).alias("slot")
    keys = t.lineitem.filter("l_quantity > 25").select("l_orderkey", slot).select("l_orderkey", *null_safe_key(t.lineitem, {"slot": -1})).distinct()
    rows = t.lineitem.select("l_orderkey", slot).select("l_orderkey", *null_safe_key(t.lineitem, {"slot": -1}))
    return rows.join(keys, ["l_orderkey", "slot"]).agg(F.count(F.lit(1)).alias("matched"), F.count_distinct("l_orderkey").alias("orders"))
