"""Aggregates and the tables that are made of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import bucket, classify, grid_cell, rate, safe_div, seconds_between, surrogate_key
from ..operators.aggregates import exact_quantiles, grid_heatmap, nested_teams, quantiles, with_distincts
from ..operators.windows import group_share, others_in_group
from .catalog import query


@query("group_counts", "select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as quantity, round(avg(l_discount), 6) as discount, min(l_extendedprice) as least, max(l_extendedprice) as most from lineitem group by 1, 2")
def group_counts(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.avg("l_discount"), 6).alias("discount"), F.min("l_extendedprice").alias("least"), F.max("l_extendedprice").alias("most")
    )


@query("filtered_counts", "select l_suppkey, count(*) filter (where l_returnflag = 'R') as returned, count(*) filter (where l_quantity >= 40 and l_linestatus = 'F') as large_done from lineitem group by 1")
def filtered_counts(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count_if((F.col("l_quantity") >= 40) & (F.col("l_linestatus") == "F")).alias("large_done"))


@query("bool_rate", """
select l_suppkey, round(avg(case when l_returnflag = 'R' then 1.0::double else 0.0::double end), 6) as return_rate, max(case when l_quantity = 50 then 1 else 0 end) = 1 as any_full from lineitem group by 1""")
def bool_rate(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.round(rate(F.col("l_returnflag") == "R"), 6).alias("return_rate"), F.bool_or(F.coalesce(F.col("l_quantity") == 50, F.lit(False))).alias("any_full"))


@query("multi_distinct", "select p_brand, count(distinct l_orderkey) as orders, count(distinct l_suppkey) as suppliers, count(*) as lines from lineitem join part on p_partkey = l_partkey group by 1")
def multi_distinct(t):
    rows = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_suppkey").join(t.part.select("p_partkey", "p_brand"), "p_partkey")
    return rows.groupBy("p_brand").agg(F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_suppkey").alias("suppliers"), F.count(F.lit(1)).alias("lines"))


@query("exact_quantiles", "select p_brand, round(median(l_extendedprice), 3) as median_price, round(quantile_cont(l_extendedprice, 0.9), 3) as p90_price from lineitem join part on p_partkey = l_partkey group by 1")
def price_quantiles(t):
    rows = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_extendedprice").join(t.part.select("p_partkey", "p_brand"), "p_partkey")
    out = exact_quantiles(rows, ["p_brand"], "l_extendedprice", [0.5, 0.9])
    return out.select("p_brand", F.round(F.col("q")[0], 3).alias("median_price"), F.round(F.col("q")[1], 3).alias("p90_price"))


@query("hot_quantiles", """
select l_linestatus, case when l_tax < 0.08 then 'most' else 'rest' end as part, count(*) as n, round(quantile_cont(l_quantity, 0.1), 6) as q10, round(median(l_extendedprice + l_quantity / 1e3), 6) as q50, round(quantile_cont(l_extendedprice + l_quantity / 1e3, 0.99), 6) as q99
from lineitem group by 1, 2""")
def hot_quantiles(t):
    """Quantiles of groups of which a few hold most rows: those are found by counting ranges of values, time and again."""
    rows = t.lineitem.select("l_linestatus", F.expr("case when l_tax < 0.08 then 'most' else 'rest' end").alias("part"), "l_quantity", F.expr("l_extendedprice + l_quantity / 1e3").alias("price"))
    by, least = ["l_linestatus", "part"], 2_000
    price = exact_quantiles(rows, by, "price", [0.5, 0.99], hot_rows=least).select(*by, "n", F.round(F.col("q")[0], 6).alias("q50"), F.round(F.col("q")[1], 6).alias("q99"))
    return price.join(exact_quantiles(rows, by, "l_quantity", [0.1], hot_rows=least).select(*by, F.round(F.col("q")[0], 6).alias("q10")), by)


@query("guarded_ratio", "select user_id, round(sum(value) filter (where event_type = 'purchase') / nullif(count(*) filter (where event_type = 'click'), 0), 4) as value_per_click from events group by 1")
def guarded_ratio(t):
    return t.events.groupBy("user_id").agg(F.round(safe_div(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))), F.count_if(F.col("event_type") == "click")), 4).alias("value_per_click"))


@query("rate_per_minute", "select user_id, case when date_diff('second', min(ts), max(ts)) > 0 then round(count(*) * 60.0::double / date_diff('second', min(ts), max(ts)), 6) end as events_per_minute from events group by 1")
def rate_per_minute(t):
    span = seconds_between(F.min("ts"), F.max("ts"))
    return t.events.groupBy("user_id").agg(F.when(span > 0, F.round(F.count(F.lit(1)) * F.lit(60.0) / span, 6)).alias("events_per_minute"))


@query("global_aggregate", "select count(*) as n, round(sum(value), 2) as total, min(value) as least, max(value) as most, count(distinct user_id) as users from events")
def global_aggregate(t):
    return t.events.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"), F.min("value").alias("least"), F.max("value").alias("most"), F.count_distinct("user_id").alias("users"))


@query("alias_shadowed_group", "select l_orderkey, l_linenumber, max(l_linenumber) as line, min(l_shipdate) is not null as shipped, count(*) as n from lineitem group by l_orderkey, l_linenumber")
def alias_shadowed_group(t):
    """Grouped by the source column although a column of the result has a name like it."""
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_linenumber").alias("line"), F.min("l_shipdate").isNotNull().alias("shipped"), F.count(F.lit(1)).alias("n"))


@query("nested_teams", """
with s as (select l_orderkey, l_suppkey, min(l_linenumber) as best, count(distinct l_partkey) as parts from lineitem group by 1, 2)
select l_orderkey, count(*) as teams, sum(parts)::bigint as players, min(best) as first_place from s group by 1""")
def teams_of_orders(t):
    """Orders as matches, suppliers as teams, parts as players."""
    nested = nested_teams(t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber"), "l_orderkey", "l_suppkey", "l_partkey", "l_linenumber")
    players = F.aggregate("teams", F.lit(0).cast("long"), lambda acc, x: acc + F.size(F.array_distinct(x["players"])))
    return nested.select("l_orderkey", F.size("teams").cast("long").alias("teams"), players.alias("players"), F.col("teams")[0]["best"].alias("first_place"))


GRID = "cast(floor(l_extendedprice / 1000.0::double / 5.0::double) as bigint)::varchar || '_' || cast(floor(l_quantity / 5.0::double) as bigint)::varchar"


@query("grid_heatmap", f"select {GRID} as cell, count(*) as n from (select l_extendedprice, l_quantity from lineitem) group by 1")
def heatmap(t):
    points = t.lineitem.select((F.col("l_extendedprice") / F.lit(1000.0)).alias("x"), "l_quantity")
    return grid_heatmap(points, "x", "l_quantity", 5)


@query("item_performance", """
with b as (select p_brand, o_orderpriority, l_extendedprice as d, l_orderkey, l_suppkey, l_returnflag = 'R' as returned,
case when l_quantity < 10 then 'few' when l_quantity < 25 then 'some' else 'many' end as size from lineitem join part on p_partkey = l_partkey join orders on o_orderkey = l_orderkey where l_linestatus = 'F'),
g as (select p_brand, o_orderpriority, size, count(*) as sales, count(distinct l_orderkey) as orders, count(distinct l_suppkey) as suppliers, round(median(d), 4) as median_price, round(avg(d), 7) as mean_price,
round(quantile_cont(d, 0.9), 5) as p90_price, round(avg(case when returned then 1.0::double else 0.0::double end), 6) as return_rate from b group by 1, 2, 3)
select *, sum(sales) over (partition by o_orderpriority)::bigint as priority_sales, round(sales / cast(sum(sales) over (partition by o_orderpriority) as double), 8) as sale_share, sales >= 100 as has_enough from g""")
def item_performance(t):
    """Brands by priority and size: the weapon mart's plan on lineitems."""
    rows = t.lineitem.filter("l_linestatus = 'F'").select(F.col("l_partkey").alias("p_partkey"), F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", F.col("l_extendedprice").alias("d"), "l_quantity", "l_returnflag")
    rows = rows.join(t.part.select("p_partkey", "p_brand"), "p_partkey").join(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
    rows = rows.withColumn("size", bucket("l_quantity", [10, 25], ["few", "some", "many"]))
    aggs = [F.count(F.lit(1)).alias("sales"), quantiles("d", [0.5, 0.9]).alias("q"), F.round(F.avg("d"), 7).alias("mean_price"), F.round(rate(F.col("l_returnflag") == "R"), 6).alias("return_rate")]
    g = with_distincts(rows, ["p_brand", "o_orderpriority", "size"], aggs, {"orders": "o_orderkey", "suppliers": "l_suppkey"})
    g = g.withColumns({"median_price": F.round(F.col("q")[0], 4), "p90_price": F.round(F.col("q")[1], 5)}).drop("q")
    out = group_share(g, ["o_orderpriority"], "sales", "priority_sales", "sale_share")
    return out.withColumns({"sale_share": F.round("sale_share", 8), "has_enough": F.col("sales") >= 100})


@query("drop_zone", """
with d as (select *, cast(floor(o_totalprice / 40.0::double / 2500.0::double) as bigint)::varchar || '_' || cast(floor(c_acctbal / 2500.0::double) as bigint)::varchar as cell from orders join customer on c_custkey = o_custkey where o_orderstatus <> 'P'),
e as (select *, count(*) over (partition by o_custkey, cell) - 1 as contest from d)
select c_mktsegment, cell, count(*) as drops, count(distinct o_custkey) as customers, round(avg(o_totalprice)) as centroid, round(median(c_acctbal), 3) as median_balance, round(avg(contest), 3) as mean_contest, count(*) >= 50 as has_enough from e group by 1, 2""")
def drop_zone(t):
    """Orders by segment and cell with how contested the cell is."""
    rows = t.orders.filter("o_orderstatus <> 'P'").join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment"), "o_custkey")
    rows = others_in_group(rows.withColumn("cell", grid_cell(F.col("o_totalprice") / F.lit(40.0), "c_acctbal", 2500)), ["o_custkey", "cell"], "contest")
    return rows.groupBy("c_mktsegment", "cell").agg(
        F.count(F.lit(1)).alias("drops"), F.count_distinct("o_custkey").alias("customers"), F.round(F.avg("o_totalprice")).alias("centroid"), F.round(F.median("c_acctbal"), 3).alias("median_balance"),
        F.round(F.avg("contest"), 3).alias("mean_contest"), (F.count(F.lit(1)) >= 50).alias("has_enough"),
    )


@query("luck_buckets", """
with z as (select p.event_id, p.value, v.value as radius from (select * from events where event_type = 'purchase') p asof left join (select * from events where event_type = 'view') v on p.user_id = v.user_id and p.ts >= v.ts),
r as (select *, value / nullif(radius, 0) as radii from z)
select case when radii < 0.5 then '1. deep inside' when radii < 1.0 then '2. inside' when radii < 1.5 then '3. just outside' when radii < 2.0 then '4. one radius out' else '5. far outside' end as bucket,
count(*) as n, round(avg(radii), 3) as mean_radii, round(median(value), 3) as median_value from r group by 1""")
def luck_buckets(t):
    """Value over the radius of the moment; no radius falls to the last bucket."""
    from ..operators.joins import asof_join
    from .marts import LUCK_EDGES, LUCK_LABELS

    views = t.events.filter("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"), F.col("value").alias("radius"))
    rows = asof_join(t.events.filter("event_type = 'purchase'"), views, ["user_id"], "ts", "view_ts", values=["radius"]).withColumn("radii", safe_div("value", "radius"))
    return rows.groupBy(bucket("radii", LUCK_EDGES, LUCK_LABELS, null_label=LUCK_LABELS[-1]).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("radii"), 3).alias("mean_radii"), F.round(F.median("value"), 3).alias("median_value"))


@query("dim_entity", """
select md5(coalesce(cast(c_custkey as varchar), '_dbt_utils_surrogate_key_null_')) as customer_sk, c_custkey, count(o_orderkey) as orders, count(*) filter (where o_orderstatus = 'F') as finished,
round(coalesce(sum(o_totalprice), 0), 2) as spent, count(*) filter (where o_orderstatus = 'F') >= 5 as has_enough_history from customer left join orders on o_custkey = c_custkey group by c_custkey""")
def dim_entity(t):
    """Customers as a dimension with a sample-size gate."""
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.sum("o_totalprice").alias("spent"))
    rows = t.customer.select("c_custkey").join(o, "c_custkey", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return rows.select(surrogate_key("c_custkey").alias("customer_sk"), "c_custkey", zero("orders").alias("orders"), zero("finished").alias("finished"), F.round(F.coalesce("spent", F.lit(0.0)), 2).alias("spent"), (zero("finished") >= 5).alias("has_enough_history"))


@query("fact_entity_period", """
with l as (select l_orderkey, count(*) as lines, sum(case when l_returnflag = 'R' then 1 else 0 end) as returned, round(sum(l_extendedprice * (1 - l_discount)), 4) as revenue from lineitem group by 1)
select md5(cast(o_orderkey as varchar) || '-' || cast(o_custkey as varchar)) as fact_sk, o_orderkey, c_mktsegment, coalesce(lines, 0) as lines, cast(coalesce(returned, 0) as bigint) as returned, coalesce(lines, 0) - cast(coalesce(returned, 0) as bigint) as kept,
coalesce(revenue, 0) as revenue from orders join customer on c_custkey = o_custkey left join l on l_orderkey = o_orderkey""")
def fact_entity_period(t):
    """Orders as facts: parent attributes by inner join, line totals by left join with defaults."""
    l = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"))
    rows = t.orders.select("o_orderkey", "o_custkey").join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey").join(l, "o_orderkey", "left")
    rows = rows.withColumns({"lines": F.coalesce("lines", F.lit(0)), "returned": F.coalesce("returned", F.lit(0)), "revenue": F.coalesce("revenue", F.lit(0.0))})
    return rows.select(surrogate_key("o_orderkey", "o_custkey").alias("fact_sk"), "o_orderkey", "c_mktsegment", "lines", "returned", (F.col("lines") - F.col("returned")).alias("kept"), "revenue")


@query("dim_weapon_classes", """
select p_type, case when p_type ilike '%econ%' then 'cheap' when p_type ilike 'promo%' then 'offer' when p_type ilike 'small%' or p_type ilike 'medium%' then 'sized' else 'other' end as class, count(*) as n, round(median(p_retailprice), 1) as median_price from part group by 1""")
def classes(t):
    rules = [("%econ%", "cheap"), ("promo%", "offer"), ("small%", "sized"), ("medium%", "sized")]
    return t.part.groupBy("p_type", classify("p_type", rules, "other").alias("class")).agg(F.count(F.lit(1)).alias("n"), F.round(F.median("p_retailprice"), 1).alias("median_price"))
