"""Data-quality assertions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as q
from .catalog import query


@query("dq_report", """
select 'orders.o_custkey not null' as check_name, count(*) filter (where o_custkey is null) as violations from orders
union all select 'orders.o_orderkey unique', count(*) from (select o_orderkey from orders group by 1 having count(*) > 1)
union all select 'orders.o_orderstatus accepted', count(*) filter (where o_orderstatus not in ('F', 'O')) from orders
union all select 'lineitem.l_discount range', count(*) filter (where l_discount < 0 or l_discount > 0.05) from lineitem
union all select 'orders.o_custkey parent', count(*) from orders where o_custkey not in (select c_custkey from customer where c_mktsegment <> 'BUILDING')
union all select 'lineitem order and line unique', count(*) from (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1)""")
def dq_report(t):
    """Violations of each kind of assertion."""
    parents = t.customer.filter("c_mktsegment <> 'BUILDING'")
    by_row = q.row_checks(t.orders, {"orders.o_custkey not null": F.col("o_custkey").isNull(), "orders.o_orderstatus accepted": q.outside_values("o_orderstatus", ["F", "O"])})
    by_row = by_row.unionByName(q.row_checks(t.lineitem, {"lineitem.l_discount range": q.outside_range("l_discount", 0, 0.05)}))
    return by_row.unionByName(q.run_checks([
        ("orders.o_orderkey unique", q.unique(t.orders, "o_orderkey")), ("orders.o_custkey parent", q.relationships(t.orders, "o_custkey", parents, "c_custkey")),
        ("lineitem order and line unique", q.unique_combination(t.lineitem, ["l_orderkey", "l_linenumber"])),
    ]))


WANT, MARKED, THERE = "select distinct o_orderkey as k from orders where o_orderstatus <> 'P'", "select distinct o_orderkey as k from orders where o_orderpriority <> '5-LOW'", "select distinct l_orderkey as k from lineitem"


def loads(t):
    want = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"))
    marked = t.orders.filter("o_orderpriority <> '5-LOW'").select(F.col("o_orderkey").alias("k"))
    return q.reconcile(want, marked, t.lineitem.select(F.col("l_orderkey").alias("k")), "k")


@query("reconcile", f"""
with w as ({WANT}), m as ({MARKED}), t as ({THERE})
select 'coverage' as check_name, count(*) as violations from (select k from w except select k from m) union all select 'accounting', count(*) from (select k from m except select k from w)
union all select 'parity', count(*) from (select k from m except select k from t) union all select 'containment', count(*) from (select k from t except select k from m)""")
def reconcile(t):
    return loads(t)[0]


@query("reconcile_safe", f"{WANT} intersect {MARKED} intersect {THERE}")
def reconcile_safe(t):
    """Keys that were expected, marked and are there."""
    return loads(t)[1]


@query("dup_profile", "select l_returnflag, count(*) as rows, count(distinct l_orderkey * 100 + l_linenumber) as distinct_keys, round(1 - count(distinct l_orderkey * 100 + l_linenumber) / cast(count(*) as double), 8) as duplicate_rate from lineitem group by 1")
def dup_profile(t):
    return q.duplicate_rate(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_returnflag"]).withColumn("duplicate_rate", F.round("duplicate_rate", 8))


@query("joinability", "select count(*) as rows, round(avg(case when c_custkey is null then 0.0::double else 1.0::double end), 8) as share from events left join customer on c_custkey = user_id * 20")
def joinability(t):
    events = t.events.select((F.col("user_id") * 20).alias("fk"))
    return q.joinability(events, "fk", t.customer, "c_custkey").withColumn("share", F.round("share", 8))


@query("degenerate_rates", "select l_orderkey, count(*) as n, avg(case when l_returnflag = 'R' then 1.0::double else 0.0::double end) as rate from lineitem group by 1 having count(*) >= 4 and (count(*) filter (where l_returnflag = 'R') in (0, count(*)))")
def degenerate(t):
    g = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)).alias("rate"))
    return q.degenerate_rates(g, "rate", "n", 4)
