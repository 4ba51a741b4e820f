"""Nested values, predicates with nulls, strings, dates and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import bucket, classify, foreign_key, is_bot, lookup, region_of, seconds_between, shrink_rate, size0, surrogate_key
from ..operators.joins import mirror_pairs
from ..operators.windows import over, spread
from .catalog import query
from .marts import matchup


@query("json_props_shred", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, json_extract_string(props, '$.missing') as missing from events where event_type = 'view'")
def json_props_shred(t):
    """A JSON column under a fixed schema; missing fields are null."""
    rows = t.events.filter("event_type = 'view'").withColumn("p", F.from_json("props", "k long, missing string"))
    return rows.select("event_id", "p.k", "p.missing")


@query("bridge_fanout", """
select l_orderkey, l_linenumber, 'part' as role, l_partkey as actor, count(*) as n from lineitem group by all
union all select l_orderkey, l_linenumber, 'supplier', l_suppkey, count(*) from lineitem where l_suppkey % 2 = 0 group by all
union all select l_orderkey, l_linenumber, 'customer', o_custkey, count(*) from lineitem join orders on o_orderkey = l_orderkey group by all""")
def bridge_fanout(t):
    """A row for each actor that is there, by role, from one pass over the joined rows."""
    rows = spread(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), t.lineitem.count(), "l_orderkey").join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey", "left")
    actor = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("actor"))
    actors = F.array(actor("part", F.col("l_partkey")), actor("supplier", F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey"))), actor("customer", F.col("o_custkey")))
    rows = rows.withColumn("a", F.explode(F.filter(actors, lambda x: x["actor"].isNotNull())))
    return rows.groupBy("l_orderkey", "l_linenumber", "a.role", "a.actor").agg(F.count(F.lit(1)).alias("n"))


@query("event_dispatch", """
select 'purchase' as target, count(*) as n, round(sum(value), 2) as total from events where event_type = 'purchase'
union all select 'view', count(*), round(sum(value), 2) from events where event_type = 'view'
union all select 'error', count(*), round(sum(value), 2) from events where event_type = 'error'""")
def event_dispatch(t):
    """One scan, dealt by type; types without a target go."""
    names = {"purchase": "purchase", "view": "view", "error": "error"}
    return t.events.withColumn("target", lookup("event_type", names)).filter("target is not null").groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("array_functions", """
select o_custkey, count(*) as orders, count(*) filter (where o_orderpriority = '1-URGENT') as urgent, min(o_orderkey) as first_key from orders group by 1""")
def array_functions(t):
    """Sizes, filters and elements of arrays."""
    rows = t.orders.groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("keys"), F.collect_list("o_orderpriority").alias("priorities"))
    return rows.select("o_custkey", size0("keys").cast("long").alias("orders"), size0(F.filter("priorities", lambda x: x == "1-URGENT")).cast("long").alias("urgent"), F.array_min("keys").alias("first_key"))


@query("sentinel_nulls", "select p_partkey, nullif(p_size, 1) as size, nullif(p_brand, 'Brand#1') as brand, nullif(p_retailprice, 900.0) / 100.0::double as price from part")
def sentinel_nulls(t):
    return t.part.select("p_partkey", F.nullif("p_size", F.lit(1)).alias("size"), F.nullif("p_brand", F.lit("Brand#1")).alias("brand"), (F.nullif("p_retailprice", F.lit(900.0)) / F.lit(100.0)).alias("price"))


@query("integrity_flags", """
select o_orderkey, o_orderstatus in ('F', 'O') as is_final, o_totalprice >= 100000 as is_large, o_orderpriority in ('1-URGENT', '2-HIGH') as is_urgent,
o_orderstatus in ('F', 'O') and o_totalprice >= 100000 and o_orderpriority in ('1-URGENT', '2-HIGH') as is_analytical from orders""")
def integrity_flags(t):
    """Flags attached, nothing filtered."""
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").isin("F", "O").alias("is_final"), (F.col("o_totalprice") >= 100000).alias("is_large"), F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_urgent"))
    return rows.withColumn("is_analytical", F.col("is_final") & F.col("is_large") & F.col("is_urgent"))


@query("ordered_case_3vl", """
with x as (select event_id, value, case when event_type <> 'error' then user_id end as killer, event_id % 150 as victim, case when event_type = 'view' then null else event_type = 'signup' end as suicide,
case when event_type <> 'click' then user_id % 2 = 0 end as killer_bot from events)
select event_id, case when suicide then 'suicide' when killer is null then 'environment' when killer = victim then 'self' when value > 100 then 'team_kill' else 'player' end as cause,
case when killer is not null then killer_bot end as killer_bot, victim % 3 <> 0 and killer is not null and not killer_bot as human_vs_human from x""")
def ordered_case_3vl(t):
    """The order of conditions decides, and nulls keep their third value."""
    e = F.col("event_type")
    x = t.events.select("event_id", "value", F.when(e != "error", F.col("user_id")).alias("killer"), (F.col("event_id") % 150).alias("victim"), F.when(e != "view", e == "signup").alias("suicide"), F.when(e != "click", F.col("user_id") % 2 == 0).alias("bot"))
    cause = F.when(F.col("suicide"), "suicide").when(F.col("killer").isNull(), "environment").when(F.col("killer") == F.col("victim"), "self").when(F.col("value") > 100, "team_kill").otherwise("player")
    there = F.col("killer").isNotNull()
    return x.select("event_id", cause.alias("cause"), F.when(there, F.col("bot")).alias("killer_bot"), ((F.col("victim") % 3 != 0) & there & ~F.col("bot")).alias("human_vs_human"))


@query("pattern_classify", """
select p_partkey, case when p_name ilike 'small%' then 'small' when p_name ilike '%red%' then 'red' when p_name ilike '%RING' then 'ring' else 'rest' end as class,
case when p_size < 10 then '0-10' when p_size < 25 then '10-25' when p_size < 40 then '25-40' else '40+' end as size_bucket from part""")
def pattern_classify(t):
    return t.part.select("p_partkey", classify("p_name", [("small%", "small"), ("%red%", "red"), ("%RING", "ring")], "rest").alias("class"), bucket("p_size", [10, 25, 40], ["0-10", "10-25", "25-40", "40+"]).alias("size_bucket"))


@query("lookup_case", "select o_orderkey, case o_orderstatus when 'F' then 'finished' when 'O' then 'open' end as status_name from orders")
def lookup_case(t):
    """Unknown codes become null."""
    return t.orders.select("o_orderkey", lookup("o_orderstatus", {"F": "finished", "O": "open"}).alias("status_name"))


@query("string_date_math", """
select p_partkey, regexp_replace(p_brand, '[0-9]+$', '') as stem, replace(p_type, 'ECON', 'E') as short_type, p_name like '%ring' as is_ring, p_name || '/' || nullif(p_brand, 'Brand#2') as joined,
case when p_size < 20 then upper(p_name) end as loud, abs(p_size - 25) as off, floor(sqrt(p_size))::bigint as root from part""")
def string_date_math(t):
    return t.part.select(
        "p_partkey", F.regexp_replace("p_brand", "[0-9]+$", "").alias("stem"), F.replace("p_type", F.lit("ECON"), F.lit("E")).alias("short_type"), F.col("p_name").like("%ring").alias("is_ring"),
        F.concat("p_name", F.lit("/"), F.nullif("p_brand", F.lit("Brand#2"))).alias("joined"), F.when(F.col("p_size") < 20, F.upper("p_name")).alias("loud"), F.abs(F.col("p_size") - 25).alias("off"),
        F.floor(F.sqrt("p_size")).cast("long").alias("root"),
    )


@query("time_math", "select event_id, date_diff('second', ts, ts + interval 900 millisecond) as boundaries, strftime(ts, '%Y-%m-%d') as day, date_diff('second', timestamp '2024-01-01', ts) as offset_s from events")
def time_math(t):
    """Boundaries passed, not time elapsed; days as text."""
    return t.events.select("event_id", seconds_between("ts", F.col("ts") + F.expr("interval 0.9 seconds")).alias("boundaries"), F.date_format("ts", "yyyy-MM-dd").alias("day"), seconds_between(F.lit("2024-01-01").cast("timestamp"), "ts").alias("offset_s"))


@query("account_names", """
with a as (select event_id, case when user_id % 10 = 0 then null when user_id % 3 = 0 then 'ai.' || user_id else 'account.' || user_id end as account, case when event_id % 4 = 0 then 'a.b' else 'x.y.region' || (event_id % 7) end as title from events)
select event_id, coalesce(account like 'ai.%', false) as is_bot, case when len(string_split(title, '.')) >= 3 then string_split(title, '.')[-1] end as region from a""")
def account_names(t):
    """Bots by their ids' beginning, and the last token of dotted ids."""
    u = F.col("user_id")
    account = F.when(u % 10 == 0, None).when(u % 3 == 0, F.concat(F.lit("ai."), u)).otherwise(F.concat(F.lit("account."), u))
    title = F.when(F.col("event_id") % 4 == 0, "a.b").otherwise(F.concat(F.lit("x.y.region"), F.col("event_id") % 7))
    rows = t.events.select("event_id", account.alias("account"), title.alias("title"))
    return rows.select("event_id", is_bot("account").alias("is_bot"), region_of("title").alias("region"))


@query("surrogate_key", """
select l_orderkey, l_linenumber, count(*) as n, md5(cast(l_orderkey as varchar) || '-' || coalesce(case when l_linenumber > 2 then cast(l_linenumber as varchar) end, '_dbt_utils_surrogate_key_null_')) as sk,
case when l_linenumber > 2 then md5(cast(l_linenumber as varchar)) end as fk from lineitem group by 1, 2""")
def keys(t):
    """Hashed keys, and foreign keys that stay null with their source."""
    rows = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).withColumn("line", F.when(F.col("l_linenumber") > 2, F.col("l_linenumber")))
    return rows.select("l_orderkey", "l_linenumber", "n", surrogate_key("l_orderkey", "line").alias("sk"), foreign_key("line").alias("fk"))


@query("shrink_rate", "select l_suppkey, sum(case when l_returnflag = 'R' then 1 else 0 end)::bigint as returned, count(*) as n, round((sum(case when l_returnflag = 'R' then 1 else 0 end) + 10 * 0.5::double) / (count(*) + 10), 8) as shrunk from lineitem group by 1")
def shrink(t):
    g = t.lineitem.groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count(F.lit(1)).alias("n"))
    return g.withColumn("shrunk", F.round(shrink_rate("returned", "n", 0.5, 10), 8))


@query("engagement_matrix", """
with c as (select user_id, event_type as a, lead(event_type) over (partition by user_id order by ts) as b, case when value < 20 then 'low' when value < 60 then 'mid' else 'high' end as range_bucket from events),
d as (select a as class_a, b as class_b, range_bucket, count(*) as a_beats_b from c where b is not null group by 1, 2, 3),
p as (select d.*, coalesce(r.a_beats_b, 0) as b_beats_a from d left join d r on r.class_a = d.class_b and r.class_b = d.class_a and r.range_bucket = d.range_bucket),
q as (select *, a_beats_b + b_beats_a as fights, a_beats_b / cast(a_beats_b + b_beats_a as double) as raw, (a_beats_b + 5.0::double) / (a_beats_b + b_beats_a + 10) as shrunk from p)
select class_a, class_b, range_bucket, a_beats_b, b_beats_a, fights, class_a = class_b as is_mirror, round(raw, 4) as raw_win_rate, round(shrunk, 4) as shrunk_win_rate, round(abs(raw - shrunk), 4) as shrinkage_applied,
fights >= 200 as has_enough_fights, class_a <> class_b and a_beats_b >= 100 and b_beats_a >= 100 as has_symmetric_observation from q""")
def engagement_matrix(t):
    """Consecutive event types of a user as directed pairs, paired with their mirror and shrunk."""
    rows = t.events.select(F.col("event_type").alias("class_a"), F.lead("event_type").over(over(["user_id"], ["ts"])).alias("class_b"), bucket("value", [20, 60], ["low", "mid", "high"]).alias("range_bucket"))
    directed = rows.filter("class_b is not null").groupBy("class_a", "class_b", "range_bucket").agg(F.count(F.lit(1)).alias("a_beats_b"))
    return matchup(mirror_pairs(directed, "class_a", "class_b", ["range_bucket"], "a_beats_b", "b_beats_a"))
