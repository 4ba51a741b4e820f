"""The gold and mart builders themselves, over inputs that the given tables stand in for.

Each input is a projection of a given table, stated once as expressions that Spark and the SQL share; the builders' own
logic is stated again in the SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gold, marts, silver
from .catalog import query


def project(df: DataFrame, columns: dict[str, str], where: str = "true") -> DataFrame:
    return df.filter(where).select(*(F.expr(e).alias(n) for n, e in columns.items()))


def as_sql(columns: dict[str, str], source: str, where: str = "true") -> str:
    return f"select {', '.join(f'{e} as {n}' for n, e in columns.items())} from {source} where {where}"


# ---- lineitems as deaths by weapon

ARMS = {
    "weapon_sk": "p_brand", "is_analytical": "l_linestatus = 'F'", "is_human_vs_human": "l_quantity > 5", "perspective": "l_returnflag", "match_id": "l_orderkey", "killer_account_id": "l_suppkey",
    "range_bucket": "case when l_tax < 0.01 then null when l_quantity < 20 then 'near' else 'far' end", "killer_distance_m": "case when l_linenumber < 7 then l_extendedprice / 1e2 end",
    "killer_through_wall": "case when l_discount > 0 then l_discount > 0.05 end", "victim_in_vehicle": "l_tax > 0.04", "zone_phase": "l_linenumber",
}
WEAPON = {"weapon_sk": "p_brand", "weapon_name": "concat('w ', p_brand)", "weapon_class": "case when p_brand < 'Brand#2' then 'low' else 'high' end", "is_firearm": "p_brand <> 'Brand#11'"}


@query("mart_weapon_performance", f"""
with k as ({as_sql(ARMS, "lineitem join part on p_partkey = l_partkey")}), w as (select distinct * from ({as_sql(WEAPON, "part")})),
b as (select k.*, weapon_name, weapon_class, coalesce(range_bucket, 'unknown') as rb from k join w on k.weapon_sk = w.weapon_sk where is_firearm and is_analytical and is_human_vs_human),
g as (select weapon_name, weapon_class, perspective, rb as range_bucket, count(*) as kills, count(distinct match_id) as matches, count(distinct killer_account_id) as distinct_killers,
round(quantile_cont(killer_distance_m, 0.5), 1) as median_distance_m, round(avg(killer_distance_m), 1) as mean_distance_m, round(quantile_cont(killer_distance_m, 0.9), 1) as p90_distance_m,
round(avg(case when killer_through_wall then 1e0 else 0e0 end), 8) as through_wall_rate, round(avg(case when victim_in_vehicle then 1e0 else 0e0 end), 8) as victim_in_vehicle_rate, round(avg(zone_phase), 2) as mean_zone_phase from b group by 1, 2, 3, 4)
select *, sum(kills) over (partition by perspective)::bigint as perspective_kills, round(kills / sum(kills) over (partition by perspective)::double, 8) as kill_share, kills >= 100 as has_enough_kills from g""")
def mart_weapon_performance(t):
    deaths = project(t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")), ARMS)
    out = marts.build_weapon_performance(deaths, project(t.part, WEAPON).distinct())
    return out.withColumns({c: F.round(c, 8) for c in ("through_wall_rate", "victim_in_vehicle_rate", "kill_share")})


# ---- orders as a player's matches

PEOPLE = {
    "match_id": "o_custkey % 300", "account_id": "o_orderkey", "map_name": "c_mktsegment", "is_analytical": "o_orderstatus <> 'P'", "is_bot": "o_orderpriority = '5-LOW'", "landing_x_m": "o_totalprice / 4.0013e1",
    "landing_y_m": "case when o_orderkey % 11 > 0 then c_acctbal * 1.00071e0 end", "human_placement_pct": "case when o_orderkey % 13 > 0 then (o_orderkey % 97) / 9.7313e1 + 1.7e-3 end", "human_kills": "o_orderkey % 7", "time_survived": "o_totalprice / 1e2",
    "survived_to_end": "o_orderkey % 10 = 0", "total_distance": "o_totalprice / 1e1",
}
PEOPLE_SQL = as_sql(PEOPLE, "orders join customer on c_custkey = o_custkey")


def people(t) -> DataFrame:
    return project(t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")), PEOPLE)


@query("mart_drop_zone", f"""
with p as ({PEOPLE_SQL}), d as (select *, floor(landing_x_m / 5e2)::int::varchar || '_' || floor(landing_y_m / 5e2)::int::varchar as grid_cell from p where is_analytical and not is_bot and landing_y_m is not null),
e as (select *, count(*) over (partition by match_id, grid_cell) - 1 as contest from d)
select map_name, case when map_name <> 'BUILDING' then lower(map_name) end as map_display_name, grid_cell, count(*) as drops, count(distinct match_id) as matches, round(avg(landing_x_m)) as centroid_x_m, round(avg(landing_y_m)) as centroid_y_m,
round(avg(human_placement_pct), 4) as avg_finish_pct, round(median(human_placement_pct), 4) as median_finish_pct, round(avg(time_survived)) as avg_survival_s, round(avg(human_kills), 3) as avg_human_kills,
round(avg(case when survived_to_end then 1e0 else 0e0 end), 4) as win_rate, round(avg(contest), 2) as avg_contest_level,
round(avg(human_kills) / case when avg(human_placement_pct) <> 0 then avg(human_placement_pct) end, 2) as kills_per_finish_cost, count(*) >= 50 as has_enough_drops from e group by 1, 2, 3""")
def mart_drop_zone(t):
    maps = t.customer.filter("c_mktsegment <> 'BUILDING'").select(F.col("c_mktsegment").alias("map_name"), F.lower("c_mktsegment").alias("map_display_name")).distinct()
    landed = people(t).withColumn("landing_grid_cell", gold.grid_cell("landing_x_m", "landing_y_m", 500))
    return marts.build_drop_zone(landed, maps)


# ---- events as phases, states, positions and deaths of a match

MATCH = "user_id % 20"
PHASE = {"match_id": MATCH, "event_ts": "ts", "phase": "cast(event_id % 3 as int)", "players_in_white_circle": "cast(event_id % 50 as int)"}
STATE = {
    "match_id": MATCH, "event_ts": "ts", "num_alive_players": "event_id % 90", "num_alive_teams": "event_id % 25", "safety_zone_x_m": "value * 5e1", "safety_zone_y_m": "value * 2e1",
    "safety_zone_radius_m": "case when event_id % 9 > 0 then value * 1e1 else 0e0 end",
}
POSITION = {
    "match_id": MATCH, "account_id": "user_id", "event_ts": "ts", "is_bot": "user_id % 10 = 0", "x_m": "value * 1e1", "y_m": "(event_id % 1000) * 1e0", "in_vehicle": "event_id % 3 = 0", "in_blue_zone": "event_id % 5 = 0",
}
LANDING = {"match_id": MATCH, "account_id": "user_id", "event_ts": "ts", "is_bot": "user_id % 10 = 0"}
PHASE_SQL, STATE_SQL = as_sql(PHASE, "events", "event_type = 'signup'"), as_sql(STATE, "events", "event_type = 'view'")


def states(t) -> DataFrame:
    return project(t.events, STATE, "event_type = 'view'")


def phases(t) -> DataFrame:
    return silver.build_phase(project(t.events, PHASE, "event_type = 'signup'"))


@query("mart_zone_luck", f"""
with s as ({STATE_SQL}), h as ({PHASE_SQL}), b as (select match_id, min(event_ts) as start from h where phase = 2 group by 1),
f as (select b.match_id, s.safety_zone_x_m as zx, s.safety_zone_y_m as zy, s.safety_zone_radius_m as r from b asof join s on b.match_id = s.match_id and b.start >= s.event_ts),
p as (select q.*, sqrt((landing_x_m - zx) * (landing_x_m - zx) + (landing_y_m - zy) * (landing_y_m - zy)) as away, r from ({PEOPLE_SQL}) q join f on q.match_id = f.match_id
where r > 0 and is_analytical and not is_bot and landing_x_m is not null and human_placement_pct is not null)
select case when away / r < 0.5 then '1. deep inside' when away / r < 1 then '2. inside' when away / r < 1.5 then '3. just outside' when away / r < 2 then '4. one radius out' else '5. far outside' end as zone_luck_bucket,
count(*) as player_matches, round(avg(away / r), 3) as avg_radii_from_centre, round(avg(away)) as avg_distance_m, round(avg(human_placement_pct), 4) as avg_finish_pct, round(median(human_placement_pct), 4) as median_finish_pct,
round(avg(human_kills), 3) as avg_human_kills, round(avg(time_survived)) as avg_survival_s, round(avg(total_distance)) as avg_distance_travelled_m from p group by 1""")
def mart_zone_luck(t):
    starts = phases(t).groupBy("match_id", "phase").agg(F.min("event_ts").alias("phase_start_ts"))
    return marts.build_zone_luck(people(t), starts, states(t))


ROTATED = {"match_id": MATCH, "account_id": "user_id", "human_placement_pct": "(user_id % 100) / 1e2", "human_kills": "user_id % 7", "team_mode": "event_type", "map_name": "'m'", "is_analytical": "case when user_id % 4 > 0 then user_id % 4 = 1 end"}


@query("mart_player_rotation", f"""
with p as ({as_sql(POSITION, "events")}), l as (select match_id, account_id, min(event_ts) as landed from ({as_sql(LANDING, "events", "event_type = 'click'")}) where not is_bot group by 1, 2),
s as (select * from ({STATE_SQL}) where safety_zone_radius_m > 0), g as (select p.* from p join l using (match_id, account_id) where not is_bot and event_ts >= landed),
z as (select g.*, s.safety_zone_radius_m as r, sqrt((x_m - s.safety_zone_x_m) * (x_m - s.safety_zone_x_m) + (y_m - s.safety_zone_y_m) * (y_m - s.safety_zone_y_m)) as d from g asof left join s on g.match_id = s.match_id and g.event_ts >= s.event_ts),
w as (select *, sqrt((x_m - lag(x_m) over o) * (x_m - lag(x_m) over o) + (y_m - lag(y_m) over o) * (y_m - lag(y_m) over o)) as step from z window o as (partition by match_id, account_id order by event_ts, x_m, y_m)),
a as (select match_id, account_id, count(*) as ticks, count(*) * 10 as grounded_seconds, round(coalesce(sum(step) filter (where step <= 600), 0)) as distance_travelled_m,
round(coalesce(sum(step) filter (where step <= 600), 0) / (count(*) * 10), 2) as mean_speed_mps, round(max(step) filter (where step <= 600) / 10, 1) as peak_speed_mps, count(*) filter (where step > 600) as implausible_steps,
round(avg(d)) as mean_dist_from_centre_m, round(avg(case when d > r then 1e0 else 0e0 end), 4) as share_outside_zone, round(avg(case when in_blue_zone then 1e0 else 0e0 end), 4) as blue_zone_share, count(*) filter (where in_blue_zone) * 10 as seconds_in_blue_zone,
round(avg(case when in_vehicle then 1e0 else 0e0 end), 4) as vehicle_share, count(*) filter (where in_vehicle) * 10 as seconds_in_vehicle from w group by 1, 2),
c as (select match_id, account_id, max(human_placement_pct) as human_placement_pct, max(human_kills) as human_kills, max(team_mode) as team_mode, max(map_name) as map_name, bool_or(coalesce(is_analytical, false)) as is_analytical from ({as_sql(ROTATED, "events")}) group by 1, 2)
select a.*, human_placement_pct, human_kills, team_mode, map_name, is_analytical, md5(concat_ws('-', match_id, account_id)) as rotation_sk from a join c using (match_id, account_id)""")
def mart_player_rotation(t):
    return marts.build_player_rotation(project(t.events, POSITION), project(t.events, LANDING, "event_type = 'click'"), states(t), project(t.events, ROTATED))


KILL = {
    "kill_sk": "concat('k', cast(event_id as string))", "match_id": MATCH, "event_ts": "ts", "victim_account_id": "concat('v', cast(user_id as string))", "killer_account_id": "case when event_id % 6 > 0 then concat('a', cast(event_id % 97 as string)) end",
    "victim_is_bot": "user_id % 8 = 0", "killer_is_bot": "case when event_id % 6 > 0 then event_id % 9 = 0 end", "has_killer": "event_id % 6 > 0", "is_human_vs_human": "user_id % 8 > 0 and event_id % 6 > 0 and event_id % 9 > 0",
    "death_cause": "case when event_id % 6 > 0 then 'player' else 'environment' end", "assist_count": "event_id % 3", "killer_weapon": "case when event_id % 5 > 0 then concat('W', cast(event_id % 12 as string)) end", "victim_weapon": "cast(null as string)",
    "killer_damage_reason": "'Head'", "killer_distance_m": "case when event_id % 6 > 0 then value * 2e0 end", "killer_through_wall": "event_id % 4 = 0", "victim_in_blue_zone": "event_id % 7 = 0", "victim_in_vehicle": "event_id % 10 = 0",
    "victim_x_m": "value * 7e0", "victim_y_m": "case when event_id % 17 > 0 then value * 3e0 end",
}
LOBBY = {"match_id": MATCH, "match_start_ts": "min(ts)", "match_type": "min(event_type)", "game_mode": "'squad'", "perspective": "'tpp'", "map_name": "case when min(user_id) % 2 = 0 then 'M' end", "is_analytical": "min(user_id) % 5 > 0"}
KILL_SQL, LOBBY_SQL = as_sql(KILL, "events", "event_type = 'purchase'"), as_sql(LOBBY, "events") + f" group by {MATCH}"
KEY_SQL = "md5(coalesce(cast({0} as string), '_dbt_utils_surrogate_key_null_'))"
DEATH_SQL = f"""
h as (select match_id, event_ts, max(phase) as zone_phase from ({PHASE_SQL}) group by 1, 2), s as ({STATE_SQL}), m as ({LOBBY_SQL}),
d as (select k.*, m.match_start_ts, m.match_type, m.game_mode, m.perspective, m.map_name, m.is_analytical, h.zone_phase, s.num_alive_players, s.num_alive_teams, s.safety_zone_radius_m
from ({KILL_SQL}) k join m on k.match_id = m.match_id asof left join h on k.match_id = h.match_id and k.event_ts >= h.event_ts asof left join s on k.match_id = s.match_id and k.event_ts >= s.event_ts)"""


def deaths(t) -> tuple[DataFrame, DataFrame]:
    lobby = t.events.groupBy(F.expr(MATCH).alias("match_id")).agg(*(F.expr(e).alias(n) for n, e in LOBBY.items() if n != "match_id"))
    return gold.build_fact_kill(project(t.events, KILL, "event_type = 'purchase'"), lobby, phases(t), states(t)), lobby


@query("fact_kill", f"""
with {DEATH_SQL}
select kill_sk, match_id, event_ts, {KEY_SQL.format("map_name")} as map_sk, case when killer_weapon is not null then md5(killer_weapon) end as weapon_sk, md5(victim_account_id) as victim_player_sk,
case when killer_account_id is not null then md5(killer_account_id) end as killer_player_sk, match_type, game_mode, perspective, map_name, is_analytical, date_diff('second', match_start_ts, event_ts) as seconds_into_match, zone_phase, num_alive_players,
num_alive_teams, safety_zone_radius_m, victim_account_id, victim_is_bot, killer_account_id, killer_is_bot, has_killer, is_human_vs_human, death_cause, assist_count, killer_weapon, victim_weapon, killer_damage_reason, killer_distance_m,
killer_through_wall, victim_in_blue_zone, victim_in_vehicle, victim_x_m, victim_y_m, floor(victim_x_m / 5e2)::int::varchar || '_' || floor(victim_y_m / 5e2)::int::varchar as victim_grid_cell,
case when killer_distance_m is null then null when killer_distance_m < 10 then '0-10m' when killer_distance_m < 50 then '10-50m' when killer_distance_m < 100 then '50-100m' when killer_distance_m < 200 then '100-200m'
when killer_distance_m < 400 then '200-400m' else '400m+' end as range_bucket from d""")
def fact_kill(t):
    return deaths(t)[0]


@query("fact_match_phase", f"""
with {DEATH_SQL}, n as (select *, lead(event_ts) over (partition by match_id order by event_ts) as next_ts from ({PHASE_SQL})),
g as (select match_id, phase, min(event_ts) as phase_start_ts, max(next_ts) as phase_end_ts, max(players_in_white_circle) as players_in_white_circle from n group by 1, 2),
x as (select match_id, zone_phase as phase, count(*) as deaths, count(*) filter (where is_human_vs_human) as human_deaths, count(*) filter (where death_cause = 'environment') as environment_deaths, round(median(killer_distance_m), 1) as median_engagement_m
from d where zone_phase is not null group by 1, 2)
select g.match_id, g.phase, phase_start_ts, phase_end_ts, players_in_white_circle, s.num_alive_players, s.num_alive_teams, s.safety_zone_radius_m, m.match_type, m.game_mode, m.map_name, m.is_analytical, coalesce(x.deaths, 0) as deaths,
coalesce(human_deaths, 0) as human_deaths, coalesce(environment_deaths, 0) as environment_deaths, median_engagement_m, md5(concat_ws('-', g.match_id, g.phase)) as match_phase_sk, {KEY_SQL.format("m.map_name")} as map_sk,
date_diff('second', phase_start_ts, phase_end_ts) as phase_duration_s,
case when date_diff('second', phase_start_ts, phase_end_ts) > 0 then round(coalesce(x.deaths, 0) * 6e1 / date_diff('second', phase_start_ts, phase_end_ts), 2) end as deaths_per_minute
from g asof left join s on g.match_id = s.match_id and g.phase_start_ts >= s.event_ts join m on g.match_id = m.match_id left join x on g.match_id = x.match_id and g.phase = x.phase""")
def fact_match_phase(t):
    kills, lobby = deaths(t)
    return gold.build_fact_match_phase(phases(t), states(t), lobby, kills)
