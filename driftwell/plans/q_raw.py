"""Shredding of nested JSON: the given tables are spelled as manifests and events, parsed under the fixed schemas, shredded.

A manifest is an order with its lineitems as participants and a roster for each return flag; events of five types become
the five event types that are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import spread
from ..sources import shred
from ..sources.schemas import EVENT, MANIFEST, pruned
from .catalog import query


def manifests(t, *fields: str) -> DataFrame:
    """data and included of each order, by way of JSON text. A manifest holds one order's lines, by flag and line number.

    Lines and orders are shuffled once each, by order and as columns; all else takes place where they are then. A line is
    spelled once, an order's lines are put together once. fields: what is parsed (all by default); the text has all.
    """
    e, rows = F.expr, t.lineitem.count()
    person = F.to_json(e("""struct('participant' as type, concat('p', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey) as id, struct(struct(concat(if(l_suppkey % 5 = 0, 'ai.', 'account.'), l_suppkey) as playerId,
        concat('n', l_suppkey) as name, l_linenumber as winPlace, cast(l_quantity as bigint) as kills, l_extendedprice as damageDealt, if(l_tax > 0.05, 'alive', 'byplayer') as deathType) as stats) as attributes)"""))
    lines = spread(t.lineitem.select("l_orderkey", "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax"), rows, "l_orderkey")
    line = F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linenumber").alias("number"), e("concat('p', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey) as id"), person.alias("person"))
    lines = lines.select("l_orderkey", line.alias("line")).groupBy("l_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    orders = spread(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"), rows, "o_orderkey")
    both = orders.join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")  # texts are far larger than estimated: they stay where they are
    rosters = F.to_json(e("""transform(transform(array_distinct(lines.flag), f -> filter(lines, x -> x.flag <=> f)), team -> struct('roster' as type, concat('r', o_orderkey, team[0].flag) as id,
        struct(if(array_min(team.number) = 1, 'true', 'False') as won, struct(ascii(team[0].flag) as teamId, array_min(team.number) as rank) as stats) as attributes,
        struct(struct(transform(team, x -> struct(x.id)) as data) as participants) as relationships))"""))
    data = F.to_json(e("""struct(concat('m', o_orderkey) as id, struct(cast(o_totalprice as bigint) as duration, o_orderstatus as matchType, if(o_orderkey % 3 > 0, o_orderpriority, null) as mapName,
        if(o_orderkey % 3 > 0, o_orderkey % 2 = 0, null) as isCustomMatch) as attributes)"""))
    objects = F.concat_ws(",", "lines.person", F.coalesce(F.substr(rosters, F.lit(2)), F.lit("]")))  # people, then the rosters' array without its bracket, in order of their flags
    text = F.concat(F.lit('{"data":'), data, F.lit(',"included":['), objects, F.lit("}"))
    return both.select(F.from_json(text, pruned(MANIFEST, *fields) if fields else MANIFEST).alias("m")).select("m.*")


@query("shred_matches", """
select 'm' || o_orderkey as match_id, trunc(o_totalprice)::bigint as duration_s, o_orderstatus as match_type, case when o_orderkey % 3 > 0 then o_orderpriority end as map_name, o_orderkey % 3 > 0 and o_orderkey % 2 = 0 as is_custom_match,
count(l_orderkey) as player_count, count(*) filter (where l_suppkey % 5 = 0) as bot_count, count(*) filter (where l_suppkey % 5 > 0) as human_count, count(distinct l_returnflag) as roster_count
from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_totalprice, o_orderstatus, o_orderpriority""")
def shred_matches(t):
    return shred.shred_match(manifests(t, "data", "included.type", "included.attributes.stats.playerId")).select("match_id", "duration_s", "match_type", "map_name", "is_custom_match", "player_count", "bot_count", "human_count", "roster_count")


@query("shred_players", """
select 'm' || l_orderkey as match_id, 'p' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey as participant_id, case when l_suppkey % 5 = 0 then 'ai.' else 'account.' end || l_suppkey as account_id, 'n' || l_suppkey as player_name, l_suppkey % 5 = 0 as is_bot,
max(ascii(l_returnflag)) over (partition by l_orderkey, l_linenumber, l_partkey, l_suppkey) as team_id, l_linenumber as win_place, trunc(l_quantity)::bigint as kills, l_extendedprice as damage_dealt, case when l_tax > 0.05 then 'alive' else 'byplayer' end as death_type from lineitem join orders on o_orderkey = l_orderkey""")
def shred_players(t):
    return shred.shred_match_player(manifests(t)).select("match_id", "participant_id", "account_id", "player_name", "is_bot", "team_id", "win_place", "kills", "damage_dealt", "death_type")


@query("shred_rosters", """
select 'm' || l_orderkey as match_id, 'r' || l_orderkey || l_returnflag as roster_id, ascii(l_returnflag) as team_id, min(l_linenumber) as team_rank, min(l_linenumber) = 1 as won, count(*) as participant_count
from lineitem join orders on o_orderkey = l_orderkey group by l_orderkey, l_returnflag""")
def shred_rosters(t):
    return shred.shred_roster(manifests(t, "data.id", "included.type", "included.id", "included.attributes.won", "included.attributes.stats.teamId", "included.attributes.stats.rank", "included.relationships"))


@query("shred_humans", """
select 'm' || l_orderkey as match_id, count(*) as humans, max(place) as last_place from (select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber) - 1 as place from lineitem join orders on o_orderkey = l_orderkey where l_suppkey % 5 > 0)
where place < 2 group by l_orderkey""")
def shred_humans(t):
    """The first two human accounts of each match."""
    return shred.human_accounts(manifests(t, "data.id", "included.type", "included.attributes.stats.playerId"), 2).groupBy("match_id").agg(F.count("account_id").alias("humans"), F.max("place").alias("last_place"))


def event_text() -> Column:
    """An event as JSON text, of five types."""
    who = lambda name, account: f"struct({account} as accountId, concat('{name}', user_id) as name, user_id % 4 as teamId, value as health, event_id % 3 = 0 as isInVehicle, struct(value as x, value * 2e0 as y, 1e0 as z) as location)"
    character, killer = who("c", "concat(if(user_id % 10 = 0, 'ai.', 'account.'), user_id)"), who("k", "concat(if(event_id % 9 = 0, 'ai.', 'account.'), event_id % 97)")
    of = lambda kind, x: f"if(event_type = '{kind}', {x}, null)"
    fields = {
        "_T": "case event_type when 'signup' then 'LogPhaseChange' when 'view' then 'LogGameStatePeriodic' when 'click' then 'LogPlayerPosition' when 'error' then 'LogParachuteLanding' else 'LogPlayerKillV2' end",
        "_D": "concat('t', event_id)", "phase": of("signup", "cast(event_id % 8 as int)"), "playersInWhiteCircle": of("signup", "if(event_id % 4 > 0, array_repeat('x', cast(event_id % 4 as int)), null)"),
        "gameState": of("view", "struct(event_id % 1000 as elapsedTime, event_id % 90 as numAlivePlayers, struct(value as x, value * 3e0 as y) as safetyZonePosition, value * 5e0 as safetyZoneRadius)"),
        "character": f"if(event_type in ('click', 'error'), {character}, null)", "distance": of("error", "value * 4e0"), "elapsedTime": of("click", "value"), "numAlivePlayers": of("click", "event_id % 70"),
        "attackId": of("purchase", "if(event_id % 8 > 0, event_id, null)"), "isSuicide": of("purchase", "event_id % 31 = 0"), "victimWeapon": of("purchase", "if(event_id % 7 > 0, concat('Weap_', event_id % 5), '')"),
        "assists_AccountId": of("purchase", "if(event_id % 5 > 2, array(concat('account.', event_id % 11)), null)"), "victim": of("purchase", character), "killer": of("purchase", f"if(event_id % 6 > 0, {killer}, null)"),
        "killerDamageInfo": of("purchase", "struct(if(event_id % 2 = 0, 'Head', null) as damageReason, concat('W', event_id % 12) as damageCauserName, value as distance, event_id % 4 = 0 as isThroughPenetrableWall)"),
    }
    return F.to_json(F.struct(*(F.expr(x).alias(n) for n, x in fields.items())))


def telemetry(t) -> DataFrame:
    """The events as JSON text, parsed; match_id as the file's name would give it."""
    rows = t.events.select(F.expr("concat('m', user_id % 20)").alias("match_id"), F.from_json(event_text(), EVENT).alias("e"))
    return rows.select("match_id", "e.*")


ACCOUNT = "case when user_id % 10 = 0 then 'ai.' else 'account.' end || user_id"
KILLER = "case when event_id % 6 > 0 then case when event_id % 9 = 0 then 'ai.' else 'account.' end || (event_id % 97) end"


@query("shred_phases", "select 'm' || (user_id % 20) as match_id, 't' || event_id as event_ts, event_id % 8 as phase, event_id % 4 as players_in_white_circle from events where event_type = 'signup'")
def shred_phases(t):
    return shred.shred_phase(telemetry(t))


@query("shred_states", """
select 'm' || (user_id % 20) as match_id, 't' || event_id as event_ts, event_id % 1000 as elapsed_time_s, event_id % 90 as num_alive_players, value as safety_zone_x, value * 3e0 as safety_zone_y, cast(null as double) as safety_zone_z,
value * 5e0 as safety_zone_radius, cast(null as double) as red_zone_x from events where event_type = 'view'""")
def shred_states(t):
    return shred.shred_game_state(telemetry(t)).select("match_id", "event_ts", "elapsed_time_s", "num_alive_players", "safety_zone_x", "safety_zone_y", "safety_zone_z", "safety_zone_radius", "red_zone_x")


@query("shred_positions", f"""
select 'm' || (user_id % 20) as match_id, 't' || event_id as event_ts, value as elapsed_time_s, event_id % 70 as num_alive_players, {ACCOUNT} as account_id, user_id % 10 = 0 as is_bot, user_id % 4 as team_id, value as health,
event_id % 3 = 0 as in_vehicle, false as in_blue_zone, value as x, value * 2e0 as y from events where event_type = 'click'""")
def shred_positions(t):
    return shred.shred_player_position(telemetry(t)).drop("ranking", "z")


@query("shred_landings", f"""
select 'm' || (user_id % 20) as match_id, 't' || event_id as event_ts, {ACCOUNT} as account_id, 'c' || user_id as player_name, user_id % 4 as team_id, user_id % 10 = 0 as is_bot, value * 4e0 as distance, value as x, value * 2e0 as y, 1e0 as z
from events where event_type = 'error'""")
def shred_landings(t):
    return shred.shred_landing(telemetry(t))


@query("shred_deaths", f"""
select 'm' || (user_id % 20) as match_id, 't' || event_id as event_ts, case when event_id % 8 > 0 then event_id end as attack_id, event_id % 31 = 0 as is_suicide, case when event_id % 7 > 0 then 'Weap_' || (event_id % 5) end as victim_weapon,
case when event_id % 5 > 2 then 1 else 0 end as assist_count, 0 as team_kill_count, {ACCOUNT} as victim_account_id, user_id % 10 = 0 as victim_is_bot, event_id % 3 = 0 as victim_in_vehicle, {KILLER} as killer_account_id,
event_id % 6 > 0 and event_id % 9 = 0 as killer_is_bot, case when event_id % 6 > 0 then value * 2e0 end as killer_y, case when event_id % 2 = 0 then 'Head' end as killer_damage_reason, 'W' || (event_id % 12) as killer_damage_causer,
value as killer_distance, event_id % 4 = 0 as killer_through_wall, cast(null as varchar) as finisher_account_id from events where event_type = 'purchase'""")
def shred_deaths(t):
    return shred.shred_kill(telemetry(t)).select(
        "match_id", "event_ts", "attack_id", "is_suicide", "victim_weapon", "assist_count", "team_kill_count", "victim_account_id", "victim_is_bot", "victim_in_vehicle", "killer_account_id", "killer_is_bot", "killer_y",
        "killer_damage_reason", "killer_damage_causer", "killer_distance", "killer_through_wall", "finisher_account_id",
    )


@query("shred_actors", f"""
with d as (select 'm' || (user_id % 20) as match_id, 't' || event_id as event_ts, case when event_id % 8 > 0 then event_id end as attack_id, {ACCOUNT} as victim, {KILLER} as killer, event_id, value from events where event_type = 'purchase')
select match_id, event_ts, attack_id, 'victim' as role, victim as account_id, starts_with(victim, 'ai.') as is_bot, value as x, victim as victim_account_id from d
union all select match_id, event_ts, attack_id, 'killer', killer, starts_with(killer, 'ai.'), value, victim from d where killer is not null
union all select match_id, event_ts, attack_id, 'assist', 'account.' || (event_id % 11), false, null, victim from d where event_id % 5 > 2""")
def shred_actors(t):
    """The bridge from deaths to everyone who had a part in them."""
    return shred.shred_kill_participant(telemetry(t)).select("match_id", "event_ts", "attack_id", "role", "account_id", "is_bot", "x", "victim_account_id")


@query("shred_definitions", """
with d as (select l_orderkey, arg_min(l_suppkey, struct_pack(a := l_linenumber, b := 'x.' || (l_suppkey % 7) || '.eu-' || (l_suppkey % 3))) as s,
  min(struct_pack(a := l_linenumber, b := 'x.' || (l_suppkey % 7) || '.eu-' || (l_suppkey % 3))).b as id from lineitem where l_linenumber > 1 group by 1)
select 'm' || o_orderkey as match_id, id as telemetry_match_id, 'eu-' || (s % 3) as region, case when s % 7 > 0 then 'q' || (s % 7) end as ping_quality
from orders left join d on l_orderkey = o_orderkey""")
def shred_definitions(t):
    """Matches with the first of their definition events: where and how well the lobby was reached. Some have none."""
    line = "concat('x.', l_suppkey % 7, '.eu-', l_suppkey % 3) as MatchId"
    text = F.to_json(F.expr(f"struct('{shred.DEFINITION}' as _T, cast(l_linenumber as string) as _D, {line}, if(l_suppkey % 7 > 0, concat('q', l_suppkey % 7), '') as PingQuality)"))
    events = t.lineitem.filter("l_linenumber > 1").select(F.concat(F.lit("m"), "l_orderkey").alias("match_id"), F.from_json(text, EVENT).alias("e")).select("match_id", "e.*")
    matches = t.orders.select(F.from_json(F.to_json(F.expr("struct(struct(concat('m', o_orderkey) as id) as data)")), MANIFEST).alias("m")).select("m.*")
    return shred.shred_match(matches, shred.match_definitions(events)).select("match_id", "telemetry_match_id", "region", "ping_quality")
