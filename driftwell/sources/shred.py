"""Shredding: nested manifests and events to flat bronze tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import flatten, is_bot, region_of, size0
from .schemas import CHARACTER_FIELDS, DAMAGE_FIELDS, bronze_columns

#: Event types that each table is made of.
PHASE, STATE, KILL, LANDING, POSITION, DEFINITION = "LogPhaseChange", "LogGameStatePeriodic", "LogPlayerKillV2", "LogParachuteLanding", "LogPlayerPosition", "LogMatchDefinition"


def _shape(df: DataFrame, table: str) -> DataFrame:
    return df.select(*(F.col(name).cast(kind).alias(name) for name, kind in bronze_columns(table)))


def included(kind: str) -> Column:
    """The manifest's included objects of one type."""
    return F.filter("included", lambda x: x["type"] == kind)


def shred_match(manifests: DataFrame, definitions: DataFrame | None = None) -> DataFrame:
    """One row a match: attributes, and counts from the arrays themselves. definitions: match_definitions()."""
    people = included("participant")
    bots = F.filter(people, lambda p: is_bot(p["attributes"]["stats"]["playerId"]))
    a = "data.attributes."
    rows = manifests.select(
        F.col("data.id").alias("match_id"), F.col(a + "createdAt").alias("created_at"), F.col(a + "duration").alias("duration_s"), F.col(a + "gameMode").alias("game_mode"),
        F.col(a + "matchType").alias("match_type"), F.col(a + "mapName").alias("map_name"), F.col(a + "shardId").alias("shard_id"), F.col(a + "seasonState").alias("season_state"),
        F.coalesce(F.col(a + "isCustomMatch"), F.lit(False)).alias("is_custom_match"), F.col(a + "titleId").alias("title_id"), size0(people).alias("player_count"),
        size0(bots).alias("bot_count"), size0(included("roster")).alias("roster_count"),
    ).withColumn("human_count", F.col("player_count") - F.col("bot_count"))
    if definitions is None:
        rows = rows.withColumn("telemetry_match_id", F.lit(None)).withColumn("ping_quality", F.lit(None))
    else:
        rows = rows.join(definitions, "match_id", "left")
    return _shape(rows.withColumn("region", region_of("telemetry_match_id")), "match")


def match_definitions(events: DataFrame) -> DataFrame:
    """The first definition event of each match: telemetry id and ping quality (empty is null)."""
    first = F.min_by(F.struct("MatchId", "PingQuality"), F.struct("_D", "MatchId")).alias("d")
    rows = events.filter(F.col("_T") == DEFINITION).groupBy("match_id").agg(first)
    return rows.select("match_id", F.col("d.MatchId").alias("telemetry_match_id"), F.nullif("d.PingQuality", F.lit("")).alias("ping_quality"))


def team_map() -> Column:
    """A manifest's participants with their teams, as a map; who stands in several rosters has the last one's team.

    Entries are sorted by participant, the last roster first, and all but the first of each participant go.
    """
    rosters = F.transform(included("roster"), lambda r, i: F.transform(
        F.coalesce(r["relationships"]["participants"]["data"], F.array().cast("array<struct<id: string>>")),
        lambda p: F.struct(p["id"].alias("id"), (-i).alias("roster"), r["attributes"]["stats"]["teamId"].alias("team")),
    ))
    entries = F.sort_array(F.filter(F.flatten(rosters), lambda e: e["id"].isNotNull()))
    last = F.transform(F.array(entries), lambda a: F.filter(a, lambda e, i: (i == 0) | (F.get(a, i - 1)["id"] != e["id"])))[0]
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["id"], e["team"])))


def shred_match_player(manifests: DataFrame) -> DataFrame:
    """One row a participant; the team comes from the last roster that refers to it, null if none does.

    Teams are looked up in the manifest's own map, row by row: there is no join, and a manifest is read once.
    """
    one = manifests.select(F.col("data.id").alias("match_id"), team_map().alias("teams"), included("participant").alias("people"))
    people = one.select("match_id", "teams", F.explode_outer("people").alias("p")).filter("p is not null")  # a plain explode would have its filter on the array parse JSON once more
    people = people.select("match_id", F.try_element_at("teams", F.col("p.id")).alias("team_id"), F.col("p.id").alias("participant_id"), "p.attributes.stats.*")
    names = {
        "playerId": "account_id", "name": "player_name", "winPlace": "win_place", "killPlace": "kill_place", "DBNOs": "dbnos", "damageDealt": "damage_dealt", "deathType": "death_type",
        "headshotKills": "headshot_kills", "longestKill": "longest_kill", "roadKills": "road_kills", "teamKills": "team_kills", "vehicleDestroys": "vehicle_destroys",
        "weaponsAcquired": "weapons_acquired", "walkDistance": "walk_distance", "rideDistance": "ride_distance", "swimDistance": "swim_distance", "timeSurvived": "time_survived",
    }
    people = people.drop("teamId", "rank").withColumnsRenamed(names).withColumn("is_bot", is_bot("account_id"))
    return _shape(people, "match_player")


def shred_roster(manifests: DataFrame) -> DataFrame:
    """One row a team. 'won' arrives as text."""
    rows = manifests.select(F.col("data.id").alias("match_id"), F.explode_outer(included("roster")).alias("r")).filter("r is not null")
    return _shape(rows.select(
        "match_id", F.col("r.id").alias("roster_id"), F.col("r.attributes.stats.teamId").alias("team_id"), F.col("r.attributes.stats.rank").alias("team_rank"),
        F.coalesce(F.lower("r.attributes.won") == "true", F.lit(False)).alias("won"), size0(F.col("r.relationships.participants.data")).alias("participant_count"),
    ), "roster")


def shred_phase(events: DataFrame) -> DataFrame:
    rows = events.filter(F.col("_T") == PHASE)
    return _shape(rows.select("match_id", F.col("_D").alias("event_ts"), "phase", size0("playersInWhiteCircle").alias("players_in_white_circle")), "phase")


def shred_game_state(events: DataFrame) -> DataFrame:
    zone = lambda name, path: [F.col(f"gameState.{path}Position.{k}").alias(f"{name}_{k}") for k in "xyz"]
    g = "gameState."
    return _shape(events.filter(F.col("_T") == STATE).select(
        "match_id", F.col("_D").alias("event_ts"), F.col(g + "elapsedTime").alias("elapsed_time_s"), F.col(g + "numStartTeams").alias("num_start_teams"), F.col(g + "numAliveTeams").alias("num_alive_teams"),
        F.col(g + "numJoinPlayers").alias("num_join_players"), F.col(g + "numStartPlayers").alias("num_start_players"), F.col(g + "numAlivePlayers").alias("num_alive_players"),
        *zone("safety_zone", "safetyZone"), *zone("poison_gas", "poisonGasWarning"), *zone("red_zone", "redZone"), F.col(g + "safetyZoneRadius").alias("safety_zone_radius"),
        F.col(g + "poisonGasWarningRadius").alias("poison_gas_radius"), F.col(g + "redZoneRadius").alias("red_zone_radius"), F.col(g + "blackZoneRadius").alias("black_zone_radius"),
    ), "game_state")


def shred_kill(events: DataFrame) -> DataFrame:
    """One row a death: four characters and three damage records, flattened with prefixes."""
    people = {"victim": "victim", "killer": "killer", "finisher": "finisher", "dbno_maker": "dBNOMaker"}
    damage = {"killer": "killerDamageInfo", "finish": "finishDamageInfo", "dbno": "dBNODamageInfo"}
    columns = [c for prefix, source in people.items() for c in [*flatten(prefix, source, CHARACTER_FIELDS), is_bot(f"{source}.accountId").alias(f"{prefix}_is_bot")]]
    columns += [c for prefix, source in damage.items() for c in flatten(prefix, source, DAMAGE_FIELDS)]
    return _shape(events.filter(F.col("_T") == KILL).select(
        "match_id", F.col("_D").alias("event_ts"), F.col("attackId").alias("attack_id"), F.col("dBNOId").alias("dbno_id"), F.col("isSuicide").alias("is_suicide"),
        F.nullif("victimWeapon", F.lit("")).alias("victim_weapon"), F.col("victimGameResult.rank").alias("victim_game_rank"), F.col("victimGameResult.gameResult").alias("victim_game_result"),
        size0("assists_AccountId").alias("assist_count"), size0("teamKillers_AccountId").alias("team_kill_count"), *columns,
    ), "kill")


def shred_kill_participant(events: DataFrame) -> DataFrame:
    """Bridge: a row for each actor that is there, with its role, and one for each assist. The victim's id rides along, so
    that a death can be told from another of the same instant."""
    kind = "struct<role: string, account_id: string, player_name: string, team_id: bigint, x: double, y: double, z: double>"
    def actor(role, c):
        return F.struct(F.lit(role).alias("role"), F.col(f"{c}.accountId").alias("account_id"), F.col(f"{c}.name").alias("player_name"), F.col(f"{c}.teamId").alias("team_id"), *(F.col(f"{c}.location.{k}").alias(k) for k in "xyz")).cast(kind)
    actors = F.filter(F.array(actor("victim", "victim"), actor("killer", "killer"), actor("finisher", "finisher"), actor("dbno_maker", "dBNOMaker")), lambda x: x["account_id"].isNotNull() & (x["account_id"] != ""))
    none = lambda t: F.lit(None).cast(t)
    assists = F.transform(F.coalesce("assists_AccountId", F.array().cast("array<string>")), lambda a: F.struct(F.lit("assist").alias("role"), a.alias("account_id"), none("string").alias("player_name"), none("bigint").alias("team_id"), none("double").alias("x"), none("double").alias("y"), none("double").alias("z")).cast(kind))
    rows = events.filter(F.col("_T") == KILL).select("match_id", F.col("_D").alias("event_ts"), F.col("attackId").alias("attack_id"), F.col("victim.accountId").alias("victim_account_id"), F.explode(F.concat(actors, assists)).alias("a"))
    rows = rows.select("match_id", "event_ts", "attack_id", "victim_account_id", "a.*").withColumn("is_bot", is_bot("account_id"))
    return _shape(rows, "kill_participant")


def _mover(events: DataFrame, kind: str, *more: Column) -> DataFrame:
    c = "character."
    return events.filter(F.col("_T") == kind).select("match_id", F.col("_D").alias("event_ts"), F.col(c + "accountId").alias("account_id"), F.col(c + "name").alias("player_name"), F.col(c + "teamId").alias("team_id"), is_bot(c + "accountId").alias("is_bot"), *(F.col(f"{c}location.{k}").alias(k) for k in "xyz"), *more)


def shred_landing(events: DataFrame) -> DataFrame:
    return _shape(_mover(events, LANDING, F.col("distance")), "landing")


def shred_player_position(events: DataFrame) -> DataFrame:
    """Positions, the bulk of the events; a job of its own, so that other tables can be redone without it."""
    c = "character."
    more = [F.col("elapsedTime").alias("elapsed_time_s"), F.col("numAlivePlayers").alias("num_alive_players"), F.col(c + "health").alias("health"), F.col(c + "ranking").alias("ranking"), F.coalesce(c + "isInVehicle", F.lit(False)).alias("in_vehicle"), F.coalesce(c + "isInBlueZone", F.lit(False)).alias("in_blue_zone")]
    return _shape(_mover(events, POSITION, *more), "player_position")


def human_accounts(manifests: DataFrame, n: int) -> DataFrame:
    """The first n human accounts of each match, in the manifest's order."""
    account = lambda p: p["attributes"]["stats"]["playerId"]
    humans = F.slice(F.filter("included", lambda p: (p["type"] == "participant") & account(p).startswith("account.")), 1, n)
    rows = manifests.select(F.col("data.id").alias("match_id"), F.posexplode(humans).alias("place", "p"))
    return rows.select("match_id", "place", account(F.col("p")).alias("account_id"))


def shred_all(manifests: DataFrame, events: DataFrame) -> dict[str, DataFrame]:
    """Every bronze table, lazily. Write events once (or cache them) if all tables are wanted."""
    return {
        "match": shred_match(manifests, match_definitions(events)), "match_player": shred_match_player(manifests), "roster": shred_roster(manifests), "phase": shred_phase(events),
        "game_state": shred_game_state(events), "kill": shred_kill(events), "kill_participant": shred_kill_participant(events), "landing": shred_landing(events),
        "player_position": shred_player_position(events),
    }
