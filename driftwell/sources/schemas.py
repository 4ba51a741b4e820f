"""Fixed schemas of raw files and bronze tables, as DDL, and the run-time configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import ArrayType, DataType, StructField, StructType

LOCATION = "struct<x: double, y: double, z: double>"
CHARACTER = (
    "struct<accountId: string, name: string, type: string, teamId: long, ranking: long, individualRanking: long, health: double, isInBlueZone: boolean, "
    f"isInRedZone: boolean, isInVehicle: boolean, isDBNO: boolean, location: {LOCATION}>"
)
DAMAGE = "struct<damageReason: string, damageTypeCategory: string, damageCauserName: string, distance: double, isThroughPenetrableWall: boolean>"
STATS = (
    "struct<playerId: string, name: string, deathType: string, winPlace: long, killPlace: long, kills: long, DBNOs: long, assists: long, headshotKills: long, "
    "heals: long, boosts: long, revives: long, roadKills: long, teamKills: long, vehicleDestroys: long, weaponsAcquired: long, damageDealt: double, "
    "longestKill: double, walkDistance: double, rideDistance: double, swimDistance: double, timeSurvived: double, teamId: long, rank: long>"
)
MANIFEST = (
    "data struct<id: string, attributes: struct<createdAt: string, duration: long, gameMode: string, matchType: string, mapName: string, shardId: string, "
    "seasonState: string, isCustomMatch: boolean, titleId: string>>, "
    f"included array<struct<type: string, id: string, attributes: struct<won: string, URL: string, stats: {STATS}>, "
    "relationships: struct<participants: struct<data: array<struct<id: string>>>>>>"
)
STATE = (
    "struct<elapsedTime: long, numStartTeams: long, numAliveTeams: long, numJoinPlayers: long, numStartPlayers: long, numAlivePlayers: long, "
    f"safetyZonePosition: {LOCATION}, poisonGasWarningPosition: {LOCATION}, redZonePosition: {LOCATION}, safetyZoneRadius: double, "
    "poisonGasWarningRadius: double, redZoneRadius: double, blackZoneRadius: double>"
)
EVENT = (
    f"_T string, _D string, MatchId string, PingQuality string, phase int, playersInWhiteCircle array<string>, gameState {STATE}, attackId long, dBNOId long, "
    "isSuicide boolean, victimWeapon string, assists_AccountId array<string>, teamKillers_AccountId array<string>, "
    f"victimGameResult struct<rank: long, gameResult: string>, victim {CHARACTER}, killer {CHARACTER}, finisher {CHARACTER}, dBNOMaker {CHARACTER}, "
    f"killerDamageInfo {DAMAGE}, finishDamageInfo {DAMAGE}, dBNODamageInfo {DAMAGE}, character {CHARACTER}, distance double, elapsedTime double, numAlivePlayers long"
)
#: A character's fields as flat columns (suffix: path), and a damage record's.
CHARACTER_FIELDS = {
    "account_id": "accountId", "name": "name", "character_type": "type", "team_id": "teamId", "ranking": "ranking", "individual_ranking": "individualRanking", "health": "health",
    "in_blue_zone": "isInBlueZone", "in_red_zone": "isInRedZone", "in_vehicle": "isInVehicle", "is_dbno": "isDBNO", "x": "location.x", "y": "location.y", "z": "location.z",
}
DAMAGE_FIELDS = {"damage_reason": "damageReason", "damage_category": "damageTypeCategory", "damage_causer": "damageCauserName", "distance": "distance", "through_wall": "isThroughPenetrableWall"}


def _character(prefix: str) -> str:
    kinds = {"team_id": "long", "ranking": "long", "individual_ranking": "long", "health": "double", "x": "double", "y": "double", "z": "double"}
    kinds |= dict.fromkeys(("in_blue_zone", "in_red_zone", "in_vehicle", "is_dbno"), "boolean")
    return ", ".join([*(f"{prefix}_{n} {kinds.get(n, 'string')}" for n in CHARACTER_FIELDS), f"{prefix}_is_bot boolean"])


def _damage(prefix: str) -> str:
    return ", ".join(f"{prefix}_{n} { {'distance': 'double', 'through_wall': 'boolean'}.get(n, 'string')}" for n in DAMAGE_FIELDS)


BRONZE = {
    "match": "match_id string, telemetry_match_id string, created_at string, duration_s long, game_mode string, match_type string, map_name string, shard_id string, "
    "region string, season_state string, is_custom_match boolean, title_id string, ping_quality string, player_count long, bot_count long, human_count long, roster_count long",
    "match_player": "match_id string, participant_id string, account_id string, player_name string, is_bot boolean, team_id long, win_place long, kill_place long, kills long, "
    "dbnos long, assists long, damage_dealt double, death_type string, headshot_kills long, longest_kill double, heals long, boosts long, revives long, road_kills long, "
    "team_kills long, vehicle_destroys long, weapons_acquired long, walk_distance double, ride_distance double, swim_distance double, time_survived double",
    "roster": "match_id string, roster_id string, team_id long, team_rank long, won boolean, participant_count long",
    "phase": "match_id string, event_ts string, phase int, players_in_white_circle int",
    "game_state": "match_id string, event_ts string, elapsed_time_s long, num_start_teams long, num_alive_teams long, num_join_players long, num_start_players long, "
    "num_alive_players long, safety_zone_x double, safety_zone_y double, safety_zone_z double, safety_zone_radius double, poison_gas_x double, poison_gas_y double, "
    "poison_gas_z double, poison_gas_radius double, red_zone_x double, red_zone_y double, red_zone_z double, red_zone_radius double, black_zone_radius double",
    "kill": "match_id string, event_ts string, attack_id long, dbno_id long, is_suicide boolean, victim_weapon string, victim_game_rank long, victim_game_result string, "
    "assist_count int, team_kill_count int, " + ", ".join([*map(_character, ("victim", "killer", "finisher", "dbno_maker")), *map(_damage, ("killer", "finish", "dbno"))]),
    "kill_participant": "match_id string, event_ts string, attack_id long, role string, account_id string, player_name string, team_id long, is_bot boolean, x double, "
    "y double, z double, victim_account_id string",
    "landing": "match_id string, event_ts string, account_id string, player_name string, team_id long, is_bot boolean, distance double, x double, y double, z double",
    "player_position": "match_id string, event_ts string, elapsed_time_s double, num_alive_players long, account_id string, is_bot boolean, team_id long, health double, "
    "ranking long, in_vehicle boolean, in_blue_zone boolean, x double, y double, z double",
}


def bronze_columns(table: str) -> list[tuple[str, str]]:
    """Names and types of a bronze table's columns, in order."""
    return [tuple(c.split(" ")) for c in BRONZE[table].split(", ")]


def pruned(ddl: str, *paths: str) -> StructType:
    """A schema's fields that dotted paths name, each with all below it, in the schema's order. Arrays add no step to a path."""

    def keep(kind: DataType, below: list[list[str]]) -> DataType:
        if [] in below:
            return kind
        if isinstance(kind, ArrayType):
            return ArrayType(keep(kind.elementType, below), kind.containsNull)
        if missing := {p[0] for p in below} - set(kind.names if isinstance(kind, StructType) else ()):
            raise ValueError(f"not in the schema: {sorted(missing)}")
        return StructType([StructField(f.name, keep(f.dataType, [p[1:] for p in below if p[0] == f.name]), f.nullable) for f in kind if any(p[0] == f.name for p in below)])

    return keep(StructType.fromDDL(ddl), [p.split(".") for p in paths])


@dataclass(frozen=True)
class Config:
    """What table builders can be told."""

    analytical_match_types: tuple[str, ...] = ("official", "competitive")
    min_match_duration_s: int = 300
    min_human_count: int = 10
    cm_per_m: float = 100.0
    cell_m: float = 500.0
    max_step_m: float = 600.0
    tick_s: int = 10
