"""Silver tables: typed, without duplicates, integrity flags attached but not applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import blank, metres, safe_div, surrogate_key
from ..operators.windows import dedup_first, duration_to_next, scaled_rank, sequence
from ..sources.schemas import Config

CFG = Config()


def ts(name: str = "event_ts") -> Column:
    return F.col(name).cast("timestamp")


def in_metres(cfg: Config, *names: str) -> list[Column]:
    return [metres(n, cfg.cm_per_m).alias(f"{n}_m") for n in names]


def build_match(match: DataFrame, cfg: Config = CFG) -> DataFrame:
    keep = ["match_id", "telemetry_match_id", "duration_s", "game_mode", "match_type", "map_name", "shard_id", "region", "season_state", "is_custom_match", "player_count", "bot_count", "human_count", "roster_count"]
    out = match.select(
        *keep, ts("created_at").alias("match_start_ts"), F.when(F.col("game_mode").like("%-fpp"), "fpp").otherwise("tpp").alias("perspective"),
        F.replace("game_mode", F.lit("-fpp"), F.lit("")).alias("team_mode"), blank("ping_quality", "").alias("ping_quality"), safe_div("bot_count", "player_count").alias("bot_share"),
    )
    out = out.withColumns({"is_competitive_type": F.col("match_type").isin(*cfg.analytical_match_types), "is_full_length": F.col("duration_s") >= cfg.min_match_duration_s, "has_human_lobby": F.col("human_count") >= cfg.min_human_count})
    return out.withColumn("is_analytical", F.col("is_competitive_type") & F.col("is_full_length") & F.col("has_human_lobby"))


def build_match_player(match_player: DataFrame, slv_match: DataFrame) -> DataFrame:
    """Adds the placement among humans, as a dense rank and scaled to 0 (best) .. 1."""
    parent = slv_match.select("match_id", "human_count", F.col("player_count").alias("lobby_size"), F.col("is_analytical").alias("match_is_analytical"))
    rows = scaled_rank(match_player.join(parent, "match_id"), ["match_id"], ["win_place"], ~F.col("is_bot"), "human_placement", "human_rank_count", "human_placement_pct")
    rows = rows.withColumnRenamed("win_place", "raw_placement")
    return rows.withColumns({"survived_to_end": F.col("death_type") == "alive", "death_type": blank("death_type", ""), "total_distance": F.col("walk_distance") + F.col("ride_distance") + F.col("swim_distance")})


def build_roster(roster: DataFrame) -> DataFrame:
    return roster.select("match_id", "roster_id", "team_id", "team_rank", "won", "participant_count")


def death_cause() -> Column:
    """The order decides; a null is_suicide falls through."""
    return (
        F.when(F.col("is_suicide"), "suicide").when(F.col("killer_account_id").isNull(), "environment").when(F.col("killer_account_id") == F.col("victim_account_id"), "self")
        .when(F.col("team_kill_count") > 0, "team_kill").otherwise("player")
    )


def build_kill(kill: DataFrame, cfg: Config = CFG) -> DataFrame:
    has_killer = F.col("killer_account_id").isNotNull()
    who = ["victim_account_id", "victim_name", "victim_team_id", "victim_is_bot", "victim_game_rank", "victim_in_blue_zone", "victim_in_red_zone", "victim_in_vehicle"]
    return kill.select(
        surrogate_key("match_id", "event_ts", "victim_account_id").alias("kill_sk"), "match_id", ts().alias("event_ts"), blank("attack_id", -1).alias("attack_id"), blank("dbno_id", -1).alias("dbno_id"), "is_suicide", *who,
        *in_metres(cfg, "victim_x", "victim_y", "victim_z"), "killer_account_id", "killer_name", "killer_team_id", F.when(has_killer, F.col("killer_is_bot")).alias("killer_is_bot"),
        *in_metres(cfg, "killer_x", "killer_y", "killer_z"), has_killer.alias("has_killer"), "finisher_account_id", "finisher_is_bot", "dbno_maker_account_id",
        blank("killer_damage_causer", "").alias("killer_weapon"), blank("killer_damage_reason", "").alias("killer_damage_reason"), blank("killer_damage_category", "").alias("killer_damage_category"),
        blank("finish_damage_causer", "").alias("finish_weapon"), blank("finish_damage_category", "").alias("finish_damage_category"),
        blank(F.regexp_replace("victim_weapon", "_[0-9]+$", ""), "").alias("victim_weapon"), F.when(F.col("killer_distance") >= 0, metres("killer_distance", cfg.cm_per_m)).alias("killer_distance_m"),
        "killer_through_wall", "assist_count", "team_kill_count", death_cause().alias("death_cause"), (~F.col("victim_is_bot") & has_killer & ~F.col("killer_is_bot")).alias("is_human_vs_human"),
    )


def build_kill_participant(kill_participant: DataFrame, slv_kill: DataFrame, cfg: Config = CFG, by_victim: bool = True) -> DataFrame:
    """Each actor of a death with the death's key.

    by_victim: join on the victim too, where the bridge carries it, so that two deaths of one instant don't mix. Without
    it, deaths are told apart by attack id alone, nulls read as -1, and deaths without one fan out.
    """
    keys = ["match_id", "event_ts", "attack_id", "role", "account_id"] + (["victim_account_id"] if by_victim else [])
    zero = [F.coalesce(c, F.lit(0.0)).asc() for c in ("x", "y")]
    one = dedup_first(kill_participant, keys, [*zero, "z", "player_name", "team_id"]).withColumn("event_ts", ts())
    raw_id = F.coalesce("attack_id", F.lit(-1).cast("long"))
    deaths = slv_kill.select("kill_sk", "match_id", "event_ts", raw_id.alias("raw_id"), *(["victim_account_id"] if by_victim else []))
    on = ["match_id", "event_ts", "raw_id"] + (["victim_account_id"] if by_victim else [])
    rows = one.withColumn("raw_id", raw_id if by_victim else F.col("attack_id")).join(deaths, on)
    return rows.select("kill_sk", "match_id", "event_ts", blank("attack_id", -1).alias("attack_id"), "role", "account_id", "player_name", "team_id", "is_bot", *in_metres(cfg, "x", "y", "z"))


def build_landing(landing: DataFrame, cfg: Config = CFG) -> DataFrame:
    one = dedup_first(landing, ["match_id", "account_id", "event_ts"], ["x", "y", "z", "distance"]).withColumn("event_ts", ts())
    out = sequence(one, ["match_id", "account_id"], ["event_ts"], "landing_seq")
    return out.select("match_id", "event_ts", "account_id", "player_name", "team_id", "is_bot", F.col("distance").alias("parachute_distance"), *in_metres(cfg, "x", "y", "z"), "landing_seq")


def build_phase(phase: DataFrame) -> DataFrame:
    return duration_to_next(phase.withColumn("event_ts", ts()), ["match_id"], "event_ts", "next_phase_ts", "phase_duration_s").select("match_id", "event_ts", "phase", "players_in_white_circle", "next_phase_ts", "phase_duration_s")


def build_game_state(game_state: DataFrame, cfg: Config = CFG) -> DataFrame:
    counts = ["elapsed_time_s", "num_start_teams", "num_alive_teams", "num_join_players", "num_start_players", "num_alive_players"]
    no_radius = [metres(blank(c, 0.0), cfg.cm_per_m).alias(f"{c}_m") for c in ("poison_gas_radius", "red_zone_radius", "black_zone_radius")]
    return game_state.select(
        "match_id", ts().alias("event_ts"), *counts, (F.col("num_start_players") - F.col("num_alive_players")).alias("players_eliminated"),
        *in_metres(cfg, "safety_zone_x", "safety_zone_y", "safety_zone_radius", "poison_gas_x", "poison_gas_y"), *no_radius, (F.col("poison_gas_radius") > 0).alias("is_zone_closing"),
    )


def build_player_position(player_position: DataFrame, cfg: Config = CFG) -> DataFrame:
    """Never written: readers inline it, so that the scan reads only the columns they use."""
    keep = ["elapsed_time_s", "num_alive_players", "account_id", "is_bot", "team_id", "health", "ranking", "in_vehicle", "in_blue_zone"]
    return player_position.select("match_id", ts().alias("event_ts"), *keep, *in_metres(cfg, "x", "y", "z"))
