"""Gold tables: dimensions, facts and the point-in-time feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import bucket, classify, foreign_key, grid_cell, lookup, safe_div, seconds_between, surrogate_key
from ..operators.joins import HOT_ROWS, asof_join, left_fill
from ..operators.windows import latest, leave_one_out_mean, over, prior_window
from ..sources.schemas import Config

CFG = Config()

#: Display names of maps.
MAP_NAMES = {
    "Baltic_Main": "Erangel", "Desert_Main": "Miramar", "Savage_Main": "Sanhok", "DihorOtok_Main": "Vikendi", "Tiger_Main": "Taego", "Neon_Main": "Rondo", "Chimera_Main": "Paramo",
    "Summerland_Main": "Karakin", "Kiki_Main": "Deston", "Range_Main": "Camp Jackal", "Heaven_Main": "Haven", "Italy_TDM_Main": "Team Deathmatch (Italy)",
}
#: Sources of damage by the causer's name; the first match counts.
DAMAGE_SOURCES = [
    ("Bluezonebomb%", "blue_zone"),
    ("%Molotov%", "fire"), ("%FireEffect%", "fire"), ("%JerrycanFire%", "fire"), ("%GasPump%", "fire"),
    ("PanzerFaust%", "launcher"), ("Mortar%", "launcher"),
    ("Proj%", "throwable"),
    ("Player%Pawn%", "fists"), ("PlayerMale%", "fists"), ("PlayerFemale%", "fists"), ("UltAIPawn%", "fists"),
    ("Weap%", "weapon"),
]
#: Distances in metres.
RANGE_EDGES, RANGE_LABELS = [10, 50, 100, 200, 400], ["0-10m", "10-50m", "50-100m", "100-200m", "200-400m", "400m+"]


def build_dim_map(slv_match: DataFrame) -> DataFrame:
    seen = slv_match.groupBy("map_name").agg(F.count(F.lit(1)).alias("match_count"), F.round(F.avg("duration_s")).alias("avg_duration_s"), F.min("match_start_ts").alias("first_seen_ts"), F.max("match_start_ts").alias("last_seen_ts"))
    return seen.select(
        surrogate_key("map_name").alias("map_sk"), "map_name", lookup("map_name", MAP_NAMES).alias("map_display_name"), (F.col("map_name") == "Range_Main").alias("is_training_map"),
        F.col("map_name").like("%TDM%").alias("is_deathmatch_arena"), "match_count", "avg_duration_s", "first_seen_ts", "last_seen_ts",
    )


def build_dim_weapon(slv_kill: DataFrame, weapon_class: DataFrame) -> DataFrame:
    seen = slv_kill.filter("killer_weapon is not null").groupBy(F.col("killer_weapon").alias("causer_name")).agg(
        F.count(F.lit(1)).alias("kill_count"), F.count_if("is_human_vs_human").alias("hvh_kill_count"), F.round(F.median("killer_distance_m"), 1).alias("median_distance_m")
    )
    source = F.when(F.col("causer_name") == "None", "unknown").otherwise(classify("causer_name", DAMAGE_SOURCES, "vehicle"))
    rows = seen.withColumn("damage_source", source).join(weapon_class.select("causer_name", F.col("weapon_name").alias("seed_name"), F.col("weapon_class").alias("seed_class")), "causer_name", "left")
    firearm = F.col("damage_source") == "weapon"
    return rows.select(
        surrogate_key("causer_name").alias("weapon_sk"), "causer_name", F.coalesce("seed_name", "causer_name").alias("weapon_name"), "damage_source",
        F.when(firearm, F.coalesce("seed_class", F.lit("unclassified"))).otherwise(F.col("damage_source")).alias("weapon_class"), firearm.alias("is_firearm"), "kill_count", "hvh_kill_count", "median_distance_m",
    )


def build_dim_player(slv_match_player: DataFrame, slv_match: DataFrame) -> DataFrame:
    rows = slv_match_player.join(slv_match.select("match_id", "match_start_ts", "is_analytical"), "match_id")
    seen = rows.groupBy("account_id", "is_bot").agg(
        F.count(F.lit(1)).alias("matches_played"), F.count_if("is_analytical").alias("analytical_matches"), F.min("match_start_ts").alias("first_seen_ts"), F.max("match_start_ts").alias("last_seen_ts"),
        F.sum("kills").alias("career_kills"), F.sum("damage_dealt").alias("career_damage"), F.min("human_placement").alias("best_human_placement"), F.count_if(F.col("human_placement") == 1).alias("wins"),
    )
    return seen.withColumns({"player_sk": surrogate_key("account_id"), "has_enough_history": F.col("analytical_matches") >= 5})


def build_fact_kill(slv_kill: DataFrame, slv_match: DataFrame, slv_phase: DataFrame, slv_game_state: DataFrame, cfg: Config = CFG) -> DataFrame:
    """Deaths with the zone phase and the lobby as of the moment. Of state rows with one time, the one with fewest left counts."""
    phases = slv_phase.groupBy("match_id", "event_ts").agg(F.max("phase").alias("zone_phase"))
    lobby = slv_game_state.select("match_id", "event_ts", "num_alive_players", "num_alive_teams", "safety_zone_radius_m")
    context = slv_match.select("match_id", "match_start_ts", "match_type", "game_mode", "perspective", "map_name", "is_analytical")
    rows = slv_kill.join(context, "match_id")
    rows = asof_join(rows, phases, ["match_id"], "event_ts", "event_ts", values=["zone_phase"], hot_rows=HOT_ROWS)
    rows = asof_join(rows, lobby, ["match_id"], "event_ts", "event_ts", values=["num_alive_players", "num_alive_teams", "safety_zone_radius_m"], tiebreak=["num_alive_players", "num_alive_teams"], hot_rows=HOT_ROWS)
    return rows.select(
        "kill_sk", "match_id", "event_ts", surrogate_key("map_name").alias("map_sk"), foreign_key("killer_weapon").alias("weapon_sk"), surrogate_key("victim_account_id").alias("victim_player_sk"),
        foreign_key("killer_account_id").alias("killer_player_sk"), "match_type", "game_mode", "perspective", "map_name", "is_analytical", seconds_between("match_start_ts", "event_ts").alias("seconds_into_match"),
        "zone_phase", "num_alive_players", "num_alive_teams", "safety_zone_radius_m", "victim_account_id", "victim_is_bot", "killer_account_id", "killer_is_bot", "has_killer", "is_human_vs_human",
        "death_cause", "assist_count", "killer_weapon", "victim_weapon", "killer_damage_reason", "killer_distance_m", "killer_through_wall", "victim_in_blue_zone", "victim_in_vehicle", "victim_x_m",
        "victim_y_m", grid_cell("victim_x_m", "victim_y_m", cfg.cell_m).alias("victim_grid_cell"), bucket("killer_distance_m", RANGE_EDGES, RANGE_LABELS).alias("range_bucket"),
    )


def build_fact_match_phase(slv_phase: DataFrame, slv_game_state: DataFrame, slv_match: DataFrame, fact_kill: DataFrame) -> DataFrame:
    phases = slv_phase.groupBy("match_id", "phase").agg(F.min("event_ts").alias("phase_start_ts"), F.max("next_phase_ts").alias("phase_end_ts"), F.max("players_in_white_circle").alias("players_in_white_circle"))
    state = ["num_alive_players", "num_alive_teams", "safety_zone_radius_m"]
    started = asof_join(phases, slv_game_state.select("match_id", "event_ts", *state), ["match_id"], "phase_start_ts", "event_ts", values=state, tiebreak=state[:2])
    deaths = fact_kill.filter("zone_phase is not null").groupBy("match_id", F.col("zone_phase").alias("phase")).agg(
        F.count(F.lit(1)).alias("deaths"), F.count_if("is_human_vs_human").alias("human_deaths"), F.count_if(F.col("death_cause") == "environment").alias("environment_deaths"), F.round(F.median("killer_distance_m"), 1).alias("median_engagement_m")
    )
    rows = started.join(slv_match.select("match_id", "match_type", "game_mode", "map_name", "is_analytical"), "match_id")
    rows = left_fill(rows, deaths, ["match_id", "phase"], {"deaths": 0, "human_deaths": 0, "environment_deaths": 0})
    length = seconds_between("phase_start_ts", "phase_end_ts")
    per_minute = F.when(length > 0, F.round(F.col("deaths") * F.lit(60.0) / length, 2))
    return rows.withColumns({"match_phase_sk": surrogate_key("match_id", "phase"), "map_sk": surrogate_key("map_name"), "phase_duration_s": length, "deaths_per_minute": per_minute})


def build_fact_player_match(slv_match_player: DataFrame, slv_match: DataFrame, slv_kill_participant: DataFrame, slv_kill: DataFrame, slv_roster: DataFrame, slv_landing: DataFrame, cfg: Config = CFG) -> DataFrame:
    fights = slv_kill.filter("is_human_vs_human").select("kill_sk", "killer_distance_m")
    kills = slv_kill_participant.filter("role = 'killer'").select("kill_sk", "match_id", "account_id").join(fights, "kill_sk")
    kills = kills.groupBy("match_id", "account_id").agg(F.count(F.lit(1)).alias("human_kills"), F.count_if(F.col("killer_distance_m") >= 100).alias("human_kills_long_range"))
    teams = slv_roster.select("match_id", "team_id", F.col("participant_count").alias("team_size"))
    landed = slv_landing.filter("landing_seq = 1").select("match_id", "account_id", F.col("x_m").alias("landing_x_m"), F.col("y_m").alias("landing_y_m"))
    context = slv_match.select("match_id", "match_start_ts", "match_type", "game_mode", "team_mode", "perspective", "map_name", "region", F.col("duration_s").alias("match_duration_s"), "is_analytical")
    rows = slv_match_player.drop("human_rank_count", "match_is_analytical", "player_name").join(context, "match_id").join(teams, ["match_id", "team_id"], "left")
    rows = left_fill(rows, kills, ["match_id", "account_id"], {"human_kills": 0, "human_kills_long_range": 0})
    rows = rows.join(landed, ["match_id", "account_id"], "left").withColumnRenamed("kills", "kills_reported")
    return rows.withColumns({
        "player_match_sk": surrogate_key("match_id", "account_id"), "player_sk": surrogate_key("account_id"), "map_sk": surrogate_key("map_name"), "won_match": F.col("human_placement") == 1,
        "bot_kills": F.col("kills_reported") - F.col("human_kills"), "landing_grid_cell": grid_cell("landing_x_m", "landing_y_m", cfg.cell_m),
    })


def build_fact_rating_update(ratings: DataFrame) -> DataFrame:
    return ratings.withColumns({
        "match_start_ts": F.col("match_start_ts").cast("timestamp"), "rating_update_sk": surrogate_key("account_id", "match_id", "rating_system"), "player_sk": surrogate_key("account_id"),
        "had_prior_history": F.col("games_played_before") > 0,
    })


def build_dim_player_rating(fact_rating_update: DataFrame, dim_player: DataFrame, converged: int = 30) -> DataFrame:
    last = latest(fact_rating_update, ["account_id", "rating_system"], ["match_start_ts", "match_id"])
    games = F.col("games_played_before") + 1
    rows = last.select("player_sk", "account_id", "rating_system", F.col("mu_post").alias("mu"), F.col("sigma_post").alias("sigma"), F.col("ordinal_post").alias("ordinal"), games.alias("games_rated"), F.col("match_start_ts").alias("last_rated_ts"), (games >= converged).alias("is_converged"))
    return rows.join(dim_player.select("account_id", "matches_played", "analytical_matches", "career_kills"), "account_id", "left")


def build_feat_player_match(fact_player_match: DataFrame, fact_rating_update: DataFrame, strict_mates: bool = True) -> DataFrame:
    """Features as of the match's start, and the label. Nothing in a row comes from its own match or a later one.

    strict_mates=False counts a player without a rating among the rated when the mates' mean is taken.
    """
    base = fact_player_match.filter(F.col("is_analytical") & ~F.col("is_bot") & F.col("human_placement_pct").isNotNull())
    base = base.select("match_id", "account_id", "team_id", "match_start_ts", "perspective", "team_mode", "map_name", "human_count", "team_size", "human_placement_pct")
    rows = base.join(fact_rating_update.select("match_id", "account_id", "ordinal_pre", "sigma_pre", "games_played_before"), ["match_id", "account_id"], "left")
    rows = leave_one_out_mean(rows, ["match_id", "team_id"], "ordinal_pre", "teammate_mean_ordinal_pre", strict=strict_mates)
    rows = rows.withColumn("observed_team_size", F.count(F.lit(1)).over(over(["match_id", "team_id"])))
    pct = "human_placement_pct"
    rows = prior_window(rows, ["account_id"], ["match_start_ts", "match_id"], {"prior_mean_finish_pct": F.avg(pct), "prior_matches": F.count(F.lit(1)), "prior_best_finish_pct": F.min(pct)})
    rows = rows.withColumns({
        "feature_sk": surrogate_key("match_id", "account_id"), "team_size": F.coalesce("team_size", "observed_team_size"), "finished_top_half": F.col(pct) <= 0.5,
        "has_rating_history": F.coalesce("games_played_before", F.lit(0)) > 0, "has_form_history": F.col("prior_matches") > 0,
    })
    return rows.drop("team_id", "observed_team_size")
