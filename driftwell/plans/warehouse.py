"""All tables from bronze, in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.ratings import rating_history
from ..sources.schemas import Config
from . import gold, marts, silver


def build_silver(b: dict[str, DataFrame], cfg: Config = Config()) -> dict[str, DataFrame]:
    m = silver.build_match(b["match"], cfg)
    k = silver.build_kill(b["kill"], cfg)
    return {
        "slv_match": m, "slv_match_player": silver.build_match_player(b["match_player"], m), "slv_roster": silver.build_roster(b["roster"]), "slv_kill": k,
        "slv_kill_participant": silver.build_kill_participant(b["kill_participant"], k, cfg), "slv_landing": silver.build_landing(b["landing"], cfg), "slv_phase": silver.build_phase(b["phase"]),
        "slv_game_state": silver.build_game_state(b["game_state"], cfg), "slv_player_position": silver.build_player_position(b["player_position"], cfg),
    }


def build_gold(s: dict[str, DataFrame], weapon_class: DataFrame, cfg: Config = Config()) -> dict[str, DataFrame]:
    kill = gold.build_fact_kill(s["slv_kill"], s["slv_match"], s["slv_phase"], s["slv_game_state"], cfg)
    return {
        "dim_map": gold.build_dim_map(s["slv_match"]), "dim_weapon": gold.build_dim_weapon(s["slv_kill"], weapon_class), "dim_player": gold.build_dim_player(s["slv_match_player"], s["slv_match"]),
        "fact_kill": kill, "fact_match_phase": gold.build_fact_match_phase(s["slv_phase"], s["slv_game_state"], s["slv_match"], kill),
        "fact_player_match": gold.build_fact_player_match(s["slv_match_player"], s["slv_match"], s["slv_kill_participant"], s["slv_kill"], s["slv_roster"], s["slv_landing"], cfg),
    }


def build_ratings(g: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rating history of analytical human play, and what hangs on it. The rating rounds run as this is called."""
    people = g["fact_player_match"].filter("is_analytical and not is_bot and human_placement is not null")
    updates = gold.build_fact_rating_update(rating_history(people, "match_id", "match_start_ts", "team_id", "account_id", "human_placement"))
    return {"fact_rating_update": updates, "dim_player_rating": gold.build_dim_player_rating(updates, g["dim_player"]), "feat_player_match": gold.build_feat_player_match(g["fact_player_match"], updates)}


def build_marts(s: dict[str, DataFrame], g: dict[str, DataFrame], weapon_class: DataFrame, cfg: Config = Config()) -> dict[str, DataFrame]:
    return {
        "mart_weapon_performance": marts.build_weapon_performance(g["fact_kill"], g["dim_weapon"]), "mart_engagement_matrix": marts.build_engagement_matrix(g["fact_kill"], weapon_class),
        "mart_drop_zone": marts.build_drop_zone(g["fact_player_match"], g["dim_map"]), "mart_zone_luck": marts.build_zone_luck(g["fact_player_match"], g["fact_match_phase"], s["slv_game_state"]),
        "mart_player_rotation": marts.build_player_rotation(s["slv_player_position"], s["slv_landing"], s["slv_game_state"], g["fact_player_match"], cfg),
    }
