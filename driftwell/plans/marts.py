"""Marts: aggregates that are read as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import bucket, distance, rate, safe_div, shrink_rate, surrogate_key
from ..operators.aggregates import grid_heatmap, quantiles, with_distincts
from ..operators.joins import HOT_ROWS, asof_join, mirror_pairs, since_join
from ..operators.windows import group_share, others_in_group, step_distance
from ..sources.schemas import Config

CFG = Config()
#: Distance from the zone's centre in radii.
LUCK_EDGES, LUCK_LABELS = [0.5, 1.0, 1.5, 2.0], ["1. deep inside", "2. inside", "3. just outside", "4. one radius out", "5. far outside"]


def build_weapon_performance(fact_kill: DataFrame, dim_weapon: DataFrame, exact: bool = True) -> DataFrame:
    """Firearms by perspective and range. exact=False takes quantiles from sketches of bounded memory."""
    arms = dim_weapon.filter("is_firearm").select("weapon_sk", "weapon_name", "weapon_class")
    base = fact_kill.filter(F.col("is_analytical") & F.col("is_human_vs_human")).join(arms, "weapon_sk")
    d = "killer_distance_m"
    base = base.withColumn("range_bucket", F.coalesce("range_bucket", F.lit("unknown")))
    aggs = [
        F.count(F.lit(1)).alias("kills"), quantiles(d, [0.5, 0.9], exact).alias("q"), F.round(F.avg(d), 1).alias("mean_distance_m"), rate(F.col("killer_through_wall")).alias("through_wall_rate"),
        rate(F.col("victim_in_vehicle")).alias("victim_in_vehicle_rate"), F.round(F.avg("zone_phase"), 2).alias("mean_zone_phase"),
    ]
    rows = with_distincts(base, ["weapon_name", "weapon_class", "perspective", "range_bucket"], aggs, {"matches": "match_id", "distinct_killers": "killer_account_id"})
    rows = rows.select(
        "weapon_name", "weapon_class", "perspective", "range_bucket", "kills", "matches", "distinct_killers", F.round(F.col("q")[0], 1).alias("median_distance_m"), "mean_distance_m",
        F.round(F.col("q")[1], 1).alias("p90_distance_m"), "through_wall_rate", "victim_in_vehicle_rate", "mean_zone_phase",
    )
    return group_share(rows, ["perspective"], "kills", "perspective_kills", "kill_share").withColumn("has_enough_kills", F.col("kills") >= 100)


def build_engagement_matrix(fact_kill: DataFrame, weapon_class: DataFrame, prior: float = 0.5, weight: float = 10) -> DataFrame:
    """How often class a beats class b at a range; a pair shows up in a direction only if that direction was seen."""
    fights = fact_kill.filter(F.col("is_analytical") & F.col("is_human_vs_human") & (F.col("death_cause") == "player"))
    side = lambda source, name: weapon_class.select(F.col("causer_name").alias(source), F.col("weapon_class").alias(name))
    fights = fights.join(side("killer_weapon", "class_a"), "killer_weapon").join(side("victim_weapon", "class_b"), "victim_weapon")
    directed = fights.groupBy("class_a", "class_b", F.coalesce("range_bucket", F.lit("unknown")).alias("range_bucket")).agg(F.count(F.lit(1)).alias("a_beats_b"))
    return matchup(mirror_pairs(directed, "class_a", "class_b", ["range_bucket"], "a_beats_b", "b_beats_a"), prior, weight)


def matchup(pairs: DataFrame, prior: float = 0.5, weight: float = 10, enough: int = 200, symmetric: int = 100) -> DataFrame:
    """Raw and shrunk win rates of paired counts."""
    a, total = F.col("a_beats_b"), F.col("a_beats_b") + F.col("b_beats_a")
    raw, shrunk = safe_div(a, total), shrink_rate(a, total, prior, weight)
    same = F.col("class_a") == F.col("class_b")
    return pairs.withColumns({
        "is_mirror": same, "fights": total, "raw_win_rate": F.round(raw, 4), "shrunk_win_rate": F.round(shrunk, 4), "shrinkage_applied": F.round(F.abs(raw - shrunk), 4),
        "has_enough_fights": total >= enough, "has_symmetric_observation": ~same & (a >= symmetric) & (F.col("b_beats_a") >= symmetric),
    })


def build_drop_zone(fact_player_match: DataFrame, dim_map: DataFrame) -> DataFrame:
    drops = fact_player_match.filter(F.col("is_analytical") & ~F.col("is_bot") & F.col("landing_grid_cell").isNotNull()).withColumnRenamed("landing_grid_cell", "grid_cell")
    drops = others_in_group(drops, ["match_id", "grid_cell"], "contest_level").join(dim_map.select("map_name", "map_display_name"), "map_name", "left")
    pct = "human_placement_pct"
    return drops.groupBy("map_name", "map_display_name", "grid_cell").agg(
        F.count(F.lit(1)).alias("drops"), F.count_distinct("match_id").alias("matches"), F.round(F.avg("landing_x_m")).alias("centroid_x_m"), F.round(F.avg("landing_y_m")).alias("centroid_y_m"),
        F.round(F.avg(pct), 4).alias("avg_finish_pct"), F.round(F.median(pct), 4).alias("median_finish_pct"), F.round(F.avg("time_survived")).alias("avg_survival_s"),
        F.round(F.avg("human_kills"), 3).alias("avg_human_kills"), F.round(rate(F.col("survived_to_end")), 4).alias("win_rate"), F.round(F.avg("contest_level"), 2).alias("avg_contest_level"),
        F.round(safe_div(F.avg("human_kills"), F.avg(pct)), 2).alias("kills_per_finish_cost"), (F.count(F.lit(1)) >= 50).alias("has_enough_drops"),
    )


def build_zone_luck(fact_player_match: DataFrame, fact_match_phase: DataFrame, slv_game_state: DataFrame) -> DataFrame:
    """Results by distance from the second circle. A match whose latest state has no radius drops out: the filter comes
    after the as-of join. Players without a distance fall to the last bucket."""
    zone = ["safety_zone_x_m", "safety_zone_y_m", "safety_zone_radius_m"]
    second = fact_match_phase.filter("phase = 2").select("match_id", "phase_start_ts")
    first = asof_join(second, slv_game_state.select("match_id", "event_ts", *zone), ["match_id"], "phase_start_ts", "event_ts", values=zone, tiebreak=zone).filter("safety_zone_radius_m > 0").drop("phase_start_ts")
    people = fact_player_match.filter(F.col("is_analytical") & ~F.col("is_bot") & F.col("landing_x_m").isNotNull() & F.col("human_placement_pct").isNotNull())
    rows = people.join(first, "match_id").withColumn("away", distance("landing_x_m", "landing_y_m", "safety_zone_x_m", "safety_zone_y_m")).withColumn("radii", safe_div("away", "safety_zone_radius_m"))
    return rows.groupBy(bucket("radii", LUCK_EDGES, LUCK_LABELS, null_label=LUCK_LABELS[-1]).alias("zone_luck_bucket")).agg(
        F.count(F.lit(1)).alias("player_matches"), F.round(F.avg("radii"), 3).alias("avg_radii_from_centre"), F.round(F.avg("away")).alias("avg_distance_m"), F.round(F.avg("human_placement_pct"), 4).alias("avg_finish_pct"),
        F.round(F.median("human_placement_pct"), 4).alias("median_finish_pct"), F.round(F.avg("human_kills"), 3).alias("avg_human_kills"), F.round(F.avg("time_survived")).alias("avg_survival_s"),
        F.round(F.avg("total_distance")).alias("avg_distance_travelled_m"),
    )


def build_player_rotation(slv_player_position: DataFrame, slv_landing: DataFrame, slv_game_state: DataFrame, fact_player_match: DataFrame, cfg: Config = CFG) -> DataFrame:
    """Movement of each human after landing. Steps that nobody can walk or drive are counted but not summed; positions
    before any zone count as inside."""
    landed = slv_landing.filter(~F.col("is_bot")).groupBy("match_id", "account_id").agg(F.min("event_ts").alias("landed_ts"))
    grounded = since_join(slv_player_position.filter(~F.col("is_bot")).select("match_id", "account_id", "event_ts", "x_m", "y_m", "in_vehicle", "in_blue_zone"), landed, ["match_id", "account_id"], "event_ts", "landed_ts")
    zone = ["safety_zone_x_m", "safety_zone_y_m", "safety_zone_radius_m"]
    zones = slv_game_state.filter("safety_zone_radius_m > 0").select("match_id", "event_ts", *zone)
    rows = asof_join(grounded, zones, ["match_id"], "event_ts", "event_ts", values=zone, tiebreak=zone, hot_rows=HOT_ROWS)
    rows = rows.withColumn("from_centre", distance("x_m", "y_m", "safety_zone_x_m", "safety_zone_y_m"))
    rows = step_distance(rows, ["match_id", "account_id"], ["event_ts", "x_m", "y_m"], "x_m", "y_m", "step")
    fair = F.when(F.col("step") <= cfg.max_step_m, F.col("step"))
    ticks, share = F.count(F.lit(1)), lambda c: F.round(rate(c), 4)
    moved = F.coalesce(F.sum(fair), F.lit(0.0))
    out = rows.groupBy("match_id", "account_id").agg(
        ticks.alias("ticks"), (ticks * cfg.tick_s).alias("grounded_seconds"), F.round(moved).alias("distance_travelled_m"), F.round(safe_div(moved, ticks * cfg.tick_s), 2).alias("mean_speed_mps"),
        F.round(F.max(fair) / F.lit(float(cfg.tick_s)), 1).alias("peak_speed_mps"), F.count_if(F.col("step") > cfg.max_step_m).alias("implausible_steps"), F.round(F.avg("from_centre")).alias("mean_dist_from_centre_m"),
        share(F.col("from_centre") > F.col("safety_zone_radius_m")).alias("share_outside_zone"), share(F.col("in_blue_zone")).alias("blue_zone_share"), (F.count_if("in_blue_zone") * cfg.tick_s).alias("seconds_in_blue_zone"),
        share(F.col("in_vehicle")).alias("vehicle_share"), (F.count_if("in_vehicle") * cfg.tick_s).alias("seconds_in_vehicle"),
    )
    context = fact_player_match.groupBy("match_id", "account_id").agg(*(F.max(c).alias(c) for c in ("human_placement_pct", "human_kills", "team_mode", "map_name")), F.bool_or(F.coalesce("is_analytical", F.lit(False))).alias("is_analytical"))
    return out.join(context, ["match_id", "account_id"]).withColumn("rotation_sk", surrogate_key("match_id", "account_id"))


def build_heatmap(positions: DataFrame, cfg: Config = CFG) -> DataFrame:
    return grid_heatmap(positions, "x_m", "y_m", cfg.cell_m)
