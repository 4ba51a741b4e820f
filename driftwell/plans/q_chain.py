"""From players' matches to features: the builders called one after another over weekly leagues of users, with SQL that
states each of them anew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gold, silver, warehouse
from .catalog import query
from .q_estimates import rating_recursion

#: A user's week, as bronze would have it. Users of one last digit share a match; fifty in a row make a team.
BASE = """select concat(cast(w as string), '-', cast(user_id % 10 as string)) as match_id, w as week, user_id as account_id, user_id % 4 = 3 as is_bot, user_id {div} 50 as team_id, purchases as kills, total * 1e1 as damage_dealt,
case when total > 1e3 then 'alive' else '' end as death_type, total as walk_distance, case when user_id % 6 > 0 then total * 2e0 end as ride_distance, 1e0 as swim_distance, user_id % 10 as league, total
from (select user_id, {week} as w, round(sum(value), 2) as total, count(case when event_type = 'purchase' then 1 end) as purchases from events group by user_id, {week})"""
LOBBY = """select match_id, week as match_start_ts, case when league % 3 > 0 then 'official' else 'custom' end as match_type, 'squad-fpp' as game_mode, 'squad' as team_mode, 'fpp' as perspective,
case when league % 2 = 0 then 'M' end as map_name, 'eu' as region, 1800 as duration_s, count(*) as player_count, count(case when not is_bot then 1 end) as human_count, league % 3 > 0 as is_analytical from ({base}) group by match_id, week, league"""
SPARK = {"div": "div", "week": "datediff(ts, timestamp'2024-01-01') div 7"}
DUCK = {"div": "//", "week": "date_diff('day', date '2024-01-01', cast(ts as date)) // 7"}


def silver_tables(t) -> dict[str, DataFrame]:
    """The silver tables that fact_player_match is made of."""
    t.events.createOrReplaceTempView("_chain_events")
    sql = lambda text: t.spark.sql(text.replace("from events", "from _chain_events"))
    base = sql(BASE.format(**SPARK))
    lobby = sql(LOBBY.format(base=BASE.format(**SPARK)))
    placed = base.withColumn("win_place", F.expr("rank() over (partition by match_id order by total desc)")).drop("week", "league", "total").withColumn("player_name", F.lit("n"))
    at = F.expr(f"concat(cast({SPARK['week']} as string), '-', cast(user_id % 10 as string))").alias("match_id")
    shots, falls = t.events.filter("event_type = 'purchase'"), t.events.filter("event_type = 'click'")
    roles = F.explode(F.array(F.lit("killer"), F.lit("victim"))).alias("role")
    return {
        "slv_match": lobby, "slv_match_player": silver.build_match_player(placed, lobby),
        "slv_kill": shots.select(F.col("event_id").alias("kill_sk"), (F.col("event_id") % 3 > 0).alias("is_human_vs_human"), (F.col("value") * 10).alias("killer_distance_m")),
        "slv_kill_participant": shots.select(F.col("event_id").alias("kill_sk"), at, F.col("user_id").alias("account_id"), roles), "slv_roster": base.groupBy("match_id", "team_id").agg(F.count(F.lit(1)).alias("participant_count")),
        "slv_landing": silver.build_landing(falls.select(at, F.col("user_id").alias("account_id"), F.col("ts").alias("event_ts"), F.lit("n").alias("player_name"), F.lit(0).alias("team_id"), F.lit(False).alias("is_bot"), F.lit(1.0).alias("distance"), F.expr("value * 1e4 as x"), F.expr("(event_id % 1000) * 1e3 as y"), F.lit(0.0).alias("z"))),
    }


def fact(t) -> tuple[dict[str, DataFrame], DataFrame]:
    s = silver_tables(t)
    return s, gold.build_fact_player_match(s["slv_match_player"], s["slv_match"], s["slv_kill_participant"], s["slv_kill"], s["slv_roster"], s["slv_landing"])


FACT_SQL = f"""b as ({BASE.format(**DUCK)}), m as ({LOBBY.format(base=BASE.format(**DUCK))}),
placed as (select *, rank() over (partition by match_id order by total desc) as win_place from b), humans as (select *, case when not is_bot then dense_rank() over (partition by match_id, is_bot order by win_place) end as human_placement from placed),
ranked as (select *, max(human_placement) over (partition by match_id) as ranks from humans),
e as (select *, {DUCK["week"]} || '-' || (user_id % 10) as match_id from events),
h as (select match_id, user_id, count(*) as human_kills, count(*) filter (where value * 10 >= 100) as far from e where event_type = 'purchase' and event_id % 3 > 0 group by 1, 2),
c as (select match_id, user_id, arg_min(value * 1e4, ts) / 1e2 as x, arg_min((event_id % 1000) * 1e3, ts) / 1e2 as y from e where event_type = 'click' group by 1, 2),
f as (select k.match_id, k.account_id, k.team_id, k.is_bot, kills, damage_dealt, human_placement, case when not is_bot and ranks > 1 then (human_placement - 1) / (ranks - 1)::double end as human_placement_pct, m.match_start_ts, m.map_name, m.is_analytical,
count(*) over (partition by k.match_id, k.team_id) as team_size, coalesce(human_kills, 0) as human_kills, coalesce(far, 0) as human_kills_long_range, kills - coalesce(human_kills, 0) as bot_kills, x as landing_x_m, y as landing_y_m,
walk_distance + ride_distance + swim_distance as total_distance, death_type = 'alive' as survived_to_end
from ranked k join m on m.match_id = k.match_id left join h on h.match_id = k.match_id and h.user_id = k.account_id left join c on c.match_id = k.match_id and c.user_id = k.account_id)"""


@query("fact_player_match", f"""
with {FACT_SQL}
select match_id, account_id, team_id, is_bot, kills as kills_reported, human_placement, round(human_placement_pct, 8) as human_placement_pct, map_name, is_analytical, team_size, human_kills, human_kills_long_range, bot_kills, round(landing_x_m, 4) as landing_x_m,
floor(landing_x_m / 5e2)::int::varchar || '_' || floor(landing_y_m / 5e2)::int::varchar as landing_grid_cell, human_placement = 1 as won_match, survived_to_end, round(total_distance, 4) as total_distance, md5(match_id || '-' || account_id) as player_match_sk from f""")
def fact_player_match(t):
    """One row a player and match: placement among humans, kills of humans, the team's size, where the player landed."""
    return fact(t)[1].select(
        "match_id", "account_id", "team_id", "is_bot", "kills_reported", "human_placement", F.round("human_placement_pct", 8).alias("human_placement_pct"), "map_name", "is_analytical", "team_size", "human_kills", "human_kills_long_range",
        "bot_kills", F.round("landing_x_m", 4).alias("landing_x_m"), "landing_grid_cell", "won_match", "survived_to_end", F.round("total_distance", 4).alias("total_distance"), "player_match_sk",
    )


@query("dim_player", f"""
with {FACT_SQL}
select account_id, is_bot, count(*) as matches_played, count(*) filter (where is_analytical) as analytical_matches, min(match_start_ts) as first_week, max(match_start_ts) as last_week, sum(kills)::bigint as career_kills, round(sum(damage_dealt), 4) as career_damage,
min(human_placement) as best_human_placement, count(*) filter (where human_placement = 1) as wins, md5(account_id::varchar) as player_sk, count(*) filter (where is_analytical) >= 5 as has_enough_history from f group by account_id, is_bot""")
def dim_player(t):
    s = silver_tables(t)
    out = gold.build_dim_player(s["slv_match_player"], s["slv_match"])
    return out.withColumnsRenamed({"first_seen_ts": "first_week", "last_seen_ts": "last_week"}).withColumn("career_damage", F.round("career_damage", 4))


def rating_tables(t) -> dict[str, DataFrame]:
    s, people = fact(t)
    people = people.withColumn("match_start_ts", F.timestamp_seconds(F.col("match_start_ts") * 604800))
    return warehouse.build_ratings({"fact_player_match": people, "dim_player": gold.build_dim_player(s["slv_match_player"], s["slv_match"])})


#: The rated rows of f, in the form that the recursion over weeks reads.
RATED_SQL = f"{FACT_SQL}, g as (select match_start_ts as week, account_id as user_id, match_id as league, team_id as team, human_placement as place from f where is_analytical and not is_bot and human_placement is not null), {rating_recursion()}"
UPDATES = "u as (select r.*, p.league as match_id, p.week, p.team, p.team_rank, p.teams from r join p on p.user_id = r.user_id and p.w = r.w where r.played)"


@query("fact_rating_update", f"""
with recursive {RATED_SQL}, {UPDATES}
select user_id as account_id, match_id, team as team_id, team_rank, teams as teams_in_match, games - 1 as games_played_before, games > 1 as had_prior_history, round(mu_pre, 6) as mu_pre, round(sigma_pre, 6) as sigma_pre, round(mu, 6) as mu_post,
round(sigma, 6) as sigma_post, md5(user_id || '-' || match_id || '-plackett_luce') as rating_update_sk, md5(user_id::varchar) as player_sk, week * 604800 as started_s from u""")
def fact_rating_update(t):
    """Rating updates of humans in analytical matches, keyed."""
    out = rating_tables(t)["fact_rating_update"]
    return out.select(
        "account_id", "match_id", "team_id", "team_rank", "teams_in_match", "games_played_before", "had_prior_history", *(F.round(c, 6).alias(c) for c in ("mu_pre", "sigma_pre", "mu_post", "sigma_post")),
        "rating_update_sk", "player_sk", F.unix_seconds("match_start_ts").alias("started_s"),
    )


@query("dim_player_rating", f"""
with recursive {RATED_SQL}, {UPDATES}, l as (select *, row_number() over (partition by user_id order by week desc) as back from u),
d as (select account_id, count(*) as matches_played, count(*) filter (where is_analytical) as analytical_matches, sum(kills)::bigint as career_kills from f group by account_id)
select l.user_id as account_id, round(mu, 6) as mu, round(sigma, 6) as sigma, games as games_rated, games >= 30 as is_converged, week * 604800 as last_rated_s, matches_played, analytical_matches, career_kills from l left join d on d.account_id = l.user_id where back = 1""")
def dim_player_rating(t):
    """Each player's rating after the last match, beside the career."""
    out = rating_tables(t)["dim_player_rating"]
    return out.select("account_id", F.round("mu", 6).alias("mu"), F.round("sigma", 6).alias("sigma"), "games_rated", "is_converged", F.unix_seconds("last_rated_ts").alias("last_rated_s"), "matches_played", "analytical_matches", "career_kills")


@query("feat_player_match", f"""
with recursive {RATED_SQL}, {UPDATES},
x as (select f.*, u.mu_pre - 3 * u.sigma_pre as ordinal_pre, u.sigma_pre, u.games - 1 as games_before from f left join u on u.match_id = f.match_id and u.user_id = f.account_id where f.is_analytical and not f.is_bot and f.human_placement_pct is not null),
y as (select *, (sum(ordinal_pre) over w - coalesce(ordinal_pre, 0)) / nullif(count(ordinal_pre) over w - case when ordinal_pre is null then 0 else 1 end, 0) as mates,
avg(human_placement_pct) over o as prior_mean, count(*) over o as prior_matches, min(human_placement_pct) over o as prior_best from x
window w as (partition by match_id, team_id), o as (partition by account_id order by match_start_ts, match_id rows between unbounded preceding and 1 preceding))
select match_id, account_id, team_size, round(ordinal_pre, 5) as ordinal_pre, games_before as games_played_before, round(mates, 5) as teammate_mean_ordinal_pre, round(prior_mean, 7) as prior_mean_finish_pct, prior_matches, round(prior_best, 7) as prior_best_finish_pct,
human_placement_pct <= 0.5 as finished_top_half, coalesce(games_before, 0) > 0 as has_rating_history, prior_matches > 0 as has_form_history, md5(match_id || '-' || account_id) as feature_sk from y""")
def feat_player_match(t):
    """Features as of each match's start, and the label."""
    out = rating_tables(t)["feat_player_match"]
    return out.select(
        "match_id", "account_id", "team_size", F.round("ordinal_pre", 5).alias("ordinal_pre"), "games_played_before", F.round("teammate_mean_ordinal_pre", 5).alias("teammate_mean_ordinal_pre"),
        F.round("prior_mean_finish_pct", 7).alias("prior_mean_finish_pct"), "prior_matches", F.round("prior_best_finish_pct", 7).alias("prior_best_finish_pct"), "finished_top_half", "has_rating_history", "has_form_history", "feature_sk",
    )
