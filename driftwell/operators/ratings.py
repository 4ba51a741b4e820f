"""Skill ratings of players from team placements (Plackett-Luce; Weng and Lin 2011), with every state before and after.

Matches are rated in order of time. A match only reads and writes its own players, so it can be rated as soon as each of
its players has played all matches before it. A match's level is the length of the longest chain of matches that leads
to it by way of players. Levels follow from ids alone and are found first; matches of one level share no player and are
rated at once, and the result is that of the fold. A round reads the rows of its own level and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import fresh_path, stage, versions
from .windows import competition_rank, over


@dataclass(frozen=True)
class RatingParams:
    """Published defaults of the model."""

    mu: float = 25.0
    sigma: float = 25.0 / 3
    beta: float = 25.0 / 6
    tau: float = 25.0 / 300
    kappa: float = 1e-4
    spread: float = 3.0
    system: str = "plackett_luce"


def rated_teams(participants: DataFrame, match: str, ts: str, team: str, player: str, placement: str) -> DataFrame:
    """A row a player and rated match: teams ranked 1, 1, 3 by their best placement; matches of one team are left out."""
    rows = participants.select(F.col(match).alias("match_id"), F.col(ts).alias("match_start_ts"), F.col(team).alias("team_id"), F.col(player).alias("account_id"), F.col(placement).alias("placement"))
    rows = rows.filter("team_id is not null and placement is not null and account_id is not null").dropDuplicates(["match_id", "account_id"])
    teams = rows.groupBy("match_id", "team_id").agg(F.min("placement").alias("best"))
    teams = competition_rank(teams, ["match_id"], ["best"], "team_rank").withColumn("teams_in_match", F.count(F.lit(1)).over(over(["match_id"])))
    return rows.join(teams.filter("teams_in_match > 1").select("match_id", "team_id", "team_rank", "teams_in_match"), ["match_id", "team_id"]).drop("placement")


def update_round(ready: DataFrame, p: RatingParams) -> DataFrame:
    """Rate matches that share no player. ready: match_id, team_id, team_rank, account_id, mu_pre, sigma_pre and more."""
    prior2 = F.col("sigma_pre") * F.col("sigma_pre") + F.lit(p.tau * p.tau)
    rows = ready.withColumn("s2", prior2)
    teams = rows.groupBy("match_id", "team_id", "team_rank").agg(F.sum("mu_pre").alias("team_mu"), F.sum("s2").alias("team_s2"))
    c2 = F.sum(F.col("team_s2") + F.lit(p.beta * p.beta)).over(over(["match_id"]))
    teams = teams.withColumn("c", F.sqrt(c2)).withColumn("e", F.exp(F.col("team_mu") / F.col("c")))
    # Teams of one rank share the sum over all that finished with them or behind them, and the number of ties.
    w = over(["match_id"], [F.col("team_rank").desc()]).rangeBetween(Window.unboundedPreceding, 0)
    teams = teams.withColumn("behind", F.sum("e").over(w)).withColumn("ties", F.count(F.lit(1)).over(over(["match_id", "team_rank"])))
    i, q = teams.alias("i"), teams.select("match_id", F.col("team_id").alias("q_team"), F.col("team_rank").alias("q_rank"), "behind", "ties").alias("q")
    pairs = i.join(q, (F.col("i.match_id") == F.col("q.match_id")) & (F.col("q.q_rank") <= F.col("i.team_rank")))
    share = F.col("i.e") / F.col("q.behind")
    own = F.when(F.col("q.q_team") == F.col("i.team_id"), F.lit(1.0)).otherwise(F.lit(0.0))
    sums = pairs.groupBy(F.col("i.match_id").alias("match_id"), F.col("i.team_id").alias("team_id"), "i.c", "i.team_s2").agg(
        F.sum((own - share) / F.col("q.ties")).alias("omega"), F.sum(share * (1 - share) / F.col("q.ties")).alias("delta")
    )
    sums = sums.withColumn("omega", F.col("omega") * F.col("team_s2") / F.col("c"))
    sums = sums.withColumn("delta", F.col("delta") * F.sqrt("team_s2") / F.col("c") * F.col("team_s2") / (F.col("c") * F.col("c")))
    out = rows.join(sums.select("match_id", "team_id", "omega", "delta", "team_s2"), ["match_id", "team_id"])
    part = F.col("s2") / F.col("team_s2")
    out = out.withColumns({"mu_post": F.col("mu_pre") + part * F.col("omega"), "sigma_post": F.sqrt(F.col("s2")) * F.sqrt(F.greatest(1 - part * F.col("delta"), F.lit(p.kappa)))})
    return out.drop("s2", "team_s2", "omega", "delta")


def match_levels(rows: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """match_id, level (from 1) of rows match_id, account_id, seq (a player's matches in order, from 1).

    A match's level is at least its place in each of its players' histories. A round carries levels along whole
    histories (a running maximum of level - seq), then takes each match's maximum over its players; it ends when no match
    rises. So rounds count how often the longest chain changes from player to player, not its matches.
    """
    rows = rows.select("match_id", "account_id", "seq")
    levels = stage(rows.groupBy("match_id").agg(F.max("seq").alias("level")))
    history = over(["account_id"], ["seq"]).rowsBetween(Window.unboundedPreceding, 0)
    for _ in range(max_rounds):
        along = rows.join(levels, "match_id").withColumn("least", F.max(F.col("level") - F.col("seq")).over(history) + F.col("seq"))
        risen = stage(along.groupBy("match_id").agg(F.max("least").alias("level"), F.bool_or(F.col("least") > F.col("level")).alias("rose")))
        levels = risen.select("match_id", "level")
        if risen.filter("rose").isEmpty():
            return levels
    raise RuntimeError("more rounds than max_rounds")


def rating_history(participants: DataFrame, match: str, ts: str, team: str, player: str, placement: str, params: RatingParams = RatingParams(), max_rounds: int = 100_000) -> DataFrame:
    """One row a player and rated match with mu, sigma and ordinal before and after.

    Rows are stored by level. A round reads its level's rows and the states that earlier rounds have left for it, and
    leaves each player's state in the folder of the level of the player's next match. So all rounds together read each
    row and each state once.
    """
    spark = participants.sparkSession
    rows = rated_teams(participants, match, ts, team, player, placement)
    rows = stage(rows.withColumn("seq", F.row_number().over(over(["account_id"], ["match_start_ts", "match_id"])).cast("long")))
    rows = rows.join(match_levels(rows), "match_id").withColumn("next_level", F.lead("level").over(over(["account_id"], ["seq"])))
    folder, shape = fresh_path(spark, "ratings"), rows.drop("level").schema
    rows.repartition("level").write.partitionBy("level").parquet(f"{folder}/rows")
    levels = versions(spark, f"{folder}/rows", "level")
    if len(levels) > max_rounds:
        raise RuntimeError("more rounds than max_rounds")
    start, rated_shape = [F.coalesce("mu_post", F.lit(params.mu)).alias("mu_pre"), F.coalesce("sigma_post", F.lit(params.sigma)).alias("sigma_pre")], None
    for level in levels:
        ready = spark.read.schema(shape).parquet(f"{folder}/rows/level={level}")
        states = f"{folder}/states/next_level={level}"
        if level > levels[0]:  # someone has come here, or the level would be lower
            before = spark.read.schema("account_id string, mu_post double, sigma_post double").parquet(states)
            before = before.select(F.col("account_id").cast(shape["account_id"].dataType).alias("account_id"), "mu_post", "sigma_post")
            ready = ready.join(before, "account_id", "left")
        else:
            ready = ready.withColumns({"mu_post": F.lit(None).cast("double"), "sigma_post": F.lit(None).cast("double")})
        ready = ready.select(*shape.names, *start, (F.col("seq") - 1).alias("games_played_before"))
        rated = update_round(ready, params)
        rated_shape = rated.schema
        rated.write.parquet(f"{folder}/rated/level={level}")
        rated = spark.read.schema(rated_shape).parquet(f"{folder}/rated/level={level}")
        left = rated.filter("next_level is not null").select(F.col("account_id").cast("string").alias("account_id"), "mu_post", "sigma_post", "next_level")
        left.repartition("next_level").write.mode("append").partitionBy("next_level").parquet(f"{folder}/states")
    if levels:  # one scan, however many rounds
        out = spark.read.schema(rated_shape).parquet(*[f"{folder}/rated/level={n}" for n in levels])
    else:
        out = update_round(rows.select(*shape.names, F.lit(params.mu).alias("mu_pre"), F.lit(params.sigma).alias("sigma_pre"), F.lit(0).cast("long").alias("games_played_before")), params)
    ordinal = lambda k: F.col(f"mu_{k}") - F.lit(params.spread) * F.col(f"sigma_{k}")
    return out.select(
        "account_id", "match_id", "match_start_ts", "team_id", "team_rank", "teams_in_match", "games_played_before", "mu_pre", "sigma_pre", ordinal("pre").alias("ordinal_pre"), "mu_post", "sigma_post",
        ordinal("post").alias("ordinal_post"), (F.col("mu_post") - F.col("mu_pre")).alias("mu_delta"), (F.col("sigma_post") - F.col("sigma_pre")).alias("sigma_delta"), F.lit(params.system).alias("rating_system"),
    )


def chain_breaks(history: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Rows whose state before a match isn't the state after the player's match before it. None in a sound history."""
    w = over(["account_id", "rating_system"], ["match_start_ts", "match_id"])
    rows = history.withColumns({"last_mu": F.lag("mu_post").over(w), "last_sigma": F.lag("sigma_post").over(w)})
    return rows.filter((F.abs(F.col("mu_pre") - F.col("last_mu")) > tolerance) | (F.abs(F.col("sigma_pre") - F.col("last_sigma")) > tolerance))
