"""Estimators, evaluation, ratings, features and the classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import bucket, rate
from ..operators import evaluate as ev
from ..operators.models import base_rate, fit_classifier, largest_gradient, predict, temporal_split
from ..operators.quality import window_mismatch
from ..operators.ratings import chain_breaks, rating_history
from ..operators.windows import ordered_cut, prior_window, spread
from ..sources.staging import stage
from .catalog import query


def scored(t):
    """Labels with a score from the documents' lengths."""
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select("doc_id", "quality", "toxic", F.col("n_chars").alias("score"), (F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0))).alias("prob"))


SCORED = "(select l.*, n_chars as score, n_chars / (n_chars + 2000.0::double) as prob from labels l join documents d on d.doc_id = l.doc_id)"


@query("auc_exact", f"""
with s as (select * from {SCORED})
select (select round(sum(case when a.score > b.score then 1.0::double when a.score = b.score then 0.5::double else 0.0::double end) / count(*), 10) from s a join s b on a.quality = 1 and b.quality = 0) as auc,
(select count(*) from s where quality = 1) as n_pos, (select count(*) from s where quality = 0) as n_neg""")
def auc_exact(t):
    """Exact AUC of lengths against quality labels, ties half; the SQL compares all pairs."""
    return ev.auc(scored(t), "score", "quality").select(F.round("auc", 10).alias("auc"), "n_pos", "n_neg")


@query("auc_by_history", f"""
select a.toxic as history, round(sum(case when a.score > b.score then 1.0::double when a.score = b.score then 0.5::double else 0.0::double end) / count(*), 10) as auc
from {SCORED} a join {SCORED} b on a.quality = 1 and b.quality = 0 and a.toxic = b.toxic group by 1""")
def auc_by_history(t):
    """AUC in each stratum."""
    return ev.auc_by_history(scored(t), "score", "quality", F.col("toxic")).select("history", F.round("auc", 10).alias("auc")).filter("auc is not null")


@query("leakage_audit", f"""
with s as (select *, score + 100000 * quality as after from {SCORED}), p as (select * from s where quality = 1), n as (select * from s where quality = 0)
select round(b, 10) as auc_before, round(a, 10) as auc_after, round(a - b, 10) as inflation from (select
avg(case when p.score > n.score then 1.0::double when p.score = n.score then 0.5::double else 0.0::double end) as b, avg(case when p.after > n.after then 1.0::double when p.after = n.after then 0.5::double else 0.0::double end) as a from p cross join n)""")
def leakage_audit(t):
    """How much an AUC gains from a score that has seen the outcome."""
    out = ev.leakage(scored(t).withColumn("after", F.col("score") + 100000 * F.col("quality")), "score", "after", "quality")
    return out.select(*(F.round(c, 10).alias(c) for c in ("auc_before", "auc_after", "inflation")))


@query("ece_curve", f"select cast(least(floor(prob * 10), 9) as integer) as bin, count(*) as n, round(avg(prob), 8) as mean_prob, round(avg(quality), 8) as observed from {SCORED} group by 1")
def ece_curve(t):
    return ev.calibration(scored(t), "prob", "quality").select("bin", "n", F.round("mean_prob", 8).alias("mean_prob"), F.round("observed", 8).alias("observed"))


@query("ece", f"select round(sum(abs(p - o) * n) / sum(n), 8) as ece, sum(n)::bigint as n from (select least(floor(prob * 10), 9) as b, count(*) as n, avg(prob) as p, avg(quality) as o from {SCORED} group by 1)")
def ece(t):
    return ev.expected_calibration_error(scored(t), "prob", "quality").select(F.round("ece", 8).alias("ece"), "n")


@query("logloss_brier", f"select round(avg(-(quality * ln(prob) + (1 - quality) * ln(1 - prob))), 8) as log_loss, round(avg(pow(prob - quality, 2)), 8) as brier, count(*) as n from {SCORED}")
def logloss_brier(t):
    return ev.proper_scores(scored(t), "prob", "quality").select(F.round("log_loss", 8).alias("log_loss"), F.round("brier", 8).alias("brier"), "n")


@query("spearman", """
with r as (select rank() over (order by p_size) + (count(*) over (partition by p_size) - 1) / 2.0::double as a, rank() over (order by p_retailprice) + (count(*) over (partition by p_retailprice) - 1) / 2.0::double as b from part)
select round(corr(a, b), 8) as rho, count(*) as n from r""")
def spearman(t):
    return ev.spearman(t.part, "p_size", "p_retailprice").select(F.round("rho", 8).alias("rho"), "n")


@query("temporal_split", """
with o as (select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) as n, count(*) over () as total from orders)
select l_orderkey, n <= cast(floor(total * 0.75::double) as bigint) as is_train, count(*) as lines from lineitem join o on o_orderkey = l_orderkey group by 1, 2""")
def split(t):
    """The first three quarters of orders by date, with all of their lines."""
    lines, orders = spread(t.lineitem.select("l_orderkey"), t.lineitem.count(), "l_orderkey"), t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    head, tail = ordered_cut(spread(orders, t.orders.count(), "l_orderkey"), "l_orderkey", ["o_orderdate"], 0.75)
    both = head.select("l_orderkey", F.lit(True).alias("is_train")).unionByName(tail.select("l_orderkey", F.lit(False).alias("is_train")))
    return lines.join(both, "l_orderkey").groupBy("l_orderkey", "is_train").agg(F.count(F.lit(1)).alias("lines"))


CELLS = "(select p_brand, l_suppkey % 10 as slot, count(*) as n, count(*) filter (where l_returnflag = 'R') as s from lineitem join part on p_partkey = l_partkey group by 1, 2)"


def cells(t):
    rows = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), (F.col("l_suppkey") % 10).alias("slot"), "l_returnflag").join(t.part.select("p_partkey", "p_brand"), "p_partkey")
    return rows.groupBy("p_brand", "slot").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("s"))


@query("eb_prior_weight", f"""
with r as (select s / cast(n as double) as r, n from {CELLS}), v as (select var_samp(r) as o, avg(r * (1 - r) / n) as w from r)
select round(o, 10) as observed_var, round(w, 10) as sampling_var, case when o - w > 0 then round(0.25 / (o - w) - 1, 2) end as prior_weight from v""")
def prior_weight(t):
    """How many pseudo-observations the spread of rates supports."""
    out = ev.eb_prior_weight(cells(t), "s", "n")
    return out.select(F.round("observed_var", 10).alias("observed_var"), F.round("sampling_var", 10).alias("sampling_var"), F.round("prior_weight", 2).alias("prior_weight"))


@query("shrink_sweep", f"""
with c as (select *, case when n < 180 then 'few' else 'many' end as stratum from {CELLS}), k as (select unnest([0.0, 20.0, 200.0])::double as k)
select k, stratum, round(sqrt(avg(pow((s + k / 3.0::double) / nullif(n + k, 0) - 1 / 3.0::double, 2))), 8) as rmse, count(*) as cells from c cross join k group by 1, 2""")
def sweep(t):
    """Error of shrunk return rates against the known third, by weight and cell size."""
    rows = cells(t).withColumns({"stratum": F.when(F.col("n") < 180, "few").otherwise("many"), "truth": F.lit(1 / 3)})
    return ev.shrink_sweep(rows, "s", "n", "truth", [0, 20, 200], 1 / 3, "stratum").withColumn("rmse", F.round("rmse", 8))


@query("stratified_rate", """
with g as (select l_suppkey % 20 as item, l_linestatus as stratum, avg(case when l_returnflag = 'R' then 1.0::double else 0.0::double end) as r, count(*) filter (where l_returnflag = 'R') as s, count(*) as n from lineitem group by 1, 2)
select item, round(sum(s) / cast(sum(n) as double), 8) as naive_rate, round(avg(r), 8) as stratified_rate, sum(n)::bigint as n, round((sum(s) / cast(sum(n) as double) - avg(r)) * 100, 5) as gap_points from g group by 1""")
def stratified(t):
    rows = t.lineitem.withColumn("item", F.col("l_suppkey") % 20)
    out = ev.stratified_rate(rows, "item", "l_linestatus", F.col("l_returnflag") == "R")
    return out.select("item", F.round("naive_rate", 8).alias("naive_rate"), F.round("stratified_rate", 8).alias("stratified_rate"), "n", F.round("gap_points", 5).alias("gap_points"))


@query("sampling_error", f"""
with r as (select *, s / cast(n as double) as rate from {CELLS}), b as (select *, 1.645::double * sqrt(rate * (1 - rate) / n) as bound from r)
select p_brand, slot, n, s, round(rate, 8) as rate, round(bound, 8) as error_bound, bound <= 0.02 as within_2, bound <= 0.05 as within_5 from b""")
def error_floor(t):
    out = ev.sampling_error(cells(t), "s", "n")
    return out.withColumns({"rate": F.round("rate", 8), "error_bound": F.round("error_bound", 8)})


@query("replicate_error", f"""
with e as (select p_brand, abs(s / cast(n as double) - 1 / 3.0::double) as e from {CELLS})
select p_brand, round(avg(e), 8) as mean_abs_error, round(quantile_cont(e, 0.9), 8) as p90_abs_error, round(avg((e <= 0.02)::int), 8) as share_within_2, round(avg((e <= 0.05)::int), 8) as share_within_5 from e group by 1""")
def replicates(t):
    """Error over replicates of one rate."""
    rows = cells(t).withColumns({"est": F.col("s") / F.col("n").cast("double"), "truth": F.lit(1 / 3)})
    out = ev.replicate_error(rows, "est", "truth", ["p_brand"])
    return out.select("p_brand", *(F.round(c, 8).alias(c) for c in out.columns if c != "p_brand"))


@query("design_effect", """
with c as (select l_orderkey, sum(l_quantity) as s, count(*) as n, sum(l_quantity * l_quantity) as ss from lineitem group by 1),
t as (select sum(s) / sum(n) as m, sum(n) as n, sum(ss) as ss, count(*) as g from c),
v as (select m, sqrt((ss - n * m * m) / (n - 1) / n) as naive, sqrt((select sum(pow(s - m * c.n, 2)) from c, t) * g / (g - 1)) / n as robust from t)
select round(m, 6) as mean, round(naive, 6) as se_naive, round(robust, 6) as se_cluster, round(pow(robust / naive, 2), 4) as deff from v""")
def clusters(t):
    """Standard errors with lines clustered in orders."""
    out = ev.design_effect(t.lineitem, "l_quantity", "l_orderkey")
    return out.select(F.round("mean", 6).alias("mean"), F.round("se_naive", 6).alias("se_naive"), F.round("se_cluster", 6).alias("se_cluster"), F.round("deff", 4).alias("deff"))


def games(t):
    """Weekly leagues of users: each week and league is a match, ten users in turn make a team, the week's value decides places."""
    weeks = t.events.groupBy(F.date_trunc("week", "ts").alias("week"), "user_id").agg(F.sum("value").alias("total"))
    rows = weeks.select("week", "user_id", (F.col("user_id") % 10).alias("league"), F.floor(F.col("user_id") / 50).alias("team_id"), (-F.round("total", 2)).alias("place"))
    return rows.withColumn("match", F.concat_ws("-", F.date_format("week", "yyyyMMdd"), "league"))


def rating_recursion() -> str:
    """SQL of the rating model, week by week, over g (week, user_id, league, team, place); r has every user's state after
    each week, p the rated rows."""
    return """k as (select *, rank() over (partition by week, league order by best) as team_rank, count(*) over (partition by week, league) as teams from (select week, league, team, min(place) as best from g group by 1, 2, 3)),
p as (select g.user_id, g.week, g.league, g.team, team_rank, teams, dense_rank() over (order by g.week) as w from g join k using (week, league, team) where teams > 1),
r as (
  select 0::bigint as w, user_id, 0::bigint as games, 25e0 as mu, 25e0 / 3 as sigma, 25e0 as mu_pre, 25e0 / 3 as sigma_pre, false as played from (select distinct user_id from p)
  union all (
    with x as (select r.w + 1 as w, r.user_id, r.games, r.mu, r.sigma, p.league, p.team, p.team_rank, p.teams, r.sigma * r.sigma + pow(25e0 / 300, 2) as s2 from r left join p on p.user_id = r.user_id and p.w = r.w + 1 where r.w < (select max(w) from p)),
    a as (select league, team, team_rank, teams, sum(mu) as team_mu, sum(s2) as team_s2 from x where league is not null group by all),
    b as (select *, sqrt(sum(team_s2) over (partition by league) + teams * pow(25e0 / 6, 2)) as c from a),
    d as (select *, exp(team_mu / c) as e from b),
    f as (select *, sum(e) over (partition by league order by team_rank desc range between unbounded preceding and current row) as behind, count(*) over (partition by league, team_rank) as ties from d),
    o as (select i.league, i.team, i.c, i.team_s2, sum((case when q.team = i.team then 1 else 0 end - i.e / q.behind) / q.ties) as omega, sum(i.e / q.behind * (1 - i.e / q.behind) / q.ties) as delta
      from f i join f q on q.league = i.league and q.team_rank <= i.team_rank group by all)
    select x.w, x.user_id, x.games + case when o.team is null then 0 else 1 end, case when o.team is null then x.mu else x.mu + x.s2 / o.team_s2 * (o.omega * o.team_s2 / o.c) end,
      case when o.team is null then x.sigma else sqrt(x.s2) * sqrt(greatest(1 - x.s2 / o.team_s2 * (o.delta * sqrt(o.team_s2) / o.c * o.team_s2 / (o.c * o.c)), 1e-4)) end, x.mu, x.sigma, o.team is not null
    from x left join o on o.league = x.league and o.team = x.team
  )
)"""


LEAGUES_SQL = "g as (select date_trunc('week', ts) as week, user_id, user_id % 10 as league, user_id // 50 as team, -round(sum(value), 2) as place from events group by 1, 2)"
RATING_SQL = f"with recursive {LEAGUES_SQL}, {rating_recursion()}\n"
RATED_SQL = "select r.user_id as account_id, strftime(p.week, '%Y%m%d') || '-' || p.league as match_id, p.week as match_start_ts, p.team as team_id, p.team_rank, p.teams as teams_in_match, r.games - 1 as games_played_before, r.* from r join p on p.user_id = r.user_id and p.w = r.w where r.played"


@query("rating_history", RATING_SQL + f"""select account_id, match_id, team_id, team_rank, teams_in_match, games_played_before, round(mu_pre, 6) as mu_pre, round(sigma_pre, 6) as sigma_pre, round(mu, 6) as mu_post, round(sigma, 6) as sigma_post,
round(mu_pre - 3 * sigma_pre, 5) as ordinal_pre, round(mu - 3 * sigma, 5) as ordinal_post from ({RATED_SQL})""")
def rated(t):
    """Ratings of users in weekly leagues, with every state before and after; floating-point sums rounded."""
    return ratings(t).select(
        "account_id", "match_id", "team_id", "team_rank", "teams_in_match", "games_played_before", *(F.round(c, 6).alias(c) for c in ("mu_pre", "sigma_pre", "mu_post", "sigma_post")),
        *(F.round(c, 5).alias(c) for c in ("ordinal_pre", "ordinal_post")),
    )


def ratings(t):
    """Ratings of users in weekly leagues, with every state before and after."""
    return rating_history(games(t), "match", "week", "team_id", "user_id", "place")


@query("rating_chain_check", RATING_SQL + "select count(*) as violations from (select mu_pre, lag(mu) over (partition by user_id order by w) as last from r where played) where abs(mu_pre - last) > 1e-9")
def rating_chain(t):
    """Breaks in the rating chain; none is right."""
    return chain_breaks(ratings(t)).agg(F.count(F.lit(1)).alias("violations"))


PIT = """with p as (select o_orderkey, o_custkey, o_orderdate, o_totalprice, avg(o_totalprice) over w as prior_mean, count(*) over w as prior_n from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding))"""


def features(t):
    rows = prior_window(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"prior_mean": F.avg("o_totalprice"), "prior_n": F.count(F.lit(1))})
    return rows.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "prior_mean", "prior_n")


@query("auc_by_games", PIT + """,
h as (select case when prior_n = 0 then '0' when prior_n < 5 then '1-4' when prior_n < 10 then '5-9' when prior_n < 30 then '10-29' else '30+' end as history, coalesce(prior_mean, 0) as score, o_totalprice >= 150000 as y from p),
r as (select history, y, rank() over (partition by history order by score) + (count(*) over (partition by history, score) - 1) / 2e0 as place from h),
g as (select history, count(*) filter (where y) as n_pos, count(*) filter (where not y) as n_neg, sum(place) filter (where y) as places from r group by 1)
select history, n_pos, n_neg, round((places - n_pos * (n_pos + 1) / 2e0) / (n_pos * n_neg), 6) as auc from g where n_pos > 0 and n_neg > 0""")
def auc_by_games(t):
    """How well the mean of earlier orders tells large ones, by how many there were before."""
    rows = features(t).select("prior_n", F.coalesce("prior_mean", F.lit(0.0)).alias("score"), (F.col("o_totalprice") >= 150000).alias("large"))
    history = bucket("prior_n", [1, 5, 10, 30], ["0", "1-4", "5-9", "10-29", "30+"])
    return ev.auc_by_history(rows, "score", "large", history).filter("auc is not null").withColumn("auc", F.round("auc", 6))


@query("pit_features", PIT + " select o_orderkey, round(prior_mean, 7) as prior_mean, prior_n, prior_n > 0 as has_history, o_totalprice >= coalesce(prior_mean, 0) as above from p")
def pit_features(t):
    """Features as of each order, and a label."""
    return features(t).select("o_orderkey", F.round("prior_mean", 7).alias("prior_mean"), "prior_n", (F.col("prior_n") > 0).alias("has_history"), (F.col("o_totalprice") >= F.coalesce("prior_mean", F.lit(0.0))).alias("above"))


@query("pit_check", """
with f as (select o_custkey as c, o_orderkey as k, o_orderdate as d, avg(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding) as m from orders),
r as (select f.k, any_value(f.m) as m, avg(o.o_totalprice) as again from f left join orders o on o.o_custkey = f.c and (o.o_orderdate < f.d or (o.o_orderdate = f.d and o.o_orderkey < f.k)) group by f.k)
select count(*) filter (where (m is null) <> (again is null) or abs(m - again) > 1e-6) as violations, count(*) as checked from r""")
def pit_check(t):
    """Features against a recomputation by a join; no row differs."""
    f = features(t)
    bad = window_mismatch(f, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", "prior_mean", tolerance=1e-6)
    return bad.agg(F.count(F.lit(1)).alias("violations")).crossJoin(f.agg(F.count(F.lit(1)).alias("checked")))


NUMERIC = ["prior_mean", "prior_n", "c_acctbal"]
CATEGORIES = {"o_orderpriority": ["1-URGENT", "2-HIGH"]}


MODELS = {"point_in_time": NUMERIC, "leaked": [*NUMERIC, "o_totalprice"]}


def halves(t):
    """Earlier and later orders with their features, each computed once."""
    rows = features(t).join(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey").join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal"), "o_custkey")
    rows = stage(rows.withColumn("large", (F.col("o_totalprice") > 250000).cast("int")))
    train, test = temporal_split(rows, "o_orderkey", "o_orderdate")
    return stage(train), stage(test)


def scores(p):
    """Every measure of each model, from predictions that are computed once."""
    p = stage(p.select("model", "probability", "label"))
    by = ["model"]
    out = ev.proper_scores(p, "probability", "label", by=by).join(ev.auc(p, "probability", "label", by).select("model", "auc"), "model")
    return out.join(ev.expected_calibration_error(p, "probability", "label", by=by).select("model", "ece"), "model")


@query("calibrated_model")
def calibrated_model(t):
    """A classifier of large orders: fitted on the earlier ones, scored on the later, beside the base rate and a leaked score."""
    train, test = halves(t)
    out = base_rate(train, test, "large").withColumn("model", F.lit("base_rate")).select("model", "probability", "label")
    for name, numeric in MODELS.items():
        p = predict(fit_classifier(train, numeric, "large", CATEGORIES, iterations=100, tol=1e-6), test, numeric, "large", CATEGORIES)
        out = out.unionByName(p.withColumn("model", F.lit(name)).select("model", "probability", "label"))
    return scores(out)


@query("base_rate_model", """
with o as (select o_totalprice > 250000 as y, row_number() over (order by o_orderdate, o_orderkey) as place, count(*) over () as n from orders), p as (select avg(y::int) as p from o where place <= floor(n * 0.75))
select 'base_rate' as model, count(*) as n, round(avg(-(case when y then ln(p) else ln(1 - p) end)), 7) as log_loss, round(avg(pow(p - y::int, 2)), 7) as brier, 0.5e0 as auc, round(abs(p - avg(y::int)), 7) as ece from o, p where place > floor(n * 0.75) group by p""")
def base_rate_model(t):
    """What any classifier is measured against: the earlier orders' rate as everyone's probability."""
    train, test = halves(t)
    out = scores(base_rate(train, test, "large").withColumn("model", F.lit("base_rate")))
    return out.select("model", "n", *(F.round(c, 7).alias(c) for c in ("log_loss", "brier", "auc", "ece")))


@query("model_optimality", "select unnest(['point_in_time', 'leaked']) as model, true as optimal, (select floor(count(*) * 0.75)::bigint from orders) as n")
def model_optimality(t):
    """Whether the fitted weights are the best there are: the gradient at them is all but zero."""
    train, out = halves(t)[0], None
    for name, numeric in MODELS.items():
        model = fit_classifier(train, numeric, "large", CATEGORIES)
        one = largest_gradient(model, train, numeric, "large", CATEGORIES).select(F.lit(name).alias("model"), (F.col("largest") < 1e-5).alias("optimal"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("return_share", "select l_linestatus, round(avg(case when l_returnflag = 'R' then 1.0::double else 0.0::double end), 8) as share from lineitem group by 1")
def return_share(t):
    return t.lineitem.groupBy("l_linestatus").agg(F.round(rate(F.col("l_returnflag") == "R"), 8).alias("share"))
