"""Evaluation of scores, and studies of the estimators in use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import safe_div, shrink_rate
from .windows import over

#: Ranges that an order is cut into, so that running sums need no single task.
RANGES = 64


def running(df: DataFrame, order: str, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """df with before_<v>: the sum of each value over the rows with a smaller ``order`` (of the same group).

    The order is cut into ranges at approximate quantiles; sums of whole ranges are added up over a small table, and
    windows run within ranges. Rows must be unique by group and order.
    """
    probabilities = [k / RANGES for k in range(1, RANGES)]
    cuts = df.agg(F.percentile_approx(order, probabilities, 10_000).alias("_cuts"))
    rows = df.crossJoin(F.broadcast(cuts)).withColumn("_range", F.when(F.col("_cuts").isNull(), 0).otherwise(F.size(F.filter("_cuts", lambda x: x < F.col(order))))).drop("_cuts")
    whole = rows.groupBy(*by, "_range").agg(*(F.sum(v).alias(f"_s_{v}") for v in values))
    before = over(list(by), ["_range"]).rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(*by, "_range", *(F.coalesce(F.sum(f"_s_{v}").over(before), F.lit(0)).alias(f"_b_{v}") for v in values))
    rows = rows.join(whole, _same(rows, whole, [*by, "_range"])).select(rows["*"], *(whole[f"_b_{v}"] for v in values))
    own = over([*by, "_range"], [order]).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"before_{v}": F.col(f"_b_{v}") + F.coalesce(F.sum(v).over(own), F.lit(0)) for v in values})
    return rows.drop("_range", *(f"_b_{v}" for v in values))


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out


def auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties half; null where a class is missing. Rows without score or label are left out."""
    y = F.col(label).cast("int")
    tied = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("_score")).agg(F.sum(y).cast("double").alias("pos"), F.sum(1 - y).cast("double").alias("neg"))
    rows = running(tied, "_score", ["neg"], by)
    total = rows.groupBy(*by).agg(F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2)).alias("_u"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return total.select(*by, safe_div("_u", F.col("n_pos") * F.col("n_neg")).alias("auc"), F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"))


def auc_by_history(df: DataFrame, score: str, label: str, history: Column) -> DataFrame:
    """AUC for each stratum of history."""
    return auc(df.withColumn("history", history), score, label, ["history"])


def leakage(df: DataFrame, before: str, after: str, label: str) -> DataFrame:
    """AUC of a score known before the outcome, of one that contains it, and the difference."""
    a, b = auc(df, before, label).select(F.col("auc").alias("auc_before")), auc(df, after, label).select(F.col("auc").alias("auc_after"))
    return a.crossJoin(b).withColumn("inflation", F.col("auc_after") - F.col("auc_before"))


def calibration(df: DataFrame, prob: str, label: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Reliability curve over equal bins; the last holds 1.0."""
    b = F.least(F.floor(F.col(prob) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(prob).alias("mean_prob"), F.avg(F.col(label).cast("double")).alias("observed"))


def expected_calibration_error(df: DataFrame, prob: str, label: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    curve = calibration(df, prob, label, bins, by)
    return curve.groupBy(*by).agg((F.sum(F.abs(F.col("mean_prob") - F.col("observed")) * F.col("n")) / F.sum("n")).alias("ece"), F.sum("n").alias("n"))


def proper_scores(df: DataFrame, prob: str, label: str, clip: float = 1e-15, by: Sequence[str] = ()) -> DataFrame:
    """Log loss and Brier score."""
    p, y = F.least(F.greatest(F.col(prob), F.lit(clip)), F.lit(1 - clip)), F.col(label).cast("double")
    return df.groupBy(*by).agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"), F.avg((F.col(prob) - y) * (F.col(prob) - y)).alias("brier"), F.count(F.lit(1)).alias("n"))


def average_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Rank from 1; ties share their mean rank."""
    tied = df.groupBy(F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    ranks = running(tied, "_v", ["_n"]).select("_v", (F.col("before__n") + (F.col("_n") + 1) / 2).alias(out))
    return df.join(ranks, F.col(value).cast("double") == F.col("_v")).drop("_v")


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation over the rows that have both."""
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    return average_rank(average_rank(rows, x, "_rx"), y, "_ry").agg(F.corr("_rx", "_ry").alias("rho"), F.count(F.lit(1)).alias("n"))


def eb_prior_weight(df: DataFrame, successes: str, trials: str, prior: float = 0.5) -> DataFrame:
    """Pseudo-observations k = p(1-p)/s2 - 1, where s2 is the variance of rates beyond that of sampling; null if none is left."""
    r = safe_div(successes, trials)
    cells = df.filter(F.col(trials) > 0).select(r.alias("r"), (r * (1 - r) / F.col(trials)).alias("v"))
    out = cells.agg(F.var_samp("r").alias("observed_var"), F.avg("v").alias("sampling_var"))
    s2 = F.col("observed_var") - F.col("sampling_var")
    return out.withColumn("prior_weight", F.when(s2 > 0, F.lit(prior * (1 - prior)) / s2 - 1))


def shrink_sweep(cells: DataFrame, successes: str, trials: str, truth: str, ks: Sequence[float], prior: float, stratum: str) -> DataFrame:
    """Error of shrunk rates against known ones, by weight and stratum. ks is a short literal list."""
    rows = cells.withColumn("k", F.explode(F.array(*(F.lit(float(k)) for k in ks))))
    est = safe_div(F.col(successes) + F.col("k") * prior, F.col(trials) + F.col("k"))
    return rows.groupBy("k", stratum).agg(F.sqrt(F.avg((est - F.col(truth)) * (est - F.col(truth)))).alias("rmse"), F.count(F.lit(1)).alias("cells"))


def stratified_rate(df: DataFrame, item: str, stratum: str, success: Column) -> DataFrame:
    """Naive rate, the mean of the strata's rates at equal weight, and their gap in points."""
    one = F.when(success, F.lit(1.0)).otherwise(F.lit(0.0))
    strata = df.groupBy(item, stratum).agg(F.avg(one).alias("r"), F.sum(one).alias("s"), F.count(F.lit(1)).alias("n"))
    out = strata.groupBy(item).agg((F.sum("s") / F.sum("n")).alias("naive_rate"), F.avg("r").alias("stratified_rate"), F.sum("n").alias("n"))
    return out.withColumn("gap_points", (F.col("naive_rate") - F.col("stratified_rate")) * 100)


def sampling_error(cells: DataFrame, successes: str, trials: str, z: float = 1.645) -> DataFrame:
    """Each cell's rate with its normal-approximation error bound, and whether it is within 2 or 5 points."""
    r = safe_div(successes, trials)
    bound = F.lit(z) * F.sqrt(r * (1 - r) / F.col(trials))
    return cells.withColumns({"rate": r, "error_bound": bound}).withColumns({"within_2": F.col("error_bound") <= 0.02, "within_5": F.col("error_bound") <= 0.05})


def replicate_error(replicates: DataFrame, estimate: str, truth: str, by: Sequence[str]) -> DataFrame:
    """Mean and 90th percentile of the absolute error over replicates, and the shares within 2 and 5 points."""
    e = F.abs(F.col(estimate) - F.col(truth))
    return replicates.groupBy(*by).agg(F.avg(e).alias("mean_abs_error"), F.percentile(e, F.lit(0.9)).alias("p90_abs_error"), F.avg((e <= 0.02).cast("double")).alias("share_within_2"), F.avg((e <= 0.05).cast("double")).alias("share_within_5"))


def design_effect(df: DataFrame, value: str, cluster: str) -> DataFrame:
    """Standard error of a mean with and without clustering, and the square of their ratio."""
    v = F.col(value).cast("double")
    clusters = df.filter(v.isNotNull()).groupBy(cluster).agg(F.sum(v).alias("s"), F.count(F.lit(1)).alias("n"), F.sum(v * v).alias("ss"))
    total = clusters.agg(F.sum("s").alias("S"), F.sum("n").alias("N"), F.sum("ss").alias("SS"), F.count(F.lit(1)).alias("G"), F.sum(F.col("s") * F.col("s")).alias("s2"), F.sum(F.col("s") * F.col("n")).alias("sn"), F.sum(F.col("n") * F.col("n")).alias("n2"))
    m = F.col("S") / F.col("N")
    naive = F.sqrt((F.col("SS") - F.col("N") * m * m) / (F.col("N") - 1) / F.col("N"))
    within = F.col("s2") - 2 * m * F.col("sn") + m * m * F.col("n2")
    robust = F.sqrt(within * F.col("G") / (F.col("G") - 1)) / F.col("N")
    out = total.filter("N > 1 and G > 1").select(m.alias("mean"), naive.alias("se_naive"), robust.alias("se_cluster"))
    return out.withColumn("deff", safe_div(F.col("se_cluster") * F.col("se_cluster"), F.col("se_naive") * F.col("se_naive")))


def shrunk(df: DataFrame, successes: str, trials: str, prior: float, weight: float, out: str = "shrunk_rate") -> DataFrame:
    return df.withColumn(out, shrink_rate(successes, trials, prior, weight))
