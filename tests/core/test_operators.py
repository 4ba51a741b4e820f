"""Operators against plain Python and known answers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from driftwell.operators import evaluate as ev
from driftwell.operators import joins, models, quality, ratings, windows
from driftwell.operators.ratings import RatingParams


def test_asof_quirks(spark):
    left = spark.sql("select * from values (1, 'a', timestamp'2024-01-01 00:00:10'), (2, 'a', timestamp'2024-01-01 00:00:05'), (3, null, timestamp'2024-01-01 00:00:10'), (4, 'a', null), (5, 'b', timestamp'2024-01-01 00:00:01') as t(id, k, ts)")
    right = spark.sql("select * from values ('a', timestamp'2024-01-01 00:00:10', 1, null), ('a', timestamp'2024-01-01 00:00:10', 2, 'y'), ('a', timestamp'2024-01-01 00:00:07', 0, 'z'), (null, timestamp'2024-01-01 00:00:00', 9, 'q') as t(k, rts, n, v)")
    got = {r.id: (r.n, r.v) for r in joins.asof_join(left, right, ["k"], "ts", "rts", values=["n", "v"], tiebreak=["n"]).collect()}
    assert got == {1: (2, "y"), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, None)}
    one = joins.asof_join(left, right.filter("n = 1"), ["k"], "ts", "rts", values=["n", "v"], how="inner").collect()
    assert [(r.id, r.n, r.v) for r in one] == [(1, 1, None)]  # a null value of the right row stays its own
    assert {r.id: r.n for r in joins.asof_lookup(left, right, ["k"], "ts", "rts", ["n"], tiebreak=["n"]).collect()} == {1: 2, 2: None, 3: None, 4: None, 5: None}


@pytest.mark.parametrize("before,after", [(10, 10), (0, 5), (3.5, 0)])
def test_interval_join_equals_between(spark, before, after):
    rng = random.Random(1)
    rows = lambda n, c: spark.createDataFrame([(rng.randrange(3), i, float(rng.randrange(200)) / 2) for i in range(n)], f"k int, {c}_id int, {c}_s double").withColumn(f"{c}_ts", F.timestamp_seconds(f"{c}_s"))
    a, b = rows(60, "a"), rows(80, "b")
    got = {(r.a_id, r.b_id) for r in joins.interval_join(a, b, ["k"], "a_ts", "b_ts", before, after).collect()}
    want = {(r.a_id, r.b_id) for r in a.join(b, "k").filter((F.col("b_s") >= F.col("a_s") - before) & (F.col("b_s") <= F.col("a_s") + after)).collect()}
    assert got == want and want


def test_partitioning_does_not_matter(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("k"), (F.col("id") % 13).alias("t"), "id", F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).alias("v"))
    one = lambda d: sorted(map(tuple, windows.leave_one_out_mean(windows.dedup_first(d, ["k", "t"], ["id"]), ["k"], "v", "m").collect()), key=str)
    assert one(df.repartition(1)) == one(df.repartition(9, "id"))


def fold(rows, p=RatingParams()):
    """The sequential fold, for comparison: rows of (match, ts, team, player, placement)."""
    state, out = {}, {}
    for _, match in sorted({(r[1], r[0]) for r in rows}):
        mine = [r for r in rows if r[0] == match]
        best = {}
        for r in mine:
            best[r[2]] = min(best.get(r[2], 10**9), r[4])
        if len(best) < 2:
            continue
        rank = {t: 1 + sum(b < best[t] for b in best.values()) for t in best}
        pre = {r[3]: state.get(r[3], (p.mu, p.sigma)) for r in mine}
        s2 = {r[3]: pre[r[3]][1] ** 2 + p.tau**2 for r in mine}
        mu = {t: sum(pre[r[3]][0] for r in mine if r[2] == t) for t in best}
        var = {t: sum(s2[r[3]] for r in mine if r[2] == t) for t in best}
        c = math.sqrt(sum(var[t] + p.beta**2 for t in best))
        e = {t: math.exp(mu[t] / c) for t in best}
        behind = {t: sum(e[u] for u in best if rank[u] >= rank[t]) for t in best}
        ties = {t: sum(rank[u] == rank[t] for u in best) for t in best}
        for t in best:
            omega = sum(((1.0 if q == t else 0.0) - e[t] / behind[q]) / ties[q] for q in best if rank[q] <= rank[t]) * var[t] / c
            delta = sum(e[t] / behind[q] * (1 - e[t] / behind[q]) / ties[q] for q in best if rank[q] <= rank[t]) * math.sqrt(var[t]) / c * var[t] / c**2
            for r in mine:
                if r[2] == t:
                    x = s2[r[3]] / var[t]
                    state[r[3]] = (pre[r[3]][0] + x * omega, math.sqrt(s2[r[3]]) * math.sqrt(max(1 - x * delta, p.kappa)))
                    out[match, r[3]] = (rank[t], *pre[r[3]], *state[r[3]])
    return out


def test_rating_waves_equal_the_fold(spark):
    rng = random.Random(2)
    rows = []
    for m in range(14):
        for k, player in enumerate(rng.sample(range(40), 6)):
            rows.append((f"m{m:02d}", m // 2, k // 2, f"p{player}", rng.randrange(1, 5)))
    rows += [("solo", 3, 1, "p1", 1), ("solo", 3, 1, "p2", 2)]
    df = spark.createDataFrame(rows, "m string, ts long, team long, player string, place long").withColumn("ts", F.timestamp_seconds("ts"))
    history = ratings.rating_history(df, "m", "ts", "team", "player", "place")
    got, want = {(r.match_id, r.account_id): (r.team_rank, r.mu_pre, r.sigma_pre, r.mu_post, r.sigma_post) for r in history.collect()}, fold(rows)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert ratings.chain_breaks(history).count() == 0


def test_team_ranking(spark):
    rows = [("m", 10, "a", 5), ("m", 10, "b", 9), ("m", 20, "c", 1), ("m", 20, "d", 7), ("m", 30, "e", 3), ("t", 10, "a", 1), ("t", 20, "b", 1), ("t", 30, "c", 4), ("s", 10, "a", 1), ("s", 10, "b", 2)]
    df = spark.createDataFrame(rows, "m string, team int, player string, place int").withColumn("ts", F.lit(0))
    got = {(r.match_id, r.team_id): r.team_rank for r in ratings.rated_teams(df, "m", "ts", "team", "player", "place").collect()}
    assert got == {("m", 20): 1, ("m", 30): 2, ("m", 10): 3, ("t", 10): 1, ("t", 20): 1, ("t", 30): 3}


@pytest.mark.parametrize("scores,want", [([1, 2, 3, 4], 1.0), ([4, 3, 2, 1], 0.0), ([1, 1, 1, 1], 0.5)])
def test_auc(spark, scores, want):
    df = spark.createDataFrame(list(zip(map(float, scores), [0, 0, 1, 1], strict=True)), "s double, y int")
    assert ev.auc(df, "s", "y").first().auc == want
    assert ev.auc(df.filter("y = 1"), "s", "y").first().auc is None


def test_running_sums(spark):
    rng = random.Random(3)
    rows = [(k, float(v), rng.randrange(5)) for k in ("a", None) for v in {rng.randrange(3000) for _ in range(700)}]
    out = ev.running(spark.createDataFrame(rows, "k string, o double, n int"), "o", ["n"], ["k"]).collect()
    assert len(out) == len(rows)
    for r in random.Random(4).sample(out, 60):
        assert r.before_n == sum(n for k, o, n in rows if k == r.k and o < r.o)


def test_split_keeps_matches_whole(spark):
    df = spark.range(400).select((F.col("id") % 40).alias("m"), (F.col("id") % 40 % 11).alias("ts"), "id")
    head, tail = windows.ordered_cut(df, "m", ["ts"], 0.75)
    a, b = {r.m for r in head.select("m").collect()}, {r.m for r in tail.select("m").collect()}
    assert len(a) == 30 and not a & b and max(m % 11 for m in a) <= min(m % 11 for m in b)


def test_estimators_point_the_right_way(spark):
    rng = random.Random(5)
    cells = []
    for i in range(300):
        truth, n = rng.betavariate(8, 8), rng.choice([10, 400])
        cells.append((i, sum(rng.random() < truth for _ in range(n)), n, truth, "few" if n == 10 else "many"))
    df = spark.createDataFrame(cells, "i int, s int, n int, truth double, stratum string")
    rmse = {(r.k, r.stratum): r.rmse for r in ev.shrink_sweep(df, "s", "n", "truth", [0, 16], 0.5, "stratum").collect()}
    assert rmse[16, "few"] < rmse[0, "few"]
    assert 4 < ev.eb_prior_weight(df, "s", "n").first().prior_weight < 60
    lines = [(c, v + rng.gauss(0, 0.1)) for c in range(60) for v in [rng.gauss(0, 1)] for _ in range(9)]
    assert ev.design_effect(spark.createDataFrame(lines, "c int, v double"), "v", "c").first().deff > 4
    leak = ev.leakage(spark.createDataFrame([(rng.random(), y, y + rng.random()) for y in (0, 1) for _ in range(100)], "a double, y int, b double"), "a", "b", "y").first()
    assert leak.inflation > 0.2


def test_model(spark):
    rng = random.Random(6)
    rows = [(i, None if i % 9 == 0 else x, "fpp" if i % 2 else "tpp", int(x + rng.gauss(0, 0.5) > 0)) for i in range(600) for x in [rng.gauss(0, 1)]]
    df = spark.createDataFrame(rows, "i int, x double, mode string, y int")
    train, test = models.temporal_split(df, "i", "i")
    p = models.predict(models.fit_classifier(train, ["x"], "y", {"mode": ["fpp"]}, iterations=50), test, ["x"], "y", {"mode": ["fpp"]})
    base = models.base_rate(train, test, "y")
    assert ev.auc(p, "probability", "label").first().auc > 0.8 and ev.auc(base, "probability", "label").first().auc == 0.5
    assert ev.proper_scores(p, "probability", "label").first().log_loss < ev.proper_scores(base, "probability", "label").first().log_loss


def test_checks_let_nulls_pass(spark):
    df = spark.createDataFrame([(1, "a"), (None, None), (1, "z")], "k int, v string")
    assert quality.unique(df, "k").count() == 1 and quality.accepted_values(df, "v", ["a"]).count() == 1 and quality.accepted_range(df, "k", 2, 5).count() == 2
    assert quality.relationships(df, "k", spark.createDataFrame([(2,), (None,)], "p int"), "p").count() == 2 and quality.not_null(df, "k").count() == 1


def test_stream_dedup_keeps_rows_of_any_age(spark):
    from types import SimpleNamespace

    from driftwell.plans.q_streams import stream_dedup

    events = spark.range(120).selectExpr("id as event_id", "id % 2 as user_id", "'view' as event_type", "timestamp '2024-01-01' + make_interval(0, 0, 0, cast(id * 3 as int)) as ts")
    got = {r.user_id: r.n for r in stream_dedup(SimpleNamespace(spark=spark, events=events)).collect()}
    assert got == {0: 60, 1: 60}


def test_stream_pulse_reads_events_as_they_are_spread(spark, monkeypatch):
    from types import SimpleNamespace

    from driftwell.plans import q_streams

    paths, read = [], q_streams.file_stream
    monkeypatch.setattr(q_streams, "file_stream", lambda s, path, *a, **b: paths.append(path) or read(s, path, *a, **b))
    events = spark.range(0, 240, 1, 4).selectExpr("id as event_id", "id % 5 as user_id", "'view' as event_type", "timestamp '2024-01-01' + make_interval(0, 0, 0, 0, cast((id * 37) % 240 as int)) as ts")
    got = q_streams.stream_pulse(SimpleNamespace(spark=spark, events=events)).collect()
    assert sorted(r.window_s for r in got) == [1704067200 + 86400 * k for k in range(7)] and {(r.events, r.actors) for r in got} == {(24, 5)}
    assert len(spark.read.parquet(paths[0]).inputFiles()) == 4


@pytest.mark.parametrize("hot", [2, 30])
def test_asof_in_stretches_equals_asof(spark, hot):
    rng = random.Random(3)
    some = lambda n, c: spark.createDataFrame([(rng.choice([1, 2, None]), i, rng.choice([None, *range(90)])) for i in range(n)], f"k int, {c} int, s int").select("k", c, F.timestamp_seconds("s").alias(f"{c}_ts"))
    left, right = some(200, "l"), some(70, "r")
    for how in ("left", "inner"):
        a, b = (sorted(map(tuple, joins.asof_join(left, right, ["k"], "l_ts", "r_ts", how=how, tiebreak=["r"], hot_rows=x).collect()), key=str) for x in (None, hot))
        assert a == b and a


def test_window_mismatch_blocks(spark):
    df = spark.range(600).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"), F.when(F.col("id") % 7 > 0, (F.col("id") * 37 % 101).cast("double")).alias("v"))
    df = windows.prior_window(df, ["k"], ["o"], {"m": F.avg("v")})
    assert quality.window_mismatch(df, ["k"], ["o"], "v", "m", block=16).count() == 0
    wrong = df.withColumn("m", F.when(F.col("o").isin(5, 400), F.col("m") + 1).when(F.col("o") == 11, None).otherwise(F.col("m")))
    assert sorted(r.o for r in quality.window_mismatch(wrong, ["k"], ["o"], "v", "m", block=16).collect()) == [5, 11, 400]


def test_upserts_replay(spark, tmp_path):
    from driftwell.streaming import streams

    root, write = f"file://{tmp_path}/t", None
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string")
    write = streams.upsert_batch(root, ["k"])
    for number, rows in ((0, [(1, "a"), (1, "a")]), (1, [(1, "b"), (2, "c")]), (1, [(1, "b"), (2, "c")]), (2, [(3, "d")])):
        write(frame(rows), number)
    shape = frame([]).schema
    assert sorted(map(tuple, streams.read_upserted(spark, root, shape).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert streams.fold_upserted(spark, root, shape) == 0


def test_distinct_actors_survive_a_restart(spark, tmp_path):
    from driftwell.streaming import streams

    rows = spark.range(0, 600).select((F.col("id") * 17 % 13).alias("who"), (F.col("id") % 2).alias("kind"), F.timestamp_seconds((F.col("id") * 600).cast("double") + 1_704_067_200).alias("ts")).withColumn("who", F.when(F.col("who") > 0, F.col("who")))
    source, out, mark = (f"file://{tmp_path}/{x}" for x in ("in", "out", "mark"))
    for low, high in ((0, 250), (250, 420), (420, 600)):  # each run ends in the middle of a window and goes on from its checkpoint
        rows.filter(F.unix_seconds("ts").between(1_704_067_200 + low * 600, 1_704_067_200 + high * 600 - 1)).write.mode("append").parquet(source)
        stream = streams.file_stream(spark, source, rows.schema, max_files=2)
        streams.drain(streams.shred_stream(streams.pulse(stream, "ts", "1 day", "2 hours", ["kind"], actor="who"), lambda df: df, out, mark))
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    want = sorted(map(tuple, streams.pulse(rows, "ts", "1 day", "2 hours", ["kind"], actor="who").filter("unix_seconds(window_start) + 86400 <= 1704067200 + 599 * 600 - 7200").collect()))
    assert got == want and len(got) == 8 and {r[3] for r in got} == {12}
