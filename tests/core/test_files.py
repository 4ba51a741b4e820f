"""Raw files, ledgers, versions and compaction: what is there afterwards, and what isn't after a run that died."""

import gzip
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from driftwell.operators import aggregates, joins, models, ratings
from driftwell.plans import catalog
from driftwell.sources import ledger, raw, shred, tables
from driftwell.sources.schemas import MANIFEST, pruned

COMPACT = """
import sys
from pyspark.sql import SparkSession, functions as F
from driftwell.sources import tables
spark = (SparkSession.builder.master(f"local[{sys.argv[2]}]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").config("spark.checkpoint.dir", sys.argv[1] + "/cp").getOrCreate())
root = sys.argv[1] + "/t"
df = spark.range(0, 40_000, 1, 4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
large, small = df.filter("id < 20000").coalesce(1), df.filter("id >= 20000").repartitionByRange(16, "id")
tables.snapshot_write(large.unionByName(small), root)
sizes = tables.file_sizes(tables.read_version(spark, root)).collect()
version, before, after = tables.compact(spark, root, target_bytes=300_000)
new = tables.read_version(spark, root, version)
paths = {r.path for r in tables.file_sizes(new).collect()}
print("RESULT", before, after, len(paths), new.count(), new.distinct().count(), max(sizes, key=lambda r: r.bytes).path in paths, tables.compact(spark, root, target_bytes=300_000)[1:], sep="|")
"""


@pytest.mark.parametrize("cores", [1, 4, 8])
def test_compaction_at_any_core_count(tmp_path, cores):
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))}
    done = subprocess.run([sys.executable, "-c", COMPACT, f"file://{tmp_path}", str(cores)], capture_output=True, text=True, env=env, timeout=240)
    before, after, files, rows, distinct, kept, again = next(x for x in done.stdout.split("\n") if x.startswith("RESULT")).split("|")[1:]
    assert (int(before), int(rows), int(distinct), kept) == (17, 40_000, 40_000, "True") and files == after
    assert 4 <= int(after) <= 7, after  # the large file, and 16 small ones of some 85 KB
    a, b = eval(again)
    assert b <= a == int(after)  # what has been put together isn't split again


def test_compaction_leaves_what_it_cannot_help(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    tables.snapshot_write(spark.range(10).coalesce(1), root)
    assert tables.compact(spark, root) == (0, 1, 1)
    assert tables.versions(spark, root) == [0]


def test_a_write_that_dies_leaves_nothing(spark, tmp_path):
    root, bad = f"file://{tmp_path}/t", F.when(F.col("id") == 7, F.raise_error(F.lit("died"))).otherwise(F.col("id"))
    tables.snapshot_write(spark.range(3), root)
    with pytest.raises(Exception, match="died"):
        tables.snapshot_write(spark.range(0, 10, 1, 4).withColumn("id", bad), root)
    assert tables.versions(spark, root) == [0] and tables.read_version(spark, root).count() == 3
    rows = spark.range(0, 10, 1, 4).select(F.col("id").alias("feature_sk"), F.lit("m").alias("match_id"), F.lit("a").alias("account_id"), F.lit(0).alias("match_start_ts"), bad.cast("double").alias("probability"), F.lit(True).alias("label"))
    path = f"file://{tmp_path}/p"
    tables.write_predictions(rows.filter("feature_sk < 7"), path, "v1")
    with pytest.raises(Exception, match="died"):
        tables.write_predictions(rows, path, "v2")
    got = tables.read_predictions(spark, path).collect()
    assert sorted(r.feature_sk for r in got) == list(range(7)) and {(r.model_version, r.part) for r in got} == {("v1", 0)}


def events(n, kind="LogPlayerKillV2"):
    return [{"_T": kind, "_D": f"t{i}", "attackId": i, "victim": {"accountId": "account.1"}} for i in range(n)]


def put(folder, name, data, layers=1):
    folder.mkdir(parents=True, exist_ok=True)
    body = data if isinstance(data, bytes) else json.dumps(data).encode()
    for _ in range(layers):
        body = gzip.compress(body)
    (folder / f"{name}.json{'.gz' if layers else ''}").write_bytes(body)


def test_ledger_takes_each_file_once(spark, tmp_path):
    box, out = tmp_path / "in" / "shard=s" / "dt=2024-01-01", f"file://{tmp_path}/out"
    for k in range(5):
        put(box, f"m{k}", events(k + 1))
    put(box, "m9", b'[{"_T": "LogPl')
    run = lambda **more: ledger.ingest(spark, f"file://{tmp_path}/in", out, shred.shred_kill, spark.createDataFrame([("m0",)], "match_id string"), matches=2, **more)
    assert run(limit=3) in (2, 3)  # the damaged file may be among the oldest
    put(box, "m7", events(7))
    run()
    assert run() == 0  # the damaged file stays pending and is tried again
    seen = {r.match_id: (r.n_events, r.adopted) for r in ledger.ledger(spark, out).collect()}
    assert seen == {f"m{k}": (k + 1, k > 0) for k in range(5)} | {"m7": (7, True)} and ledger.ledger(spark, out).count() == 6
    assert ledger.ingested(spark, out, spark.read.parquet(f"{out}/part=0/rows").schema).count() == 15 + 7
    assert [r.match_id for r in ledger.pending(spark, f"file://{tmp_path}/in", out).collect()] == ["m9"]
    assert ledger.ledger(spark, out).groupBy("part").count().agg(F.max("count")).first()[0] <= 2


def test_ledger_part_that_dies(spark, tmp_path):
    put(tmp_path / "in", "m1", events(3))
    died = lambda df: shred.shred_kill(df).withColumn("attack_id", F.raise_error(F.lit("died")))
    root, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    with pytest.raises(Exception, match="died"):
        ledger.ingest(spark, root, out, died)
    assert ledger.ledger(spark, out).count() == 0
    assert ledger.ingest(spark, root, out, shred.shred_kill) == 1 and ledger.ingest(spark, root, out, shred.shred_kill) == 0


def test_layers_and_damage(spark, tmp_path):
    for k in range(4):
        put(tmp_path / "in", f"m{k}", events(k + 2), layers=k)
    got = raw.read_gz_layers(spark, f"file://{tmp_path}/in", "*.json*").groupBy("match_id").count().collect()
    assert {r.match_id: r["count"] for r in got} == {f"m{k}": k + 2 for k in range(4)}
    put(tmp_path / "one", "a", events(2))
    put(tmp_path / "one", "b", b"[{")
    assert {tuple(r) for r in raw.event_counts(raw.read_telemetry(spark, f"file://{tmp_path}/one")).collect()} == {("a", 2), ("b", -1)}


def test_last_roster_wins(spark):
    person = lambda i: {"type": "participant", "id": i, "attributes": {"stats": {"playerId": f"account.{i}"}}}
    roster = lambda team, ids: {"type": "roster", "id": str(team), "attributes": {"stats": {"teamId": team}}, "relationships": {"participants": {"data": ids if ids is None else [{"id": i} for i in ids]}}}
    manifest = {"data": {"id": "m"}, "included": [person("a"), person("b"), person("a"), person("c"), roster(5, ["a", "b", None]), roster(2, ["a", "a"]), roster(3, None), roster(None, ["b"])]}
    df = spark.createDataFrame([(json.dumps(manifest),), ('{"data": {"id": "none"}}',)], "t string").select(F.from_json("t", MANIFEST).alias("m")).select("m.*")
    got = shred.shred_match_player(df).select("match_id", "participant_id", "team_id").collect()
    assert sorted(map(tuple, got), key=str) == [("m", "a", 2), ("m", "a", 2), ("m", "b", None), ("m", "c", None)]
    assert "Join" not in shred.shred_match_player(df)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("values", ["cast(id as double)", "cast(7 as double)", "cast(id % 3 as double)", "pow(2e0, id % 900)", "if(id % 5 = 0, null, -1e0 / (1 + id % 4001))"])
def test_quantiles_of_a_hot_group(spark, values):
    df = spark.range(0, 20_000, 1, 6).selectExpr("if(id % 10 < 8, null, id % 3) as k", f"{values} as v")
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.k: (r.n, r.q) for r in aggregates.exact_quantiles(df, ["k"], "v", ps, hot_rows=700).collect()}
    want = {r.k: (r.n, r.q) for r in df.groupBy("k").agg(F.count("v").alias("n"), F.percentile("v", ps).alias("q")).collect()}
    assert got == want and len(got) == 4
    assert aggregates.exact_quantiles(df.filter("false"), ["k"], "v", ps).count() == 0


def test_asof_with_one_key_of_most_rows(spark):
    left = spark.range(0, 30_000, 1, 5).select(F.when(F.col("id") % 50 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("l"), F.timestamp_seconds((F.col("id") * 7919 % 10_007).cast("double")).alias("t"))
    right = spark.range(0, 300, 1, 3).select(F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("r"), F.timestamp_seconds((F.col("id") * 101 % 9001).cast("double")).alias("u"))
    a, b = (sorted(map(tuple, joins.asof_join(left, right, ["k"], "t", "u", tiebreak=["r"], hot_rows=n).select("l", "r").collect()), key=str) for n in (None, 2_000))
    assert a == b and len(a) == 30_000
    both = spark.createDataFrame([(1, 0, "2024-01-01")] * 4_000, "k int, l int, s string").withColumn("t", F.col("s").cast("timestamp"))
    one = both.limit(1).select("k", F.lit(3).alias("r"), F.col("t").alias("u"))
    assert {tuple(r) for r in joins.asof_join(both, one, ["k"], "t", "u", hot_rows=100).select("r").collect()} == {(3,)}  # all at one time


def test_levels_of_matches(spark):
    rows = [("a", 1, 1), ("a", 2, 1), ("b", 2, 2), ("b", 3, 1), ("c", 3, 2), ("c", 4, 1), ("d", 4, 2), ("d", 1, 2), ("e", 9, 1)]
    df = spark.createDataFrame(rows, "match_id string, account_id int, seq int")
    assert {r.match_id: r.level for r in ratings.match_levels(df).collect()} == {"a": 1, "b": 2, "c": 3, "d": 4, "e": 1}
    assert ratings.match_levels(df.filter("false")).count() == 0


def test_a_round_reads_its_own_level(spark, monkeypatch):
    read, real = [], ratings.update_round

    def spy(ready, p):
        read.append([f.rpartition("/")[0].rpartition("/")[2] for f in ready.inputFiles()])
        return real(ready, p)

    monkeypatch.setattr(ratings, "update_round", spy)
    df = spark.createDataFrame([(m, m, team, player, place) for m in range(6) for team, player, place in (("x", m % 3, 1), ("y", (m + 1) % 3, 2))], "m int, ts int, team string, player int, place int")
    assert ratings.rating_history(df, "m", "ts", "team", "player", "place").count() == 12
    assert [set(x) for x in read] == [{f"level={k}"} if k == 1 else {f"level={k}", f"next_level={k}"} for k in range(1, 7)]


def test_gradient_is_zero_only_at_the_best_weights(spark):
    df = spark.range(400).select((F.col("id") % 17).cast("double").alias("x"), F.when(F.col("id") % 5 > 0, (F.col("id") * 31 % 23).cast("double")).alias("z"), ((F.col("id") * 13 % 29) > F.col("id") % 17).alias("y"))
    best, early = (models.fit_classifier(df, ["x", "z"], "y", iterations=n) for n in (500, 1))
    assert models.largest_gradient(best, df, ["x", "z"], "y").first().largest < 1e-6 < 1e-4 < models.largest_gradient(early, df, ["x", "z"], "y").first().largest


def test_jobs_do_not_grow_with_parts(spark, tmp_path):
    for k in range(7):
        put(tmp_path / "in", f"m{k}", events(k + 1) if k != 3 else events(2, "LogPhaseChange"))
    put(tmp_path / "in" / "again", "m0", events(9))
    put(tmp_path / "in", "m8", b"[{")
    out, reads = f"file://{tmp_path}/out", []

    def read(spark, paths):
        reads.append(len(paths))
        return raw.read_telemetry(spark, paths)

    assert ledger.ingest(spark, f"file://{tmp_path}/in", out, shred.shred_kill, matches=2, read=read) == 8
    assert reads == [8, 1]  # all parts at once; a match's second file comes after its first
    files = ledger.ledger(spark, out).collect()
    assert sorted((r.match_id, r.n_events) for r in files) in ([("m0", 1), ("m0", 9), *((f"m{k}", k + 1 if k != 3 else 2) for k in range(1, 7))],)
    assert max(sum(r.part == n for r in files) for n in {r.part for r in files}) <= 2
    by_part = {(r.match_id, r.part): r.n_events for r in files if r.match_id != "m3"}
    for part in tables.versions(spark, out, "part"):
        rows = spark.read.schema("match_id string").parquet(f"{out}/part={part}/rows").groupBy("match_id").count().collect()
        assert {(r.match_id, part): r["count"] for r in rows} == {k: n for k, n in by_part.items() if k[1] == part}
    assert ledger.ingest(spark, f"file://{tmp_path}/in", out, shred.shred_kill, matches=2) == 0


def test_driver_names_no_files(spark, tmp_path, monkeypatch):
    client, sent = spark.sparkContext._gateway._gateway_client, []
    real = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *a, **k: sent.append(1) or real(*a, **k))

    def written(n):
        rows = spark.range(0, n, 1, 2).select(F.when(F.col("id") > 0, F.concat(F.lit("a:"), F.col("id") % 2)).alias("p"), F.concat(F.lit("m"), "id").alias("name"), F.when(F.col("id") != 1, F.concat(F.lit("é"), "id")).alias("body"))
        sent.clear()
        raw.write_files(rows, f"file://{tmp_path}/w{n}", by=["p"], suffix=".json.gz", compression="gzip")
        return len(sent), {str(f.relative_to(tmp_path / f"w{n}")): gzip.decompress(f.read_bytes()).decode() for f in (tmp_path / f"w{n}").rglob("*") if f.is_file()}

    (few, _), (many, files) = written(3), written(40)
    assert many < few + 20
    assert files == {f"p={'a%3A' + str(k % 2) if k else '__HIVE_DEFAULT_PARTITION__'}/m{k}.json.gz": (f"é{k}" if k != 1 else "") + "\n" for k in range(40)}
    with pytest.raises(Exception, match="FileExistsError"):
        raw.write_files(spark.createDataFrame([("m1", "x"), ("m1", "y")], "name string, body string"), f"file://{tmp_path}/twice")


def test_files_of_stores_that_arrow_does_not_know(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw, "_arrow_store", lambda uri: False)
    raw.write_files(spark.createDataFrame([("m1", "x"), ("m2", "y")], "name string, body string"), f"file://{tmp_path}/w")
    assert {f.name: f.read_text() for f in (tmp_path / "w").iterdir() if not f.name.startswith(".")} == {"m1.json": "x\n", "m2.json": "y\n"}


def test_hot_values_are_not_repeated_for_each_rank(spark, monkeypatch):
    df, placed, ps = spark.range(0, 60_000, 1, 4).select((F.col("id") % 2).alias("k"), (F.col("id") * 7919 % 60_013).cast("double").alias("v")), [], [0.1, 0.5, 0.99]
    real = aggregates.stage
    monkeypatch.setattr(aggregates, "stage", lambda d: (lambda out: placed.append(out.count() if out.columns == ["g", "v", "j"] else 0) or out)(real(d)))
    want = {r.k: r.q for r in df.groupBy("k").agg(F.percentile("v", ps).alias("q")).collect()}
    got = {r.k: r.q for r in aggregates.exact_quantiles(df, ["k"], "v", ps, hot_rows=1_000).collect()}
    assert got == want and 0 < max(placed) <= 60_000 * len(ps) * 6 // 10_000
    monkeypatch.setattr(aggregates, "MARGIN", -0.01)  # ranks lie outside: all values are cut
    assert {r.k: r.q for r in aggregates.exact_quantiles(df, ["k"], "v", ps, hot_rows=1_000).collect()} == want


def test_tasks_stay_bounded(spark, monkeypatch):
    from driftwell.operators import windows

    monkeypatch.setattr(windows, "TASK_ROWS", 100)
    df = spark.range(0, 3_000, 1, 3).select(F.floor(F.col("id") / 3).alias("k"), F.col("id").alias("o"))
    out = windows.spread(df, 3_000, "k").withColumn("n", F.count(F.lit(1)).over(windows.over(["k"]))).groupBy("k", "o").agg(F.max("n").alias("n"))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 20 and max(sizes) < 250 and out.filter("n = 3").count() == 3_000
    places = windows.numbered(df.select("o"), ["o"], "place")
    assert places.filter("place = o").count() == 3_000


def test_manifests_shuffle_lines_before_they_are_text(spark):
    from driftwell.plans import catalog, q_raw

    lines = spark.createDataFrame([(1, 2, 3, 1, 1.0, 2.0, 0.0, "R")], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string")

    class T:
        lineitem, orders = lines, spark.createDataFrame([(1, 9.0, "F", "1-URGENT")], "o_orderkey long, o_totalprice double, o_orderstatus string, o_orderpriority string")

    assert catalog.QUERIES and catalog.q_raw.manifests(T).select(F.size("included").alias("n")).first().n == 2
    plan = catalog.q_raw.manifests(T)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1 and "hashpartitioning(l_orderkey#" in plan and "l_returnflag" not in "".join(x for x in plan.split("\n") if "Exchange" in x)


def test_manifests_are_put_together_once_and_parsed_as_needed(spark, tmp_path):
    line = lambda o, n, supp, flag: (o, flag, n, 7 * n, supp, 3.0, 1.5, 0.01 * n)
    lines = [line(1, n, n, "RAN"[n % 3]) for n in range(1, 13)] + [line(2, 1, 5, "A"), line(2, 2, 10, None)] + [line(4, 1, None, "N"), line(9, 1, 1, "N")]
    spark.createDataFrame(lines, "l_orderkey long, l_returnflag string, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_tax double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, 9.5, 'O"', "1-URGENT") for k in (1, 2, 3, 4)], "o_orderkey long, o_totalprice double, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    t = catalog.Tables(spark, str(tmp_path))
    whole = catalog.q_raw.manifests(t)
    assert {r.data.id: [x.id for x in r.included if x.type == "participant"][:4] for r in whole.collect()}["m1"] == ["p1_1_7_1", "p1_4_28_4", "p1_7_49_7", "p1_10_70_10"]  # by flag, then number
    humans = {tuple(r) for r in catalog.q_raw.shred_humans(t).collect()}
    assert humans == {("m1", 2, 1)}
    for some, all_ in ((catalog.q_raw.shred_matches(t), shred.shred_match(whole)), (catalog.q_raw.shred_rosters(t), shred.shred_roster(whole))):
        assert sorted(map(str, some.collect())) == sorted(map(str, all_.select(*some.columns).collect()))
    assert {r.match_id: (r.player_count, r.roster_count) for r in catalog.q_raw.shred_matches(t).collect()} == {"m1": (12, 3), "m2": (2, 2), "m3": (0, 0), "m4": (1, 1)}
    plan = catalog.q_raw.shred_humans(t)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ObjectHashAggregate(") == 2 and "BroadcastExchange" not in plan  # one grouping, in two steps, and no text is broadcast
    assert pruned(MANIFEST, "data.id", "included.attributes.stats.rank").simpleString() == "struct<data:struct<id:string>,included:array<struct<attributes:struct<stats:struct<rank:bigint>>>>>"
    with pytest.raises(ValueError, match="ranks"):
        pruned(MANIFEST, "included.attributes.stats.ranks")
