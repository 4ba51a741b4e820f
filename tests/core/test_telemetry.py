"""Raw JSON to marts on a small hand-made match, and the quirks that builders must keep."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from driftwell.plans import gold, marts, silver, warehouse
from driftwell.sources import raw, shred, tables


def person(k, team, place, bot=False, **stats):
    account = f"ai.{k}" if bot else f"account.{k}"
    base = {"playerId": account, "name": f"p{k}", "deathType": "alive" if place == 1 else "byplayer", "winPlace": place, "killPlace": place, "kills": 1, "DBNOs": 0, "assists": 0, "damageDealt": 50.0, "walkDistance": 10.0, "rideDistance": 5.0, "swimDistance": None if k == 3 else 1.0, "timeSurvived": 600.0}
    return {"type": "participant", "id": f"part{k}", "attributes": {"stats": base | stats}}


def roster(team, ids, won):
    return {"type": "roster", "id": f"team{team}", "attributes": {"won": won, "stats": {"teamId": team, "rank": team}}, "relationships": {"participants": {"data": [{"id": f"part{k}"} for k in ids]}}}


def body(k, x, y, bot=False, vehicle=False):
    return {"accountId": f"ai.{k}" if bot else f"account.{k}", "name": f"p{k}", "teamId": 1, "health": 90.0, "ranking": 3, "location": {"x": x, "y": y, "z": 0.0}, "isInVehicle": vehicle, "isInBlueZone": False}


def manifest(mid="m1", n=12, duration=1500, created="2024-01-01T10:00:00Z"):
    people = [person(k, (k - 1) // 2 + 1, (k - 1) // 2 + 1, bot=k > n - 2) for k in range(1, n + 1)]
    teams = [roster(t, [2 * t - 1, 2 * t], "true" if t == 1 else "false") for t in range(1, n // 2 + 1)]
    return {"data": {"id": mid, "attributes": {"createdAt": created, "duration": duration, "gameMode": "squad-fpp", "matchType": "official", "mapName": "Baltic_Main", "shardId": "steam", "isCustomMatch": False}}, "included": [*people, *teams, {"type": "asset", "id": "a"}]}


def telemetry():
    t = lambda s: f"2024-01-01T10:{s // 60:02d}:{s % 60:02d}.500Z"
    zone = lambda s, r, alive: {"_T": "LogGameStatePeriodic", "_D": t(s), "gameState": {"elapsedTime": s, "numStartPlayers": 12, "numAlivePlayers": alive, "numAliveTeams": 5, "safetyZonePosition": {"x": 100000.0, "y": 100000.0, "z": 0.0}, "safetyZoneRadius": r, "poisonGasWarningRadius": 0.0}}
    kill = lambda s, a, b, **more: {"_T": "LogPlayerKillV2", "_D": t(s), "attackId": -1 if a is None else 7, "dBNOId": -1, "isSuicide": False, "victim": body(b, 110000.0, 110000.0), "killer": None if a is None else body(a, 100000.0, 100000.0), "killerDamageInfo": {"damageCauserName": "WeapAK47_C", "distance": 14142.0}, "victimWeapon": "WeapRPD_C_7", "assists_AccountId": ["account.9"] if a else [], **more}
    pos = lambda s, k, x, **more: {"_T": "LogPlayerPosition", "_D": t(s), "character": body(k, x, 100000.0, **more), "elapsedTime": float(s), "numAlivePlayers": 9}
    land = lambda s, k, x, bot=False: {"_T": "LogParachuteLanding", "_D": t(s), "character": body(k, x, 100000.0, bot), "distance": 5.0}
    return [
        {"_T": "LogMatchDefinition", "_D": t(0), "MatchId": "match.bro.official.pc-2018-28.steam.squad-fpp.eu.x.eu-west", "PingQuality": ""},
        {"_T": "LogPhaseChange", "_D": t(10), "phase": 1, "playersInWhiteCircle": []}, {"_T": "LogPhaseChange", "_D": t(300), "phase": 2, "playersInWhiteCircle": ["account.1"]},
        zone(5, 0.0, 12), zone(120, 50000.0, 10), zone(310, 30000.0, 8), land(60, 1, 90000.0), land(60, 1, 89990.0), land(61, 2, 90500.0), land(62, 12, 1.0, bot=True),
        kill(200, 1, 3), kill(330, 2, 4), kill(340, None, 5), kill(340, None, 6),
        pos(30, 1, 1000.0), pos(70, 1, 90000.0), pos(80, 1, 92000.0, vehicle=True), pos(130, 1, 400000.0), pos(140, 1, 401000.0), {"_T": "LogUnknown", "_D": t(1)},
    ]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for kind, data in (("matches", manifest()), ("telemetry", telemetry())):
        d = root / kind / "shard=steam" / "dt=2024-01-01"
        d.mkdir(parents=True)
        (d / "m1.json.gz").write_bytes(gzip.compress(json.dumps(data).encode()))
    (root / "matches" / "shard=steam" / "dt=2024-01-01" / "m2.json.gz").write_bytes(gzip.compress(json.dumps(manifest("m2")).encode()))
    twice = root / "twice"
    twice.mkdir()
    (twice / "m1.json.gz").write_bytes(gzip.compress(gzip.compress(json.dumps(telemetry()).encode())))
    return root


@pytest.fixture(scope="module")
def layers(spark, files):
    manifests, events = raw.read_manifests(spark, f"{files}/matches"), raw.read_telemetry(spark, f"{files}/telemetry").cache()
    bronze = shred.shred_all(manifests.filter("data.id = 'm1'"), events)
    s = warehouse.build_silver(bronze)
    seed = spark.createDataFrame([("WeapAK47_C", "AKM", "ar"), ("WeapRPD_C", "RPD", "lmg")], "causer_name string, weapon_name string, weapon_class string")
    return bronze, s, warehouse.build_gold(s, seed), seed


def test_scans(spark, files):
    manifests, events = raw.read_manifests(spark, f"{files}/matches"), raw.read_telemetry(spark, f"{files}/telemetry")
    assert {r.file_match_id for r in manifests.select("file_match_id").collect()} == {"m1", "m2"} and "shard" in manifests.columns
    assert [tuple(r) for r in raw.event_counts(events).collect()] == [("m1", len(telemetry()))]
    paired, missing = __import__("driftwell.operators.joins", fromlist=["x"]).pair_inputs(manifests.select(F.col("data.id").alias("match_id")), events)
    assert [r.match_id for r in paired.collect()] == ["m1"] and [tuple(r) for r in missing.collect()] == [("m2", "events")]
    assert raw.read_gz_layers(spark, f"{files}/twice").count() == len(telemetry())
    assert raw.gunzip_layers(b"plain") == b"plain" and raw.gunzip_layers(b"\x1f\x8bnot gzip") == b"\x1f\x8bnot gzip"
    listing = raw.list_files(spark, f"{files}/matches", "*.gz")
    assert raw.orphan_files(listing, listing.limit(1)).count() == 1


def test_bronze(layers):
    bronze = layers[0]
    m = bronze["match"].first()
    assert (m.player_count, m.bot_count, m.human_count, m.roster_count, m.ping_quality, m.region) == (12, 2, 10, 6, None, "eu-west")
    assert {c: bronze[c].count() for c in ("match_player", "roster", "phase", "game_state", "kill", "landing", "player_position")} == {"match_player": 12, "roster": 6, "phase": 2, "game_state": 3, "kill": 4, "landing": 4, "player_position": 5}
    assert len(bronze["kill"].columns) == 85 and bronze["roster"].filter("won").count() == 1
    assert sorted(r.role for r in bronze["kill_participant"].collect()) == ["assist"] * 2 + ["killer"] * 2 + ["victim"] * 4
    assert bronze["match_player"].filter("participant_id = 'part3'").first().team_id == 2


def test_silver(layers):
    s = layers[1]
    m = s["slv_match"].first()
    assert (m.perspective, m.team_mode, m.is_analytical) == ("fpp", "squad", True)
    assert s["slv_landing"].count() == 3 and s["slv_landing"].filter("account_id = 'account.1'").first().x_m == 899.9
    kills = {r.victim_account_id: r for r in s["slv_kill"].collect()}
    assert kills["account.3"].death_cause == "player" and kills["account.3"].is_human_vs_human and kills["account.5"].death_cause == "environment"
    assert kills["account.3"].victim_weapon == "WeapRPD_C" and kills["account.5"].attack_id is None and kills["account.5"].killer_is_bot is None
    assert s["slv_kill_participant"].count() == 8  # two deaths of one instant stay apart
    fanned = silver.build_kill_participant(layers[0]["kill_participant"], s["slv_kill"], by_victim=False)
    assert fanned.count() == 10  # and fan out where only the attack id tells deaths apart
    people = {r.account_id: r for r in s["slv_match_player"].collect()}
    assert people["account.1"].human_placement_pct == 0.0 and people["account.10"].human_placement_pct == 1.0 and people["ai.11"].human_placement is None
    assert people["account.3"].total_distance is None and people["account.1"].survived_to_end
    assert [r.phase_duration_s for r in s["slv_phase"].orderBy("phase").collect()] == [290, None]


def test_gold_and_marts(layers):
    _, s, g, seed = layers
    kills = {r.victim_account_id: r for r in g["fact_kill"].collect()}
    assert (kills["account.3"].zone_phase, kills["account.3"].num_alive_players, kills["account.4"].zone_phase, kills["account.4"].num_alive_players) == (1, 10, 2, 8)
    assert kills["account.3"].range_bucket == "100-200m" and kills["account.5"].weapon_sk is not None and kills["account.3"].seconds_into_match == 200
    phase = {r.phase: r for r in g["fact_match_phase"].collect()}
    assert (phase[1].deaths, phase[1].num_alive_players, phase[2].deaths, phase[2].environment_deaths) == (1, 12, 3, 2)
    people = {r.account_id: r for r in g["fact_player_match"].collect()}
    assert people["account.1"].human_kills == 1 and people["account.1"].human_kills_long_range == 1 and people["account.3"].human_kills == 0 and people["account.1"].landing_grid_cell == "1_2"
    m = warehouse.build_marts(s, g, seed)
    duel = m["mart_engagement_matrix"].first()
    assert (duel.class_a, duel.class_b, duel.a_beats_b, duel.b_beats_a) == ("ar", "lmg", 2, 0) and duel.shrunk_win_rate == round(7 / 12, 4)
    move = m["mart_player_rotation"].filter("account_id = 'account.1'").first()
    assert (move.ticks, move.implausible_steps, move.distance_travelled_m) == (4, 1, 30.0) and move.share_outside_zone == 0.5
    assert m["mart_weapon_performance"].first().kills == 2 and m["mart_drop_zone"].agg(F.sum("drops")).first()[0] == 2
    luck = m["mart_zone_luck"].collect()
    assert sum(r.player_matches for r in luck) == 2
    assert g["dim_map"].first().map_display_name == "Erangel" and g["dim_weapon"].first().is_firearm
    assert g["dim_player"].filter("account_id = 'account.1'").first().wins == 1
    assert marts.build_heatmap(s["slv_player_position"]).agg(F.sum("n")).first()[0] == 5


def test_luck_filter_comes_after_the_join(layers):
    _, s, g, _ = layers
    gone = s["slv_game_state"].withColumn("safety_zone_radius_m", F.when(F.col("elapsed_time_s") == 120, 0.0).otherwise(F.col("safety_zone_radius_m")))
    assert marts.build_zone_luck(g["fact_player_match"], g["fact_match_phase"], gone).count() == 0


def test_ratings_and_features(layers):
    _, s, g, _ = layers
    r = warehouse.build_ratings(g)
    rows = r["fact_rating_update"].collect()
    assert len(rows) == 10 and all(x.sigma_post < x.sigma_pre for x in rows)
    best = max(rows, key=lambda x: x.mu_post)
    assert best.account_id in ("account.1", "account.2") and best.games_played_before == 0
    feats = r["feat_player_match"].collect()
    assert len(feats) == 10 and all(f.prior_matches == 0 and not f.has_form_history for f in feats)
    assert gold.build_dim_player_rating(r["fact_rating_update"], g["dim_player"]).count() == 10


def test_tables(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert tables.snapshot_write(df, root) == 0
    assert tables.snapshot_write(tables.delete_where(df, F.col("v") == "a"), root) == 1
    assert tables.read_version(spark, root, 0).count() == 2 and tables.read_version(spark, root).count() == 1
    assert tables.upsert_new(spark, root, spark.createDataFrame([(2, "z"), (3, "c"), (3, "c")], "k int, v string"), ["k"]) == 2
    assert sorted(map(tuple, tables.read_version(spark, root).collect())) == [(2, None), (3, "c")]
    version, before, after = tables.compact(spark, root)
    assert after == 1 and before >= after and version == (2 if before == 1 else 3)
    seed = tmp_path / "seed.csv"
    seed.write_text("causer_name,weapon_name,weapon_class\nA,B,C\n")
    assert tuple(tables.read_seed(spark, str(seed)).first()) == ("A", "B", "C")
    assert tables.materialize(df, "v1", "view").count() == 2
