"""Raw files end to end: the given tables are written as files of nested JSON, one a match, below shard= and dt=; some are
damaged, some compressed once or twice; then they are listed, read and counted."""

from __future__ import annotations

import gzip

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import ledger, raw, shred, tables
from ..sources.staging import fresh_path
from .catalog import query
from .q_raw import event_text

#: Users share a match by fives; one match in seven has a damaged file.
FOLDERS = {"shard": "concat('s', m % 2)", "dt": "concat('2024-01-0', m % 3 + 1)"}
FOLDERS_SQL = "'s' || (m % 2) as shard, '2024-01-0' || (m % 3 + 1) as dt"
TYPES_SQL = "case event_type when 'signup' then 'LogPhaseChange' when 'view' then 'LogGameStatePeriodic' when 'click' then 'LogPlayerPosition' when 'error' then 'LogParachuteLanding' else 'LogPlayerKillV2' end"


def match_texts(t) -> DataFrame:
    """m, name, body of each match: the JSON array of its events. A match is a file, and so a task's unit."""
    rows = t.events.select(F.expr("user_id div 5").alias("m"), event_text().alias("event"))
    rows = rows.groupBy("m").agg(F.concat(F.lit("["), F.array_join(F.collect_list("event"), ","), F.lit("]")).alias("body"))
    return rows.withColumn("name", F.concat(F.lit("m"), "m")).withColumns({n: F.expr(e) for n, e in FOLDERS.items()})


def event_files(t) -> str:
    """The matches as compressed files, each seventh cut off in the middle."""
    root = fresh_path(t.spark, "telemetry")
    whole = F.col("m") % 7 != 3
    body = F.when(whole, F.col("body")).otherwise(F.expr("left(body, cast(length(body) / 2 as int))"))
    raw.write_files(match_texts(t).withColumn("body", body), root, by=list(FOLDERS), suffix=".json.gz", compression="gzip")
    return root


@query("scan_events", f"""
select {FOLDERS_SQL}, 'm' || m as match_id, {TYPES_SQL} as kind, count(*) as n, count(distinct event_id) as ids from (select *, user_id // 5 as m from events) where m % 7 <> 3 group by m, event_type""")
def scan_events(t):
    """Events read back from files, with the folders' columns; damaged files give no events and stop nothing."""
    events = raw.read_telemetry(t.spark, event_files(t)).filter(F.col(raw.CORRUPT).isNull())
    return events.groupBy("shard", F.col("dt").cast("string").alias("dt"), "match_id", F.col("_T").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_D").alias("ids"))


@query("events_per_file", "select 'm' || (user_id // 5) as match_id, case when user_id // 5 % 7 = 3 then -1 else count(*) end as n_events from events group by user_id // 5")
def events_per_file(t):
    """Events of each file, -1 where it can't be parsed."""
    return raw.event_counts(raw.read_telemetry(t.spark, event_files(t)))


@query("scan_manifests", """
with o as (select *, year(o_orderdate) * 100 + month(o_orderdate) as m from orders)
select 'm' || m as file_match_id, 's' || (m % 2) as shard, '2024-01-0' || (m % 3 + 1) as dt, m % 7 = 3 as damaged, case when m % 7 <> 3 then count(*) end as players,
case when m % 7 <> 3 then round(sum(o_totalprice), 2) end as damage from o group by m""")
def scan_manifests(t):
    """Manifests read back from files: a month's orders are its participants. A damaged one keeps its text instead."""
    root = fresh_path(t.spark, "manifests")
    person = F.to_json(F.expr("struct('participant' as type, concat('p', o_orderkey) as id, struct(struct(concat('account.', o_custkey) as playerId, o_totalprice as damageDealt) as stats) as attributes)"))
    rows = t.orders.select(F.expr("year(o_orderdate) * 100 + month(o_orderdate)").alias("m"), person.alias("person")).groupBy("m").agg(F.array_join(F.collect_list("person"), ",").alias("people"))
    text = F.concat(F.lit('{"data":{"id":"m'), "m", F.lit('"},"included":['), "people", F.when(F.col("m") % 7 != 3, F.lit("]}")).otherwise(F.lit("")))
    rows = rows.select("m", F.concat(F.lit("m"), "m").alias("name"), text.alias("body")).withColumns({n: F.expr(e) for n, e in FOLDERS.items()})
    raw.write_files(rows, root, by=list(FOLDERS))
    damage = F.aggregate("included", F.lit(0.0), lambda acc, x: acc + x["attributes"]["stats"]["damageDealt"])
    return raw.read_manifests(t.spark, root).select("file_match_id", "shard", F.col("dt").cast("string").alias("dt"), F.col(raw.CORRUPT).isNotNull().alias("damaged"), F.when(F.col("included").isNotNull(), F.size("included")).alias("players"), F.round(damage, 2).alias("damage"))


def zipped(rows: DataFrame) -> DataFrame:
    """rows with body gzipped, as bytes."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            bodies = [gzip.compress(x.encode(), mtime=0) for x in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("m"), batch.column("name"), pa.array(bodies, pa.binary())], names=["m", "name", "body"])

    return rows.select("m", "name", "body").mapInArrow(run, "m bigint, name string, body binary")


@query("gunzip_layers", f"select 'm' || (user_id // 5) as match_id, {TYPES_SQL} as kind, count(*) as n, count(distinct event_id) as ids from events group by user_id // 5, event_type")
def gunzip_layers(t):
    """Files that were compressed not at all, once or twice, told apart by their first bytes."""
    root, rows = fresh_path(t.spark, "layers"), match_texts(t)
    raw.write_files(rows.filter("m % 3 = 0"), root)
    raw.write_files(rows.filter("m % 3 = 1"), root, suffix=".json.gz", compression="gzip")
    raw.write_files(zipped(rows.filter("m % 3 = 2")), root, suffix=".json.gz", compression="gzip")
    events = raw.read_gz_layers(t.spark, root, "*.json*")
    return events.groupBy("match_id", F.col("_T").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_D").alias("ids"))


@query("ledger_ingest", """
with m as (select user_id // 5 as m, event_type from events), o as (select 'deaths' as output, 'purchase' as kind union all select 'positions', 'click')
select output, 'm' || m as match_id, count(*) filter (where event_type = kind) as n, count(*) as n_events, 1 as times, m % 3 = 0 as adopted from m, o where m % 7 <> 3 group by output, kind, m""")
def ledger_ingest(t):
    """Two runs over files that keep arriving take in each once; positions have a ledger of their own, and damaged files wait."""
    root, texts = fresh_path(t.spark, "inbox"), match_texts(t)
    body = F.when(F.col("m") % 7 != 3, F.col("body")).otherwise(F.lit("["))
    known, out = texts.filter("m % 3 > 0").select(F.col("name").alias("match_id")), None
    outputs = {"deaths": (shred.shred_kill, fresh_path(t.spark, "deaths")), "positions": (shred.shred_player_position, fresh_path(t.spark, "positions"))}
    for half in (0, 1):
        raw.write_files(texts.filter(f"m % 2 = {half}").withColumn("body", body), root, by=list(FOLDERS), suffix=".json.gz", compression="gzip")
        for name, (make, path) in outputs.items():
            if name == "deaths" or half == 1:  # positions only begin when all is there
                ledger.ingest(t.spark, root, path, make, known, matches=64)
    for name, (make, path) in outputs.items():
        rows = ledger.ingested(t.spark, path, make(raw.read_telemetry(t.spark, root)).schema).groupBy("match_id").agg(F.count(F.lit(1)).alias("n"))
        taken = ledger.ledger(t.spark, path).groupBy("match_id").agg(F.max("n_events").alias("n_events"), F.count(F.lit(1)).cast("int").alias("times"), F.bool_or("adopted").alias("adopted"))
        one = taken.join(rows, "match_id", "left").select(F.lit(name).alias("output"), "match_id", F.coalesce("n", F.lit(0)).alias("n"), "n_events", "times", "adopted")
        out = one if out is None else out.unionByName(one)
    return out


@query("prediction_sink", """
select cast(o_orderkey as varchar) as feature_sk, o_custkey as match_id, o_clerk_ as account_id, round(o_totalprice / 1e6, 6) as predicted_top_half_prob, case when o_orderstatus = 'F' then 1 else 0 end as actual_top_half,
case when o_orderkey % 2 = 0 then 'v1' else 'v2' end as model_version, cast(o_orderkey % 2 as int) as part from (select *, 'c' || (o_custkey % 100) as o_clerk_ from orders)""")
def prediction_sink(t):
    """Predictions of two models, each written as a part that appears as a whole, read back."""
    path = fresh_path(t.spark, "predictions")
    rows = t.orders.select(F.col("o_orderkey").cast("string").alias("feature_sk"), F.col("o_custkey").alias("match_id"), F.expr("concat('c', o_custkey % 100)").alias("account_id"), F.col("o_orderdate").alias("match_start_ts"), F.round(F.col("o_totalprice") / 1e6, 6).alias("probability"), (F.col("o_orderstatus") == "F").alias("label"))
    for k, version in enumerate(("v1", "v2")):
        tables.write_predictions(rows.filter(F.col("feature_sk").cast("long") % 2 == k), path, version)
    return tables.read_predictions(t.spark, path).drop("match_start_ts")
