"""Streams over the given events, snapshots and compaction. All write to fresh folders of the shared storage."""

from __future__ import annotations

import contextlib

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ..sources.staging import fresh_path
from ..sources.tables import compact, delete_where, file_sizes, read_version, snapshot_write, upsert_new
from ..streaming.streams import dedup_stream, drain, file_stream, pulse, read_upserted, shred_stream, upsert_batch
from .catalog import query


def event_stream(t, parts: int = 3):
    """The events as a file source: written in parts, read as they come."""
    path = fresh_path(t.spark, "events")
    t.events.repartition(parts, "event_id").write.parquet(path)
    return file_stream(t.spark, path, t.events.schema, max_files=1).withColumn("ts", F.col("ts").cast("timestamp"))


def props(df):
    return df.filter("event_type = 'view'").select("event_id", "user_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("stream_shred", "select event_id, user_id, cast(json_extract_string(props, '$.k') as bigint) as k from events where event_type = 'view'")
def stream_shred(t):
    """Incremental shredding: two calls with one checkpoint give each row once."""
    source, out, mark = event_stream(t), fresh_path(t.spark, "shred"), fresh_path(t.spark, "mark")
    for _ in range(2):
        drain(shred_stream(source, props, out, mark))
    return t.spark.read.parquet(out)


@query("stream_dedup", "select user_id, event_type, count(*) as n from (select distinct user_id, event_type, date_trunc('hour', ts) as h from events) group by 1, 2")
def stream_dedup(t):
    """The first event of a user, type and hour, wherever it arrives."""
    out, mark = fresh_path(t.spark, "dedup"), fresh_path(t.spark, "mark")
    ts = F.col("ts").cast("timestamp")
    span = t.events.agg(F.unix_seconds(F.max(ts)) - F.unix_seconds(F.min(ts))).first()[0] or 0
    delay = f"{span + 3600} seconds"  # files come in no order of time: no row may be late
    rows = dedup_stream(event_stream(t).withColumn("h", F.date_trunc("hour", "ts")), ["user_id", "event_type", "h"], "ts", delay)
    drain(shred_stream(rows, lambda df: df.select("user_id", "event_type", "h"), out, mark))
    return t.spark.read.parquet(out).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("stream_pulse", "select epoch_us(date_trunc('day', ts)) // 1000000 as window_s, event_type, count(*) as events, count(distinct user_id) as actors from events where ts < (select max(ts) - interval 2 day from events) group by 1, 2 having epoch_us(date_trunc('day', min(ts))) // 1000000 + 86400 <= (select epoch_us(max(ts) - interval 2 day) // 1000000 from events)")
def stream_pulse(t):
    """Tumbling windows that the watermark has closed, with their events and distinct users."""
    name = "pulse_" + fresh_path(t.spark).rpartition("-")[2]
    out, mark = fresh_path(t.spark, name), fresh_path(t.spark, "mark")
    path = fresh_path(t.spark, "events")
    t.events.write.parquet(path)  # all files come in one batch, and the watermark moves only after it
    source = file_stream(t.spark, path, t.events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
    drain(shred_stream(pulse(source, "ts", "1 day", "2 days", ["event_type"], actor="user_id"), lambda df: df, out, mark))
    return t.spark.read.parquet(out).select(F.unix_seconds("window_start").alias("window_s"), "event_type", "events", "actors")


@query("stream_upsert", "select min(event_id) is not null as there, user_id, event_type from events group by user_id, event_type")
def stream_upsert(t):
    """Micro-batches inserted where their key is new."""
    root, mark = fresh_path(t.spark, "upsert"), fresh_path(t.spark, "mark")
    rows = event_stream(t).select("user_id", "event_type", F.lit(True).alias("there"))
    drain(rows.writeStream.foreachBatch(upsert_batch(root, ["user_id", "event_type"])).option("checkpointLocation", mark).trigger(availableNow=True).start())
    return read_upserted(t.spark, root, rows.schema)


@query("stream_restart", """
select 'view' as stream, user_id, count(*) as n, sum(event_id)::bigint as ids from events where event_type = 'view' group by user_id
union all select 'purchase', user_id, count(*), sum(event_id)::bigint from events where event_type = 'purchase' group by user_id""")
def stream_restart(t):
    """Two streams over one source, each with its own checkpoint: one is stopped after a batch and goes on by itself."""
    source, out = event_stream(t), None
    for name, stops in (("view", False), ("purchase", True)):
        root, mark = fresh_path(t.spark, name), fresh_path(t.spark, "mark")
        rows = source.filter(F.col("event_type") == name).select(F.lit(name).alias("stream"), "user_id", "event_id")
        write = upsert_batch(root, ["event_id"])

        def once(batch, number, write=write):
            if number > 0:
                raise InterruptedError("stopped")
            write(batch, number)

        start = lambda sink, rows=rows, mark=mark: rows.writeStream.foreachBatch(sink).option("checkpointLocation", mark).trigger(availableNow=True).start()
        if stops:
            with contextlib.suppress(StreamingQueryException):
                drain(start(once))
        drain(start(write))
        table = read_upserted(t.spark, root, rows.schema)
        out = table if out is None else out.unionByName(table)
    return out.groupBy("stream", "user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("snapshot_versions", """
select 'first' as version, count(*) as n, round(sum(o_totalprice), 2) as total from orders where o_orderstatus <> 'O'
union all select 'second', count(*), round(sum(o_totalprice), 2) from orders where o_orderstatus = 'F' union all select 'third', count(*), round(sum(o_totalprice), 2) from orders where o_orderstatus in ('F', 'O')""")
def snapshots(t):
    """A table, a predicate delete, an insert of new keys: each state stays readable."""
    root = fresh_path(t.spark, "orders")
    versions = [snapshot_write(t.orders.filter("o_orderstatus <> 'O'"), root)]
    versions.append(snapshot_write(delete_where(read_version(t.spark, root), F.col("o_orderstatus") == "P"), root))
    versions.append(upsert_new(t.spark, root, t.orders.filter("o_orderstatus <> 'P'"), ["o_orderkey"]))
    out = None
    for name, v in zip(("first", "second", "third"), versions, strict=True):
        one = read_version(t.spark, root, v).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).select(F.lit(name).alias("version"), "n", "total")
        out = one if out is None else out.unionByName(one)
    return out


@query("compaction", "select o_orderstatus, count(*) as n, true as fewer, true as large_stays, true as all_once from orders group by 1")
def compaction(t):
    """One large file and many small ones: the small are put together by their bytes, the large stays, and so do the rows."""
    root = fresh_path(t.spark, "small")
    large, small = t.orders.filter("o_orderstatus = 'F'").coalesce(1), t.orders.filter("o_orderstatus <> 'F'").repartition(12)
    snapshot_write(large.unionByName(small), root)
    old = file_sizes(read_version(t.spark, root)).orderBy(F.col("bytes").desc()).limit(1).first()
    version, before, after = compact(t.spark, root, target_bytes=old["bytes"])
    new = read_version(t.spark, root, version)
    counts = new.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) == F.count_distinct("o_orderkey")).alias("all_once"))
    stays = file_sizes(new).agg(F.bool_or(F.col("path") == old["path"]).alias("large_stays"))
    return counts.join(F.broadcast(stays)).withColumn("fewer", F.lit(1 < after < before))
