"""Streaming queries over the stored event table, replayed as a stream, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.plans import common as c
from reelspan.session import scratch_path, table
from reelspan.sources import sinks
from reelspan.streaming import incremental

#: Observations that share a track state, on average.
GROUP_ROWS = 4_000
#: Observations fed to the track states at a time.
SLICE_ROWS = 4_000_000


def _events(spark: SparkSession, d: str, *columns: str, closed: bool = False) -> DataFrame:
    """The event table as a stream; ``closed`` adds a row far behind the last one, so that the watermark passes all events."""
    e = table(spark, d, "events")
    if not closed:
        cols = ", ".join(f"{n} {t}" for n, t in e.dtypes)
        return spark.readStream.schema(cols).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    rows, root = e.select(*columns, F.col("ts").cast("timestamp").alias("ts")), scratch_path(spark, "events")
    end = rows.agg(F.max("ts").alias("ts")).where("ts IS NOT NULL").select(*[F.lit(None).cast(dict(rows.dtypes)[n]).alias(n) for n in columns], (F.col("ts") + F.expr("INTERVAL 30 DAY")).alias("ts"))
    rows.unionByName(end).write.parquet(root)
    return spark.readStream.schema(rows.schema).parquet(root)


def stream_window_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sliding windows of one hour every 30 minutes; a window comes out, and leaves the state, once the watermark has passed it."""
    out = incremental.run_once(incremental.windowed_counts(_events(spark, d, "event_type", closed=True), length="1 hour", slide="30 minutes"), "windows")
    return out.select(F.unix_millis("window_start").alias("start_ms"), "event_type", "rows")


def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions per user, closed after six hours without an event."""
    out = incremental.run_once(incremental.sessions(_events(spark, d, "user_id", closed=True), gap="6 hours"), "sessions")
    return out.select("user_id", F.unix_millis("session_start").alias("start_ms"), "rows")


def stream_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Events in two deliveries, the second with old ones among them: those too late wait in a pending table."""
    e, root = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")), scratch_path(spark, "late")
    half = e.agg(F.percentile(F.unix_millis("ts"), 0.5)).first()[0]
    second = F.coalesce((F.unix_millis("ts") > half) | (F.col("event_id") % 10 == 0), F.lit(True))
    one, two = f"{root}/in", f"{root}/work"
    e.where(~second).coalesce(1).write.parquet(one)
    stream = lambda: incremental.file_stream(spark, one, "event_id long, ts timestamp")
    incremental.split_late(stream(), two, time="ts", delay_ms=3_600_000)
    e.where(second).coalesce(1).write.mode("append").parquet(one)
    rows, pending = incremental.split_late(stream(), two, time="ts", delay_ms=3_600_000)
    return rows.withColumn("late", F.lit(False)).unionByName(pending.withColumn("late", F.lit(True))).select("event_id", "late")


def stream_rate_gate(spark: SparkSession, d: str) -> DataFrame:
    """One event per user and day; which one is not fixed."""
    out = incremental.run_once(incremental.gated(_events(spark, d), time="ts", part="user_id", interval="1 day"), "gate")
    return out.select("user_id", F.unix_millis("_bucket").alias("day_ms"))


def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Shots brought into a versioned table, the latest delivery winning."""
    src = table(spark, d, "shot").where("end_ms IS NOT NULL").select("shot_id", "end_ms", F.unix_micros(F.col("ingested_at").cast("timestamp")).alias("seq"))
    root = scratch_path(spark, "upsert")
    src.write.parquet(f"{root}/in")
    incremental.ingest(spark, f"{root}/in", "shot_id string, end_ms bigint, seq bigint", f"{root}/table", f"{root}/log", key="shot_id", order="seq")
    return sinks.current_version(spark, f"{root}/table")[0]


def stream_tracks(spark: SparkSession, d: str) -> DataFrame:
    """Tracks closed by event time; a row far behind the last one closes those still open at the end.

    The frames are fed in slices of time, so that the states hold the tracks of one slice.
    """
    f = c.frames(spark, d).where("shot_id IS NOT NULL AND timestamp_ms IS NOT NULL")
    rows = f.select("shot_id", F.col("source").alias("class_id"), F.lit(0).cast("long").alias("local_id"), F.timestamp_millis(F.col("timestamp_ms") + 86_400_000).alias("event_time"), "timestamp_ms", F.col("fps").alias("confidence"))
    root = scratch_path(spark, "tracks")
    rows.write.parquet(f"{root}/rows")
    kept = spark.read.schema(rows.schema).parquet(f"{root}/rows")
    count, last = kept.count(), kept.agg(F.max("event_time").alias("event_time"))
    empty = {n: F.lit(None).cast(t) for n, t in rows.dtypes if n != "event_time"}
    flush = last.where("event_time IS NOT NULL").select(*[empty.get(n, F.col("event_time") + F.expr("INTERVAL 1 DAY")).alias(n) for n in rows.columns]).withColumn("timestamp_ms", F.unix_millis("event_time"))
    groups, slices = max(1, -(-min(count, SLICE_ROWS) // GROUP_ROWS)), -(-count // SLICE_ROWS)
    feed = f"{root}/in" if slices > 1 else f"{root}/rows"
    tracks = lambda: incremental.run_once(incremental.track_states(incremental.file_stream(spark, feed, "shot_id string, class_id string, local_id long, event_time timestamp, timestamp_ms long, confidence double"), groups=groups), "tracks", checkpoint=f"{root}/run")
    if slices > 1:
        edges = sorted(set(kept.approxQuantile("timestamp_ms", [i / slices for i in range(1, slices)], 0.1 / slices)))
        part = sum([(F.col("timestamp_ms") >= int(e)).cast("int") for e in edges], F.lit(0))
        kept.withColumn("_slice", part).repartition("_slice", F.pmod(F.xxhash64("shot_id"), F.lit(8))).write.partitionBy("_slice").parquet(f"{root}/slices")
        for i in range(len(edges) + 1):
            if sinks.exists(spark, f"{root}/slices/_slice={i}"):
                spark.read.schema(rows.schema).parquet(f"{root}/slices/_slice={i}").write.mode("append").parquet(feed)
                tracks()
    flush.write.mode("append").parquet(feed)
    return tracks()


def queries() -> dict:
    return {f.__name__: f for f in (stream_window_counts, stream_sessions, stream_late_rows, stream_rate_gate, stream_upsert, stream_tracks)}


def oracle_sql() -> dict[str, str]:
    return {
        "stream_window_counts": "WITH w AS (SELECT event_type, unnest([epoch_ms(ts) // 1800000 * 1800000, epoch_ms(ts) // 1800000 * 1800000 - 1800000]) AS start_ms FROM events) SELECT start_ms, event_type, count(*) AS rows FROM w GROUP BY 1, 2",
        "stream_sessions": "WITH g AS (SELECT user_id, epoch_us(ts) // 1000 AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 21600000000 THEN 0 ELSE 1 END AS o FROM events), s AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(t) AS start_ms, count(*) AS rows FROM s GROUP BY user_id, k",
        "stream_late_rows": "WITH h AS (SELECT quantile_cont(epoch_ms(ts), 0.5) AS half FROM events), x AS (SELECT event_id, epoch_ms(ts) AS t, coalesce(epoch_ms(ts) > half OR event_id % 10 = 0, true) AS second FROM events, h) SELECT event_id, coalesce(second AND t < (SELECT max(t) FROM x WHERE NOT second) - 3600000, false) AS late FROM x",
        "stream_rate_gate": "SELECT DISTINCT user_id, epoch_ms(ts) // 86400000 * 86400000 AS day_ms FROM events",
        "stream_upsert": "SELECT shot_id, arg_max(end_ms, ingested_at) AS end_ms, max(epoch_us(ingested_at)) AS seq FROM shot WHERE end_ms IS NOT NULL GROUP BY 1",
        "stream_tracks": f"WITH g AS (SELECT shot_id, source AS class_id, timestamp_ms AS t, fps, CASE WHEN timestamp_ms - lag(timestamp_ms) OVER (PARTITION BY shot_id, source ORDER BY timestamp_ms) <= 2000 THEN 0 ELSE 1 END AS o FROM {c.FRAMES} WHERE shot_id IS NOT NULL AND timestamp_ms IS NOT NULL), s AS (SELECT *, sum(o) OVER (PARTITION BY shot_id, class_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT shot_id, class_id, CAST(0 AS BIGINT) AS local_id, min(t) AS start_ms, greatest(max(t), min(t) + 1) AS end_ms, count(*) AS observation_count, coalesce(sum(fps), 0) / count(*) AS average_confidence FROM s GROUP BY shot_id, class_id, k",
    }
