"""Incremental ingestion and windowed streams: file sources, watermarks, idempotent upserts."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reelspan.session import stored
from reelspan.sources import sinks

#: Observations a track state takes in, at least, before it merges them.
MERGE_ROWS = 20_000


def guard_resume(spark: SparkSession, root: str, config: dict) -> None:
    """Refuse to resume a checkpoint that was made under another configuration."""
    digest = hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()
    at = f"{root}/config.json"
    if sinks.exists(spark, at):
        if json.loads(sinks._get(spark, at))["digest"] != digest:
            raise ValueError("checkpoint was made under another configuration")
    else:
        sinks._put(spark, at, json.dumps({"digest": digest}))


def file_stream(spark: SparkSession, path: str, schema: str, *, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, *, key: str, order: str, config: dict | None = None) -> None:
    """Bring new files into a versioned table, the latest row per key winning; a batch run twice changes nothing."""
    guard_resume(spark, checkpoint, config or {})

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark, version = batch.sparkSession, f"{batch_id:010d}"
        if sinks.exists(spark, f"{target}/current.json") and json.loads(sinks._get(spark, f"{target}/current.json"))["version"] >= version:
            return  # this batch was published before
        sinks.remove(spark, f"{target}/versions/{version}")  # left by a run that did not reach the pointer
        sinks.publish_changes(batch, target, version, key=key, order=order)

    file_stream(spark, source, schema).writeStream.foreachBatch(merge).option("checkpointLocation", f"{checkpoint}/log").trigger(availableNow=True).start().awaitTermination()


def split_late(stream: DataFrame, root: str, *, time: str, delay_ms: int) -> tuple[DataFrame, DataFrame]:
    """Run a stream over what there is now; (rows in time, rows that came too late), all of them kept.

    A row is late if its time lies more than ``delay_ms`` before the greatest time of earlier
    batches. Late rows wait in a pending folder. A batch run twice writes the same folders.
    """
    schema = stream.schema

    def put(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, f"{root}/seen/{batch_id:010d}.json"
        before = f"{root}/seen/{batch_id - 1:010d}.json"
        top = json.loads(sinks._get(spark, before))["top"] if sinks.exists(spark, before) else None
        rows = stored(batch, "batch")
        late = F.lit(False) if top is None else F.coalesce(F.unix_millis(time) < top - delay_ms, F.lit(False))
        rows.where(~late).write.mode("overwrite").parquet(f"{root}/rows/{batch_id:010d}")
        rows.where(late).write.mode("overwrite").parquet(f"{root}/pending/{batch_id:010d}")
        most = rows.agg(F.max(F.unix_millis(time))).first()[0]
        sinks._put(spark, seen, json.dumps({"top": max((x for x in (top, most) if x is not None), default=None)}))

    stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{root}/log").trigger(availableNow=True).start().awaitTermination()
    spark = stream.sparkSession
    read = lambda name: spark.read.schema(schema).parquet(f"{root}/{name}/*") if sinks.exists(spark, f"{root}/{name}") else spark.createDataFrame([], schema)
    return read("rows"), read("pending")


def windowed_counts(events: DataFrame, *, time: str = "ts", key: str = "event_type", length: str = "10 seconds", slide: str | None = "8 seconds", delay: str = "1 minute") -> DataFrame:
    """Counts per sliding window and key; late rows within the delay still count."""
    win = F.window(time, length, slide) if slide else F.window(time, length)
    return events.withWatermark(time, delay).groupBy(win.alias("w"), key).agg(F.count("*").alias("rows")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "rows")


def sessions(events: DataFrame, *, time: str = "ts", key: str = "user_id", gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Sessions per key: closed after a gap."""
    return events.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("s"), key).agg(F.count("*").alias("rows")).select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "rows")


def gated(events: DataFrame, *, time: str, part: str, interval: str, delay: str = "1 minute") -> DataFrame:
    """One row per part and time interval, whichever comes first."""
    bucketed = events.withColumn("_bucket", F.window(time, interval)["start"])
    return bucketed.withWatermark("_bucket", delay).dropDuplicatesWithinWatermark([part, "_bucket"])


def merge_spans(spans: list[tuple], idle_ms: int) -> list[tuple]:
    """Spans (first, last, n, total, lo, hi) with those at most ``idle_ms`` apart made one, in time order."""
    out: list[tuple] = []
    for x in sorted(spans):
        if out and x[0] - out[-1][1] <= idle_ms:
            f, t, n, total, lo, hi = out[-1]
            out[-1] = (f, max(t, x[1]), n + x[2], total + x[3], min(lo, x[4]), max(hi, x[5]))
        else:
            out.append(x)
    return out


def track_states(observations: DataFrame, *, delay: str = "10 seconds", idle_ms: int = 2000, groups: int = 64) -> DataFrame:
    """Tracks of a stream of observations (shot_id, class_id, local_id, event_time, timestamp_ms, confidence).

    A gap above ``idle_ms`` of event time ends a track. It is emitted, and leaves the state, when the
    watermark has passed that gap; until then late rows may still join tracks or lie between them.
    Objects share ``groups`` states, by hash, so that the cost of a state is spread over many short
    tracks; a checkpoint holds for one number of groups.
    """
    ids = ["shot_id", "class_id", "local_id"]

    def merged(spans: dict[tuple, list[tuple]]) -> dict[tuple, list[tuple]]:
        return {k: merge_spans(x, idle_ms) if len(x) > 1 else x for k, x in spans.items()}

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        spans: dict[tuple, list[tuple]] = {}
        for k0, k1, k2, *x in zip(*state.get) if state.exists else ():
            spans.setdefault((k0, k1, k2), []).append(tuple(x))
        if not state.hasTimedOut:
            held, fresh = sum(map(len, spans.values())), 0
            for b in batches:
                keys = zip(*(b[n].astype(object).where(b[n].notna(), None).tolist() for n in ids))
                at, ms = b["_at"].astype("int64").tolist(), b["timestamp_ms"].astype("int64").tolist()
                for k, t, m, c in zip(keys, at, ms, b["confidence"].fillna(0.0).astype(float).tolist()):
                    spans.setdefault(k, []).append((t, t, 1, c, m, m))
                fresh += len(b)
                if fresh > max(MERGE_ROWS, held):
                    spans = merged(spans)
                    held, fresh = sum(map(len, spans.values())), 0
            spans = merged(spans)
        now = state.getCurrentWatermarkMs()
        closed, left = [], []
        for k, xs in spans.items():
            for x in xs:
                (closed if x[1] + idle_ms < now else left).append((*k, *x))
        if left:
            state.update(tuple(list(v) for v in zip(*left)))
            state.setTimeoutTimestamp(max(min(x[4] for x in left) + idle_ms, now + 1))
        elif state.exists:
            state.remove()
        if closed:
            rows = [(*k, lo, max(hi, lo + 1), n, total / n) for *k, _, _, n, total, lo, hi in closed]
            yield pd.DataFrame(rows, columns=[*ids, "start_ms", "end_ms", "observation_count", "average_confidence"])

    # local_id travels as text: pandas makes floats of integers with nulls
    shared = observations.withWatermark("event_time", delay).withColumns({"_at": F.unix_millis("event_time"), "_group": F.pmod(F.xxhash64(*ids), F.lit(groups)), "local_id": F.col("local_id").cast("string")})
    tracks = shared.groupBy("_group").applyInPandasWithState(
        step,
        "shot_id string, class_id string, local_id string, start_ms long, end_ms long, observation_count long, average_confidence double",
        "shot_id array<string>, class_id array<string>, local_id array<string>, first array<long>, last array<long>, n array<long>, total array<double>, lo array<long>, hi array<long>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return tracks.withColumn("local_id", F.col("local_id").cast("long"))


def run_once(stream: DataFrame, name: str, *, mode: str = "append", checkpoint: str | None = None, keep: bool = True) -> DataFrame:
    """Run a stream over what there is now and return its rows, written to the shared folder."""
    from reelspan.session import scratch_path

    spark = stream.sparkSession
    root = checkpoint or scratch_path(spark, name)
    if mode == "append":
        stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/log").outputMode("append").trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{root}/out")
    results: list[str] = []

    def put(batch: DataFrame, batch_id: int) -> None:
        at = f"{root}/out-{batch_id}"
        batch.write.mode("overwrite").parquet(at)
        results.append(at)

    stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{root}/log").outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    if not results:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(results[-1])


__all__ = ["file_stream", "gated", "guard_resume", "ingest", "run_once", "sessions", "split_late", "stored", "track_states", "windowed_counts"]
