"""Pairing records with the record nearest in time, as a stateful streaming join.

``nearest_stream`` buffers both sides per entity and stretch of time, emits a left moment
once the watermark has passed its tolerance horizon and evicts right records no later
moment can reach. A stretch is ``SLOT_MS`` long and right records near its border are
given to both stretches, so a hot entity spreads over its timeline and holds at most one
record per millisecond of a stretch. Small entities share a state, by hash, so that the
cost of a state is spread over about ``GROUP_EVENTS`` events.

``nearest_in_time`` runs that join over stored tables: both sides are reduced to distinct
(entity, millisecond), written in event-time order in a few slices to the shared folder
and replayed slice by slice; matches are then joined back to the left rows.

Defined cases: rows with null entity or time take no part; times beyond ``MAX_MS`` (about
139 years either way) are no times; repeated rows count once; of equally near records the earlier
one wins, then the smaller key; a left row without a record within the tolerance gives
no row; empty sides give an empty result; other columns are carried unchanged, but for
right_key and right_ms, which are replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reelspan.session import scratch_path, stored

SLOT_MS = 1 << 19
MAX_MS = 1 << 42
#: Event times are shifted so that time 0 lies after the watermark a stream starts with.
SHIFT_MS = MAX_MS + 86_400_000
#: Rows of one replayed slice.
SLICE_ROWS = 4_000_000
_EVENTS = "entity string, grp long, slot long, side int, t long, key string, event_time timestamp"
#: Events that share a state, on average: entities are hashed into groups of about this many.
GROUP_EVENTS = 20_000
_MATCHES = "entity string, left_ms long, right_key string, right_ms long"


def _nearest(times: list[int], t: int, tolerance: int) -> int | None:
    at = bisect_left(times, t)
    best = None
    for i in (at - 1, at):
        if 0 <= i < len(times) and abs(times[i] - t) <= tolerance and (best is None or abs(times[i] - t) < abs(best - t)):
            best = times[i]
    return best


def _step(tolerance: int, slot_ms: int):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        _, slot = key
        if slot is None or slot != slot:  # the punctuation that moves the watermark
            for _ in batches:
                pass
            return
        slot = int(slot)
        re, rt, rk, le, lt = state.get if state.exists else ([], [], [], [], [])
        right = {(str(e), int(t)): str(k) for e, t, k in zip(re, rt, rk)}
        left = {(str(e), int(t)) for e, t in zip(le, lt)}
        if not state.hasTimedOut:
            for b in batches:
                for e, side, t, k in zip(b["entity"].tolist(), b["side"].tolist(), b["t"].tolist(), b["key"].tolist()):
                    at = (e, t)
                    if side == 0:
                        left.add(at)
                    elif at not in right or k < right[at]:
                        right[at] = k
        mark = state.getCurrentWatermarkMs() - SHIFT_MS
        due = sorted(at for at in left if at[1] + tolerance < mark)
        out = []
        if due:
            asked, times = {e for e, _ in due}, {}
            for e, t in sorted(right):
                if e in asked:
                    times.setdefault(e, []).append(t)
            for e, t in due:
                hit = _nearest(times.get(e, []), t, tolerance)
                if hit is not None:
                    out.append((e, t, right[e, hit], hit))
            left.difference_update(due)
        # a waiting moment may lie one tolerance before the mark
        kept = [at for at in right if at[1] + 2 * tolerance >= mark]
        end = (slot + 1) * slot_ms + tolerance
        if not left and end < mark:
            state.remove()
        else:
            state.update(([e for e, _ in kept], [t for _, t in kept], [right[at] for at in kept], [e for e, _ in left], [t for _, t in left]))
            horizon = min(t for _, t in left) + tolerance + 1 if left else end + 1
            state.setTimeoutTimestamp(max(horizon, mark + 1) + SHIFT_MS)
        if out:
            yield pd.DataFrame(out, columns=["entity", "left_ms", "right_key", "right_ms"])

    return step


def nearest_stream(events: DataFrame, tolerance_ms: int, *, delay: str = "1 second", slot_ms: int = SLOT_MS) -> DataFrame:
    """Matches of a stream of events: entity, grp, slot, side (0 left, 1 right), t, key, event_time."""
    return (
        events.withWatermark("event_time", delay)
        .groupBy("grp", "slot")
        .applyInPandasWithState(_step(tolerance_ms, slot_ms), _MATCHES, "re array<string>, rt array<long>, rk array<string>, le array<string>, lt array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    )


def as_events(left: DataFrame, right: DataFrame, tolerance_ms: int, *, groups: int, slot_ms: int = SLOT_MS) -> DataFrame:
    """left (entity, t) and right (entity, t, key) as one stream's events, entities in ``groups`` groups."""
    grp = F.pmod(F.xxhash64("entity"), F.lit(groups)).cast("long").alias("grp")
    slot = lambda t: F.floor(t / F.lit(slot_ms)).cast("long")
    clean = lambda d: d.where(F.col("entity").isNotNull() & F.col("t").between(-MAX_MS, MAX_MS))
    stamp = F.timestamp_millis(F.col("t") + SHIFT_MS).alias("event_time")
    lefts = clean(left).select("entity", grp, slot(F.col("t")).alias("slot"), F.lit(0).alias("side"), "t", F.lit(None).cast("string").alias("key"), stamp)
    near = F.array_distinct(F.array(slot(F.col("t") - tolerance_ms), slot(F.col("t")), slot(F.col("t") + tolerance_ms)))
    rights = clean(right).select("entity", grp, F.explode(near).alias("slot"), F.lit(1).alias("side"), "t", "key", stamp)
    return lefts.unionByName(rights)


def replay(events: DataFrame, tolerance_ms: int, *, slices: int, slot_ms: int = SLOT_MS) -> DataFrame:
    """Run the streaming join over stored events, fed in event-time order; the matches."""
    spark = events.sparkSession
    root = scratch_path(spark, "nearest")
    feed, out, log = f"{root}/feed", f"{root}/out", f"{root}/log"
    bounds = events.approxQuantile("t", [i / slices for i in range(1, slices)], 0.01) if slices > 1 else []
    edges = [None, *sorted(set(int(b) for b in bounds)), None]
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    flush = spark.range(1).select(F.lit(None).cast("string").alias("entity"), F.lit(None).cast("long").alias("grp"), F.lit(None).cast("long").alias("slot"), F.lit(1).alias("side"), F.lit(0).cast("long").alias("t"), F.lit(None).cast("string").alias("key"), F.timestamp_millis(F.lit(2 * SHIFT_MS + 10 * slot_ms)).alias("event_time"))
    try:
        for lo, hi in zip(edges, edges[1:]):
            part = events
            if lo is not None:
                part = part.where(F.col("t") >= lo)
            if hi is not None:
                part = part.where(F.col("t") < hi)
            part.write.mode("append").parquet(feed)
            _drain(spark, feed, out, log, tolerance_ms, slot_ms)
        flush.write.mode("append").parquet(feed)
        _drain(spark, feed, out, log, tolerance_ms, slot_ms)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(_MATCHES).parquet(out)


def _drain(spark: SparkSession, feed: str, out: str, log: str, tolerance_ms: int, slot_ms: int) -> None:
    source = spark.readStream.schema(_EVENTS).parquet(feed)
    query = nearest_stream(source, tolerance_ms, slot_ms=slot_ms).writeStream.format("parquet").option("path", out).option("checkpointLocation", log).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def nearest_in_time(left: DataFrame, right: DataFrame, *, entity: str, left_time: str, right_time: str, right_key: str, tolerance_ms: int, slice_rows: int = SLICE_ROWS, group_events: int = GROUP_EVENTS, slot_ms: int = SLOT_MS) -> DataFrame:
    """Left rows with their nearest right record: the columns of ``left``, right_key, right_ms."""
    left = left.drop("right_key", "right_ms").withColumn("__moment", F.col(left_time).cast("long"))
    lefts = left.select(F.col(entity).alias("entity"), F.col("__moment").alias("t")).distinct()
    rights = right.groupBy(F.col(entity).alias("entity"), F.col(right_time).cast("long").alias("t")).agg(F.min(F.col(right_key).cast("string")).alias("key"))
    rights = rights.where(F.col("key").isNotNull())
    total = lefts.count() + rights.count()
    events = stored(as_events(lefts, rights, tolerance_ms, groups=max(1, -(-total // group_events)), slot_ms=slot_ms), "nearest-events")
    slices = max(2, -(-total // slice_rows))
    found = replay(events, tolerance_ms, slices=slices, slot_ms=slot_ms)
    found = found.select(F.col("entity").alias("__entity"), F.col("left_ms").alias("__left"), "right_key", "right_ms")
    return left.join(found, (F.col(entity) == F.col("__entity")) & (F.col("__moment") == F.col("__left"))).drop("__entity", "__left", "__moment")


def batch_entries(batches: DataFrame) -> DataFrame:
    """Entries of decoded batches: batch_id, pos, video_id, moment_ms; one row per entry.

    The moment is the actual timestamp, or the requested one where that is null.
    """
    empty = F.array().cast("array<bigint>")
    zipped = F.arrays_zip(F.coalesce("requested_timestamps_ms", empty).alias("r"), F.coalesce("actual_timestamps_ms", empty).alias("a"))
    return (
        batches.select("batch_id", "video_id", F.posexplode(zipped).alias("pos", "e"))
        .select("batch_id", "pos", "video_id", F.coalesce("e.a", "e.r").alias("moment_ms"))
        .where(F.col("moment_ms").isNotNull())
        .dropDuplicates(["batch_id", "pos"])
    )
