"""All queries of the core, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.operators import joins, timeline
from reelspan.plans import common, data_quality, ingestion, media, scalars, selection_sql, streams, timelines

_MODULES = [data_quality, timelines, media, scalars, ingestion, streams]


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.oracle_sql().items()} | selection_sql.ALL


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Shots to clip windows to frames: clip windows per video with the frames they hold."""
    clips = timeline.clip_frames(timeline.clip_windows(common.sound_shots(spark, d)))
    held = joins.bucket_range_join(
        common.frames(spark, d).select("frame_id", "video_id", "timestamp_ms"), clips.select("video_id", "clip_id", "clip_start_ms", "clip_end_ms"), key="video_id", time="timestamp_ms", start="clip_start_ms", end="clip_end_ms"
    )
    return held.groupBy("video_id", "clip_id").agg(F.count("*").alias("frames"), F.min("timestamp_ms").alias("first_ms"))
