"""Cleaned inputs shared by the queries, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.operators import joins
from reelspan.operators.stretches import Placed
from reelspan.session import table


def shots(spark: SparkSession, d: str) -> DataFrame:
    return joins.current_rows(table(spark, d, "shot"), "shot_id")


def sound_shots(spark: SparkSession, d: str) -> DataFrame:
    return shots(spark, d).where("video_id IS NOT NULL AND start_ms >= 0 AND end_ms > start_ms AND start_frame_idx >= 0 AND end_frame_idx >= start_frame_idx")


def frames(spark: SparkSession, d: str) -> DataFrame:
    return joins.first_arrivals(table(spark, d, "frame"), "frame_id")


def clips(spark: SparkSession, d: str) -> DataFrame:
    return joins.first_arrivals(table(spark, d, "clip_record"), "clip_id")


def sound_clips(spark: SparkSession, d: str) -> DataFrame:
    return clips(spark, d).where("shot_id IS NOT NULL AND end_ms > start_ms")


def tracks(spark: SparkSession, d: str) -> DataFrame:
    return joins.first_arrivals(table(spark, d, "object_track"), "track_id")


def ocr(spark: SparkSession, d: str) -> DataFrame:
    return joins.first_arrivals(table(spark, d, "ocr"), "frame_id", "n")


def videos(spark: SparkSession, d: str) -> DataFrame:
    return joins.current_rows(table(spark, d, "video"), "video_id")


def candidates(spark: SparkSession, d: str) -> DataFrame:
    usable = "size(clip_vector) = 64 AND forall(clip_vector, x -> x IS NOT NULL AND NOT isnan(x)) AND exists(clip_vector, x -> x <> 0)"
    return joins.first_arrivals(table(spark, d, "redundancy_candidate"), "candidate_id").where(usable)


def timeline(spark: SparkSession, d: str) -> DataFrame:
    """Events as frame scores: video_id, frame_idx, score."""
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "value")
    numbered = Placed(e, ["user_id"], ["ts", "event_id"]).numbered("frame_idx").result()
    return numbered.select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("video_id"), (F.col("frame_idx") - 1).alias("frame_idx"), F.col("value").alias("score"), "event_id")


def _first(t: str, *keys: str) -> str:
    return f"(SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY ingested_at NULLS LAST) = 1)"


def _current(t: str, key: str) -> str:
    return f"(SELECT * FROM (SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ingested_at DESC NULLS LAST, deleted_at DESC NULLS LAST) = 1) WHERE deleted_at IS NULL)"


SHOTS = _current("shot", "shot_id")
SOUND_SHOTS = f"(SELECT * FROM {SHOTS} WHERE video_id IS NOT NULL AND start_ms >= 0 AND end_ms > start_ms AND start_frame_idx >= 0 AND end_frame_idx >= start_frame_idx)"
FRAMES = _first("frame", "frame_id")
CLIPS = _first("clip_record", "clip_id")
SOUND_CLIPS = f"(SELECT * FROM {CLIPS} WHERE shot_id IS NOT NULL AND end_ms > start_ms)"
TRACKS = _first("object_track", "track_id")
OCR = _first("ocr", "frame_id", "n")
VIDEOS = _current("video", "video_id")
CANDIDATES = f"(SELECT * FROM {_first('redundancy_candidate', 'candidate_id')} WHERE len(clip_vector) = 64 AND len(list_filter(clip_vector, lambda x: x IS NULL OR isnan(x))) = 0 AND len(list_filter(clip_vector, lambda x: x <> 0)) > 0)"
TIMELINE = "(SELECT 'U' || user_id AS video_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx, value AS score FROM events)"
