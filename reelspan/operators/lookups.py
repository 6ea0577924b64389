"""Ordered lookups over the relational tables. Each is a filter that reaches the scan, and an order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frame_by_id(frames: DataFrame, frame_id: str) -> DataFrame:
    return frames.where(F.col("frame_id") == frame_id)


def frames_of_video(frames: DataFrame, video_id: str) -> DataFrame:
    return frames.where(F.col("video_id") == video_id).orderBy("frame_idx", "frame_id")


def frames_of_shot(frames: DataFrame, shot_id: str) -> DataFrame:
    return frames.where(F.col("shot_id") == shot_id).orderBy("frame_idx", "frame_id")


def shots_of_video(shots: DataFrame, video_id: str) -> DataFrame:
    return shots.where(F.col("video_id") == video_id).orderBy("shot_index", "shot_id")


def clips_of_shot(clips: DataFrame, shot_id: str) -> DataFrame:
    return clips.where(F.col("shot_id") == shot_id).orderBy("start_ms", "end_ms", "clip_id")


def video_list(videos: DataFrame) -> DataFrame:
    return videos.orderBy("video_id")


def mappings(rows: DataFrame, key: str, ids: list, *, version: str | None = None, model: str | None = None) -> DataFrame:  # type: ignore[type-arg]
    """Embedding mappings of given entities, version and model."""
    out = rows.where(F.col(key).isin(*ids)) if ids else rows.limit(0)
    if version is not None:
        out = out.where(F.col("index_version") == version)
    if model is not None:
        out = out.where(F.col("model_name") == model)
    return out


def usable_frames(frames: DataFrame, media: DataFrame) -> DataFrame:
    """Extracted frames, and official ones whose video has media (video_id)."""
    kept = frames.where(F.col("source").isin("official", "extracted"))
    return kept.where("source = 'extracted'").unionByName(kept.where("source = 'official'").join(media.select("video_id").distinct(), "video_id", "left_semi").select(*kept.columns))


def embedding_outcomes(done: DataFrame, failed: DataFrame) -> DataFrame:
    """Success and failure records as one table with ``status``."""
    a = done.withColumn("status", F.lit("success"))
    b = failed.withColumn("status", F.lit("failed"))
    return a.unionByName(b, allowMissingColumns=True)


def first_distinct(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The first row of each key in the given order."""
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_x"))
    return picked.select(*keys, "_x.*").select(*df.columns)
