"""Tables of the media model as DDL strings, and the value lists of their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VIDEO = "video_id string, video_path string, title string, description string, keywords array<string>, author string, channel_id string, channel_url string, watch_url string, thumbnail_url string, publish_date date, duration_ms bigint"
SHOT = "shot_id string, video_id string, shot_index int, start_ms bigint, end_ms bigint, start_frame_idx bigint, end_frame_idx bigint"
FRAME = "frame_id string, n int, video_id string, shot_id string, pts_time double, timestamp_ms bigint, fps double, frame_idx bigint, source string, frame_path string, image_url string, width int, height int"
CLASS = "class_id string, class_name string"
OCR = "frame_id string, n int, text string, language string, x_min double, x_max double, y_min double, y_max double"
DETECTION = "detection_id bigint, frame_id string, class_id string, confidence double, x_min double, y_min double, x_max double, y_max double, model_name string, model_version string"
FRAME_EMBEDDING = "faiss_id bigint, frame_id string, index_version string, model_name string"
TRANSCRIPT = "segment_id string, video_id string, start_ms bigint, end_ms bigint, text string"
TRACK = "track_id bigint, shot_id string, class_id string, start_ms bigint, end_ms bigint, start_frame_idx bigint, end_frame_idx bigint, average_confidence double, observation_count int, sampling_fps double"
OBSERVATION = "track_id bigint, frame_idx bigint, timestamp_ms bigint, confidence double, x_min double, y_min double, x_max double, y_max double"
CLIP = "clip_id string, shot_id string, start_ms bigint, end_ms bigint, start_frame_idx bigint, end_frame_idx bigint, sampling_fps double, clip_path string"
CLIP_EMBEDDING = "faiss_id bigint, clip_id string, index_version string, model_name string"
SHOT_EMBEDDING = "faiss_id bigint, shot_id string, index_version string, model_name string, model_version string, pooling string"
CAPTION = "caption_id bigint, frame_id string, clip_id string, shot_id string, text string, structured_data string, confidence double, created_at timestamp"
EMBEDDING_META = "embedding_id string, entity_type string, entity_id string, video_id string, status string, dimension int, normalized boolean, model_name string, model_version string, sampled_timestamps array<bigint>, actual_timestamps array<bigint>, source_ids array<string>, failure_reason string"

TABLES = {
    "video": VIDEO, "shot": SHOT, "frame": FRAME, "class": CLASS, "ocr": OCR, "detection": DETECTION, "frame_embedding": FRAME_EMBEDDING, "transcript": TRANSCRIPT, "track": TRACK,
    "observation": OBSERVATION, "clip": CLIP, "clip_embedding": CLIP_EMBEDDING, "shot_embedding": SHOT_EMBEDDING, "caption": CAPTION,
}

FRAME_SOURCES = ("official", "extracted")
SCALE_TYPES = ("full_shot", "fixed_window")
DECODE_STATES = ("success", "decode_failed")
ENTITY_TYPES = ("frame", "clip", "shot")


def conform(df: DataFrame, contract: str) -> DataFrame:
    """The columns of a contract in its order and types; a missing column is null, a value of another kind fails the job."""
    fields = [f.split(" ", 1) for f in contract.split(", ")]
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in fields])
