"""Row rules with reasons, and the filters of the model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspan.functions import text


def with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``reasons``: names of the rules a row breaks (a rule is true where it is broken; null counts as kept)."""
    return df.withColumn("reasons", F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()])))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reasons``)."""
    marked = with_reasons(df, rules)
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0)


def fail_on(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows unchanged; the job fails on the first row that breaks a rule."""
    out = df
    for name, bad in rules.items():
        first = out.columns[0]
        out = out.withColumn(first, F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit(f"row breaks {name}"))).otherwise(F.col(first)))
    return out


def shot_rules() -> dict[str, Column]:
    return {
        "shot_id_missing": F.col("shot_id").isNull(),
        "video_id_missing": F.col("video_id").isNull(),
        "time_missing": F.col("start_ms").isNull() | F.col("end_ms").isNull(),
        "time_negative": F.col("start_ms") < 0,
        "time_reversed": F.col("end_ms") <= F.col("start_ms"),
        "frames_reversed": F.col("end_frame_idx") < F.col("start_frame_idx"),
    }


def frame_rules() -> dict[str, Column]:
    return {
        "source_unknown": ~F.col("source").isin("official", "extracted"),
        "official_with_shot": (F.col("source") == "official") & F.col("shot_id").isNotNull(),
        "official_without_n": (F.col("source") == "official") & F.col("n").isNull(),
        "rate_not_positive": F.col("fps") <= 0,
        "time_missing": F.col("timestamp_ms").isNull(),
    }


def clip_rules() -> dict[str, Column]:
    return {
        "shot_id_missing": F.col("shot_id").isNull(),
        "time_missing": F.col("start_ms").isNull() | F.col("end_ms").isNull(),
        "time_reversed": F.col("end_ms") <= F.col("start_ms"),
        "frames_missing": F.col("start_frame_idx").isNull() | F.col("end_frame_idx").isNull(),
        "frame_count": F.col("target_num_frames") <= 0,
    }


def track_rules() -> dict[str, Column]:
    return {
        "time_reversed": F.col("end_ms") <= F.col("start_ms"),
        "no_observation": F.col("observation_count") <= 0,
        "confidence_missing": F.col("confidence_sum").isNull(),
        "confidence_range": (F.col("confidence_sum") < 0) | (F.col("confidence_sum") > F.col("observation_count")),
    }


def ocr_rules() -> dict[str, Column]:
    inside = lambda c: ~F.col(c).between(0, 1)
    return {
        "text_blank": text.non_blank(F.col("text")).isNull(),
        "box_range": inside("x_min") | inside("x_max") | inside("y_min") | inside("y_max"),
        "box_order": (F.col("x_min") >= F.col("x_max")) | (F.col("y_min") >= F.col("y_max")),
        "confidence_range": inside("confidence"),
    }


def caption_rules() -> dict[str, Column]:
    given = F.col("frame_id").isNotNull().cast("int") + F.col("clip_id").isNotNull().cast("int") + F.col("shot_id").isNotNull().cast("int")
    return {"target": given != 1, "text_blank": text.non_blank(F.col("text")).isNull(), "confidence_range": ~F.col("confidence").between(0, 1)}


def by_confidence(df: DataFrame, threshold: float, column: str = "confidence") -> DataFrame:
    """Rows of at least the threshold."""
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must lie in [0, 1]")
    return df.where(F.col(column) >= threshold)


def by_classes(df: DataFrame, *, names: list[str] | None = None, class_ids: list[str] | None = None, id_col: str = "class_id", name_col: str = "class_name") -> DataFrame:
    """Rows whose id or normalized name is listed; empty lists keep nothing, no lists keep all."""
    if names is None and class_ids is None:
        return df
    keep = F.lit(False)
    if class_ids:
        keep = keep | F.col(id_col).isin(*class_ids)
    if names:
        wanted = [" ".join(n.strip().lower().replace("_", " ").split()) for n in names]
        keep = keep | text.class_name(F.col(name_col)).isin(*wanted)
    return df.where(keep)


def in_range(time: Column, start: Column, end: Column) -> Column:
    """start <= time < end."""
    return (time >= start) & (time < end)


def temporal_match(start: int | None, end: int | None, *, start_col: str = "start_ms", end_col: str = "end_ms", point_col: str = "timestamp_ms") -> Column:
    """Interval overlap or point membership; a document without times never matches."""
    span, point = F.lit(True), F.lit(True)
    if start is not None:
        span, point = span & (F.col(end_col) > start), point & (F.col(point_col) >= start)
    if end is not None:
        span, point = span & (F.col(start_col) < end), point & (F.col(point_col) < end)
    if start is None and end is None:
        return F.lit(True)
    return F.coalesce(span & F.col(start_col).isNotNull() & F.col(end_col).isNotNull(), F.lit(False)) | F.coalesce(point & F.col(point_col).isNotNull(), F.lit(False))


def region_match(regions: Column, region: str) -> Column:
    """Whether one region of the array lies in the named part of the picture."""
    tests = {
        "top": lambda r: r["y_max"] <= 0.25,
        "header": lambda r: r["y_max"] <= 0.25,
        "bottom": lambda r: r["y_min"] >= 0.75,
        "footer": lambda r: r["y_min"] >= 0.75,
        "left": lambda r: r["x_max"] <= 0.35,
        "right": lambda r: r["x_min"] >= 0.65,
        "center": lambda r: (r["x_min"] < 0.65) & (r["x_max"] > 0.35) & (r["y_min"] < 0.75) & (r["y_max"] > 0.25),
    }
    return F.exists(regions, tests[region])


def usable_boxes(df: DataFrame, *, track: str = "internal_track_id", box: tuple[str, str, str, str] = ("x_min", "y_min", "x_max", "y_max")) -> DataFrame:
    """Rows with a track number and a box with an area."""
    x1, y1, x2, y2 = map(F.col, box)
    return df.where((F.col(track) >= 0) & (x2 > x1) & (y2 > y1))


def text_gate(df: DataFrame, minimum: float = 0.45, *, text_col: str = "text", score_col: str = "confidence") -> DataFrame:
    """Recognized texts that are not blank and score at least the minimum."""
    return df.where(text.non_blank(F.col(text_col)).isNotNull() & (F.col(score_col) >= minimum))
