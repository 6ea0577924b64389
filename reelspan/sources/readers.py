"""Readers with explicit schemas. Each returns a DataFrame and checks what its format promises."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.functions import ids


def _stem() -> F.Column:
    return F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1)


def media_info(spark: SparkSession, path: str) -> DataFrame:
    """Media-info JSON files, one per video; the file stem is the video id."""
    schema = "title string, description string, author string, channel_id string, channel_url string, watch_url string, thumbnail_url string, keywords array<string>, publish_date string, length bigint"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    return raw.select(
        F.url_decode(_stem()).alias("video_id"), "title", F.left("description", F.lit(500)).alias("description"), "keywords", "author", "channel_id", "channel_url", "watch_url", "thumbnail_url",
        F.try_to_date("publish_date", "dd/MM/yyyy").alias("publish_date"), (F.col("length") * 1000).alias("duration_ms"),
    )


def new_videos(found: DataFrame, existing: DataFrame) -> DataFrame:
    """Those not stored yet."""
    return found.join(existing.select("video_id").distinct(), "video_id", "left_anti")


def keyframe_map(spark: SparkSession, path: str) -> DataFrame:
    """Keyframe map CSV files with the exact header n, pts_time, fps, frame_idx; the file stem is the video id."""
    names = ["n", "pts_time", "fps", "frame_idx"]
    heads = spark.read.text(path).select(F.input_file_name().alias("f"), F.regexp_replace("value", "^﻿", "").alias("v"), F.monotonically_increasing_id().alias("i"))
    first = heads.groupBy("f").agg(F.min_by("v", "i").alias("v"))
    bad = [r["f"] for r in first.where(F.trim("v") != ",".join(names)).limit(10).collect()]
    if bad:
        raise ValueError(f"wrong header in {bad}")
    rows = spark.read.schema("n int, pts_time double, fps double, frame_idx bigint").option("header", True).option("enforceSchema", True).option("mode", "FAILFAST").csv(path)
    return rows.withColumn("video_id", F.url_decode(_stem()))


def official_frames(rows: DataFrame) -> DataFrame:
    """Map rows as official frames: identity, milliseconds (half to even), no shot."""
    return rows.select(
        ids.official_frame_id(F.col("video_id"), F.col("n")).alias("frame_id"), "n", "video_id", F.lit(None).cast("string").alias("shot_id"), "pts_time",
        F.bround(F.col("pts_time") * 1000).cast("bigint").alias("timestamp_ms"), "fps", "frame_idx", F.lit("official").alias("source"),
    )


def organizer_objects(spark: SparkSession, path: str, *, threshold: float = 0.25) -> DataFrame:
    """Object JSON with five parallel arrays as detections of at least the threshold; arrays of unequal length fail the job."""
    schema = "detection_scores array<string>, detection_class_names array<string>, detection_class_entities array<string>, detection_boxes array<array<string>>, detection_class_labels array<string>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("f", F.input_file_name())
    return unzip_detections(raw.withColumn("video_id", F.url_decode(F.regexp_extract("f", r"([^/]+)/[^/]+$", 1))).withColumn("keyframe_index", F.regexp_extract("f", r"(\d+)\.[^./]*$", 1).cast("int")), threshold)


def unzip_detections(raw: DataFrame, threshold: float) -> DataFrame:
    """Five parallel arrays per row as one row per detection; boxes come as y, x, y, x."""
    names = ["detection_scores", "detection_class_names", "detection_class_entities", "detection_boxes", "detection_class_labels"]
    same = F.lit(True)
    for n in names[1:]:
        same = same & (F.size(n) == F.size(names[0]))
    checked = raw.withColumn(names[0], F.when(same, F.col(names[0])).otherwise(F.raise_error(F.lit("inconsistent lengths"))))
    z = checked.select("video_id", "keyframe_index", F.explode(F.arrays_zip(*names)).alias("z"))
    box = lambda i: F.col("z.detection_boxes")[i].cast("double")
    return z.select(
        "video_id", "keyframe_index", F.col("z.detection_scores").cast("double").alias("confidence"), F.col("z.detection_class_names").alias("class_mid"), F.col("z.detection_class_entities").alias("class_name"),
        F.col("z.detection_class_labels").cast("int").alias("class_label"), F.struct(box(0).alias("y_min"), box(1).alias("x_min"), box(2).alias("y_max"), box(3).alias("x_max")).alias("bbox"),
    ).where(F.col("confidence") >= threshold)


def detection_lines(spark: SparkSession, path: str) -> DataFrame:
    """Detections as JSON lines in <video>/<n>.jsonl; rows whose body names another video or frame fail the job."""
    schema = "video_id string, keyframe_index int, confidence double, class_mid string, class_name string, class_label int, bbox struct<y_min:double,x_min:double,y_max:double,x_max:double>"
    raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path).withColumn("f", F.input_file_name())
    by_path = (F.url_decode(F.regexp_extract("f", r"([^/]+)/[^/]+$", 1)) == F.col("video_id")) & (F.regexp_extract("f", r"(\d+)\.[^./]*$", 1).cast("int") == F.col("keyframe_index"))
    return raw.withColumn("video_id", F.when(by_path, F.col("video_id")).otherwise(F.raise_error(F.lit("path and body disagree")))).drop("f").withColumn("frame_id", ids.official_frame_id(F.col("video_id"), F.col("keyframe_index")))


def class_vocabulary(spark: SparkSession, path: str, *, size: int = 601) -> DataFrame:
    """Class CSV label, class_id, class_name: labels 1..size, all three unique."""
    df = spark.read.schema("label int, class_id string, class_name string").option("header", True).option("mode", "FAILFAST").csv(path)
    got = df.agg(F.count("*").alias("n"), F.count_distinct("label").alias("l"), F.count_distinct("class_id").alias("i"), F.count_distinct("class_name").alias("c"), F.min("label").alias("a"), F.max("label").alias("b")).first()
    if not (got["n"] == got["l"] == got["i"] == got["c"] == size and got["a"] == 1 and got["b"] == size):
        raise ValueError(f"class vocabulary is not 1..{size} with unique ids and names")
    return df


def npy_vectors(spark: SparkSession, path: str, *, dim: int | None = None) -> DataFrame:
    """(video_id, pos, vector): matrices of `.npy` files, one per video, row by row."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").option("recursiveFileLookup", True).load(path).select("path", "content")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, content in zip(b["path"], b["content"]):
                m = np.load(io.BytesIO(content), allow_pickle=False)
                if m.ndim != 2 or not np.issubdtype(m.dtype, np.floating) or (dim is not None and m.shape[1] != dim):
                    raise ValueError(f"unexpected matrix in {p}")
                stem = re.sub(r"\.npy$", "", p.rsplit("/", 1)[-1])
                for at in range(0, len(m), 4096):
                    part = m[at : at + 4096].astype(np.float32)
                    yield pd.DataFrame({"video_id": stem, "pos": np.arange(at, at + len(part)), "vector": list(part)})

    return files.mapInPandas(parse, "video_id string, pos bigint, vector array<float>")


def any_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV, JSON lines or Parquet by suffix, all with the same types if a schema is given; a row that does not fit it fails the job."""
    suffix = path.rsplit(".", 1)[-1].lower()
    reader = spark.read.option("mode", "FAILFAST") if schema is None else spark.read.schema(schema).option("mode", "FAILFAST")
    if suffix == "csv":
        return reader.option("header", True).option("enforceSchema", False).csv(path)
    if suffix in ("jsonl", "json"):
        return reader.json(path)
    if suffix == "parquet":
        return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    raise ValueError(f"unknown table format: {suffix}")


def video_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, video_url) of a headerless two-column text; TAB, comma or blanks between; duplicates and blanks fail."""
    rows = spark.read.text(path).where(F.trim("value") != "").select(F.split(F.trim("value"), r"[\t,]\s*|\s+", 2).alias("p"))
    df = rows.select(F.trim(F.col("p")[0]).alias("video_id"), F.trim(F.get("p", F.lit(1))).alias("video_url"))
    bad = df.where(F.col("video_url").isNull() | (F.col("video_url") == "") | (F.col("video_id") == "")).limit(1).count()
    if bad or df.groupBy("video_id").count().where("count > 1").limit(1).count():
        raise ValueError("manifest has blank or repeated entries")
    return df


def row_slice(df: DataFrame, start: int, end: int, *order: str) -> DataFrame:
    """Rows at positions [start, end) of the given order, numbered without bringing them together."""
    return ids.next_ids(df, -1, *order, name="_n").where(F.col("_n").between(start, end - 1)).drop("_n")


def video_slice(df: DataFrame, start: int, end: int, key: str = "video_id") -> DataFrame:
    """All rows of the videos at positions [start, end) of the sorted ids."""
    picked = row_slice(df.select(key).distinct(), start, end, key)
    return df.join(picked, key, "left_semi")


def embedding_artifact(spark: SparkSession, path: str, *, status: str = "success") -> DataFrame:
    """Vectors and metadata of an artifact, joined by shard and row."""
    meta = spark.read.parquet(f"{path}/metadata").where(F.col("status") == status)
    if status != "success":
        return meta
    return meta.join(spark.read.parquet(f"{path}/vectors"), ["vector_shard", "vector_row"])


def image_files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = ("jpg", "jpeg", "png", "webp")) -> DataFrame:
    """(path, length) of pictures below a folder, without their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return files.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*suffixes))


def media_paths(videos: DataFrame, *candidates: DataFrame) -> DataFrame:
    """(video_id, media_path): the first candidate table (video_id, media_path) that knows the video."""
    out = videos.select("video_id")
    names = []
    for i, c in enumerate(candidates):
        out = out.join(c.groupBy("video_id").agg(F.min("media_path").alias(f"_p{i}")), "video_id", "left")
        names.append(F.col(f"_p{i}"))
    return out.select("video_id", F.coalesce(*names).alias("media_path"))


def media_stream(spark: SparkSession, path: str, decode, schema: str) -> DataFrame:  # type: ignore[no-untyped-def]
    """Seam for decoders: ``decode(path, content)`` yields rows of the schema for each media file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, c in zip(b["path"], b["content"]):
                yield pd.DataFrame(list(decode(p, c)), columns=[f.split()[0] for f in schema.split(", ")])

    return files.mapInPandas(run, schema)
