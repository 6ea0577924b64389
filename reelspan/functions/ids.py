"""Identity rules of the media model as column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspan.session import stored


def valid_video_id(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\AL\d+_V\d+\z"), F.lit(False))


def official_frame_id(video: Column, n: Column) -> Column:
    """video_NNN; null beyond 15 characters."""
    made = F.format_string("%s_%03d", video, n)
    return F.when(F.length(made) <= 15, made)


def extracted_frame_id(video: Column, seq: Column) -> Column:
    return F.format_string("%s_E%03d", video, seq)


def extracted_seq(frame: Column) -> Column:
    """The number of an extracted frame, or null."""
    return F.nullif(F.regexp_extract(frame, r"_E(\d+)$", 1), F.lit("")).cast("long")


def shot_id(video: Column, index: Column) -> Column:
    return F.format_string("%s_S%03d", video, index)


def clip_id(shot: Column, n: Column) -> Column:
    """LxVySzCnn if the shot id is canonical, n at most 99 and the id at most 15 characters, else a digest."""
    canonical = F.concat(
        F.regexp_extract(shot, r"\A(L\d+)_(V\d+)_(S\d+)\z", 1), F.regexp_extract(shot, r"\A(L\d+)_(V\d+)_(S\d+)\z", 2), F.regexp_extract(shot, r"\A(L\d+)_(V\d+)_(S\d+)\z", 3), F.format_string("C%02d", n)
    )
    digest = F.concat(F.lit("C"), F.upper(F.substring(F.sha1(F.concat(shot, F.lit(":"), n.cast("string"))), 1, 14)))
    return F.when(shot.rlike(r"\AL\d+_V\d+_S\d+\z") & (n <= 99) & (F.length(canonical) <= 15), canonical).otherwise(digest)


def uuid5(*parts: Column, namespace: uuid.UUID = uuid.NAMESPACE_URL) -> Column:
    """Name-based UUID (version 5) of the parts joined by `::`; null parts count as empty."""
    name = F.array_join(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), "::")
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def document_id(source: Column, entity: Column, version: str = "v1") -> Column:
    """source:entity:version."""
    return F.concat(source, F.lit(":"), entity, F.lit(f":{version}"))


def segment_id(video: Column, index: Column) -> Column:
    return F.format_string("%s_%04d", video, index)


def audio_segment_id(video: Column, index: Column) -> Column:
    return F.format_string("%s_shot%04d", video, index)


def next_ids(df: DataFrame, existing_max: int, *order: str, name: str = "row_id") -> DataFrame:
    """Contiguous ids from existing_max + 1, in the given order.

    Rows are range-partitioned, stored once with the number of their partition and counted
    per partition; only the counts are ordered globally, so no task holds all rows, and an
    input that would come out otherwise a second time gives neither gaps nor repeats.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(df.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()), "placed")
    ranked = placed.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    counts = placed.groupBy("_p").count()
    offsets = counts.select("_p", (F.sum("count").over(Window.orderBy("_p")) - F.col("count")).alias("_o"))
    return ranked.join(F.broadcast(offsets), "_p").withColumn(name, (F.col("_o") + F.col("_r") + existing_max).cast("long")).drop("_p", "_r", "_o")
