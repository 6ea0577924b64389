"""Joins the model needs beyond equality: ranges, nearest in time, positions, chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_range_join(points: DataFrame, intervals: DataFrame, *, key: str, time: str, start: str, end: str, bucket_ms: int = 16_384) -> DataFrame:
    """Points with every interval of the same key that holds them (start <= time < end).

    Intervals are listed in the time buckets they touch, so the join is an equality join on
    (key, bucket), which also spreads a hot key over its timeline. Both sides must not
    share other column names.
    """
    lo, hi = F.floor(F.col(start) / F.lit(bucket_ms)), F.floor((F.col(end) - 1) / F.lit(bucket_ms))
    listed = intervals.where(F.col(end) > F.col(start)).withColumn("_b", F.explode(F.sequence(lo, hi)))
    placed = points.where(F.col(time).isNotNull()).withColumn("_b", F.floor(F.col(time) / F.lit(bucket_ms)))
    return placed.join(listed, [key, "_b"]).where((F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))).drop("_b")


def assign_single(points: DataFrame, intervals: DataFrame, *, point_id: str, key: str, time: str, start: str, end: str, interval_id: str) -> DataFrame:
    """Points with the one interval that holds them; ``ambiguous`` where several do, ``unmatched`` where none does."""
    held = bucket_range_join(points.select(point_id, key, time), intervals.select(key, interval_id, start, end), key=key, time=time, start=start, end=end)
    per = held.groupBy(point_id).agg(F.count("*").alias("_n"), F.min(interval_id).alias("_i"))
    out = points.join(per, point_id, "left")
    return out.withColumn("assigned", F.when(F.col("_n") == 1, F.col("_i"))).withColumn("status", F.when(F.col("_n") == 1, "assigned").when(F.col("_n") > 1, "ambiguous").otherwise("unmatched")).drop("_n", "_i")


def nearest_within(left: DataFrame, right: DataFrame, *, key: str, left_id: list[str], left_time: str, right_time: str, right_id: str, tolerance_ms: int) -> DataFrame:
    """Left rows with their nearest right row at most ``tolerance_ms`` away: left_id, right_id, distance_ms.

    Equality join on (key, bucket of the tolerance), right rows listed in three buckets;
    ties go to the earlier row, then the smaller id.
    """
    b = max(1, tolerance_ms)
    r = right.where(F.col(right_time).isNotNull()).select(key, F.col(right_time).alias("_rt"), F.col(right_id).alias("_rid"))
    r = r.groupBy(key, "_rt").agg(F.min("_rid").alias("_rid")).withColumn("_b", F.explode(F.array(*[F.floor(F.col("_rt") / F.lit(b)) + i for i in (-1, 0, 1)])))
    placed = left.where(F.col(left_time).isNotNull()).select(key, *left_id, F.col(left_time).alias("_lt")).distinct().withColumn("_b", F.floor(F.col("_lt") / F.lit(b)))
    near = placed.join(r, [key, "_b"]).withColumn("_d", F.abs(F.col("_lt") - F.col("_rt"))).where(F.col("_d") <= tolerance_ms)
    best = near.groupBy(*left_id).agg(F.min(F.struct("_d", "_rt", "_rid")).alias("_m"))
    return best.select(*left_id, F.col("_m._rid").alias(right_id), F.col("_m._d").alias("distance_ms"))


def positional_join(vectors: DataFrame, references: DataFrame, *, key: str, pos: str, n: str) -> DataFrame:
    """Vector row i (from 0) with the reference numbered n = i + 1."""
    return vectors.withColumn(n, F.col(pos) + 1).join(references, [key, n])


def pending(entities: DataFrame, done: DataFrame, key: str, **where: object) -> DataFrame:
    """Entities without a finished row for the given version columns."""
    for name, value in where.items():
        done = done.where(F.col(name) == F.lit(value))
    return entities.join(done.select(key).distinct(), key, "left_anti")


def missing_parents(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys of the child that the parent lacks."""
    return child.where(F.col(key).isNotNull()).select(key).distinct().join(parent.select(key).distinct(), key, "left_anti")


def require_parents(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """The child rows, after a check that every key has a parent; raises with up to 10 missing keys."""
    gone = [r[0] for r in missing_parents(child, parent, key).orderBy(key).limit(10).collect()]
    if gone:
        raise ValueError(f"missing {key}: {gone}")
    return child


def retained(rows: DataFrame, kept: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are among the kept ones."""
    return rows.join(kept.select(*keys).distinct(), list(keys), "left_semi")


def left_or_failure(shots: DataFrame, clips: DataFrame, key: str, reason: str = "no_clip_vectors") -> DataFrame:
    """Shots joined with their clips; ``failure`` names the reason where there is none."""
    marked = clips.withColumn("_hit", F.lit(True))
    return shots.join(marked, key, "left").withColumn("failure", F.when(F.col("_hit").isNull(), reason)).drop("_hit")


def chained_video_id(df: DataFrame, frames: DataFrame, shots: DataFrame, clips: DataFrame) -> DataFrame:
    """``video_id`` of rows with one of frame_id, shot_id, clip_id: by frame, by shot, or by the clip's shot."""
    f = frames.select(F.col("frame_id"), F.col("video_id").alias("_vf"))
    s = shots.select(F.col("shot_id"), F.col("video_id").alias("_vs"))
    c = clips.select("clip_id", F.col("shot_id").alias("_cs")).join(shots.select(F.col("shot_id").alias("_cs"), F.col("video_id").alias("_vc")), "_cs").drop("_cs")
    return df.join(f, "frame_id", "left").join(s, "shot_id", "left").join(c, "clip_id", "left").withColumn("video_id", F.coalesce("_vf", "_vs", "_vc")).drop("_vf", "_vs", "_vc")


def hamming_pairs(rows: DataFrame, *, key: str, row_id: str, hash_col: str, limit: int) -> DataFrame:
    """(key, a, b, bits, copies_a, copies_b): pairs of different 64-bit hashes of a key within ``limit`` bits.

    A hash stands for all rows that have it: a and b are its smallest ids, ``copies`` says
    how many rows there are. Hashes within the limit agree in at least one of limit + 1 bit
    stretches, so only these are joined; no key is compared pair by pair.
    """
    classes = rows.groupBy(key, hash_col).agg(F.min(row_id).alias("_id"), F.count("*").alias("_n"))
    cuts = [64 * i // (limit + 1) for i in range(limit + 2)]
    bands = F.array(*[F.shiftrightunsigned(F.shiftleft(hash_col, 64 - hi), 64 - hi + lo) for lo, hi in zip(cuts, cuts[1:])])
    listed = classes.select(key, "_id", "_n", F.col(hash_col).alias("_h"), F.posexplode(bands).alias("_band", "_value"))
    a, b = (listed.select(key, "_band", "_value", *[F.col(c).alias(f"{c}_{x}") for c in ("_id", "_n", "_h")]) for x in ("a", "b"))
    differing = F.bit_count(F.col("_h_a").bitwiseXOR(F.col("_h_b"))).cast("int")
    near = a.join(b, [key, "_band", "_value"]).where("_id_a < _id_b").withColumn("bits", differing).where(F.col("bits") <= limit)
    return near.select(key, F.col("_id_a").alias("a"), F.col("_id_b").alias("b"), "bits", F.col("_n_a").alias("copies_a"), F.col("_n_b").alias("copies_b")).distinct()


def key_conflicts(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that stand on several rows, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def first_arrivals(df: DataFrame, *keys: str, time: str = "ingested_at") -> DataFrame:
    """One row per key, the first to arrive; repeated deliveries drop out."""
    w = Window.partitionBy(*keys).orderBy(F.col(time).asc_nulls_last())
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def current_rows(df: DataFrame, *keys: str, time: str = "ingested_at", deleted: str = "deleted_at") -> DataFrame:
    """The latest row per key, without withdrawn ones."""
    w = Window.partitionBy(*keys).orderBy(F.col(time).desc_nulls_last(), F.col(deleted).desc_nulls_last())
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").where(F.col(deleted).isNull()).drop("_n")


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, with ``side`` (left or right)."""
    x, y = a.select(key).distinct().withColumn("_a", F.lit(1)), b.select(key).distinct().withColumn("_b", F.lit(1))
    return x.join(y, key, "full").where(F.col("_a").isNull() | F.col("_b").isNull()).select(key, F.when(F.col("_b").isNull(), "left").otherwise("right").alias("side"))


def upsert_status(incoming: DataFrame, existing: DataFrame, key: str, values: list[str], identity: list[str] = ()) -> DataFrame:  # type: ignore[assignment]
    """Incoming rows with ``status``: inserted, updated, unchanged, or conflict where an identity column differs."""
    old = existing.select(F.col(key), *[F.col(c).alias(f"_old_{c}") for c in dict.fromkeys([*values, *identity])], F.lit(True).alias("_there"))
    same = F.lit(True)
    for c in values:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    clash = F.lit(False)
    for c in identity:
        clash = clash | ~F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    status = F.when(F.col("_there").isNull(), "inserted").when(clash, "conflict").when(same, "unchanged").otherwise("updated")
    return incoming.join(old, key, "left").withColumn("status", status).drop("_there", *[f"_old_{c}" for c in dict.fromkeys([*values, *identity])])


def observations_from_detections(links: DataFrame, detections: DataFrame, frames: DataFrame) -> DataFrame:
    """Observations of tracks from links (track_id, detection_id), detections and frames.

    Two observations of a track in one frame stop the job before anything is returned.
    """
    d = detections.select("detection_id", "frame_id", "confidence", "x_min", "x_max", "y_min", "y_max")
    f = frames.select("frame_id", "frame_idx", "timestamp_ms")
    rows = links.select("track_id", "detection_id").join(d, "detection_id").join(f, "frame_id")
    clash = [tuple(r)[:2] for r in key_conflicts(rows, "track_id", "frame_idx").limit(10).collect()]
    if clash:
        raise ValueError(f"several observations of a track in one frame: {clash}")
    return rows.select("track_id", "frame_idx", "timestamp_ms", "confidence", "x_min", "x_max", "y_min", "y_max")
