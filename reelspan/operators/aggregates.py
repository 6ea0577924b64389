"""Aggregations of the model: tracks, coverage, pooling, document bodies, metrics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspan.functions import geometry, text, vectors
from reelspan.operators import blocks


def track_summary(observations: DataFrame, keys: list[str], *, time: str = "timestamp_ms", frame: str = "frame_idx", confidence: str = "confidence") -> DataFrame:
    """One row per track: first and last time and frame, observations, mean confidence; it lasts at least 1 ms."""
    return observations.groupBy(*keys).agg(
        F.min(time).alias("start_ms"),
        F.greatest(F.max(time), F.min(time) + 1).alias("end_ms"),
        F.min_by(frame, time).alias("start_frame_idx"),
        F.max_by(frame, time).alias("end_frame_idx"),
        F.count("*").alias("observation_count"),
        F.avg(confidence).alias("average_confidence"),
    )


def coverage_weights(clips: DataFrame, *, shot: str = "shot_id", clip: str = "clip_id") -> DataFrame:
    """(shot, clip, weight): the time a clip covers, shared evenly where clips overlap.

    The elementary stretches between neighbouring bounds of a shot are joined to the clips
    that span them by the bound they start at, listed per clip in time buckets of the shot.
    """
    c = clips.where(F.col("end_ms") > F.col("start_ms")).select(shot, clip, "start_ms", "end_ms")
    bounds = c.select(shot, F.explode(F.array("start_ms", "end_ms")).alias("a")).distinct()
    parts = bounds.withColumn("b", F.lead("a").over(Window.partitionBy(shot).orderBy("a"))).where("b IS NOT NULL")
    size = 16_384
    listed = c.withColumn("_k", F.explode(F.sequence(F.floor(F.col("start_ms") / F.lit(size)), F.floor((F.col("end_ms") - 1) / F.lit(size)))))
    spans = parts.withColumn("_k", F.floor(F.col("a") / F.lit(size))).join(listed, [shot, "_k"]).where("start_ms <= a AND b <= end_ms")
    shared = spans.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(shot, "a")))
    return shared.groupBy(shot, clip).agg(F.sum((F.col("b") - F.col("a")) / F.col("_n")).alias("weight"))


def overlap_flags(clips: DataFrame, part: str) -> DataFrame:
    """(part, has_overlap): whether any interval begins before all earlier ones have ended."""
    w = Window.partitionBy(part).orderBy("start_ms", "end_ms").rowsBetween(Window.unboundedPreceding, -1)
    return clips.withColumn("_seen", F.max("end_ms").over(w)).groupBy(part).agg(F.coalesce(F.bool_or(F.col("start_ms") < F.col("_seen")), F.lit(False)).alias("has_overlap"))


def pooled_shots(clips: DataFrame, vectors_df: DataFrame, *, overlapping_by_coverage: bool = True) -> DataFrame:
    """(shot_id, pooled): mean of clip vectors weighted by coverage (or duration), scaled to length 1."""
    if overlapping_by_coverage:
        w = coverage_weights(clips)
    else:
        w = clips.select("shot_id", "clip_id", (F.col("end_ms") - F.col("start_ms")).cast("double").alias("weight"))
    return vectors.mean_pool(w.join(vectors_df, "clip_id"), ["shot_id"], "vector", weight=F.col("weight"))


def ocr_bodies(ocr: DataFrame, *, frame: str = "frame_id") -> DataFrame:
    """Per frame: the texts in order of n as one content, the regions as an array, the first language given."""
    kept = ocr.where(text.non_blank(F.col("text")).isNotNull() & F.col("x_min").between(0, 1) & F.col("x_max").between(0, 1) & F.col("y_min").between(0, 1) & F.col("y_max").between(0, 1) & (F.col("x_min") <= F.col("x_max")) & (F.col("y_min") <= F.col("y_max")))
    region = F.struct("n", F.trim("text").alias("text"), "language", "x_min", "x_max", "y_min", "y_max")
    body = kept.groupBy(frame).agg(F.array_sort(F.collect_list(region)).alias("regions"))
    languages = F.filter(F.transform("regions", lambda r: text.non_blank(r["language"])), lambda x: x.isNotNull())
    return body.select(frame, F.array_join(F.transform("regions", lambda r: r["text"]), "\n").alias("content"), F.get(languages, F.lit(0)).alias("language"), "regions")


def status_counts(df: DataFrame, status: str = "status", states: tuple[str, ...] = ("inserted", "updated", "unchanged")) -> DataFrame:
    """One row with the number of rows in each state."""
    return df.agg(*[F.count_if(F.col(status) == s).alias(s) for s in states])


def norm_stats(df: DataFrame, vector: str, *groups: str) -> DataFrame:
    """Rows, and mean, least and greatest length of vectors."""
    return df.withColumn("_l", vectors.norm(F.col(vector))).groupBy(*groups).agg(F.count("*").alias("rows"), F.avg("_l").alias("mean_norm"), F.min("_l").alias("min_norm"), F.max("_l").alias("max_norm"))


def sample_summary(samples: DataFrame, *columns: str) -> DataFrame:
    """Greatest and mean value of text columns of measurements; what does not parse is left out."""
    out = []
    for c in columns:
        v = F.col(c).try_cast("double")
        out += [F.max(v).alias(f"max_{c}"), F.avg(v).alias(f"avg_{c}")]
    return samples.agg(*out)


def dedup_ratio(df: DataFrame, part: list[str], value: str) -> DataFrame:
    """(part, ratio): 1 - distinct / all; 0 for none."""
    return df.groupBy(*part).agg((F.lit(1.0) - F.count_distinct(value) / F.count(value)).alias("ratio")).withColumn("ratio", F.coalesce("ratio", F.lit(0.0)))


def timestamp_owners(df: DataFrame, part: list[str], time: str, owner: str) -> DataFrame:
    """(part, time, owners): which owners ask for a timestamp, in order."""
    return df.groupBy(*part, time).agg(F.array_sort(F.collect_set(owner)).alias("owners"))


def recall_at_k(ranked: DataFrame, relevant: DataFrame, k: int, *, query: str = "query_id", item: str = "item_id", rank: str = "rank") -> DataFrame:
    """One row: share of queries with a relevant item among the first k; 0 without queries."""
    hits = ranked.where(F.col(rank) <= k).join(relevant.select(query, item).distinct().withColumn("_hit", F.lit(1)), [query, item], "left")
    per = hits.groupBy(query).agg(F.max(F.coalesce("_hit", F.lit(0))).alias("_h"))
    return per.agg(F.coalesce(F.avg("_h"), F.lit(0.0)).alias("recall"))


def mean_reciprocal_rank(ranked: DataFrame, relevant: DataFrame, *, query: str = "query_id", item: str = "item_id", rank: str = "rank") -> DataFrame:
    """One row: mean over queries of 1 / rank of the first relevant item, 0 where there is none."""
    hits = ranked.join(relevant.select(query, item).distinct().withColumn("_hit", F.lit(1)), [query, item], "left")
    per = hits.groupBy(query).agg(F.coalesce(1.0 / F.min(F.when(F.col("_hit") == 1, F.col(rank))), F.lit(0.0)).alias("_r"))
    return per.agg(F.coalesce(F.avg("_r"), F.lit(0.0)).alias("mrr"))


def single_value(df: DataFrame, *columns: str) -> DataFrame:
    """One row: the value of each column if all rows agree on it, else null."""
    return df.agg(*[F.when(F.count_distinct(c) == 1, F.max(c)).alias(c) for c in columns])


def color_histogram(pixels: DataFrame, key: str) -> DataFrame:
    """(key, bin, share, bins): 8 x 8 x 8 histogram over h, s, v columns (0..255), scaled to length 1."""
    code = lambda c: F.least(F.floor(F.col(c) / F.lit(32)), F.lit(7))
    counted = pixels.groupBy(key, (code("h") * 64 + code("s") * 8 + code("v")).alias("bin")).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(key)
    return counted.select(key, "bin", (F.col("_c") / F.sqrt(F.sum(F.col("_c") * F.col("_c")).over(w))).alias("share"), F.count(F.lit(1)).over(w).alias("bins"))


def any_speech(frames: DataFrame, key: str, flag: Column) -> DataFrame:
    """(key, has_speech)."""
    return frames.groupBy(key).agg(F.bool_or(flag).alias("has_speech"))


def median_heights(df: DataFrame, key: str, box: geometry.Box) -> DataFrame:
    return df.groupBy(key).agg(F.median(box.y2 - box.y1).alias("median_height"))


def silhouette(points: DataFrame, *, part: str, point: str, cluster: str, vector: str, rows: int = 4_000) -> DataFrame:
    """(part, silhouette): mean silhouette of clustered points per part.

    A point alone in its cluster has distance 0 within it. A part of one cluster, or of as
    many clusters as points, scores minus infinity. Points are compared in blocks of
    about ``rows``; a task passes on one sum per point and cluster. Null vectors take no part.
    """
    src = points.where(F.col(vector).isNotNull()).select(F.col(part).alias("_name"), F.xxhash64(part).alias("_part"), F.col(point).cast("long").alias("_p"), F.xxhash64(cluster).alias("_c"), F.col(vector).cast("array<double>").alias("_v"))

    def sums(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"_part": [], "_p": [], "_c": [], "_d": [], "_s": [], "_n": []})
        x, y = np.stack(a["_v"].to_numpy()), np.stack(b["_v"].to_numpy())
        names, code = np.unique(b["_c"].to_numpy(), return_inverse=True)
        one = np.zeros((len(b), len(names)))
        one[np.arange(len(b)), code] = 1
        total = np.zeros((len(a), len(names)))
        for s in range(0, len(a), 256):
            square = (x[s : s + 256] ** 2).sum(1)[:, None] + (y**2).sum(1) - 2 * x[s : s + 256] @ y.T
            total[s : s + 256] = np.sqrt(np.maximum(square, 0)) @ one
        n = len(names)
        rep = lambda c: np.repeat(a[c].to_numpy(), n)
        return pd.DataFrame({"_part": rep("_part"), "_p": rep("_p"), "_c": rep("_c"), "_d": np.tile(names, len(a)), "_s": total.ravel(), "_n": np.tile(one.sum(0), len(a))})

    bare = src.drop("_name")
    per_block = blocks.in_blocks(bare, bare, sums, "_part long, _p long, _c long, _d long, _s double, _n double", left_id="_p", right_id="_p", on=("_part",), rows=rows)
    dist = per_block.groupBy("_part", "_p", "_c", "_d").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    own = F.when(F.col("_c") == F.col("_d"), F.when(F.col("_n") > 1, F.col("_s") / (F.col("_n") - 1)).otherwise(F.lit(0.0)))
    other = F.when(F.col("_c") != F.col("_d"), F.col("_s") / F.col("_n"))
    per = dist.groupBy("_part", "_p").agg(F.max(own).alias("_a"), F.min(other).alias("_b"), F.count("*").alias("_k"))
    longest = F.greatest("_a", "_b")
    score = F.when(longest == 0, F.lit(0.0)).otherwise((F.col("_b") - F.col("_a")) / longest)
    mean = per.groupBy("_part").agg(F.avg(score).alias("_m"), F.max("_k").alias("_k"), F.count("*").alias("_n"))
    none = (F.col("_k") < 2) | (F.col("_k") >= F.col("_n"))
    named = mean.join(src.select("_part", "_name").distinct(), "_part")
    return named.select(F.col("_name").alias(part), F.when(none, F.lit(float("-inf"))).otherwise(F.col("_m")).alias("silhouette"))
