"""Timeline operators: scenes, shots, clip windows, sampling, sessions, chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspan.functions import ids
from reelspan.operators.stretches import Placed


def milliseconds(seconds: Column) -> Column:
    """Seconds as milliseconds, half to even."""
    return F.bround(seconds * 1000).cast("long")


def frame_ms(frame: Column, fps: Column) -> Column:
    return F.bround(frame / fps * 1000).cast("long")


def scene_islands(scores: DataFrame, *, video: str = "video_id", frame: str = "frame_idx", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """(video, start_frame_idx, end_frame_idx): runs of frames without transition.

    Scores above the threshold are transitions; a run followed by a transition takes that
    frame too. A video of transitions only is one scene.
    """
    flagged = scores.select(video, F.col(frame).alias("_f"), (F.col(score) > threshold).alias("_t"))
    marked = Placed(flagged.withColumn("_one", F.col("_t").cast("int")), [video], ["_f"])
    scenes = marked.running("_one", "_run").result().where(~F.col("_t")).groupBy(video, "_run").agg(F.min("_f").alias("start_frame_idx"), F.max("_f").alias("_b"))
    last = flagged.groupBy(video).agg(F.max("_f").alias("_last"))
    scenes = scenes.join(last, video).select(video, "start_frame_idx", F.least(F.col("_b") + 1, F.col("_last")).alias("end_frame_idx"))
    whole = flagged.groupBy(video).agg(F.min("_f").alias("start_frame_idx"), F.max("_f").alias("end_frame_idx"), F.bool_and("_t").alias("_all"))
    return scenes.unionByName(whole.where("_all").drop("_all"))


def scene_shots(scenes: DataFrame, fps: Column, *, video: str = "video_id") -> DataFrame:
    """Scenes with half-open start_ms and end_ms; a shot lasts at least 1 ms."""
    start = frame_ms(F.col("start_frame_idx"), fps)
    return scenes.withColumn("start_ms", start).withColumn("end_ms", F.greatest(frame_ms(F.col("end_frame_idx") + 1, fps), start + 1))


def merge_short_shots(shots: DataFrame, min_ms: int = 500, *, video: str = "video_id") -> DataFrame:
    """Shots below ``min_ms`` join the one before; a short first group joins the next. Renumbered with ids."""
    spans = [f(n).alias(n) for f, n in ((F.min, "start_ms"), (F.max, "end_ms"), (F.min, "start_frame_idx"), (F.max, "end_frame_idx"))]
    own = shots.withColumn("_own", (F.col("end_ms") - F.col("start_ms") >= min_ms).cast("int"))
    # group 0: the short shots ahead of the first long one, if any
    grouped = Placed(own, [video], ["start_frame_idx"]).running("_own", "_g").result().groupBy(video, "_g").agg(*spans)
    ahead = grouped.where("_g <= 1").groupBy(video).agg(F.max(F.when(F.col("_g") == 0, F.col("end_ms") - F.col("start_ms"))).alias("_ahead"), F.max("_g").alias("_next"))
    first = ahead.select(video, ((F.col("_ahead") < min_ms) & (F.col("_next") == 1)).alias("_join"), F.when(F.col("_ahead").isNull() | ((F.col("_ahead") < min_ms) & (F.col("_next") == 1)), 1).otherwise(0).alias("_base"))
    moved = grouped.join(first, video).withColumn("_g", F.when((F.col("_g") == 0) & F.col("_join"), 1).otherwise(F.col("_g")))
    numbered = moved.groupBy(video, "_g", "_base").agg(*spans).withColumn("shot_index", (F.col("_g") - F.col("_base")).cast("int")).drop("_g", "_base")
    return numbered.withColumn("shot_id", ids.shot_id(F.col(video), F.col("shot_index")))


def clip_starts(start: Column, end: Column, *, split_ms: int = 10_000, window_ms: int = 10_000, stride_ms: int = 8_000, min_gap_ms: int = 2_000) -> Column:
    """Start times of the clip windows of [start, end): strided windows with an aligned tail.

    A tail closer than ``min_gap_ms`` to the last strided window replaces it.
    """
    dur = end - start
    n = F.ceil((dur - window_ms) / F.lit(stride_ms)).cast("long")
    tail = dur - window_ms
    keep_all = (n <= 1) | (tail - (n - 1) * stride_ms >= min_gap_ms)
    strided = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(F.when(keep_all, n - 1).otherwise(n - 2), F.lit(0))), lambda k: k * stride_ms)
    offsets = F.when(dur <= split_ms, F.array(F.lit(0).cast("long"))).otherwise(F.concat(strided, F.array(tail.cast("long"))))
    return F.transform(offsets, lambda o: start + o)


def clip_windows(shots: DataFrame, *, split_ms: int = 10_000, window_ms: int = 10_000, stride_ms: int = 8_000, min_gap_ms: int = 2_000) -> DataFrame:
    """Shots with clip_no (from 1), clip_start_ms, clip_end_ms; a shot gives at least one clip."""
    starts = clip_starts(F.col("start_ms"), F.col("end_ms"), split_ms=split_ms, window_ms=window_ms, stride_ms=stride_ms, min_gap_ms=min_gap_ms)
    out = shots.select("*", F.posexplode(starts).alias("_k", "clip_start_ms"))
    whole = F.col("end_ms") - F.col("start_ms") <= split_ms
    return out.withColumn("clip_no", F.col("_k") + 1).withColumn("clip_end_ms", F.when(whole, F.col("end_ms")).otherwise(F.col("clip_start_ms") + window_ms)).drop("_k")


def clip_frames(clips: DataFrame) -> DataFrame:
    """Clips with frame bounds interpolated linearly within the shot, ids and effective rate."""
    span_ms, span_f = F.col("end_ms") - F.col("start_ms"), F.col("end_frame_idx") - F.col("start_frame_idx")
    at = lambda ms: (F.col("start_frame_idx") + F.bround((ms - F.col("start_ms")) * span_f / span_ms)).cast("long")
    out = clips.withColumn("clip_start_frame", at(F.col("clip_start_ms"))).withColumn("clip_end_frame", at(F.col("clip_end_ms")))
    return out.withColumn("sampling_fps", span_f * 1000.0 / span_ms).withColumn("clip_id", ids.clip_id(F.col("shot_id"), F.col("clip_no")))


def scale_type(clip_start: Column, clip_end: Column, shot_start: Column, shot_end: Column) -> Column:
    return F.when((clip_start == shot_start) & (clip_end == shot_end), "full_shot").otherwise("fixed_window")


def midpoints(start: Column, end: Column, n: Column) -> Column:
    """n timestamps at the middle of n equal parts, below ``end``."""
    return F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.least((start + (i + F.lit(0.5)) * (end - start) / n).cast("long"), end - 1))


def rate_gate(frames: DataFrame, *, part: str, time: str, start: str, interval_ms: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """The first frame of each interval, counted from the start of its part."""
    bucket = F.floor((F.col(time) - F.col(start)) / F.lit(interval_ms))
    w = Window.partitionBy(part, bucket).orderBy(time, *ties)
    return frames.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def gap_groups(df: DataFrame, part: list[str], time: str, max_gap_ms: int) -> DataFrame:
    """``group_no`` from 0: a new group begins after a gap above ``max_gap_ms``."""
    placed = Placed(df, part, [time]).previous(time, "_before")
    placed.rows = placed.rows.withColumn("_o", F.coalesce((F.col(time) - F.col("_before") > max_gap_ms).cast("int"), F.lit(0)))
    return placed.running("_o", "group_no").result().drop("_o", "_before")


def evenly_picked(df: DataFrame, part: list[str], order: list[str], k: int) -> DataFrame:
    """At most k rows a part, evenly spread, first and last included."""
    rows = Placed(df, part, order).numbered("_i", total="_n").result().withColumn("_i", (F.col("_i") - 1).cast("int"))
    spots = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / F.lit(max(k - 1, 1))).cast("int"))
    kept = (F.col("_n") <= k) | (F.lit(k > 1) & F.array_contains(spots, F.col("_i"))) | (F.lit(k == 1) & (F.col("_i") == 0))
    return rows.where(kept).drop("_i", "_n")


def chunks(df: DataFrame, part: list[str], order: list[str], size: int, name: str = "unit_no") -> DataFrame:
    """Rows in order, in units of ``size``, numbered from 0 per part."""
    return Placed(df, part, order).numbered(name).result().withColumn(name, F.floor((F.col(name) - 1) / F.lit(size)).cast("long"))


def model_windows(frames: DataFrame, *, video: str = "video_id", frames_col: str = "n_frames", size: int = 100, hop: int = 50, context: int = 25) -> DataFrame:
    """Windows of a frame sequence: hop frames with context on both sides; ends repeat edge frames."""
    count = F.ceil(F.col(frames_col) / F.lit(hop)).cast("long")
    out = frames.where(F.col(frames_col) > 0).select("*", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("window_no"))
    first = F.col("window_no") * hop - context
    limit = lambda x: F.least(F.greatest(x, F.lit(0)), F.col(frames_col) - 1)
    return (
        out.withColumn("first_frame", limit(first))
        .withColumn("last_frame", limit(first + size - 1))
        .withColumn("left_repeats", F.greatest(-first, F.lit(0)))
        .withColumn("right_repeats", F.greatest(first + size - F.col(frames_col), F.lit(0)))
        .withColumn("kept_first", F.col("window_no") * hop)
        .withColumn("kept_last", F.least((F.col("window_no") + 1) * hop, F.col(frames_col)) - 1)
    )


def adjacent_gaps(df: DataFrame, part: str, start: str = "start_ms", end: str = "end_ms", ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose end is not the start of the next row of the part, with ``next_start``."""
    return Placed(df, [part], [start, end, *ties]).following(start, "next_start").result().where(F.col("next_start") != F.col(end))


def order_violations(shots: DataFrame, part: str = "video_id") -> DataFrame:
    """Shots that begin before the one ahead of them ends, or do not last."""
    return Placed(shots, [part], ["start_ms", "shot_id"]).previous("end_ms", "previous_end").result().where((F.col("start_ms") < F.col("previous_end")) | (F.col("end_ms") <= F.col("start_ms")))


def window_faults(clips: DataFrame, shots: DataFrame, max_ms: int) -> DataFrame:
    """Shots whose clip windows break a rule: cover, order, gap or length."""
    w = Window.partitionBy("shot_id").orderBy("start_ms", "end_ms")
    c = clips.select("shot_id", "start_ms", "end_ms", F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_seen"))
    per = c.groupBy("shot_id").agg(
        F.min("start_ms").alias("_s"), F.max("end_ms").alias("_e"), F.bool_or(F.col("start_ms") > F.col("_seen")).alias("has_gap"), F.bool_or(F.col("end_ms") - F.col("start_ms") > max_ms).alias("too_long")
    )
    s = shots.select("shot_id", F.col("start_ms").alias("_a"), F.col("end_ms").alias("_b"))
    joined = s.join(per, "shot_id")
    return joined.select(
        "shot_id", ((F.col("_s") != F.col("_a")) | (F.col("_e") != F.col("_b"))).alias("not_covered"), F.coalesce("has_gap", F.lit(False)).alias("has_gap"), "too_long"
    ).where("not_covered OR has_gap OR too_long")


def coalesce_transcripts(items: DataFrame, part: str, order: str, *, text: str = "text", start: str = "start_ms", end: str = "end_ms", min_words: int = 8) -> DataFrame:
    """Short items are joined with the following ones until ``min_words`` words; a short rest is kept.

    A fold over the ordered items of each part inside the JVM.
    """
    item = F.struct(F.col(order).alias("o"), F.col(start).alias("s"), F.col(end).alias("e"), F.trim(text).alias("t"), F.size(F.split(F.trim(text), r"\s+")).alias("n"))
    kind = "struct<out:array<struct<s:bigint,e:bigint,t:string>>,s:bigint,e:bigint,t:string,n:int>"
    zero = F.expr(f"CAST(named_struct('out', array(), 's', NULL, 'e', NULL, 't', NULL, 'n', 0) AS {kind})")

    def step(acc: Column, x: Column) -> Column:
        text_ = F.when(acc["n"] > 0, F.concat(acc["t"], F.lit(" "), x["t"])).otherwise(x["t"])
        begin = F.when(acc["n"] > 0, acc["s"]).otherwise(x["s"])
        full = acc["n"] + x["n"] >= min_words
        done = F.concat(acc["out"], F.array(F.struct(begin.alias("s"), x["e"].alias("e"), text_.alias("t"))))
        return F.struct(
            F.when(full, done).otherwise(acc["out"]).alias("out"), F.when(~full, begin).alias("s"), F.when(~full, x["e"]).alias("e"), F.when(~full, text_).alias("t"), F.when(full, 0).otherwise(acc["n"] + x["n"]).cast("int").alias("n")
        ).cast(kind)

    def finish(acc: Column) -> Column:
        return F.when(acc["n"] > 0, F.concat(acc["out"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e"), acc["t"].alias("t"))))).otherwise(acc["out"])

    rows = items.where(F.trim(text) != "").groupBy(part).agg(F.array_sort(F.collect_list(item)).alias("_all"))
    return rows.select(part, F.posexplode(F.aggregate("_all", zero, step, finish)).alias("segment_no", "_x")).select(part, "segment_no", F.col("_x.s").alias("start_ms"), F.col("_x.e").alias("end_ms"), F.col("_x.t").alias("text"))
