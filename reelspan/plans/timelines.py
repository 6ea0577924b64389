"""Timeline queries: clip windows, scenes, sampling, sessions, joins in time, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.operators import aggregates, joins
from reelspan.operators import timeline as tl
from reelspan.plans import common as c
from reelspan.session import table

_Q: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):  # type: ignore[no-untyped-def]
    def add(f):  # type: ignore[no-untyped-def]
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


_WINDOWS = f"""
  s AS (SELECT *, end_ms - start_ms AS dur, CAST(ceil((end_ms - start_ms - 10000) / 8000.0) AS BIGINT) AS n FROM {c.SOUND_SHOTS}),
  k AS (SELECT *, CASE WHEN dur <= 10000 THEN [0] ELSE list_append(list_transform(range(CASE WHEN n <= 1 OR dur - 10000 - (n - 1) * 8000 >= 2000 THEN n ELSE n - 1 END), lambda x: x * 8000), dur - 10000) END AS offs FROM s),
  w AS (SELECT * EXCLUDE (offs), unnest(offs) AS o, unnest(range(1, len(offs) + 1)) AS clip_no FROM k),
  win AS (SELECT *, start_ms + o AS clip_start_ms, CASE WHEN dur <= 10000 THEN end_ms ELSE start_ms + o + 10000 END AS clip_end_ms FROM w)
"""


@_query(f"WITH {_WINDOWS} SELECT shot_id, CAST(clip_no AS INTEGER) AS clip_no, clip_start_ms, clip_end_ms FROM win")
def clip_windows(spark: SparkSession, d: str) -> DataFrame:
    return tl.clip_windows(c.sound_shots(spark, d)).select("shot_id", "clip_no", "clip_start_ms", "clip_end_ms")


@_query(f"WITH {_WINDOWS} SELECT video_id, count(*) AS clips, CAST(sum(clip_end_ms - clip_start_ms) AS BIGINT) AS total_ms FROM win GROUP BY 1")
def clip_window_counts(spark: SparkSession, d: str) -> DataFrame:
    w = tl.clip_windows(c.sound_shots(spark, d))
    return w.groupBy("video_id").agg(F.count("*").alias("clips"), F.sum(F.col("clip_end_ms") - F.col("clip_start_ms")).alias("total_ms"))


@_query(
    f"""WITH {_WINDOWS} SELECT shot_id, CAST(clip_no AS INTEGER) AS clip_no,
    CAST(start_frame_idx + round_even((clip_start_ms - start_ms) * (end_frame_idx - start_frame_idx) / CAST(dur AS DOUBLE), 0) AS BIGINT) AS clip_start_frame,
    CAST(start_frame_idx + round_even((clip_end_ms - start_ms) * (end_frame_idx - start_frame_idx) / CAST(dur AS DOUBLE), 0) AS BIGINT) AS clip_end_frame,
    CASE WHEN regexp_full_match(shot_id, 'L[0-9]+_V[0-9]+_S[0-9]+') AND clip_no <= 99 AND length(replace(shot_id, '_', '') || 'C' || lpad(CAST(clip_no AS VARCHAR), 2, '0')) <= 15 THEN replace(shot_id, '_', '') || 'C' || lpad(CAST(clip_no AS VARCHAR), 2, '0')
      ELSE 'C' || upper(substr(sha1(shot_id || ':' || clip_no), 1, 14)) END AS clip_id FROM win"""
)
def clip_frame_bounds(spark: SparkSession, d: str) -> DataFrame:
    return tl.clip_frames(tl.clip_windows(c.sound_shots(spark, d))).select("shot_id", "clip_no", "clip_start_frame", "clip_end_frame", "clip_id")


_MID = f"""m AS (SELECT clip_id, video_id, unnest(range(target_num_frames)) AS pos, start_ms, end_ms, target_num_frames AS n FROM {c.SOUND_CLIPS} WHERE target_num_frames > 0),
  t AS (SELECT clip_id, video_id, pos, least(CAST(floor(start_ms + (pos + CAST(0.5 AS DOUBLE)) * (end_ms - start_ms) / n) AS BIGINT), end_ms - 1) AS ts FROM m)"""


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return c.sound_clips(spark, d).where("target_num_frames > 0").select("clip_id", "video_id", F.posexplode(tl.midpoints(F.col("start_ms"), F.col("end_ms"), F.col("target_num_frames"))).alias("pos", "ts"))


@_query(f"WITH {_MID} SELECT clip_id, CAST(pos AS INTEGER) AS pos, ts FROM t")
def midpoint_samples(spark: SparkSession, d: str) -> DataFrame:
    return _samples(spark, d).select("clip_id", "pos", "ts")


@_query(f"WITH {_MID} SELECT video_id, round(1.0 - count(DISTINCT ts) / CAST(count(ts) AS DOUBLE), 6) AS ratio FROM t GROUP BY 1")
def midpoint_dedup_ratio(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.dedup_ratio(_samples(spark, d), ["video_id"], "ts").select("video_id", F.round("ratio", 6).alias("ratio"))


@_query(f"WITH {_MID} SELECT video_id, ts, count(DISTINCT clip_id) AS owner_count, min(clip_id) AS first_owner FROM t GROUP BY 1, 2")
def timestamp_owners(spark: SparkSession, d: str) -> DataFrame:
    o = aggregates.timestamp_owners(_samples(spark, d), ["video_id"], "ts", "clip_id")
    return o.select("video_id", "ts", F.size("owners").cast("long").alias("owner_count"), F.col("owners")[0].alias("first_owner"))


_SCENES = f"""f AS (SELECT *, score > 80 AS t FROM {c.TIMELINE}),
  r AS (SELECT *, sum(CAST(t AS INTEGER)) OVER (PARTITION BY video_id ORDER BY frame_idx) AS run, max(frame_idx) OVER (PARTITION BY video_id) AS last FROM f),
  sc AS (SELECT video_id, min(frame_idx) AS start_frame_idx, least(max(frame_idx) + 1, any_value(last)) AS end_frame_idx FROM r WHERE NOT t GROUP BY video_id, run
    UNION ALL SELECT video_id, min(frame_idx), max(frame_idx) FROM f GROUP BY video_id HAVING bool_and(t)),
  sh AS (SELECT *, CAST(round_even(start_frame_idx / CAST(25 AS DOUBLE) * 1000, 0) AS BIGINT) AS start_ms, CAST(round_even((end_frame_idx + 1) / CAST(25 AS DOUBLE) * 1000, 0) AS BIGINT) AS end_ms FROM sc)"""


@_query(f"WITH {_SCENES} SELECT video_id, start_frame_idx, end_frame_idx FROM sc")
def scene_islands(spark: SparkSession, d: str) -> DataFrame:
    return tl.scene_islands(c.timeline(spark, d), threshold=80)


@_query(f"WITH {_SCENES} SELECT video_id, start_frame_idx, end_frame_idx, start_ms, greatest(end_ms, start_ms + 1) AS end_ms FROM sh")
def scene_shots(spark: SparkSession, d: str) -> DataFrame:
    return tl.scene_shots(tl.scene_islands(c.timeline(spark, d), threshold=80), F.lit(25.0))


@_query(
    f"""WITH {_SCENES}, o AS (SELECT *, sum(CASE WHEN n = 1 OR end_ms - start_ms >= 150 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY start_frame_idx) AS g FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY start_frame_idx) AS n FROM sh)),
    a AS (SELECT video_id, g, min(start_ms) AS start_ms, max(end_ms) AS end_ms, min(start_frame_idx) AS fa, max(end_frame_idx) AS fb FROM o GROUP BY 1, 2),
    b AS (SELECT *, max(CASE WHEN g = 1 THEN end_ms - start_ms < 150 END) OVER (PARTITION BY video_id) AND max(g) OVER (PARTITION BY video_id) > 1 AS short FROM a),
    e AS (SELECT video_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms, min(fa) AS start_frame_idx, max(fb) AS end_frame_idx FROM (SELECT *, CASE WHEN g = 1 AND short THEN 2 ELSE g END AS h FROM b) GROUP BY video_id, h)
    SELECT *, CAST(row_number() OVER (PARTITION BY video_id ORDER BY start_frame_idx) - 1 AS INTEGER) AS shot_index, video_id || '_S' || lpad(CAST(row_number() OVER (PARTITION BY video_id ORDER BY start_frame_idx) - 1 AS VARCHAR), 3, '0') AS shot_id FROM e"""
)
def short_shot_merge(spark: SparkSession, d: str) -> DataFrame:
    return tl.merge_short_shots(tl.scene_shots(tl.scene_islands(c.timeline(spark, d), threshold=80), F.lit(25.0)), 150)


_IN_SHOT = f"(SELECT f.frame_id, f.shot_id, f.timestamp_ms, s.start_ms FROM {c.FRAMES} f JOIN {c.SOUND_SHOTS} s ON f.shot_id = s.shot_id WHERE f.timestamp_ms IS NOT NULL)"


@_query(f"SELECT frame_id, shot_id FROM {_IN_SHOT} QUALIFY row_number() OVER (PARTITION BY shot_id, floor((timestamp_ms - start_ms) / 2000.0) ORDER BY timestamp_ms, frame_id) = 1")
def rate_gate_sample(spark: SparkSession, d: str) -> DataFrame:
    f = c.frames(spark, d).where("timestamp_ms IS NOT NULL").select("frame_id", "shot_id", "timestamp_ms").join(c.sound_shots(spark, d).select("shot_id", "start_ms"), "shot_id")
    return tl.rate_gate(f, part="shot_id", time="timestamp_ms", start="start_ms", interval_ms=2000, ties=("frame_id",)).select("frame_id", "shot_id")


@_query(
    f"""WITH g AS (SELECT video_id, timestamp_ms, CASE WHEN timestamp_ms - lag(timestamp_ms) OVER w > 2000 THEN 1 ELSE 0 END AS o FROM {c.FRAMES} WHERE timestamp_ms IS NOT NULL AND video_id IS NOT NULL WINDOW w AS (PARTITION BY video_id ORDER BY timestamp_ms)),
    n AS (SELECT video_id, timestamp_ms, sum(o) OVER (PARTITION BY video_id ORDER BY timestamp_ms) AS k FROM g)
    SELECT video_id, CAST(k AS BIGINT) AS group_no, count(*) AS frames, min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms FROM n GROUP BY 1, 2"""
)
def gap_groups(spark: SparkSession, d: str) -> DataFrame:
    f = c.frames(spark, d).where("timestamp_ms IS NOT NULL AND video_id IS NOT NULL").select("video_id", "timestamp_ms")
    return tl.gap_groups(f, ["video_id"], "timestamp_ms", 2000).groupBy("video_id", "group_no").agg(F.count("*").alias("frames"), F.min("timestamp_ms").alias("first_ms"), F.max("timestamp_ms").alias("last_ms"))


@_query(
    f"""WITH o AS (SELECT frame_id, video_id, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx NULLS FIRST, frame_id) - 1 AS i, count(*) OVER (PARTITION BY video_id) AS n FROM {c.FRAMES} WHERE video_id IS NOT NULL)
    SELECT frame_id, video_id FROM o WHERE n <= 8 OR list_contains(list_transform(range(8), lambda x: CAST(round_even(x * (n - 1) / CAST(7 AS DOUBLE), 0) AS BIGINT)), i)"""
)
def even_downsample(spark: SparkSession, d: str) -> DataFrame:
    return tl.evenly_picked(c.frames(spark, d).where("video_id IS NOT NULL").select("frame_id", "video_id", "frame_idx"), ["video_id"], ["frame_idx", "frame_id"], 8).select("frame_id", "video_id")


@_query(f"SELECT video_id, unit_no, count(*) AS clips, min(start_ms) AS first_ms FROM (SELECT *, (row_number() OVER (PARTITION BY video_id ORDER BY start_ms, end_ms, clip_id) - 1) // 16 AS unit_no FROM {c.SOUND_CLIPS}) GROUP BY 1, 2")
def work_units(spark: SparkSession, d: str) -> DataFrame:
    return tl.chunks(c.sound_clips(spark, d), ["video_id"], ["start_ms", "end_ms", "clip_id"], 16).groupBy("video_id", "unit_no").agg(F.count("*").alias("clips"), F.min("start_ms").alias("first_ms"))


@_query(
    """WITH v AS (SELECT video_id, max(end_frame_idx) + 1 AS n FROM shot WHERE end_frame_idx >= 0 GROUP BY 1), w AS (SELECT video_id, n, unnest(range(CAST(ceil(n / 50.0) AS BIGINT))) AS k FROM v)
    SELECT video_id, n AS n_frames, k AS window_no, least(greatest(k * 50 - 25, 0), n - 1) AS first_frame, least(greatest(k * 50 - 25 + 99, 0), n - 1) AS last_frame, greatest(25 - k * 50, 0) AS left_repeats, greatest(k * 50 - 25 + 100 - n, 0) AS right_repeats,
      k * 50 AS kept_first, least((k + 1) * 50, n) - 1 AS kept_last FROM w"""
)
def model_windows(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "shot").where("end_frame_idx >= 0").groupBy("video_id").agg((F.max("end_frame_idx") + 1).alias("n_frames"))
    return tl.model_windows(v)


@_query(f"SELECT shot_id, video_id, end_ms, nx AS next_start FROM (SELECT *, lead(start_ms) OVER (PARTITION BY video_id ORDER BY start_ms, end_ms, shot_id) AS nx FROM {c.SOUND_SHOTS}) WHERE nx <> end_ms")
def adjacent_gap_warnings(spark: SparkSession, d: str) -> DataFrame:
    return tl.adjacent_gaps(c.sound_shots(spark, d), "video_id", ties=("shot_id",)).select("shot_id", "video_id", "end_ms", "next_start")


@_query(f"SELECT shot_id, start_ms, pe AS previous_end FROM (SELECT *, lag(end_ms) OVER (PARTITION BY video_id ORDER BY start_ms, shot_id) AS pe FROM {c.SHOTS} WHERE start_ms IS NOT NULL AND video_id IS NOT NULL) WHERE start_ms < pe OR end_ms <= start_ms")
def shot_order_violations(spark: SparkSession, d: str) -> DataFrame:
    return tl.order_violations(c.shots(spark, d).where("start_ms IS NOT NULL AND video_id IS NOT NULL")).select("shot_id", "start_ms", "previous_end")


@_query(
    f"""WITH x AS (SELECT shot_id, start_ms, end_ms, max(end_ms) OVER (PARTITION BY shot_id ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM {c.SOUND_CLIPS}),
    p AS (SELECT shot_id, min(start_ms) AS s, max(end_ms) AS e, coalesce(bool_or(start_ms > seen), false) AS has_gap, bool_or(end_ms - start_ms > 10000) AS too_long FROM x GROUP BY 1)
    SELECT shot_id, s <> a OR e <> b AS not_covered, has_gap, too_long FROM p JOIN (SELECT shot_id, start_ms AS a, end_ms AS b FROM {c.SOUND_SHOTS}) USING (shot_id) WHERE s <> a OR e <> b OR has_gap OR too_long"""
)
def clip_window_faults(spark: SparkSession, d: str) -> DataFrame:
    return tl.window_faults(c.sound_clips(spark, d), c.sound_shots(spark, d), 10_000)


_HELD = f"(SELECT f.frame_id, s.shot_id FROM {c.FRAMES} f JOIN {c.SOUND_SHOTS} s ON f.video_id = s.video_id AND f.timestamp_ms >= s.start_ms AND f.timestamp_ms < s.end_ms)"


def _times(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    f = c.frames(spark, d).select("frame_id", "video_id", "timestamp_ms")
    return f, c.sound_shots(spark, d).select("video_id", F.col("shot_id").alias("held_by"), "start_ms", "end_ms")


@_query(f"SELECT frame_id, shot_id AS held_by FROM {_HELD}")
def range_join_frames_to_shots(spark: SparkSession, d: str) -> DataFrame:
    f, s = _times(spark, d)
    return joins.bucket_range_join(f, s, key="video_id", time="timestamp_ms", start="start_ms", end="end_ms").select("frame_id", "held_by")


@_query(
    f"""WITH h AS (SELECT frame_id, count(*) AS n, min(shot_id) AS s FROM {_HELD} GROUP BY 1)
    SELECT f.frame_id, CASE WHEN h.n = 1 THEN h.s END AS assigned, CASE WHEN h.n = 1 THEN 'assigned' WHEN h.n > 1 THEN 'ambiguous' ELSE 'unmatched' END AS status FROM {c.FRAMES} f LEFT JOIN h ON f.frame_id = h.frame_id"""
)
def frame_shot_assignment(spark: SparkSession, d: str) -> DataFrame:
    f, s = _times(spark, d)
    return joins.assign_single(f, s, point_id="frame_id", key="video_id", time="timestamp_ms", start="start_ms", end="end_ms", interval_id="held_by").select("frame_id", "assigned", "status")


@_query(
    f"""WITH {_MID}, j AS (SELECT clip_id, pos, f.frame_id, abs(f.timestamp_ms - t.ts) AS distance_ms, row_number() OVER (PARTITION BY clip_id, pos ORDER BY abs(f.timestamp_ms - t.ts), f.timestamp_ms, f.frame_id) AS r
      FROM t JOIN {c.FRAMES} f ON f.video_id = t.video_id AND f.timestamp_ms BETWEEN t.ts - 500 AND t.ts + 500)
    SELECT clip_id, CAST(pos AS INTEGER) AS pos, frame_id, distance_ms FROM j WHERE r = 1"""
)
def asof_nearest_frame(spark: SparkSession, d: str) -> DataFrame:
    return joins.nearest_within(_samples(spark, d), c.frames(spark, d), key="video_id", left_id=["clip_id", "pos"], left_time="ts", right_time="timestamp_ms", right_id="frame_id", tolerance_ms=500)


@_query(
    f"""WITH b AS (SELECT DISTINCT shot_id, x AS a FROM (SELECT shot_id, unnest([start_ms, end_ms]) AS x FROM {c.SOUND_CLIPS})), p AS (SELECT *, lead(a) OVER (PARTITION BY shot_id ORDER BY a) AS z FROM b),
    h AS (SELECT p.shot_id, k.clip_id, p.a, p.z, count(*) OVER (PARTITION BY p.shot_id, p.a) AS n FROM p JOIN {c.SOUND_CLIPS} k ON p.shot_id = k.shot_id AND k.start_ms <= p.a AND p.z <= k.end_ms WHERE p.z IS NOT NULL)
    SELECT shot_id, clip_id, round(sum((z - a) / CAST(n AS DOUBLE)), 6) AS weight FROM h GROUP BY 1, 2"""
)
def coverage_weights(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.coverage_weights(c.sound_clips(spark, d)).select("shot_id", "clip_id", F.round("weight", 6).alias("weight"))


@_query(f"SELECT shot_id, coalesce(bool_or(start_ms < seen), false) AS has_overlap FROM (SELECT *, max(end_ms) OVER (PARTITION BY shot_id ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM {c.SOUND_CLIPS}) GROUP BY 1")
def overlap_flag(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.overlap_flags(c.sound_clips(spark, d), "shot_id")


@_query(f"SELECT k.clip_id, CASE WHEN k.start_ms = s.start_ms AND k.end_ms = s.end_ms THEN 'full_shot' ELSE 'fixed_window' END AS derived, k.scale_type FROM {c.SOUND_CLIPS} k JOIN {c.SOUND_SHOTS} s ON k.shot_id = s.shot_id")
def scale_types(spark: SparkSession, d: str) -> DataFrame:
    s = c.sound_shots(spark, d).select("shot_id", F.col("start_ms").alias("a"), F.col("end_ms").alias("b"))
    return c.sound_clips(spark, d).join(s, "shot_id").select("clip_id", tl.scale_type(F.col("start_ms"), F.col("end_ms"), F.col("a"), F.col("b")).alias("derived"), "scale_type")


@_query(f"SELECT frame_id, CAST(round_even(pts_time * 1000, 0) AS BIGINT) AS from_seconds, CAST(round_even(frame_idx / fps * 1000, 0) AS BIGINT) AS from_frame FROM {c.FRAMES} WHERE fps > 0")
def frame_time_conversions(spark: SparkSession, d: str) -> DataFrame:
    return c.frames(spark, d).where("fps > 0").select("frame_id", tl.milliseconds(F.col("pts_time")).alias("from_seconds"), tl.frame_ms(F.col("frame_idx"), F.col("fps")).alias("from_frame"))


@_query()
def transcript_coalesce(spark: SparkSession, d: str) -> DataFrame:
    items = c.ocr(spark, d).where("text IS NOT NULL").select("frame_id", "n", "text", (F.col("n") * 100).cast("long").alias("start_ms"), (F.col("n") * 100 + 90).cast("long").alias("end_ms"))
    return tl.coalesce_transcripts(items, "frame_id", "n")


def queries() -> dict:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
