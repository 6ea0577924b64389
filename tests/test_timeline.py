from pyspark.sql import functions as F

from reelspan.operators import aggregates, joins
from reelspan.operators import timeline as tl


def scenes(spark, scores):
    df = spark.createDataFrame([("v", i, float(s)) for i, s in enumerate(scores)], "video_id string, frame_idx long, score double")
    return sorted((r["start_frame_idx"], r["end_frame_idx"]) for r in tl.scene_islands(df).collect())


def test_scene_goldens(spark):
    assert scenes(spark, [0, 0, 0, 1, 1, 0, 0, 0]) == [(0, 3), (5, 7)]
    assert scenes(spark, [0, 0, 0, 1, 1, 1, 1, 0, 0]) == [(0, 3), (7, 8)]
    assert scenes(spark, [0] * 10) == [(0, 9)]
    assert scenes(spark, [1] * 10) == [(0, 9)]
    assert scenes(spark, [0, 0.5, 0]) == [(0, 2)]


def merged(spark, ranges):
    df = spark.createDataFrame([("L21_V001", a, b) for a, b in ranges], "video_id string, start_frame_idx long, end_frame_idx long")
    rows = tl.merge_short_shots(tl.scene_shots(df, F.lit(25.0))).orderBy("shot_index").collect()
    return [(r["start_frame_idx"], r["end_frame_idx"]) for r in rows], rows


def test_short_shot_goldens(spark):
    got, rows = merged(spark, [(0, 249)])
    assert got == [(0, 249)] and rows[0]["shot_id"] == "L21_V001_S000" and rows[0]["end_ms"] == 10_000
    assert merged(spark, [(0, 199), (200, 204)])[0] == [(0, 204)]
    assert merged(spark, [(0, 4), (5, 49)])[0] == [(0, 49)]
    assert merged(spark, [(0, 1), (2, 3), (4, 5), (6, 99)])[0] == [(0, 99)]
    assert merged(spark, [(0, 4), (5, 9), (10, 14), (15, 99)])[0] == [(0, 14), (15, 99)]


def windows(spark, start, end, fa=0, fb=0):
    df = spark.createDataFrame([("L21_V001_S0003", start, end, fa, fb)], "shot_id string, start_ms long, end_ms long, start_frame_idx long, end_frame_idx long")
    return tl.clip_frames(tl.clip_windows(df)).orderBy("clip_no").collect()


def test_clip_window_goldens(spark):
    assert len(windows(spark, 2000, 12_000)) == 1
    rows = windows(spark, 80_000, 105_000, 2400, 3150)
    assert [(r["clip_start_ms"], r["clip_end_ms"]) for r in rows] == [(80_000, 90_000), (88_000, 98_000), (95_000, 105_000)]
    assert [(r["clip_start_frame"], r["clip_end_frame"]) for r in rows] == [(2400, 2700), (2640, 2940), (2850, 3150)]
    assert rows[0]["sampling_fps"] == 30.0 and rows[0]["clip_id"] == "L21V001S0003C01"
    assert [(r["clip_start_ms"], r["clip_end_ms"]) for r in windows(spark, 0, 10_001)] == [(0, 10_000), (1, 10_001)]


def test_midpoints_and_dedup(spark):
    df = spark.createDataFrame([("a", 0, 1000, 4), ("b", 0, 1000, 4)], "clip string, s long, e long, n int")
    out = df.select("clip", F.explode(tl.midpoints(F.col("s"), F.col("e"), F.col("n"))).alias("ts"))
    assert sorted({r["ts"] for r in out.collect()}) == [125, 375, 625, 875]
    assert aggregates.dedup_ratio(out.withColumn("v", F.lit("v")), ["v"], "ts").first()["ratio"] == 0.5


def test_even_pick_keeps_ends(spark):
    df = spark.createDataFrame([("v", i) for i in range(10)], "v string, f int")
    got = sorted(r["f"] for r in tl.evenly_picked(df, ["v"], ["f"], 4).collect())
    assert len(got) == 4 and got[0] == 0 and got[-1] == 9


def test_coverage_weights(spark):
    df = spark.createDataFrame([("s", "a", 0, 10), ("s", "b", 5, 15), ("t", "c", 0, 10), ("t", "d", 8, 18), ("t", "e", 16, 26)], "shot_id string, clip_id string, start_ms long, end_ms long")
    w = {r["clip_id"]: r["weight"] for r in aggregates.coverage_weights(df).collect()}
    assert w["a"] == w["b"] == 7.5 and w["c"] + w["d"] + w["e"] == 26


def test_pooling(spark):
    clips = spark.createDataFrame([("s", "a", 0, 10), ("s", "b", 10, 30)], "shot_id string, clip_id string, start_ms long, end_ms long")
    vec = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "clip_id string, vector array<float>")
    got = aggregates.pooled_shots(clips, vec, overlapping_by_coverage=False).first()["pooled"]
    assert abs(got[0] - 10 / 500**0.5) < 1e-9 and abs(got[1] - 20 / 500**0.5) < 1e-9


def test_transcript_coalescing(spark):
    items = [("v", 0, "mot hai", 0, 100), ("v", 1, "ba bon nam sau bay tam chin", 100, 900), ("v", 2, "x", 900, 950)]
    df = spark.createDataFrame(items, "v string, i int, text string, start_ms long, end_ms long")
    rows = tl.coalesce_transcripts(df, "v", "i").orderBy("segment_no").collect()
    assert [(r["start_ms"], r["end_ms"], r["text"]) for r in rows] == [(0, 900, "mot hai ba bon nam sau bay tam chin"), (900, 950, "x")]


def test_range_and_nearest_joins(spark):
    f = spark.createDataFrame([("v", "a", 1000), ("v", "b", 1500), ("v", "c", 2000), ("v", "d", 999), ("v", "e", None)], "video_id string, frame_id string, t long")
    s = spark.createDataFrame([("v", "s1", 1000, 2000), ("v", "bad", 5, 5)], "video_id string, shot string, a long, b long")
    got = joins.bucket_range_join(f, s, key="video_id", time="t", start="a", end="b")
    assert sorted(r["frame_id"] for r in got.collect()) == ["a", "b"]
    left = spark.createDataFrame([(1, "v", 1250), (2, "v", 3000), (3, "w", 1000)], "q long, video_id string, m long")
    near = joins.nearest_within(left, f, key="video_id", left_id=["q"], left_time="m", right_time="t", right_id="frame_id", tolerance_ms=500)
    assert [(r["q"], r["frame_id"], r["distance_ms"]) for r in near.collect()] == [(1, "a", 250)]


def test_rate_gate_and_tracks(spark):
    rows = [("s", i * 500, i) for i in range(6)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "shot string, t long, f long, a long")
    assert tl.rate_gate(df, part="shot", time="t", start="a", interval_ms=1000).count() == 3
    t = aggregates.track_summary(df.withColumn("c", F.lit(0.5)), ["shot"], time="t", frame="f", confidence="c").first()
    assert (t["start_ms"], t["end_ms"], t["observation_count"], t["end_frame_idx"]) == (0, 2500, 6, 5)
