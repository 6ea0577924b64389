from datetime import datetime, timedelta

from reelspan.plans import streams
from reelspan.session import scratch_path
from reelspan.streaming import incremental


def test_gaps_split_tracks_and_the_last_one_comes_out(spark, tmp_path):
    schema = "frame_id string, shot_id string, source string, timestamp_ms long, fps double, ingested_at timestamp"
    times = {"a": [0, 1000, 3000, 9000, 9500], "b": [11000, 11500]}
    rows = [(f"{s}{t}", s, "x", t, 25.0, datetime(2025, 1, 1)) for s, ts in times.items() for t in ts]
    spark.createDataFrame(rows[::-1], schema).write.parquet(f"{tmp_path}/frame.parquet")
    got = sorted((r["shot_id"], r["start_ms"], r["end_ms"], r["observation_count"]) for r in streams.stream_tracks(spark, str(tmp_path)).collect())
    assert got == [("a", 0, 3000, 3), ("a", 9000, 9500, 2), ("b", 11000, 11500, 2)]


def test_slices_of_time_give_the_same_tracks(spark, tmp_path, monkeypatch):
    schema = "frame_id string, shot_id string, source string, timestamp_ms long, fps double, ingested_at timestamp"
    times = {"a": [0, 0, 2000, 4000, 9000, 60_000], "b": [*range(0, 70_000, 1500)], "c": [500, 30_000, 32_000, 34_001], "d": [69_999] * 9}
    rows = [(f"{s}{i}", s, "x", t, 25.0, datetime(2025, 1, 1)) for s, ts in times.items() for i, t in enumerate(ts)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/frame.parquet")
    tracks = lambda: sorted(tuple(r) for r in streams.stream_tracks(spark, str(tmp_path)).collect())
    want, runs, once = tracks(), [], incremental.run_once
    monkeypatch.setattr(streams, "SLICE_ROWS", 15)
    monkeypatch.setattr(incremental, "run_once", lambda *a, **k: runs.append(1) or once(*a, **k))
    assert tracks() == want and len(runs) > 3
    assert [r[3:6] for r in want if r[0] in "bc"] == [(0, 69_000, 47), (500, 501, 1), (30_000, 32_000, 2), (34_001, 34_002, 1)]


def test_late_rows_join_tracks_over_batches(spark):
    root, t0 = scratch_path(spark, "late"), datetime(2025, 1, 1)
    schema = "shot_id string, class_id string, local_id long, event_time timestamp, timestamp_ms long, confidence double"
    for ms in ([0, 4000], [2000], [100_000]):
        spark.createDataFrame([("s", "c", 1, t0 + timedelta(milliseconds=m), m, 0.5) for m in ms], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = incremental.track_states(incremental.file_stream(spark, f"{root}/in", schema, max_files=1))
    assert [(r["start_ms"], r["end_ms"], r["observation_count"]) for r in incremental.run_once(stream, "late").collect()] == [(0, 4000, 3)]


def test_many_objects_share_few_states(spark):
    root, t0 = scratch_path(spark, "many"), datetime(2025, 1, 1)
    schema = "shot_id string, class_id string, local_id long, event_time timestamp, timestamp_ms long, confidence double"
    objects = [(f"s{i}", "c", 2**60 + i) for i in range(300)] + [("s0", "c", None), (None, "c", 1), ("s0", None, 1)]
    late = {0: 3000, 1: 9000, 2: 500}  # joins, opens another track, begins earlier
    for times in ({i: [1000, 3000] for i in range(len(objects))}, {i: [t] for i, t in late.items()}, {0: [600_000]}):
        rows = [(*objects[i], t0 + timedelta(milliseconds=t), t, 0.5) for i, ts in times.items() for t in ts]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = incremental.track_states(incremental.file_stream(spark, f"{root}/in", schema, max_files=1))
    query = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    assert 0 < max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 64  # one state an object: 303
    want = {(*o, 1000, 3000, 2, 0.5) for o in objects[3:]}
    want |= {(*objects[0], 1000, 3000, 3, 0.5), (*objects[1], 1000, 3000, 2, 0.5), (*objects[1], 9000, 9001, 1, 0.5), (*objects[2], 500, 3000, 3, 0.5)}
    got = [tuple(r) for r in spark.read.parquet(f"{root}/out").collect()]
    assert len(got) == len(want) and set(got) == want


def test_a_state_of_many_rows_is_merged_on_the_way(spark, monkeypatch):
    monkeypatch.setattr(incremental, "MERGE_ROWS", 5)
    root, t0 = scratch_path(spark, "hot"), datetime(2025, 1, 1)
    rows = [("s", "c", 1, t0 + timedelta(milliseconds=t), t, 0.5) for t in [*range(40_000, -1, -1000), *range(60_000, 100_000, 4000), 900_000]]
    spark.createDataFrame(rows, "shot_id string, class_id string, local_id long, event_time timestamp, timestamp_ms long, confidence double").coalesce(1).write.parquet(f"{root}/in")
    stream = incremental.track_states(incremental.file_stream(spark, f"{root}/in", "shot_id string, class_id string, local_id long, event_time timestamp, timestamp_ms long, confidence double"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted((r["start_ms"], r["end_ms"], r["observation_count"]) for r in incremental.run_once(stream, "hot").collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == [(0, 40_000, 41)] + [(t, t + 1, 1) for t in range(60_000, 100_000, 4000)]
