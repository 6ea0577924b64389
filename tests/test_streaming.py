from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reelspan.operators import selectors
from reelspan.session import scratch_path
from reelspan.sources import sinks
from reelspan.streaming import incremental

T0 = datetime(2025, 1, 1)


def test_ingest_is_idempotent_and_guarded(spark):
    root = scratch_path(spark, "t")
    schema = "k string, v long, seq long"
    args = (spark, f"{root}/in", schema, f"{root}/table", f"{root}/log")
    spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("a", 2, 2)], schema).write.parquet(f"{root}/in")
    incremental.ingest(*args, key="k", order="seq", config={"x": 1})
    incremental.ingest(*args, key="k", order="seq", config={"x": 1})
    spark.createDataFrame([("b", 9, 5), ("c", 1, 1)], schema).write.mode("append").parquet(f"{root}/in")
    incremental.ingest(*args, key="k", order="seq", config={"x": 1})
    assert {r["k"]: r["v"] for r in sinks.current_version(spark, f"{root}/table")[0].collect()} == {"a": 2, "b": 9, "c": 1}
    with pytest.raises(ValueError, match="another configuration"):
        incremental.ingest(*args, key="k", order="seq", config={"x": 2})


def test_tracks_close_by_event_time(spark):
    root = scratch_path(spark, "tr")
    rows = [("s", "c", 1, T0 + timedelta(seconds=i), 1000 * i, 0.5) for i in range(3)] + [("s", "d", 2, T0 + timedelta(minutes=10), 600_000, 0.9)]
    schema = "shot_id string, class_id string, local_id long, event_time timestamp, timestamp_ms long, confidence double"
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/in")
    out = incremental.run_once(incremental.track_states(incremental.file_stream(spark, f"{root}/in", schema)), "x").collect()
    assert [(r["local_id"], r["start_ms"], r["end_ms"], r["observation_count"]) for r in out] == [(1, 0, 2000, 3)]


def test_cross_shot_chain_is_the_same_in_stretches(spark):
    import random

    rng = random.Random(8)
    rows, i = [], 0
    for v in "ab":
        for s in range(40):
            for _ in range(rng.choice([1, 1, 1, 2, 3])):
                rows.append((v, s, i, [1.0, rng.choice([0.0, 0.1, 3.0])], float(rng.randrange(5))))
                i += rng.choice([1, 30, 200])
    df = spark.createDataFrame(rows, "video_id string, shot_index int, frame_idx long, clip_vector array<double>, center_distance double")
    want = set()
    for v in "ab":
        r = [x for x in rows if x[0] == v]
        cols = {"shot_index": [x[1] for x in r], "frame_idx": [x[2] for x in r], "clip_vector": [x[3] for x in r], "center_distance": [x[4] for x in r]}
        want |= {(v, r[k][2]) for k in selectors.boundary_dedup(cols)}
    assert {(r["video_id"], r["frame_idx"]) for r in selectors.cross_shot_dedup(df).collect()} == want
    assert 0 < len(want) < len(rows)
    assert selectors.cross_shot_dedup(df.where(F.lit(False))).count() == 0


def test_only_touched_buckets_are_written_again(spark):
    root = scratch_path(spark, "pc")
    rows = spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit(1).alias("seq"))
    sinks.publish_changes(rows, root, "0", key="k", order="seq", buckets=16)
    sinks.publish_changes(spark.createDataFrame([("7", 5, 2), ("new", 6, 2), ("8", 9, 0)], "k string, v int, seq int"), root, "1", key="k", order="seq", buckets=16)
    got = {r["k"]: r["v"] for r in sinks.current_version(spark, root)[0].collect()}
    assert len(got) == 201 and got["7"] == 5 and got["new"] == 6 and got["8"] == 1
    import json

    parts = json.loads(sinks._get(spark, f"{root}/current.json"))["parts"]
    assert 1 <= sum("/versions/1/" in p for p in parts.values()) <= 3 and len(parts) == 16


def test_late_rows_wait(spark):
    root = scratch_path(spark, "late")
    schema = "k string, ts timestamp"
    write = lambda *rows: spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    run = lambda: incremental.split_late(incremental.file_stream(spark, f"{root}/in", schema), f"{root}/w", time="ts", delay_ms=60_000)
    write(("a", T0), ("b", T0 + timedelta(minutes=10)))
    run()
    write(("c", T0 + timedelta(minutes=9)), ("d", T0 + timedelta(minutes=8)), ("e", None))
    run()
    write(("f", T0 + timedelta(minutes=8)))
    rows, pending = run()
    assert {r["k"] for r in rows.collect()} == {"a", "b", "c", "e"} and {r["k"] for r in pending.collect()} == {"d", "f"}
