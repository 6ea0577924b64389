import random

from pyspark.sql import functions as F

from reelspan.llm import nearest_time as nt

LEFT = "q long, video string, m long"
RIGHT = "frame string, video string, t long"


def brute(left, right, tol):
    out = {}
    for q, v, m in left:
        if v is None or m is None:
            continue
        best = min(((abs(t - m), t, f) for f, w, t in right if w == v and t is not None and f is not None and abs(t - m) <= tol), default=None)
        if best:
            out[q] = best[2]
    return out


def run(spark, left, right, tol=500, **kw):
    a, b = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    got = nt.nearest_in_time(a, b, entity="video", left_time="m", right_time="t", right_key="frame", tolerance_ms=tol, **kw)
    return {r["q"]: r["right_key"] for r in got.collect()}


def test_ties_nulls_and_tolerance(spark):
    left = [(1, "v", 1000), (2, "v", 2000), (3, "v", None), (4, None, 1000), (5, "w", 1000), (6, "v", 5000), (7, "v", 10_000)]
    right = [("b", "v", 900), ("a", "v", 1100), ("d", "v", 2300), ("c", "v", 2300), ("c", "v", 2300), ("x", "v", None), (None, "v", 1000), ("z", None, 1000), ("e", "v", 4500), ("g", "v", 10_501)]
    assert run(spark, left, right) == {1: "b", 2: "c", 6: "e"}


def test_random_across_slots_and_slices(spark):
    rng = random.Random(4)
    slot = 4096
    left = [(i, rng.choice("uvw"), rng.randrange(-20_000, 60_000)) for i in range(400)]
    right = [(f"f{i:04}", rng.choice("uvw"), rng.randrange(-20_000, 60_000)) for i in range(300)]
    left += [(1000 + k, "u", k * slot) for k in range(3)]
    right += [(f"g{k}", "u", k * slot + d) for k in range(3) for d in (-1, 1)]
    assert run(spark, left, right, tol=200, slot_ms=slot, slice_rows=200) == brute(left, right, 200)
    assert run(spark, left, right, tol=200, slot_ms=slot, group_events=40) == brute(left, right, 200)


def test_empty_sides(spark):
    assert run(spark, [], [("a", "v", 1)]) == {}
    assert run(spark, [(1, "v", 1)], []) == {}


def test_clashing_columns(spark):
    a = spark.createDataFrame([(1, "v", 5, "x", 7, 8)], LEFT + ", right_key string, t long, slot long")
    b = spark.createDataFrame([("f", "v", 6, "y")], RIGHT + ", q string")
    got = nt.nearest_in_time(a, b, entity="video", left_time="m", right_time="t", right_key="frame", tolerance_ms=5).collect()
    assert [(r["q"], r["t"], r["slot"], r["right_key"], r["right_ms"]) for r in got] == [(1, 7, 8, "f", 6)]


def test_entries_of_uneven_arrays(spark):
    df = spark.createDataFrame([(1, "v", [10, 20, 30], [None, 21]), (1, "v", [10, 20, 30], [None, 21]), (2, "v", None, [5]), (3, "v", None, None)], "batch_id long, video_id string, requested_timestamps_ms array<long>, actual_timestamps_ms array<long>")
    got = sorted((r["batch_id"], r["pos"], r["moment_ms"]) for r in nt.batch_entries(df.withColumn("pos", F.lit(9))).collect())
    assert got == [(1, 0, 10), (1, 1, 21), (1, 2, 30), (2, 0, 5)]
