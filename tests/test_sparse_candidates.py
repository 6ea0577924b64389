import random
from datetime import datetime

from reelspan.operators import selectors
from reelspan.plans import media


def plain(start, end, step, existing, *, margin, gap, most):
    """The same by listing every frame number."""
    free = lambda f: all(abs(f - e) > gap for e in existing)
    lo, hi = sorted((min(start + margin, end), max(end - margin, start)))
    center = (start + end) // 2
    got = [f for f in sorted({*range(lo, hi + 1, step), center}) if free(f)]
    if not got:
        return [f for f in sorted(range(start, end + 1), key=lambda f: (abs(f - center), f)) if free(f)][:1]
    return got if len(got) <= most else [got[i] for i in sorted({round(i * (len(got) - 1) / (most - 1)) for i in range(most)})]


def test_arithmetic_is_the_same_as_listing():
    rng = random.Random(5)
    for _ in range(3000):
        start = rng.randrange(50)
        end = start + rng.choice([0, 1, 3, 4, 5, 20, 100, 900])
        existing = [rng.randrange(start - 20, end + 20) for _ in range(rng.choice([0, 1, 3, 10, 60]))]
        step, limits = rng.choice([1, 2, 12, 15]), {"margin": 2, "gap": rng.choice([0, 3, 10]), "most": rng.choice([8, 64])}
        assert selectors.sparse_pick(start, end, step, existing, **limits) == plain(start, end, step, existing, **limits)


def test_long_shots_have_candidates(spark, tmp_path):
    t = datetime(2025, 1, 1)
    shot = "shot_id string, video_id string, start_ms long, end_ms long, start_frame_idx long, end_frame_idx long, ingested_at timestamp, deleted_at timestamp"
    spark.createDataFrame([("s", "v", 0, 8_000_000, 0, 200_000, t, None), ("t", "v", 0, 10**12, 0, 10**11, t, None)], shot).write.parquet(f"{tmp_path}/shot.parquet")
    spark.createDataFrame([("f", "s", 2, t)], "frame_id string, shot_id string, frame_idx long, ingested_at timestamp").write.parquet(f"{tmp_path}/frame.parquet")
    got = media.sparse_candidates(spark, str(tmp_path)).collect()
    by = {k: sorted(r["frame_idx"] for r in got if r["shot_id"] == k) for k in "st"}
    assert by["s"] == plain(0, 200_000, 12, [2], margin=2, gap=10, most=64)
    assert len(by["t"]) == 64 and by["t"][0] == 2
