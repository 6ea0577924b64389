import random

import numpy as np

from reelspan.operators import intervals as iv

SCHEMA = "e string, start_ms long, end_ms long"


def brute(rows):
    out = []
    for e in sorted({r[0] for r in rows if r[0] is not None}):
        spans = sorted((s, t) for x, s, t in rows if x == e and s is not None and t is not None and t > s)
        if not spans:
            continue
        cur = list(spans[0])
        for s, t in spans[1:]:
            if s > cur[1]:
                out.append((e, *cur))
                cur = [s, t]
            else:
                cur[1] = max(cur[1], t)
        out.append((e, *cur))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    got = sorted(tuple(r) for r in iv.continuous_periods(df, "e").collect())
    assert got == want
    gaps = [(a[0], a[2], b[1]) for a, b in zip(want, want[1:]) if a[0] == b[0]]
    assert sorted(tuple(r) for r in iv.interval_gaps(df, "e").collect()) == sorted(gaps)


def test_edges(spark):
    check(spark, [("a", 0, 10), ("a", 10, 20), ("a", 21, 22), ("a", 5, 6), ("b", 3, 3), ("b", 9, 2), ("c", None, 4), ("c", 1, None), (None, 1, 2), ("d", 0, 1), ("d", 0, 1)])


def test_grid_lines_and_long_spans(spark):
    k = 1 << 16
    rows = [("a", k - 1, k), ("a", k, k + 1), ("a", 0, 2), ("b", -5, 5), ("b", -k * 3, -k), ("c", 0, 1 << 40), ("c", (1 << 40) + 7, (1 << 50) + 3), ("c", 17, 1 << 20), ("d", 3, 5 * k + 9), ("d", 5 * k + 10, 5 * k + 11), ("d", 2 * k, 3 * k)]
    rows += [("e", i * (1 << 22) - 1, i * (1 << 22) + 1) for i in range(4)] + [("e", 100, 9_000_000)]
    check(spark, rows)


def test_random(spark):
    rng = random.Random(3)
    rows = []
    for e in "uvwxyz":
        for _ in range(400):
            s = rng.randrange(-200_000, 3_000_000)
            rows.append((e, s, s + rng.choice([1, 2, 50, 3000, 70_000, -4])))
    check(spark, rows)


def test_blocks_against_marks():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n = int(rng.integers(1, 40))
        lo = rng.integers(0, 1000, n)
        hi = np.minimum(lo + rng.integers(1, 200, n), 1 << 16)
        marks = np.zeros(1400, bool)
        for a, b in zip(lo, hi):
            marks[a:b] = True
        g, a, b = iv.dyadic_runs(np.zeros(n, int), lo, hi)
        again = np.zeros(1400, bool)
        for x, y in zip(a, b):
            assert not again[max(x - 1, 0) : y + 1].any() or x == 0
            again[x:y] = True
        assert (marks == again).all()
    g, a, b = iv.dyadic_runs(np.array([0, 1]), np.array([0, 0]), np.array([1 << 16, 1]))
    assert list(zip(g, a, b)) == [(0, 0, 1 << 16), (1, 0, 1)]


def test_empty_and_clashing_columns(spark):
    assert iv.interval_gaps(spark.createDataFrame([], SCHEMA), "e").count() == 0
    df = spark.createDataFrame([("a", 0, 1, 9, 9, "x"), ("a", 5, 6, 9, 9, "x")], SCHEMA + ", lo long, hi long, entity string")
    assert [tuple(r) for r in iv.interval_gaps(df, "e").collect()] == [("a", 1, 5)]
