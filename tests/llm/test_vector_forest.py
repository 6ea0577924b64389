import heapq

import numpy as np
import pytest

from reelspan.llm import vector_forest as vf

SCHEMA = "i long, v array<float>"


def exact(rows, k, least):
    seen = {}
    for i, v in rows:
        if v is not None and i is not None and i not in seen and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            seen[i] = np.asarray(v, np.float32).astype(float)
    ids = sorted(seen)
    m = np.stack([seen[i] / np.linalg.norm(seen[i]) for i in ids]).astype(np.float32).astype(float)
    s = m @ m.T
    np.fill_diagonal(s, -2)
    out = set()
    for a in range(len(ids)):
        for b in np.lexsort((ids, -np.round(s[a], 9)))[:k]:
            if s[a, b] >= least:
                out.add((min(ids[a], ids[b]), max(ids[a], ids[b])))
    return out


def pairs(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return {(r["id_a"], r["id_b"]) for r in vf.similar_pairs(df, "i", "v", dim=8, **kw).collect()}


def clustered(n, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(n // 6, 8))
    return [(i, [float(x) for x in (centers[i % len(centers)] + rng.normal(size=8) * 0.15) * rng.uniform(0.1, 9)]) for i in range(n)]


def test_unusable_and_repeated_rows(spark):
    good = clustered(60)
    bad = [(900, None), (901, [1.0] * 7), (902, [0.0] * 8), (903, [float("nan")] + [1.0] * 7), (904, [None] + [1.0] * 7), (905, [float("inf")] + [1.0] * 7), (None, [1.0] * 8)]
    rows = good + bad + good[:10]
    assert pairs(spark, rows) == exact(rows, 5, 0.85)


@pytest.mark.parametrize("config", [vf.ForestConfig(leaf_rows=60), vf.ForestConfig(leaf_rows=400, leaf_cap=120, sample_rows=100)])
def test_recall_with_small_leaves(spark, config):
    rows = clustered(1500)
    want, got = exact(rows, 5, 0.85), pairs(spark, rows, config=config)
    assert len(want & got) >= 0.9 * len(want)
    assert len(got - want) <= 0.1 * len(want)


def test_groups_of_copies(spark):
    v = [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    rows = [(i, v) for i in range(40)] + clustered(30) + [(500, [1.0, 2.0, 0.1, 0.0, 0.0, 0.0, 0.0, 1.0])]
    rows = [(i + (100 if j >= 40 else 0), x) for j, (i, x) in enumerate(rows)]
    got = pairs(spark, rows)
    assert got == exact(rows, 5, 0.85)
    assert len(got) < 400


def test_empty_and_single(spark):
    assert pairs(spark, []) == set()
    assert pairs(spark, [(1, [1.0] * 8)]) == set()
    assert pairs(spark, [(1, None)]) == set()


def queue_order(trees, v, visits):
    """Margins of the leaves a best-first search over all trees with one priority queue pops first."""
    heap = [(-np.inf, n, 0) for n in range(len(trees))]
    out = []
    while heap and len(out) < visits:
        far, n, node = heapq.heappop(heap)
        t = trees[n]
        if node < 0:
            out.append((n, ~node, -far))
            continue
        margin = float((v @ t.planes.T - t.offsets)[node])
        for side, m in ((0, -margin), (1, margin)):
            heapq.heappush(heap, (-min(-far, m), n, int(t.children[node][side])))
    return out


def test_visits_equal_a_shared_priority_queue():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    trees = [vf.Tree.fit(x, 10, rng) for _ in range(4)]
    base = np.cumsum([0, *[t.leaves for t in trees]])
    for t in trees:
        p = t.priorities(x)
        assert (p.argmax(1) == t.home(x)).all() and ((p > 0).sum(1) <= 1).all()
    row, leaf, home, asked, margin = vf._visits([t.priorities(x) for t in trees], 7)
    for i in range(100):
        want = queue_order(trees, x[i], 7)
        mine = (row == i) & asked
        assert mine.sum() == 7
        assert np.allclose(sorted(margin[mine]), sorted(m for _, _, m in want), atol=1e-5)
        apart = {base[n] + k for n, k, m in want if m > want[-1][2] + 1e-6}
        assert apart <= set(leaf[mine].tolist())
        assert (home & (row == i)).sum() == 4


def test_split_leaves_keep_one_shared_order(spark):
    rows = clustered(900)
    config = vf.ForestConfig(trees=3, visits=5, leaf_rows=300, leaf_cap=40)
    units = vf.unit_vectors(spark.createDataFrame(rows, SCHEMA), "i", "v", 8)
    classes, _ = vf.direction_classes(units, 5)
    trees, dim = vf.fit_forest(classes, 900, config)
    routed = vf._split_leaves(vf._route(classes, trees, dim, config.visits), dim, config).toPandas()
    members = routed[routed.role <= 1]
    assert (members.groupby("cls").size() == 3).all() and members.groupby("leaf").size().max() <= 40
    asks = routed[routed.role != 1].groupby("cls").size()
    assert len(asks) == 900 and (asks == 5).all()


def test_vectors_within_rounding_end_the_splitting(spark):
    rows = [(i, [1.0, 1e-7 * i, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(60)]
    got = pairs(spark, rows, config=vf.ForestConfig(leaf_cap=10))
    assert {x for p in got for x in p} == set(range(60))


def test_recall_queries(spark):
    rows = clustered(300)
    df = spark.createDataFrame(rows, SCHEMA)
    want = exact(rows, 5, 0.85)
    for block in (20_000, 4):
        got = {(min(r["q"], r["other"]), max(r["q"], r["other"])) for r in vf.recall_queries(df, "i", "v", dim=8, block=block).collect()}
        assert got <= want and {p for p in want if p[0] % 50 == 0 and p[1] % 50 == 0} <= got | want
        assert len(got) >= 6


def test_deep_trees_lose_few_neighbours(spark):
    rows = clustered(6000, seed=3)
    want, got = exact(rows, 5, 0.85), pairs(spark, rows, config=vf.ForestConfig(leaf_rows=8, leaf_cap=64))
    assert len(want & got) >= 0.985 * len(want)
    assert len(got - want) <= 0.015 * len(want)


def test_visits_grow_with_depth():
    config = vf.ForestConfig()
    assert [config.visits_for(n) for n in (0, 1, 128_000, 8_192_000, 32_768_000)] == [8, 8, 8, 16, 19]


@pytest.mark.parametrize("cut", [1, 3, 100])
def test_linked_members_are_compared_across_batches(cut):
    import pyarrow as pa

    rng = np.random.default_rng(2)
    v = rng.normal(size=(40, 8)) + 1.5
    v = (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32)
    center = np.sort(rng.integers(0, 7, 40))
    whole = pa.RecordBatch.from_arrays([pa.array(center), pa.array(np.arange(40)[::-1].copy()), pa.array(v.tolist(), pa.list_(pa.float32()))], names=["center", "m", "v"])
    got = sorted((r["a"], r["b"]) for b in vf._compare_linked(8, 0.8)(whole.slice(i, cut) for i in range(0, 40, cut)) for r in b.to_pylist())
    cos = v.astype(float) @ v.T.astype(float)
    assert got == sorted((39 - j, 39 - i) for i in range(40) for j in range(i + 1, 40) if center[i] == center[j] and cos[i, j] >= 0.8)
