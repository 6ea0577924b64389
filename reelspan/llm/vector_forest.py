"""The k most similar vectors of every vector, with a forest of random-projection trees.

Trees are fitted on a bounded sample (``sample_rows``); every row is indexed in each
tree. A query descends all trees at once through one shared priority queue: the leaves of
the whole forest are ranked by the smallest margin on their path and the best ``visits``
are searched, which is the order a best-first queue over all trees pops them in. Leaf
candidates are scored exactly, by full cosine, and the best k over all leaves are kept.

Vectors with equal direction are collapsed to one class first, so a group of copies costs
one row. A leaf with more rows than ``leaf_cap`` is split further by trees fitted on
a bounded sample of that leaf, level after level; the margin of the path so far goes down with
the vector, so that after each level the ``visits`` best leaves of the whole forest are
kept again. Nothing is cut off: splitting ends when all leaves fit or when a level parts no
leaf any more (more than ``leaf_cap`` vectors within rounding of each other, which are then
scored in blocks). Each splitting parts some near vectors, so the leaves visited grow with the
depth of the trees (the logarithm of the rows). Neighbours the forest has parted are
found through a common neighbour: the neighbours of every vector are compared with each other.
The broadcast model is bounded by sample and tree count.

Defined cases: vectors that are null, of another length, all zero or with null, NaN or
infinite values take no part; repeated ids count once; ties in cosine go to the smaller
id; fewer than k others give fewer neighbours; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspan.session import stored


@dataclass(frozen=True)
class ForestConfig:
    """trees, leaves visited per query, sample for fitting, intended and greatest leaf size, neighbours compared through one vector."""

    trees: int = 8
    visits: int = 8
    sample_rows: int = 20_000
    leaf_rows: int = 2_000
    leaf_cap: int = 8_000
    linked: int = 32
    seed: int = 7

    def visits_for(self, total: int) -> int:
        """``visits`` holds for trees of up to 6 levels (64 leaves); deeper trees are searched in proportion to their depth."""
        depth = np.log2(max(total / self.leaf_rows, 1))
        return max(self.visits, int(np.ceil(self.visits * depth / 6)))


class Tree:
    """A binary tree in heap-free arrays: children < 0 are leaves ~child."""

    def __init__(self, planes: np.ndarray, offsets: np.ndarray, children: np.ndarray, leaves: int):
        self.planes, self.offsets, self.children, self.leaves = planes, offsets, children, leaves

    @staticmethod
    def fit(x: np.ndarray, leaf_size: int, rng: np.random.Generator) -> Tree:
        """Split by the hyperplane between two random points' directions until leaves are small."""
        planes, offsets, children, leaves = [], [], [], 0

        def build(rows: np.ndarray) -> int:
            nonlocal leaves
            if len(rows) <= leaf_size:
                leaves += 1
                return ~(leaves - 1)
            best = None
            for _ in range(3):
                a, b = x[rng.choice(rows, 2, replace=False)]
                w = a - b
                norm = float(np.linalg.norm(w))
                if norm < 1e-6:
                    continue
                p = x[rows] @ (w / norm)
                cut = float(np.median(p))
                right = p > cut
                share = right.mean()
                if best is None or abs(share - 0.5) < abs(best[3] - 0.5):
                    best = (w / norm, cut, right, share)
                if abs(share - 0.5) < 0.1:
                    break
            if best is None or not 0 < best[3] < 1:
                leaves += 1
                return ~(leaves - 1)
            at = len(planes)
            planes.append(best[0])
            offsets.append(best[1])
            children.append([0, 0])
            children[at][0] = build(rows[~best[2]])
            children[at][1] = build(rows[best[2]])
            return at

        build(np.arange(len(x)))
        dim = x.shape[1] if x.ndim == 2 else 0
        return Tree(np.asarray(planes, np.float32).reshape(-1, dim), np.asarray(offsets, np.float32), np.asarray(children, np.int64).reshape(-1, 2), leaves)

    def priorities(self, x: np.ndarray) -> np.ndarray:
        """For each row and leaf, the smallest margin on the way to that leaf."""
        out = np.full((len(x), self.leaves), np.inf, np.float32)
        if not len(self.planes):
            return out
        margin = (x @ self.planes.T - self.offsets).T
        path = np.empty((len(self.planes), len(x)), np.float32)
        path[0] = np.inf
        result = np.empty((self.leaves, len(x)), np.float32)
        for node in range(len(self.planes)):  # parents come before their children
            for side in (0, 1):
                p = np.minimum(path[node], margin[node] if side else -margin[node])
                child = self.children[node][side]
                if child < 0:
                    result[~child] = p
                else:
                    path[child] = p
        return result.T


    def home(self, x: np.ndarray) -> np.ndarray:
        """The leaf each row falls into."""
        if not len(self.planes):
            return np.zeros(len(x), np.int64)
        right = (x @ self.planes.T - self.offsets) > 0
        at = np.zeros(len(x), np.int64)
        live = np.ones(len(x), bool)
        while live.any():
            rows = np.flatnonzero(live)
            at[rows] = self.children[at[rows], right[rows, at[rows]].astype(int)]
            live[rows] = at[rows] >= 0
        return ~at


def unit_vectors(df: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    """(id, v): usable vectors scaled to length 1 as float32, one row per id."""

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arr, ids = b.column(1), b.column(0)
            ok = (pa.compute.fill_null(pa.compute.list_value_length(arr), -1).to_numpy(zero_copy_only=False) == dim) & ~pa.compute.is_null(ids).to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(ok)
            if not len(rows):
                continue
            x = arr.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            norm = np.sqrt((x * x).sum(1))
            good = np.isfinite(norm) & (norm > 0)
            big = ~good & np.isfinite(x).all(1) & (np.abs(x).max(1) > 0)
            if big.any():  # lengths beyond the range of doubles
                x[big] /= np.abs(x[big]).max(1)[:, None]
                norm[big] = np.sqrt((x[big] * x[big]).sum(1))
                good |= big
            v = (x[good] / norm[good][:, None]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[good])).cast(pa.int64()), pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), dim).cast(pa.list_(pa.float32()))], names=["id", "v"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v"))
    return src.mapInArrow(scale, "id long, v array<float>").dropDuplicates(["id"])


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(-1, dim)


def direction_classes(units: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Vectors of equal direction as classes: (cls, v) and, for classes of several, (id, cls, first).

    ``cls`` is the smallest id, ``first`` the k + 1 smallest ids. Equality goes by a key of 128
    bits, so vectors are shuffled once, by their unique ids, whatever the groups; the ids
    of a class are cut down to k + 1 per salt before they come together.
    """
    keys = units.select("id", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    found = keys.groupBy("h1", "h2").agg(F.min("id").alias("cls"), F.count("*").alias("n"))
    classes = units.join(found.select(F.col("cls").alias("id")), "id").select(F.col("id").alias("cls"), "v")
    copies = keys.join(found.where("n > 1").select("h1", "h2", "cls"), ["h1", "h2"]).select("id", "cls")
    w = Window.partitionBy("cls", F.pmod(F.xxhash64("id"), F.lit(16))).orderBy("id")
    few = copies.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k + 1)
    first = few.groupBy("cls").agg(F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("first"))
    return classes, copies.join(first, "cls").select("id", "cls", "first")


def fit_forest(rows: DataFrame, total: int, config: ForestConfig) -> tuple[list[Tree], int]:
    """Trees fitted on at most ``sample_rows`` rows; the sample goes by a hash of the id."""
    keep = min(1.0, 1.2 * config.sample_rows / max(total, 1))
    part = rows.select("cls", "v")
    if keep < 1.0:
        part = part.where(F.pmod(F.xxhash64("cls", F.lit(config.seed)), F.lit(1_000_000)) < int(keep * 1_000_000))
    got = part.limit(config.sample_rows).toArrow().combine_chunks()
    if not got.num_rows:
        return [], 0
    got = got.sort_by("cls")
    dim = len(got["v"][0])
    x = _matrix(got["v"].combine_chunks(), dim)
    leaf = max(8, int(config.leaf_rows * len(x) / max(total, 1)))
    rng = np.random.default_rng(config.seed)
    return [Tree.fit(x, leaf, rng) for _ in range(config.trees)], dim


def _visits(priorities: list[np.ndarray], visits: int, homes: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """Row, leaf (numbered over the forest), home and asked flags and margin of the best leaves over all trees."""
    all_leaves = np.concatenate(priorities, axis=1)
    n, total = all_leaves.shape
    base = np.cumsum([0, *[p.shape[1] for p in priorities[:-1]]])
    home = np.stack(homes or [p.argmax(1) for p in priorities], 1) + base
    take = min(visits, total)
    best = np.argpartition(-all_leaves, take - 1, axis=1)[:, :take] if take < total else np.tile(np.arange(total), (n, 1))
    is_home = np.zeros((n, total), bool)
    np.put_along_axis(is_home, home, True, 1)
    asked = np.zeros((n, total), bool)
    np.put_along_axis(asked, best, True, 1)
    row, leaf = np.nonzero(is_home | asked)
    return [row, leaf, is_home[row, leaf], asked[row, leaf], all_leaves[row, leaf]]


_ROUTED = "leaf string, role int, margin float, cls long, v array<float>"


def _route(classes: DataFrame, trees: list[Tree], dim: int, visits: int) -> DataFrame:
    """(leaf, role, margin, cls, v): role 0 is a member that asks, 1 a member only, 2 asks only."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                x = _matrix(b.column("v"), dim)
                row, leaf, home, asked, margin = _visits([t.priorities(x) for t in trees], visits)
                role = np.where(home & asked, 0, np.where(home, 1, 2)).astype(np.int32)
                idx = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int64)).cast(pa.string()), pa.array(role), pa.array(margin), b.column("cls").take(idx), b.column("v").take(idx)], names=["leaf", "role", "margin", "cls", "v"])

    return classes.select("cls", "v").mapInArrow(route, _ROUTED)


def _overfull(classes: DataFrame, trees: list[Tree], dim: int, cap: int) -> bool:
    """Whether any leaf holds more rows than the cap; a light pass that moves counts only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(t.leaves, np.int64) for t in trees]
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                x = _matrix(b.slice(at, 4096).column("v"), dim)
                for t, s in zip(trees, sums):
                    s += np.bincount(t.home(x), minlength=t.leaves)
        tree = np.repeat(np.arange(len(trees)), [t.leaves for t in trees])
        leaf = np.concatenate([np.arange(t.leaves) for t in trees])
        yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(leaf), pa.array(np.concatenate(sums))], names=["tree", "leaf", "n"])

    sizes = classes.select("v").mapInArrow(count, "tree long, leaf long, n long")
    return sizes.groupBy("tree", "leaf").agg(F.sum("n").alias("n")).where(F.col("n") > cap).limit(1).count() > 0


def _split_leaves(routed: DataFrame, dim: int, config: ForestConfig) -> DataFrame:
    """Split leaves above the cap by trees fitted on a bounded sample of each such leaf, keeping one shared order."""
    depth, before = 0, None
    while True:
        depth += 1
        sizes = routed.where(F.col("role") <= 1).groupBy("leaf").count()
        big = stored(sizes.where(F.col("count") > config.leaf_cap), f"big-leaves-{depth}")
        held = big.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
        if not held[0] or held == before:  # all fit, or the last level parted none
            return routed
        before = held
        sample = 1024
        picked = routed.where(F.col("role") <= 1).join(big, "leaf").where(F.pmod(F.xxhash64("cls", F.lit(depth)), F.lit(1 << 30)) < F.lit(float(sample << 30)) / F.col("count"))

        def fit(pdf: pd.DataFrame) -> pd.DataFrame:
            x = np.stack(pdf.sort_values("cls")["v"].to_numpy()).astype(np.float32)
            size = int(pdf["count"].iloc[0])
            leaf = max(8, int(config.leaf_cap / 2 * len(x) / size))
            t = Tree.fit(x, leaf, np.random.default_rng(config.seed + depth))
            return pd.DataFrame({"leaf": [pdf["leaf"].iloc[0]], "planes": [t.planes.tobytes()], "offsets": [t.offsets.tobytes()], "children": [t.children.tobytes()], "leaves": [t.leaves]})

        subtrees = picked.groupBy("leaf").applyInPandas(fit, "leaf string, planes binary, offsets binary, children binary, leaves long")

        def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for leaf, g in pdf.groupby("leaf"):
                    if g["leaves"].isna().iloc[0]:
                        yield g[["leaf", "role", "margin", "cls", "v"]]
                        continue
                    children = np.frombuffer(g["children"].iloc[0], np.int64).reshape(-1, 2)
                    t = Tree(np.frombuffer(g["planes"].iloc[0], np.float32).reshape(-1, dim), np.frombuffer(g["offsets"].iloc[0], np.float32), children, int(g["leaves"].iloc[0]))
                    x = np.stack(g["v"].to_numpy()).astype(np.float32)
                    row, sub, home, asked, margin = _visits([np.minimum(t.priorities(x), g["margin"].to_numpy(np.float32)[:, None])], config.visits, [t.home(x)])
                    was = g["role"].to_numpy()[row]
                    member, asks = home & (was <= 1), asked & (was != 1)
                    role = np.where(member & asks, 0, np.where(member, 1, 2))
                    keep = member | asks
                    h = g.iloc[row[keep]]
                    yield pd.DataFrame({"leaf": [f"{leaf}.{s}" for s in sub[keep]], "role": role[keep].astype(np.int32), "margin": margin[keep], "cls": h["cls"].to_numpy(), "v": h["v"].to_numpy()})

        deeper = routed.join(subtrees, "leaf", "left").mapInPandas(descend, _ROUTED)
        # a vector asks in at most visits x visits leaves here; the best of the whole forest go on
        order = Window.partitionBy("cls").orderBy((F.col("role") == 1).cast("int"), F.desc("margin"), "leaf")
        ranked = deeper.withColumn("_n", F.row_number().over(order))
        late = F.col("_n") > config.visits
        merged = ranked.where(~late | (F.col("role") != 2)).withColumn("role", F.when(late, 1).otherwise(F.col("role"))).drop("_n")
        routed = stored(merged, f"split-leaves-{depth}")


def _score(dim: int, k: int, min_cosine: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by leaf and role: members are held, askers stream against them."""
        leaf, ids, mats, asks = None, [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if not ids:
                return
            m_id, m = np.concatenate(ids), np.concatenate(mats)
            for q_id, q in asks:
                for s in range(0, len(q_id), 1024):
                    part = q[s : s + 1024]
                    cos = part @ m.T
                    np.putmask(cos, q_id[s : s + 1024, None] == m_id[None, :], -2)
                    n = min(k + 3, cos.shape[1])
                    flat = np.flatnonzero(cos >= np.float32(min_cosine - 1e-5))
                    if len(flat) * 5 > cos.size and n < cos.shape[1]:  # most are near: cut down first
                        top = np.argpartition(-cos, n - 1, axis=1)[:, :n]
                        r = np.repeat(np.arange(len(part)), n)
                        mem = top.ravel()
                        near = cos[r, mem] >= min_cosine - 1e-5
                        r, mem = r[near], mem[near]
                    else:
                        r, mem = np.divmod(flat, cos.shape[1])
                        if len(r) and np.bincount(r).max() > n:
                            order = np.lexsort((-cos[r, mem], r))
                            r, mem = r[order], mem[order]
                            first = np.arange(len(r)) - np.searchsorted(r, r) < n
                            r, mem = r[first], mem[first]
                    exact = np.einsum("ij,ij->i", part[r].astype(np.float64), m[mem].astype(np.float64))
                    keep = exact >= min_cosine
                    if keep.any():
                        yield pa.RecordBatch.from_arrays([pa.array(q_id[s : s + 1024][r[keep]]), pa.array(m_id[mem[keep]]), pa.array(exact[keep])], names=["a", "b", "cosine"])
            asks.clear()

        for b in batches:
            names = b.column("leaf").to_pylist()
            role, cls, v = b.column("role").to_numpy(), b.column("cls").to_numpy(), _matrix(b.column("v"), dim)
            cuts = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
            for lo, hi in zip([0, *cuts], [*cuts, len(names)]):
                if lo == hi:
                    continue
                if names[lo] != leaf:
                    yield from flush()
                    leaf, ids, mats, asks = names[lo], [], [], []
                r = role[lo:hi]
                if (r <= 1).any():
                    ids.append(cls[lo:hi][r <= 1])
                    mats.append(v[lo:hi][r <= 1])
                if (r != 1).any():
                    asks.append((cls[lo:hi][r != 1], v[lo:hi][r != 1]))
                if (r == 2).any() and sum(len(a[0]) for a in asks) > 20_000:  # members come first, so all are held
                    yield from flush()
        yield from flush()

    return score


def _compare_linked(dim: int, min_cosine: float):
    """(a, b, cosine), a < b: pairs of members of one center; rows (center, m, v) sorted by center."""

    def pairs(center: np.ndarray, m: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = np.arange(len(center))
        partners = np.searchsorted(center, center, side="right") - rows - 1
        before = np.concatenate([[0], np.cumsum(partners)])
        for lo in range(0, int(before[-1]), 20_000):
            n = np.arange(lo, min(lo + 20_000, int(before[-1])))
            i = np.searchsorted(before, n, side="right") - 1
            j = i + 1 + n - before[i]
            exact = np.einsum("ij,ij->i", v[i].astype(np.float64), v[j].astype(np.float64))
            near = exact >= min_cosine
            a, b = m[i[near]], m[j[near]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(exact[near])], names=["a", "b", "cosine"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, m, v = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, dim), np.float32)
        for b in batches:
            if not b.num_rows:
                continue
            center, m, v = np.concatenate([center, b.column("center").to_numpy()]), np.concatenate([m, b.column("m").to_numpy()]), np.concatenate([v, _matrix(b.column("v"), dim)])
            open_from = int(np.searchsorted(center, center[-1]))  # the last center may go on in the next batch
            yield from pairs(center[:open_from], m[:open_from], v[:open_from])
            center, m, v = center[open_from:], m[open_from:], v[open_from:]
        yield from pairs(center, m, v)

    return compare


def linked_neighbours(classes: DataFrame, found: DataFrame, dim: int, k: int, min_cosine: float, config: ForestConfig) -> DataFrame:
    """(a, b, cosine): up to k best of those found, in either direction, and of those that share a neighbour.

    Of each vector its ``linked`` best neighbours are compared with each other; this bounds
    what one vector in the middle of many adds and takes nothing away from ``found``.
    """
    known = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cosine")
    both = lambda pairs: pairs.select(F.explode(F.array(F.struct("a", "b", "cosine"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))).alias("p")).select("p.*")
    once = lambda pairs: pairs.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    w = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    links = both(once(known)).withColumn("n", F.row_number().over(w)).where(F.col("n") <= config.linked)
    groups = links.groupBy("a").agg(F.collect_list("b").alias("m")).where(F.size("m") > 1).select(F.col("a").alias("center"), F.explode("m").alias("m"))
    members = groups.join(classes.withColumnRenamed("cls", "m"), "m").select("center", "m", "v")
    compared = members.repartition("center").sortWithinPartitions("center").mapInArrow(_compare_linked(dim, min_cosine), "a long, b long, cosine double")
    ranked = both(once(known.unionByName(compared))).withColumn("n", F.row_number().over(w)).where(F.col("n") <= k)
    return ranked.drop("n")


def class_neighbours(classes: DataFrame, k: int, min_cosine: float, config: ForestConfig) -> DataFrame:
    """(a, b, cosine): up to k best other classes of each class, cosine at least min_cosine."""
    total = classes.count()
    config = replace(config, visits=config.visits_for(total))
    trees, dim = fit_forest(classes, total, config)
    if not trees:
        return classes.sparkSession.createDataFrame([], "a long, b long, cosine double")
    routed = _route(classes, trees, dim, config.visits)
    if _overfull(classes, trees, dim, config.leaf_cap):
        routed = _split_leaves(stored(routed, "routed"), dim, config)
    placed = routed.repartition("leaf").sortWithinPartitions("leaf", "role")
    pairs = placed.mapInArrow(_score(dim, k, min_cosine), "a long, b long, cosine double")
    best = pairs.groupBy("a").agg(F.slice(F.sort_array(F.collect_set(F.struct((-F.col("cosine")).alias("far"), "b"))), 1, k).alias("top"))
    found = best.select("a", F.explode("top").alias("t")).select("a", F.col("t.b").alias("b"), (-F.col("t.far")).alias("cosine"))
    return linked_neighbours(classes, stored(found, "found"), dim, k, min_cosine, config)


def similar_pairs(df: DataFrame, id_col: str, vector_col: str, *, k: int = 5, min_cosine: float = 0.85, dim: int = 64, config: ForestConfig = ForestConfig()) -> DataFrame:
    """(id_a, id_b, cosine), id_a < id_b: one is among the k nearest of the other."""
    units = stored(unit_vectors(df, id_col, vector_col, dim), "units")
    found, several = direction_classes(units, k)
    classes, copies = stored(found, "classes"), stored(several, "copies")
    near = stored(class_neighbours(classes, k, min_cosine, config), "near")
    groups = copies.where("id = cls").select("cls", "first")
    first = F.coalesce("first", F.array("b"))
    lists = near.join(groups.withColumnRenamed("cls", "b"), "b", "left").select("a", F.explode(first).alias("other"), "cosine")
    own = groups.select(F.col("cls").alias("a"), F.explode("first").alias("other"), F.lit(1.0).alias("cosine"))
    ranked = lists.unionByName(own).groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("cosine")).alias("far"), F.col("other")))), 1, k + 1).alias("top"))
    members = copies.where("id <> cls").select("id", F.col("cls").alias("a")).join(ranked, "a").unionByName(ranked.withColumn("id", F.col("a")))
    others = F.slice(F.filter("top", lambda t: t["other"] != F.col("id")), 1, k)
    pairs = members.select("id", F.explode(others).alias("t")).select("id", F.col("t.other").alias("other"), (-F.col("t.far")).alias("cosine"))
    return pairs.groupBy(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).agg(F.max("cosine").alias("cosine"))


def recall_queries(df: DataFrame, id_col: str, vector_col: str, *, k: int = 5, min_cosine: float = 0.85, dim: int = 64, every: int = 50, block: int = 20_000) -> DataFrame:
    """(q, other, cosine): exact neighbours of every row whose id is divisible by ``every``.

    The stated query set is compared with all rows, in blocks of about ``block`` rows of both sides.
    """
    units = stored(unit_vectors(df, id_col, vector_col, dim), "recall-units")
    return _brute(units, units.where(F.col("id") % every == 0), k, min_cosine, dim, block)


def _brute(units: DataFrame, queries: DataFrame, k: int, min_cosine: float, dim: int, block: int) -> DataFrame:
    row_parts, query_parts = (max(1, -(-x.count() // block)) for x in (units, queries))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = units.select("id", "v", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(row_parts)).cast("int").alias("part"), each(query_parts).alias("block"))
    asks = queries.select("id", "v", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(query_parts)).cast("int").alias("block"), each(row_parts).alias("part"))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, m = left["id"].to_numpy(), np.stack(left["v"].to_numpy()).astype(np.float64)
            for at in range(0, len(right), 512):
                q = right.iloc[at : at + 512]
                qids = q["id"].to_numpy()
                cos = np.stack(q["v"].to_numpy()).astype(np.float64) @ m.T
                cos[qids[:, None] == ids[None, :]] = -2
                r, c = np.nonzero(cos >= np.maximum(np.partition(cos, -min(k, len(ids)), axis=1)[:, -min(k, len(ids))], min_cosine)[:, None])
                out.append(pd.DataFrame({"q": qids[r], "other": ids[c], "cosine": cos[r, c]}))
        return pd.concat(out) if out else pd.DataFrame({"q": [], "other": [], "cosine": []})

    best = rows.groupBy("part", "block").cogroup(asks.groupBy("part", "block")).applyInPandas(compare, "q long, other long, cosine double")
    w = Window.partitionBy("q").orderBy(F.desc("cosine"), "other")
    return best.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k).drop("n")
