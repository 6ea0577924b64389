"""Merging overlapping integer intervals and listing the gaps, with dyadic blocks.

An interval is cut along a grid of radix 2**16 into pieces that each lie in one grid cell
of one tier (milliseconds, then cells of 65 536 ms, and so on), at most seven pieces
however long it is. Per cell the pieces are decomposed into canonical dyadic blocks;
blocks with an ancestor in the cell are removed, sibling pairs are merged upward and
adjacent blocks are coalesced into runs. Cells are independent, and a cell holds at most
65 536 pieces because only the furthest end of each start matters (combined before the
shuffle), so a hot entity spreads over its timeline. Runs are then put in order per
(entity, stretch of 2**22 ms), and only one summary row per stretch is ordered per entity.

Defined cases: rows with a null bound, a null entity or end <= start take no part;
repeated rows change nothing; touching intervals form one period; negative bounds are
allowed; an empty table gives an empty result; columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspan.session import stored

BITS = 16
TIERS = 4
STRETCH_BITS = 22
_SIDE = 1 << BITS


def _pieces(start: str, end: str):
    """Array of (tier, cell, lo, hi): offsets within the cell, in units of the tier."""
    out, a, b, alive = [], F.col(start), F.col(end), F.lit(True)
    for t in range(TIERS):
        ca, cb = F.shiftright(a, BITS), F.shiftright(b - 1, BITS)
        la, last = a - F.shiftleft(ca, BITS), b - F.shiftleft(cb, BITS)
        one = alive & (ca == cb)
        piece = lambda c, lo, hi, t=t: F.struct(F.lit(t).alias("tier"), c.alias("cell"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
        if t == TIERS - 1:
            out.append(F.when(alive, piece(ca, la, b - F.shiftleft(ca, BITS))))
            break
        out.append(F.when(one, piece(ca, la, last)))
        out.append(F.when(alive & (ca != cb) & (la > 0), piece(ca, la, F.lit(_SIDE))))
        out.append(F.when(alive & (ca != cb) & (last < _SIDE), piece(cb, F.lit(0), last)))
        na, nb = F.when(la > 0, ca + 1).otherwise(ca), F.when(last < _SIDE, cb).otherwise(cb + 1)
        alive, a, b = alive & (ca != cb) & (na < nb), na, nb
    return F.filter(F.array(*out), lambda p: p.isNotNull())


def dyadic_runs(g: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the union of [lo, hi) in each group; bounds within [0, 2**16].

    Decompose into canonical dyadic blocks, drop blocks under an ancestor, merge sibling
    pairs upward, coalesce neighbours. Returned in order of group and start.
    """
    width = BITS + 1
    a, b, key = lo.astype(np.int64), hi.astype(np.int64), g.astype(np.int64) << width
    levels: list[np.ndarray] = []
    for _ in range(width):
        live = a < b
        a, b, key = a[live], b[live], key[live]
        left, right = (a & 1) == 1, (b & 1) == 1
        levels.append(np.unique(np.concatenate([key[left] | a[left], key[right] | (b[right] - 1)])))
        a, b = (a + (a & 1)) >> 1, b >> 1
    mask = (1 << width) - 1
    present = [m for m in range(width) if len(levels[m])]
    for low in present:
        blocks = levels[low]
        covered = np.zeros(len(blocks), bool)
        for m in present:
            if m > low and len(levels[m]):
                up = (blocks & ~mask) | ((blocks & mask) >> (m - low))
                at = np.minimum(np.searchsorted(levels[m], up), len(levels[m]) - 1)
                covered |= levels[m][at] == up
        levels[low] = blocks[~covered]
    starts, ends = [], []
    for level in range(width):
        blocks = levels[level]
        if level < BITS and len(blocks) > 1:
            first = np.zeros(len(blocks), bool)
            first[:-1] = ((blocks[:-1] & 1) == 0) & (blocks[1:] == blocks[:-1] + 1)
            second = np.roll(first, 1)
            if first.any():
                merged = blocks[first]
                parents = (merged & ~mask) | ((merged & mask) >> 1)
                levels[level + 1] = np.union1d(levels[level + 1], parents)
                blocks = blocks[~(first | second)]
        group, at = blocks & ~mask, blocks & mask
        starts.append(group | (at << level))
        ends.append(group | ((at + 1) << level))
    start, end = np.concatenate(starts), np.concatenate(ends)
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    if not len(start):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    new = np.ones(len(start), bool)
    new[1:] = start[1:] != end[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return start[first] >> width, start[first] & mask, end[last] & mask


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs per cell of rows sorted by cell; the last, perhaps unfinished, cell is carried on."""

    def runs(t: pa.Table) -> pa.RecordBatch:
        cell, tier = t["cell"].to_numpy(), t["tier"].to_numpy()
        entity = t["entity"].combine_chunks().dictionary_encode()
        code = entity.indices.to_numpy(zero_copy_only=False)
        new = np.ones(t.num_rows, bool)
        new[1:] = (cell[1:] != cell[:-1]) | (tier[1:] != tier[:-1]) | (code[1:] != code[:-1])
        head = np.flatnonzero(new)
        g, lo, hi = dyadic_runs(np.cumsum(new) - 1, t["lo"].to_numpy(), t["hi"].to_numpy())
        row = head[g]
        base, shift = cell[row] << BITS, tier[row].astype(np.int64) * BITS
        return pa.RecordBatch.from_arrays([t["entity"].combine_chunks().take(pa.array(row)), pa.array((base + lo) << shift), pa.array((base + hi) << shift)], names=["entity", "lo", "hi"])

    rest: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t])
        if not t.num_rows:
            continue
        entity, cell, tier = t["entity"], t["cell"].to_numpy(), t["tier"].to_numpy()
        same = (cell == cell[-1]) & (tier == tier[-1]) & pa.compute.equal(entity, entity[-1]).to_numpy()
        cut = t.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield runs(t.slice(0, cut))
        rest = t.slice(cut)
    if rest is not None and rest.num_rows:
        yield runs(rest)


def interval_runs(df: DataFrame, entity: str, start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """(entity, lo, hi): runs of the union of the intervals, broken at most at grid lines."""
    valid = df.where(F.col(entity).isNotNull() & (F.col(end) > F.col(start))).select(F.col(entity).alias("entity"), F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e"))
    pieces = valid.select("entity", F.inline(_pieces("s", "e"))).groupBy("entity", "tier", "cell", "lo").agg(F.max("hi").alias("hi"))
    cells = pieces.repartition("entity", "tier", "cell").sortWithinPartitions("entity", "tier", "cell", "lo")
    return cells.mapInArrow(_cells, f"entity {dict(df.dtypes)[entity]}, lo long, hi long")


def _ordered(runs: DataFrame) -> DataFrame:
    """Runs with ``before``: the furthest end of all runs of the entity that start earlier."""
    runs = stored(runs.withColumn("stretch", F.shiftright("lo", STRETCH_BITS)), "runs")  # read twice
    inner = Window.partitionBy("entity", "stretch").orderBy("lo", F.col("hi").desc())
    local = runs.withColumn("seen", F.max("hi").over(inner.rowsBetween(Window.unboundedPreceding, -1)))
    sums = runs.groupBy("entity", "stretch").agg(F.max("hi").alias("top"))
    over = Window.partitionBy("entity").orderBy("stretch")
    carried = sums.select("entity", "stretch", F.max("top").over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("carry"), F.max("top").over(Window.partitionBy("entity")).alias("last_end"))
    return local.join(carried, ["entity", "stretch"]).withColumn("before", F.greatest("seen", "carry"))


def interval_gaps(df: DataFrame, entity: str, start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """(entity, gap_start, gap_end) between neighbouring continuous periods."""
    return _ordered(interval_runs(df, entity, start, end)).where(F.col("lo") > F.col("before")).select("entity", F.col("before").alias("gap_start"), F.col("lo").alias("gap_end"))


def continuous_periods(df: DataFrame, entity: str, start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """(entity, period_start, period_end): the maximal continuous periods."""
    starts = _ordered(interval_runs(df, entity, start, end)).where(F.col("before").isNull() | (F.col("lo") > F.col("before")))
    inner = Window.partitionBy("entity", "stretch").orderBy("lo")
    starts = starts.withColumn("next_gap", F.lead("before").over(inner))
    firsts = starts.groupBy("entity", "stretch").agg(F.min("before").alias("first_gap"), F.min("lo").alias("first_lo"))
    later = firsts.select("entity", "stretch", F.lead("first_gap").over(Window.partitionBy("entity").orderBy("stretch")).alias("later_gap"))
    return starts.join(later, ["entity", "stretch"]).select("entity", F.col("lo").alias("period_start"), F.coalesce("next_gap", "later_gap", "last_end").alias("period_end"))
