"""Filling containers of fixed capacity with texts, sized in tokens of a public tokenizer.

The configuration linear program (how many containers of each combination of sizes) is
solved over the histogram of sizes by multiplicative weights: each round prices the sizes
by their weight, finds the best combination by dynamic programming for the bounded
knapsack, and lowers the weights of what that combination covers. The fractional solution
is rounded, the program is solved again for what is left, and so on; only the residue that
rounding can place no more is filled by subset sums. The histogram has at most
``capacity`` rows whatever the number of texts, and only it reaches the driver; items are
ranked within their size in parallel and find their container by arithmetic.

A text above the capacity is cut into full containers and one remainder; no other text
is cut.

Defined cases: null texts and texts without tokens need no container and give no row;
repeated ids are items of their own; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspan.session import stored

#: Rank file of the tokenizer, read on the driver and sent to the executors (a vocabulary has a fixed size).
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The public pre-tokenization pattern of byte-level BPE vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ENCODERS: dict[str, object] = {}


def ranks(path: str) -> bytes:
    """The content of a rank file."""
    with open(path, "rb") as f:
        return f.read()


def encoder(path: str, content: bytes | None = None):  # type: ignore[no-untyped-def]
    """The tokenizer of a rank file; built once per process."""
    if path not in _ENCODERS:
        import tiktoken

        lines = map(bytes.split, (ranks(path) if content is None else content).splitlines())
        _ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines}, special_tokens={})
    return _ENCODERS[path]


def token_counts(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, tokens) of every text that has tokens."""
    vocabulary = documents.sparkSession.sparkContext.broadcast(ranks(tokenizer))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, vocabulary.value)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("d"), pa.array(n, pa.int64())], names=["doc_id", "tokens"])

    src = documents.where(F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))
    return src.mapInArrow(count, "doc_id long, tokens long").where(F.col("tokens") > 0)


@dataclass
class Plan:
    """Combination i (counts per size) fills ``times[i]`` containers from number ``first[i]``.

    ``origin[i]`` is ``whole`` (one item as large as a container), ``program`` or ``fill``;
    ``bound`` is the best dual value of the program, below which no packing can go.
    """

    combos: list[dict[int, int]] = field(default_factory=list)
    times: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    origin: list[str] = field(default_factory=list)
    bound: float = 0.0

    @property
    def containers(self) -> int:
        return sum(self.times)

    def count(self, origin: str) -> int:
        return sum(t for t, o in zip(self.times, self.origin) if o == origin)


def _knapsacks(sizes: np.ndarray, left: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """Per row of ``prices`` the combination of greatest price: counts of the sizes, at most ``left`` of each.

    One dynamic program over capacities serves all rows at once; a size is split into
    powers of two, so that its greatest number is bounded.
    """
    item, count = [], []
    for i, s in enumerate(sizes.tolist()):
        most, k = min(int(left[i]), capacity // s), 1
        while most > 0:
            k = min(k, most)
            item.append(i)
            count.append(k)
            most -= k
            k *= 2
    rows = np.arange(len(prices))
    price = prices.astype(np.float32)
    value = np.zeros((len(prices), capacity + 1), np.float32)
    took = np.zeros((len(item), len(prices), capacity + 1), bool)
    for j, (i, k) in enumerate(zip(item, count)):
        w = int(sizes[i]) * k
        with_it = value[:, :-w] + price[:, i : i + 1] * np.float32(k)
        np.greater(with_it, value[:, w:], out=took[j, :, w:])
        np.maximum(value[:, w:], with_it, out=value[:, w:])
    at = np.full(len(prices), capacity)
    out = np.zeros((len(prices), len(sizes)), np.int64)
    for j in range(len(item) - 1, -1, -1):
        use = took[j, rows, at]
        if use.any():
            out[use, item[j]] += count[j]
            at[use] -= int(sizes[item[j]]) * count[j]
    return out


def configuration_program(sizes: np.ndarray, left: np.ndarray, capacity: int, *, chains: int = 16, rounds: int = 64, rate: float = 0.5, priced: int = 120, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """A fractional packing by multiplicative weights: combinations (rows), times, dual bound.

    Covering program: choose how often each combination is used so that every size is
    covered as often as it occurs, with few containers. ``chains`` runs with slightly different
    first weights advance together and their solutions are averaged; the first half of the
    rounds only settles the weights. A round prices ``priced`` sizes drawn by weight;
    the last weights are priced in full for the dual bound.
    """
    rng = np.random.default_rng(seed)
    demand = left.astype(float)
    noise = rng.normal(size=(chains, len(sizes)))
    noise[0] = 0
    weight = left * sizes * np.exp(0.2 * noise)
    total = np.zeros(len(sizes))
    found: dict[bytes, float] = {}
    for r in range(rounds):
        weight /= weight.sum(1, keepdims=True)
        price = weight / demand
        combos = np.zeros((chains, len(sizes)), np.int64)
        pick = np.arange(len(sizes))
        if len(sizes) > priced:
            share = weight.mean(0)
            pick = np.sort(rng.choice(len(sizes), priced, replace=False, p=share / share.sum()))
        combos[:, pick] = _knapsacks(sizes[pick], left[pick], price[:, pick], capacity)
        gain = combos / demand
        step = 1 / gain.max(1)  # how often the scarcest size of the combination allows it
        weight *= np.exp(-rate * gain * step[:, None])
        total += weight.mean(0)
        if 2 * r >= rounds or rounds < 4:
            for c in range(chains):
                key = combos[c].tobytes()
                found[key] = found.get(key, 0.0) + step[c]
    volume = float((left * sizes).sum()) / capacity
    weight = total / total.sum()
    dual = 1 / float((_knapsacks(sizes, left, (weight / demand)[None], capacity)[0] * weight / demand).sum())
    rows = np.array([np.frombuffer(k, np.int64) for k in found])
    times = np.fromiter(found.values(), float)
    return rows, times * (max(volume, 1.0) / times.sum()), max(volume, dual)


def solve(histogram: dict[int, int], capacity: int, *, program: bool = True, fill_rounds: int = 240, **settings: float) -> Plan:
    """A packing of the histogram (size -> count); every item gets a place.

    Phases: the program is solved for what is left and rounded. Its combinations come fullest first,
    the fuller half by times, each up to twice its times (running sums are rounded, so that combinations used a fraction
    of a time are not all lost) and never beyond the items that are left; the next phase
    prices the rest anew. When rounding places nothing more, the residue is filled by
    subset sums and at last largest-first. Without ``program`` all goes to the fill.
    """
    sizes = np.array(sorted(s for s, n in histogram.items() if n > 0 and s > 0), np.int64)
    left = np.array([histogram[s] for s in sizes.tolist()], np.int64)
    plan = Plan()

    def use(combo: dict[int, int], times: int, origin: str) -> None:
        plan.first.append(plan.containers)
        plan.combos.append(combo)
        plan.times.append(times)
        plan.origin.append(origin)

    if len(sizes) and sizes[-1] == capacity:
        use({capacity: 1}, int(left[-1]), "whole")
        sizes, left = sizes[:-1], left[:-1]
    plan.bound = float(plan.containers)
    phase = 0
    while program and len(sizes):
        rows, times, bound = configuration_program(sizes, left, capacity, seed=phase, **settings)  # type: ignore[arg-type]
        if phase == 0:
            plan.bound += bound
        filled = rows @ sizes
        order = np.lexsort((-times, -filled))
        level = filled[order][np.searchsorted(np.cumsum(times[order]), times.sum() / 2)]
        wanted, placed = 0.0, 0
        for c in order[filled[order] >= level].tolist():
            wanted += 2 * times[c]
            on = np.flatnonzero(rows[c])
            n = min(int(wanted + 0.5) - placed, int((left[on] // rows[c, on]).min()))
            if n > 0:
                left[on] -= rows[c, on] * n
                placed += n
                use(dict(zip(sizes[on].tolist(), rows[c, on].tolist())), n, "program")
        sizes, left = sizes[left > 0], left[left > 0]
        phase += 1
        if not placed:
            break
    step = 0
    while len(sizes):
        if step < fill_rounds:
            counts = _knapsacks(sizes, left, (sizes * (1 + 1e-6 * sizes))[None], capacity)[0]
        else:
            counts, room = np.zeros(len(sizes), np.int64), capacity
            for i in range(len(sizes) - 1, -1, -1):
                counts[i] = min(int(left[i]), room // int(sizes[i]))
                room -= int(counts[i] * sizes[i])
        on = np.flatnonzero(counts)
        n = int((left[on] // counts[on]).min())
        left[on] -= counts[on] * n
        use(dict(zip(sizes[on].tolist(), counts[on].tolist())), n, "fill")
        sizes, left = sizes[left > 0], left[left > 0]
        step += 1
    return plan


ORIGINS = ("whole", "program", "fill")


def _lookup(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """Per size: ranks at which combinations begin, items per container, first container, number of the origin."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    for combo, times, first, origin in zip(plan.combos, plan.times, plan.first, plan.origin):
        for s, k in combo.items():
            out.setdefault(s, []).append((used.get(s, 0), k, first, ORIGINS.index(origin)))
            used[s] = used.get(s, 0) + k * times
    return {s: tuple(np.array(c, np.int64) for c in zip(*rows)) for s, rows in out.items()}  # type: ignore[misc]


def pack(counts: DataFrame, capacity: int, *, rows_per_salt: int = 500_000, program: bool = True) -> DataFrame:
    """(doc_id, part, token_from, token_to, container_id, origin) for (doc_id, tokens).

    ``origin`` tells what made the container: ``whole``, ``program`` or ``fill``.
    """
    spark = counts.sparkSession
    schema = "doc_id long, part long, token_from long, token_to long, container_id long, origin string"
    items = counts.select("doc_id", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {capacity}"))).alias("part")).select(
        "doc_id", "part", (F.col("part") * capacity).alias("token_from"), F.least(F.col("tokens"), (F.col("part") + 1) * capacity).alias("token_to")
    )
    items = items.withColumn("size", (F.col("token_to") - F.col("token_from")).cast("long"))
    histogram = {int(r["size"]): int(r["count"]) for r in items.groupBy("size").count().collect()}  # at most ``capacity`` rows
    if not histogram:
        return spark.createDataFrame([], schema)
    lookup = spark.sparkContext.broadcast(_lookup(solve(histogram, capacity, program=program)))
    salts = max(8, -(-max(histogram.values()) // rows_per_salt))
    items = items.withColumn("salt", F.pmod(F.xxhash64("doc_id", "part"), F.lit(salts)))
    per = items.groupBy("size", "salt").count()
    offsets = per.select("size", "salt", (F.sum("count").over(Window.partitionBy("size").orderBy("salt")) - F.col("count")).alias("offset"))
    ranked = items.withColumn("rank", F.row_number().over(Window.partitionBy("size", "salt").orderBy("doc_id", "part")) - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lookup.value
        names = ["doc_id", "part", "token_from", "token_to", "container_id", "origin"]
        for b in batches:
            size, rank = b.column("size").to_numpy(), b.column("rank").to_numpy()
            out, made = np.empty(len(size), np.int64), np.empty(len(size), np.int32)
            order = np.argsort(size, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
                if not len(rows):
                    continue
                begin, k, first, origin = table[int(size[rows[0]])]
                j = np.searchsorted(begin, rank[rows], "right") - 1
                out[rows] = first[j] + (rank[rows] - begin[j]) // k[j]
                made[rows] = origin[j]
            origins = pa.array(ORIGINS).take(pa.array(made))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names[:4]] + [pa.array(out), origins], names=names)

    placed = ranked.join(offsets, ["size", "salt"]).select("doc_id", "part", "token_from", "token_to", "size", (F.col("rank") + F.col("offset")).cast("long").alias("rank"))
    return placed.mapInArrow(place, schema)


def pack_documents(documents: DataFrame, *, capacity: int = 2048, tokenizer: str = TOKENIZER) -> DataFrame:
    """Containers of all texts of a table."""
    return pack(stored(token_counts(documents, tokenizer=tokenizer), "token-counts"), capacity)


def container_fill(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers (and how they were made), tokens, least possible containers, unused share, fullest container."""
    per = packed.groupBy("container_id").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("used"), F.first("origin").alias("origin"))
    return per.agg(
        F.count("*").alias("containers"),
        *[F.count_if(F.col("origin") == o).alias(f"by_{o}") for o in ORIGINS],
        F.sum("used").alias("tokens"),
        F.ceil(F.sum("used") / capacity).alias("least_containers"),
        (1 - F.sum("used") / (F.count("*") * capacity)).alias("unused_share"),
        F.max("used").alias("fullest"),
    )


def packing_faults(packed: DataFrame, counts: DataFrame, capacity: int) -> DataFrame:
    """One row of counts: texts packed, and what must be 0: texts whose tokens are not covered
    exactly once, texts cut without need, containers above the capacity, numbers left out."""
    per = packed.groupBy("doc_id").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("got"), F.max("token_to").alias("last"), F.min("token_from").alias("first"), F.count("*").alias("parts"), F.count_distinct("token_from").alias("starts"))
    want = counts.groupBy("doc_id").agg(F.sum("tokens").alias("tokens"), F.max("tokens").alias("longest"), F.sum(F.ceil(F.col("tokens") / capacity)).alias("pieces"))
    texts = want.join(per, "doc_id", "full").agg(
        F.count("got").alias("texts"),
        F.count_if(~F.col("tokens").eqNullSafe(F.col("got")) | ~F.col("longest").eqNullSafe(F.col("last")) | (F.col("first") != 0)).alias("not_covered_once"),
        F.count_if(~F.col("parts").eqNullSafe(F.col("pieces"))).alias("cut_without_need"),
    )
    full = packed.groupBy("container_id").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("used"))
    boxes = full.agg(F.count_if(F.col("used") > capacity).alias("above_capacity"), (F.coalesce(F.max("container_id") + 1, F.lit(0)) - F.count("*")).alias("numbers_left_out"))
    both = texts.unionByName(boxes, allowMissingColumns=True)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])
