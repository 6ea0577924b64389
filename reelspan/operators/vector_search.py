"""Exact vector search by inner product, and a table of vectors with stable ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspan.functions import ids, vectors
from reelspan.operators import blocks


#: Up to this many stated queries are sent to the corpus; more are compared in blocks of both sides.
BROADCAST_QUERIES = 10_000


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, m: np.ndarray, k: int) -> pd.DataFrame:
    """The k greatest inner products of each query with these rows, ties by the smaller id."""
    out = []
    order = np.argsort(ids, kind="stable")
    ids, m = ids[order], m[order]
    for s in range(0, len(q_ids), 256):
        score = q[s : s + 256] @ m.T
        n = min(k, score.shape[1])
        least = np.partition(score, -n, axis=1)[:, -n]
        r, c = np.nonzero(score >= least[:, None])
        best = np.lexsort((c, -score[r, c], r))
        r, c = r[best], c[best]
        first = np.arange(len(r)) - np.searchsorted(r, r) < n
        r, c = r[first], c[first]
        out.append(pd.DataFrame({"query_id": q_ids[s : s + 256][r], "item_id": ids[c], "score": score[r, c]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "item_id": [], "score": []})


def exact_top_k(queries: DataFrame, corpus: DataFrame, k: int, *, query_id: str = "query_id", query_vector: str = "query_vector", item_id: str = "item_id", vector: str = "vector", broadcast_queries: int | None = None) -> DataFrame:
    """(query_id, item_id, score, rank) of the k greatest inner products; ties go to the smaller id.

    A bounded number of stated queries is broadcast and the corpus stays in place; more
    are compared in blocks of both sides. Either way a task passes on k rows per query and batch.
    Null vectors take no part; ids are numbers.
    """
    limit = BROADCAST_QUERIES if broadcast_queries is None else broadcast_queries
    asks = queries.where(F.col(query_vector).isNotNull()).select(F.col(query_id).cast("long").alias("query_id"), F.col(query_vector).cast("array<double>").alias("q"))
    rows = corpus.where(F.col(vector).isNotNull()).select(F.col(item_id).cast("long").alias("item_id"), F.col(vector).cast("array<double>").alias("v"))
    schema = "query_id long, item_id long, score double"
    few = asks.limit(limit + 1).toPandas()
    if len(few) <= limit:
        if not len(few):
            return rows.sparkSession.createDataFrame([], schema + ", rank int")
        shared = rows.sparkSession.sparkContext.broadcast((few["query_id"].to_numpy(), np.stack(few["q"].to_numpy())))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            q_ids, q = shared.value
            for b in batches:
                if len(b):
                    yield _best(q_ids, q, b["item_id"].to_numpy(), np.stack(b["v"].to_numpy()), k)

        pairs = rows.mapInPandas(scan, schema)
    else:

        def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return pd.DataFrame({"query_id": [], "item_id": [], "score": []})
            return _best(a["query_id"].to_numpy(), np.stack(a["q"].to_numpy()), b["item_id"].to_numpy(), np.stack(b["v"].to_numpy()), k)

        pairs = blocks.in_blocks(asks, rows, compare, schema, left_id="query_id", right_id="item_id")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "item_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


class VectorTable:
    """Vectors keyed by contiguous ids from 1; every change gives a new table."""

    def __init__(self, rows: DataFrame | None = None, top_id: int = 0):
        self.rows, self.top_id = rows, top_id

    def add(self, incoming: DataFrame, *order: str, vector: str = "vector", dim: int | None = None) -> VectorTable:
        """Append rows with the next ids, in the given order; a wrong dimension raises."""
        if dim is not None and incoming.where(F.size(vectors.vector_faults(F.col(vector), dim, unit_tolerance=None)) > 0).limit(1).count():
            raise ValueError("unusable vectors")
        made = ids.next_ids(incoming, self.top_id, *order, name="vector_id")
        n = incoming.count()
        return VectorTable(made if self.rows is None else self.rows.unionByName(made), self.top_id + n)

    def rollback(self, top_id: int) -> VectorTable:
        """Without the ids above ``top_id``; they are given again."""
        return VectorTable(None if self.rows is None else self.rows.where(F.col("vector_id") <= top_id), top_id)

    def remove(self, gone: DataFrame) -> VectorTable:
        return VectorTable(self.rows.join(gone.select("vector_id"), "vector_id", "left_anti"), self.top_id) if self.rows is not None else self

    def missing(self, wanted: DataFrame) -> DataFrame:
        """Ids asked for that the table lacks."""
        have = self.rows.select("vector_id") if self.rows is not None else wanted.select("vector_id").limit(0)
        return wanted.select("vector_id").join(have, "vector_id", "left_anti")

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        return exact_top_k(queries, self.rows.select(F.col("vector_id").alias("item_id"), "vector"), k)
