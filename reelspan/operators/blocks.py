"""Two sides against each other in blocks of bounded size, without a cross join and without a row per pair."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_blocks(left: DataFrame, right: DataFrame, compute: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str, *, left_id: str, right_id: str, on: tuple[str, ...] = (), rows: int = 10_000) -> DataFrame:
    """``compute`` for every pair of blocks of the two sides (that agree ``on`` columns).

    Rows are spread by a hash of their id, so the blocks of a group hold about ``rows`` rows
    however large the group is; each side is sent once per block of the other.
    """

    def parts(df: DataFrame) -> int:
        most = df.groupBy(*on).count().agg(F.max("count")).first()[0] or 0
        return max(1, -(-int(most) // rows))

    n_left, n_right = parts(left), parts(right)
    numbered = lambda df, i, n, name: df.withColumn(name, F.pmod(F.xxhash64(i), F.lit(n)).cast("int"))
    spread = lambda df, n, name: df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    a = spread(numbered(left, left_id, n_left, "_l"), n_right, "_r")
    b = spread(numbered(right, right_id, n_right, "_r"), n_left, "_l")
    keys = [*on, "_l", "_r"]

    def both(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        return compute(x, y)

    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(both, schema)
