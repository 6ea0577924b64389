"""Vector expressions over array columns; sums run in double."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalize(v: Column, epsilon: float = 1e-12) -> Column:
    """Scaled to length 1; null for a zero or non-finite vector."""
    n = norm(v)
    return F.when(finite(v) & (n > epsilon), F.transform(v, lambda x: x.cast("double") / n))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))


def finite(v: Column) -> Column:
    """Whether all values are there and finite."""
    return F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))


def vector_faults(v: Column, dim: int, *, unit_tolerance: float | None = 1e-3) -> Column:
    """Reasons why a vector is unusable: missing, dimension, not_finite, zero, not_unit."""
    n = norm(v)
    checks = [
        F.when(v.isNull(), "missing"),
        F.when(v.isNotNull() & (F.size(v) != dim), "dimension"),
        F.when(v.isNotNull() & ~finite(v), "not_finite"),
        F.when(finite(v) & (n == 0), "zero"),
    ]
    if unit_tolerance is not None:
        checks.append(F.when(finite(v) & (n > 0) & (F.abs(n - 1) > unit_tolerance), "not_unit"))
    return F.array_compact(F.array(*checks))


def mean_pool(df: DataFrame, keys: list[str], vector: str, *, weight: Column | None = None, dim: int | None = None) -> DataFrame:
    """keys and ``pooled``: the (weighted) mean of vectors per key, scaled to length 1.

    With ``dim`` a task adds up whole vectors and passes on one row per key; vectors of
    another length or with a null take no part, weights are not negative. Without it vectors of any
    length are added up by position, as rows. Either way no key is gathered anywhere.
    """
    w = F.lit(1.0) if weight is None else weight
    if dim is not None:
        whole = (F.size(vector) == dim) & F.forall(vector, lambda x: x.isNotNull())
        rows = df.where(whole).select(*keys, w.cast("double").alias("_w"), array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
        per = rows.groupBy(*keys).agg(Summarizer.mean(F.col("_v"), F.col("_w")).alias("_m"))
        return per.select(*keys, normalize(vector_to_array("_m")).alias("pooled"))
    flat = df.select(*keys, w.alias("_w"), F.posexplode(vector).alias("_i", "_x"))
    per = flat.groupBy(*keys, "_i").agg((F.sum(F.col("_w") * F.col("_x").cast("double")) / F.sum("_w")).alias("_m"))
    back = per.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda s: s["_m"]).alias("_v"))
    return back.select(*keys, normalize(F.col("_v")).alias("pooled"))
