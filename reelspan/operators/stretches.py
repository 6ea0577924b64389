"""Order-dependent values (number, previous, next, running sum) of groups of any size.

Rows are placed by range of group and order, so a group that holds a third of all rows
lies in many partitions like any other range. Values are made per partition and group;
only a group that goes on in the next partition needs something carried over. There is at
most one such group per border, so what is broadcast has fewer rows than there are
partitions. Rows equal in all order columns come in no fixed order; null groups are groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspan.session import shuffle_width, stored


class Placed:
    """Rows placed by group and order, and stored; every method adds columns."""

    def __init__(self, df: DataFrame, part: list[str], order: list[str]):
        self.part, self.order = part, order
        width = shuffle_width(df.sparkSession)
        self.rows = stored(df.repartitionByRange(width, *part, *order).withColumn("_p", F.spark_partition_id()), "placed")

    def _local(self) -> Window:
        return Window.partitionBy("_p", *self.part).orderBy(*self.order)

    def _carried(self, aggregates: dict[str, Column], carry: dict[str, Column]) -> DataFrame:
        """Per partition and group what its other partitions bring; only of groups in several, so at most two rows a border."""
        per = self.rows.groupBy("_p", *self.part).agg(*[a.alias(n) for n, a in aggregates.items()])
        over = per.select("_p", *self.part, F.count(F.lit(1)).over(Window.partitionBy(*self.part)).alias("_many"), *[e.alias(n) for n, e in carry.items()])
        return over.where("_many > 1").drop("_many")

    def _joined(self, carried: DataFrame) -> DataFrame:
        names = ["_p", *self.part]
        right = carried.select(*[F.col(n).alias(f"_k_{n}") for n in names], *[c for c in carried.columns if c not in names])
        on = F.lit(True)
        for n in names:
            on = on & F.col(n).eqNullSafe(F.col(f"_k_{n}"))
        return self.rows.join(F.broadcast(right), on, "left").drop(*[f"_k_{n}" for n in names])

    def _others(self, first: int, last: int) -> Window:
        return Window.partitionBy(*self.part).orderBy("_p").rowsBetween(first, last)

    def numbered(self, name: str, *, total: str | None = None) -> Placed:
        """``name``: the position in the group from 1; ``total``: the rows of the group."""
        carried = self._carried({"_c": F.count("*")}, {"_ahead": F.sum("_c").over(self._others(Window.unboundedPreceding, -1)), "_all": F.sum("_c").over(Window.partitionBy(*self.part))})
        joined = self._joined(carried)
        out = joined.withColumn(name, F.row_number().over(self._local()) + F.coalesce("_ahead", F.lit(0)))
        if total:
            out = out.withColumn(total, F.coalesce("_all", F.count(F.lit(1)).over(Window.partitionBy("_p", *self.part))))
        self.rows = out.drop("_ahead", "_all")
        return self

    def previous(self, value: str, name: str) -> Placed:
        """``name``: the value of the row before in the group, or null."""
        last = F.max_by(F.struct(F.col(value).alias("x")), F.struct(*self.order))
        carried = self._carried({"_v": last}, {"_from": F.max(F.struct("_p", "_v")).over(self._others(Window.unboundedPreceding, -1))})
        out = self._joined(carried).withColumn("_first", F.row_number().over(self._local()) == 1)
        self.rows = out.withColumn(name, F.when(F.col("_first"), F.col("_from._v.x")).otherwise(F.lag(value).over(self._local()))).drop("_first", "_from")
        return self

    def following(self, value: str, name: str) -> Placed:
        """``name``: the value of the next row in the group, or null."""
        first = F.min_by(F.struct(F.col(value).alias("x")), F.struct(*self.order))
        carried = self._carried({"_v": first}, {"_from": F.min(F.struct("_p", "_v")).over(self._others(1, Window.unboundedFollowing))})
        back = Window.partitionBy("_p", *self.part).orderBy(*[F.desc(c) for c in self.order])
        out = self._joined(carried).withColumn("_last", F.row_number().over(back) == 1)
        self.rows = out.withColumn(name, F.when(F.col("_last"), F.col("_from._v.x")).otherwise(F.lead(value).over(self._local()))).drop("_last", "_from")
        return self

    def running(self, value: str, name: str) -> Placed:
        """``name``: the sum of the value over the group up to and with this row."""
        carried = self._carried({"_s": F.sum(value)}, {"_ahead": F.sum("_s").over(self._others(Window.unboundedPreceding, -1))})
        out = self._joined(carried)
        self.rows = out.withColumn(name, F.sum(value).over(self._local().rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("_ahead", F.lit(0))).drop("_ahead")
        return self

    def result(self) -> DataFrame:
        return self.rows.drop("_p")
