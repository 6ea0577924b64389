"""Box geometry as column expressions. A box is four columns or a struct of x1, y1, x2, y2."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    x1: Column
    y1: Column
    x2: Column
    y2: Column

    @property
    def width(self) -> Column:
        return F.greatest(F.lit(0.0), self.x2 - self.x1)

    @property
    def height(self) -> Column:
        return F.greatest(F.lit(0.0), self.y2 - self.y1)

    @property
    def area(self) -> Column:
        return self.width * self.height

    def clipped(self, width: Column, height: Column) -> Box:
        """Bounds limited to the picture."""
        lim = lambda v, top: F.least(F.greatest(v, F.lit(0.0)), top)
        return Box(lim(self.x1, width), lim(self.y1, height), lim(self.x2, width), lim(self.y2, height))

    def normalized(self, width: Column, height: Column) -> Box:
        """Bounds as shares of the picture."""
        return Box(self.x1 / width, self.y1 / height, self.x2 / width, self.y2 / height)

    def track_box(self, width: Column, height: Column) -> Box:
        """Ordered, clamped and normalized, as track boxes are kept."""
        ordered = Box(F.least(self.x1, self.x2), F.least(self.y1, self.y2), F.greatest(self.x1, self.x2), F.greatest(self.y1, self.y2))
        return ordered.clipped(width, height).normalized(width, height)

    def struct(self) -> Column:
        return F.struct(self.x1.alias("x1"), self.y1.alias("y1"), self.x2.alias("x2"), self.y2.alias("y2"))


def intersection(a: Box, b: Box) -> Column:
    return F.greatest(F.lit(0.0), F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)) * F.greatest(F.lit(0.0), F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 where the union has no area."""
    both = intersection(a, b)
    union = a.area + b.area - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def quadrilateral(points: Column, width: Column, height: Column) -> Column:
    """Four points in the order top left, top right, bottom right, bottom left, clipped; null if it collapses.

    Top left has the least sum of x and y, bottom right the greatest; top right the least
    y - x, bottom left the greatest.
    """
    by = lambda key, first: (F.array_min if first else F.array_max)(F.transform(points, lambda p: F.struct(key(p).alias("k"), p["x"].alias("x"), p["y"].alias("y"))))
    lim = lambda p: F.struct(F.least(F.greatest(p["x"], F.lit(0.0)), width - 1).alias("x"), F.least(F.greatest(p["y"], F.lit(0.0)), height - 1).alias("y"))
    plus, minus = (lambda p: p["x"] + p["y"]), (lambda p: p["y"] - p["x"])
    corners = F.array(lim(by(plus, True)), lim(by(minus, True)), lim(by(plus, False)), lim(by(minus, False)))
    return F.when((F.size(points) == 4) & (F.size(F.array_distinct(corners)) == 4), corners)


def expanded(points: Column, ratio: float, width: Column, height: Column) -> Column:
    """Points moved away from their centre by a share of the distance, clipped."""
    n = F.size(points)
    cx = F.aggregate(points, F.lit(0.0), lambda s, p: s + p["x"]) / n
    cy = F.aggregate(points, F.lit(0.0), lambda s, p: s + p["y"]) / n
    lim = lambda v, top: F.least(F.greatest(v, F.lit(0.0)), top - 1)
    return F.transform(points, lambda p: F.struct(lim(cx + (p["x"] - cx) * (1 + ratio), width).alias("x"), lim(cy + (p["y"] - cy) * (1 + ratio), height).alias("y")))


def bounding_box(points: Column, width: Column, height: Column) -> Box:
    """Normalized axis-parallel box of points."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return Box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)).normalized(width, height)


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 64-bit hashes."""
    return F.bit_count(a.bitwiseXOR(b))


def average_hash(gray: Column) -> Column:
    """64-bit hash of 64 gray values: a bit for each value above their mean, first value highest."""
    mean = F.aggregate(gray, F.lit(0.0), lambda s, x: s + x) / F.size(gray)
    return F.aggregate(gray, F.lit(0).cast("long"), lambda h, x: F.shiftleft(h, 1).bitwiseOR(F.when(x > mean, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))))


def reading_order(df: DataFrame, frame: str, box: Box, *ties: str) -> DataFrame:
    """``reading_rank`` per frame: rows of text by centre height within max(8, half the median height), then centre x."""
    cy, cx = (box.y1 + box.y2) / 2, (box.x1 + box.x2) / 2
    med = df.groupBy(F.col(frame).alias("_f")).agg(F.median(box.y2 - box.y1).alias("_m"))
    rows = df.join(med, F.col(frame) == F.col("_f")).withColumn("_line", F.bround(cy / F.greatest(F.lit(8.0), F.col("_m") / 2)))
    w = Window.partitionBy(frame).orderBy("_line", cx, *ties)
    return rows.withColumn("reading_rank", F.row_number().over(w)).drop("_f", "_m", "_line")
