"""Orphan references: foreign keys whose parent is missing, withdrawn or late.

Distinct non-null foreign keys are anti-joined with the live parent keys; what is left
(and the parents that arrived late) is joined back to the child rows for the listing and
for the counts per table and period. Both sides of every join are aggregated before the
shuffle; the join back keeps child rows on the streamed side, where adaptive execution
splits a hot key.

Defined cases: a null foreign key is no reference and gives no row; an empty string is a
reference; keys compare exactly as stored; several rows of one key count once, from the
first arrival; rows without arrival time count with period NULL and are never early; an
empty parent table makes every reference an orphan; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Reference:
    """One foreign key: ``child.fk`` names ``parent.parent_key``."""

    child_table: str
    child_key: str
    fk: str
    parent_table: str
    parent_key: str


#: The references of the media model.
MEDIA_REFERENCES = (
    Reference("shot", "shot_id", "video_id", "video", "video_id"),
    Reference("frame", "frame_id", "shot_id", "shot", "shot_id"),
    Reference("clip_record", "clip_id", "shot_id", "shot", "shot_id"),
    Reference("object_track", "track_id", "shot_id", "shot", "shot_id"),
)


def parent_states(parent: DataFrame, key: str, *, time: str = "ingested_at", deleted: str = "deleted_at") -> DataFrame:
    """One row per parent key: ``_pk``, ``_first`` arrival, ``_withdrawn`` by its latest row."""
    gone = F.col(deleted).isNotNull() if deleted in parent.columns else F.lit(False)
    return (
        parent.where(F.col(key).isNotNull())
        .select(F.col(key).alias("_pk"), F.col(time).alias("_t"), gone.alias("_d"))
        .groupBy("_pk")
        .agg(F.min("_t").alias("_first"), F.max(F.struct("_t", "_d"))["_d"].alias("_withdrawn"))
    )


def orphan_references(child: DataFrame, parent: DataFrame, ref: Reference, *, time: str = "ingested_at", deleted: str = "deleted_at") -> DataFrame:
    """Child rows with a broken reference.

    Columns: child_table, child_key (string), fk_value, child_first, reason
    (``missing``, ``withdrawn`` or ``late``).
    """
    rows = (
        child.where(F.col(ref.fk).isNotNull())
        .select(F.col(ref.child_key).cast("string").alias("child_key"), F.col(ref.fk).alias("_fk"), F.col(time).alias("_ct"))
        .groupBy("child_key", "_fk")
        .agg(F.min("_ct").alias("child_first"))
    )
    states = parent_states(parent, ref.parent_key, time=time, deleted=deleted)
    used = child.where(F.col(ref.fk).isNotNull()).select(F.col(ref.fk).alias("_fk")).distinct()
    live = states.where(~F.col("_withdrawn"))
    broken = (
        used.join(live, F.col("_fk") == F.col("_pk"), "left_anti")
        .join(states.where("_withdrawn").select("_pk"), F.col("_fk") == F.col("_pk"), "left")
        .select("_fk", F.when(F.col("_pk").isNull(), "missing").otherwise("withdrawn").alias("_why"), F.lit(None).cast("timestamp_ntz" if dict(parent.dtypes)[time] == "timestamp_ntz" else "timestamp").alias("_first"))
    )
    verdicts = broken.unionByName(live.select(F.col("_pk").alias("_fk"), F.lit("late").alias("_why"), "_first"))
    return (
        rows.join(verdicts, "_fk")
        .where((F.col("_why") != "late") | (F.col("_first") > F.col("child_first")))
        .select(F.lit(ref.child_table).alias("child_table"), "child_key", F.col("_fk").cast("string").alias("fk_value"), "child_first", F.col("_why").alias("reason"))
    )


def orphan_report(orphans: DataFrame, *, period: str = "month") -> DataFrame:
    """Counts per child table, period of the child's first arrival and reason."""
    return orphans.groupBy("child_table", F.date_format(F.date_trunc(period, F.col("child_first").cast("timestamp")), "yyyy-MM-dd").alias("period"), "reason").agg(
        F.count("*").alias("orphan_rows"), F.countDistinct("fk_value").alias("orphan_keys")
    )
