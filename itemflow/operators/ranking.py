"""Ranks over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemflow.functions.checkpoints import checkpointed


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str], rank: str) -> DataFrame:
    """Number the rows of each group from 1 in the given order.

    The rows must be distinct in group and order. They are sorted over the whole
    cluster, so one group may span many tasks: each task numbers its own part,
    and the parts before it are added as an offset. The parts are checkpointed,
    because the bounds of a range partitioning are sampled and a recomputed task
    must not see other bounds.
    """
    keys = [*group, *order]
    plain = [c for c in rows.columns if c not in group]
    # the group travels as one value, in which null equals null: window and join agree on it
    parts = checkpointed(
        rows.repartitionByRange(*[F.col(k).asc_nulls_last() for k in keys])
        .select(*plain, F.struct(*group, F.spark_partition_id().alias("__part")).alias("__group"))
    )
    earlier = (
        Window.partitionBy(*[f"__group.{k}" for k in group])
        .orderBy("__group.__part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        # one row per group and part
        parts.groupBy("__group")
        .agg(F.count("*").alias("__rows"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
        .drop("__rows")
    )
    inside = Window.partitionBy("__group").orderBy(*[F.col(k).asc_nulls_last() for k in order])
    numbered = parts.withColumn("__inside", F.row_number().over(inside)).join(offsets, "__group")
    columns = [F.col(f"__group.`{c}`").alias(c) if c in group else F.col(f"`{c}`") for c in rows.columns]
    return numbered.select(*columns, (F.col("__before") + F.col("__inside")).alias(rank))


def activity_order(responses: DataFrame) -> DataFrame:
    """(student, activity, start, order): the order of a student's activities by start.

    An activity without a start time has no place in the order.
    """
    activities = (
        responses.where(F.col("timestamp_created").isNotNull())
        .select("student_id", "activity_id_hist", "timestamp_created")
        .distinct()
    )
    return ranked(
        activities, ["student_id"], ["timestamp_created", "activity_id_hist"], "actual_activity_order"
    )
