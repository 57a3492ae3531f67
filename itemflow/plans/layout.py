"""Choice of the physical layout of a cleaning run.

The rows are partitioned by student once, and every rule that follows is a window
inside that partitioning: one shuffle of the wide rows in all. Two kinds of students
take another way, in which every total is aggregated before it is shuffled and joined
back: those with very many rows, and those who took part in an activity that several
students share. All rows of such a student go that way. As whoever shares an activity
is such a student, every activity is whole on its side, and the rules see it whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from itemflow.functions.checkpoints import checkpointed, stored
from itemflow.operators.joins import drop_members, equi_join, keep_members
from itemflow.operators.omissions import held_showings, spread_showings
from itemflow.operators.ranking import activity_order
from itemflow.operators.scoring import activities_per_student
from itemflow.plans.attach import Attach, by_saved_join, by_window

LAYOUTS = ("auto", "student", "aggregate")
# A student with more rows than this is not held in one task.
HOT_ROWS = 1_000_000
# Rows aimed at per shuffle partition.
PARTITION_ROWS = 2_000_000


@dataclass(frozen=True)
class Branch:
    """Rows and the way in which group totals and orders are attached to them."""

    rows: DataFrame
    activity: tuple[str, ...]
    attach: Attach
    order_activities: Callable[[DataFrame, Column | None], DataFrame]
    count_activities: Callable[[DataFrame, Column | None], DataFrame]
    rank_showings: Callable[[DataFrame, str, Column | None], DataFrame]
    # students of the other kinds: groups are of any size, and saved
    apart: bool = False


def _of_student(alive: Column | None) -> WindowSpec:
    """A student's rows; removed rows, where they are kept, form a window of their own."""
    return Window.partitionBy("student_id", *([] if alive is None else [alive]))


def _living(frame: DataFrame, alive: Column | None) -> DataFrame:
    return frame if alive is None else frame.where(alive)


def _order_by_window(frame: DataFrame, alive: Column | None) -> DataFrame:
    start = F.col("timestamp_created")
    by_start = _of_student(alive).orderBy(start.asc_nulls_last(), "activity_id_hist")
    ranked = start.isNotNull() if alive is None else alive & start.isNotNull()
    rank = F.when(ranked, F.dense_rank().over(by_start))
    return frame.withColumn("actual_activity_order", rank.cast("bigint"))


def _order_by_join(frame: DataFrame, alive: Column | None) -> DataFrame:
    order = activity_order(_living(frame, alive))
    return equi_join(frame, order, ["student_id", "activity_id_hist", "timestamp_created"], "left")


def _count_by_window(frame: DataFrame, alive: Column | None) -> DataFrame:
    student = _of_student(alive)
    place = F.dense_rank().over(student.orderBy("activity_id_hist"))
    placed = frame.withColumn("__place", place)
    return placed.withColumn("__activities", F.max("__place").over(student)).drop("__place")


def _count_by_join(frame: DataFrame, alive: Column | None) -> DataFrame:
    taken = activities_per_student(_living(frame, alive)).withColumnRenamed(
        "num_activities", "__activities"
    )
    return equi_join(frame, checkpointed(taken), ["student_id"], "left")


def _rank_and_store(frame: DataFrame, rank: str, alive: Column | None) -> DataFrame:
    """The showings ranked and written once: the totals that follow do not repeat the rules before them."""
    return stored(spread_showings(frame, rank, alive))


def by_student(rows: DataFrame, n_rows: int | None = None) -> Branch:
    default = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-(n_rows or 0) // PARTITION_ROWS)
    # without a number the partitions can still be merged when they turn out small
    parts = rows.repartition(wanted, "student_id") if wanted > default else rows.repartition("student_id")
    return Branch(parts, ("student_id", "activity_id_hist"), by_window, _order_by_window, _count_by_window, held_showings)


def by_aggregate(rows: DataFrame, activity: tuple[str, ...]) -> Branch:
    return Branch(rows, activity, by_saved_join, _order_by_join, _count_by_join, _rank_and_store, True)


def student_hash() -> Column:
    return F.xxhash64("student_id")


def activity_students(responses: DataFrame) -> DataFrame:
    """(activity_id_hist, n, student_hash, last_hash): rows and the least and greatest student of each activity."""
    return (
        responses.select("activity_id_hist", student_hash().alias("student_hash"))
        .groupBy("activity_id_hist")
        .agg(
            F.count("*").alias("n"),
            F.min("student_hash").alias("student_hash"),
            F.max("student_hash").alias("last_hash"),
        )
    )


def student_loads(responses: DataFrame) -> DataFrame:
    """(student_hash, n_rows, shared): rows per student, and whether an activity is shared.

    Reads two columns and combines them per activity before the first shuffle.
    Students are told apart by a 64-bit hash, a number that a hash aggregate can
    keep in place; students with one hash are only counted together. The rows of a
    shared activity count for its first student.
    """
    return activity_students(responses).groupBy("student_hash").agg(
        F.sum("n").alias("n_rows"), F.max(F.col("student_hash") != F.col("last_hash")).alias("shared")
    )


def sharing_students(responses: DataFrame) -> DataFrame:
    """(student_hash): students with rows in an activity of several students."""
    shared = activity_students(responses).where(F.col("student_hash") != F.col("last_hash")).select("activity_id_hist")
    members = responses.select("activity_id_hist", student_hash().alias("student_hash"))
    return keep_members(members, checkpointed(shared), ["activity_id_hist"]).select("student_hash")


def branches(responses: DataFrame, rows: DataFrame, layout: str, hot_rows: int = HOT_ROWS) -> list[Branch]:
    """Split the rows by the layout they need. ``responses`` are the rows as given."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if layout == "student":
        return [by_student(rows)]
    if layout == "aggregate":
        return [by_aggregate(rows, ("activity_id_hist",))]
    loads = student_loads(responses)
    most = loads.agg(
        F.max("n_rows").alias("n_rows"), F.max("shared").alias("shared"), F.sum("n_rows").alias("total")
    ).first()
    if not most.shared and (most.n_rows or 0) <= hot_rows:
        return [by_student(rows, most.total)]
    # at most total / hot_rows students, and those who share
    apart = loads.where(F.col("n_rows") > hot_rows).select("student_hash")
    if most.shared:
        apart = apart.unionByName(sharing_students(responses))
    apart = checkpointed(apart.distinct())
    hashed = rows.withColumn("student_hash", student_hash())
    most_rows = drop_members(hashed, apart, ["student_hash"]).drop("student_hash")
    rest = keep_members(hashed, apart, ["student_hash"]).drop("student_hash")
    activity = ("activity_id_hist",) if most.shared else ("student_id", "activity_id_hist")
    return [by_student(most_rows, most.total), by_aggregate(rest, activity)]
