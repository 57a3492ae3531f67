"""Rules that remove whole activities.

Each ``bad_*`` function returns the keys of the activities a rule removes. The
scan behind it reads only the columns of the rule, and is aggregated before it
is shuffled, so a key with very many rows is combined where it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemflow.functions.columns import (
    is_deleted_name,
    grouped,
    milliseconds_to_minutes,
    strict_sum,
)
from itemflow.operators.joins import drop_members, equi_join
from itemflow.operators.rows import is_not_staged

ACTIVITY = ["activity_id_hist"]


def without(frame: DataFrame, bad: DataFrame, keys: Sequence[str] = ACTIVITY) -> DataFrame:
    """Drop every row of the listed activities."""
    return drop_members(frame, bad.select(*keys).distinct(), keys)


# Row conditions: an activity is bad when one of its rows has the property.


def scored_without_response(mode: str = "null") -> Column:
    """Marked as right although there is no response.

    ``mode`` says what no response means: ``null``, ``zero`` or ``either``.
    """
    missing = {
        "null": F.col("raw_response").isNull(),
        "zero": F.col("raw_response").cast("string") == "0",
        "either": F.col("raw_response").isNull() | (F.col("raw_response").cast("string") == "0"),
    }
    if mode not in missing:
        raise ValueError("no_response must be 'null', 'zero' or 'either'")
    return (F.col("scored_response") == 1) & missing[mode]


def negative_time() -> Column:
    return F.col("milliseconds_used") < 0


def bad_by_row(frame: DataFrame, condition: Column) -> DataFrame:
    return frame.where(condition).select(*ACTIVITY).distinct()


def bad_too_many_questions(frame: DataFrame, part: str = "template_name", allowed: str = "test_num_ques") -> DataFrame:
    """Activities with more rows in a template (or section) than its map allows."""
    return (
        frame.groupBy(*ACTIVITY, part)
        .agg(F.count("*").alias("actual_num_ques"), F.min(allowed).alias(allowed))
        .where(F.col("actual_num_ques") > F.col(allowed))
        .select(*ACTIVITY)
        .distinct()
    )


def bad_duplicate_items(frame: DataFrame) -> DataFrame:
    """Activities that show an item more than once; staged rows do not count."""
    return (
        frame.where(is_not_staged())
        .groupBy(*ACTIVITY, "content_item_name")
        .agg(F.count("*").alias("n_shown"))
        .where("n_shown > 1")
        .select(*ACTIVITY)
        .distinct()
    )


def sitting() -> Column:
    """Orders the sittings of a template; null when the start is unknown."""
    return F.when(
        F.col("timestamp_created").isNotNull(), F.struct("timestamp_created", "activity_id_hist")
    )


def is_later_sitting(first: Column) -> Column:
    return F.coalesce(sitting() != first, F.lit(False))


def bad_repeat_administrations(frame: DataFrame) -> DataFrame:
    """Activities that are not the student's first sitting of their template."""
    sittings = frame.select("student_id", "template_name", "timestamp_created", *ACTIVITY).distinct()
    first = sittings.groupBy("student_id", "template_name").agg(F.min(sitting()).alias("first_sitting"))
    return (
        equi_join(sittings, first, ["student_id", "template_name"], "inner")
        .where(is_later_sitting(F.col("first_sitting")))
        .select(*ACTIVITY)
        .distinct()
    )


def bad_over_time(frame: DataFrame, part: Sequence[str] = ()) -> DataFrame:
    """Activities (or sections of them) that took more minutes than allowed.

    Whole milliseconds are summed, so that no order of rows decides a time that
    is exactly the limit.
    """
    used = strict_sum(F.col("milliseconds_used"))
    return (
        frame.groupBy(*ACTIVITY, *part, "test_minutes_allowed")
        .agg(used(grouped).alias("time_used"))
        .where(milliseconds_to_minutes(F.col("time_used")) > F.col("test_minutes_allowed"))
        .select(*ACTIVITY)
        .distinct()
    )


def without_deleted_templates(frame: DataFrame) -> DataFrame:
    """Drop what shares student, enrollment and template with a reset or deleted activity."""
    keys = ["student_id", "enrollment_id", "template_id"]
    deleted = frame.where(
        F.coalesce(F.col("activity_status") == "reset", F.lit(False))
        | is_deleted_name(F.col("template_name"))
    )
    return without(frame, deleted, keys)


def without_repeat_enrollments(frame: DataFrame, enrollments: DataFrame) -> DataFrame:
    """Drop rows of the listed enrollments; unknown enrollments stay."""
    return without(frame, enrollments, ["enrollment_id"])
