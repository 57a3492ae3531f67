"""Counts and scores of students, activities and sections.

Every score is a set of aggregates over a group that is then attached to the
rows of the group. The aggregates are written once; ``plans.attach`` decides
whether they run as a window or as a grouped aggregate joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemflow.functions.columns import Aggregate, count_where, ratio, strict_sum, total_rows
from itemflow.operators.joins import drop_members
from itemflow.plans.attach import Attach, by_join

ACTIVITY = ("activity_id_hist",)
# What the rates of a student are made of.
STUDENT_TALLIES = ("overall_raw_correct", "overall_num_attempted")


def question_counts(
    frame: DataFrame,
    part: str = "template_name",
    attach: Attach = by_join,
    activity: Sequence[str] = ACTIVITY,
    alive: Column | None = None,
) -> DataFrame:
    """Add ``actual_num_ques``: rows of the activity in this template or section."""
    return attach(frame, [*activity, part], {"actual_num_ques": total_rows(alive)})


def _tallies(prefix: str, alive: Column | None) -> dict[str, Aggregate]:
    return {
        f"{prefix}_raw_correct": strict_sum(F.col("scored_response"), alive),
        f"{prefix}_num_attempted": count_where(F.col("attempted"), alive),
    }


def _omitted(prefix: str, alive: Column | None) -> dict[str, Aggregate]:
    return {f"{prefix}_num_omitted": count_where(~F.col("attempted"), alive)}


def _rates(prefix: str, expected: Column) -> dict[str, Column]:
    correct = F.col(f"{prefix}_raw_correct")
    return {
        f"{prefix}_pTotal": ratio(correct, expected),
        f"{prefix}_pPlus": ratio(correct, F.col(f"{prefix}_num_attempted")),
    }


def activity_scores(
    frame: DataFrame,
    expected: str = "test_num_ques",
    attach: Attach = by_join,
    activity: Sequence[str] = ACTIVITY,
    alive: Column | None = None,
    with_omitted: bool = True,
) -> DataFrame:
    """Add the scores of the whole activity."""
    tallies = _tallies("template", alive)
    rates = _rates("template", F.col(expected))
    if with_omitted:
        tallies |= _omitted("template", alive)
        rates["template_perc_attempted"] = ratio(F.col("template_num_attempted"), F.col(expected))
    return attach(frame, activity, tallies).withColumns(rates)


def section_scores(
    frame: DataFrame,
    attach: Attach = by_join,
    activity: Sequence[str] = ACTIVITY,
    alive: Column | None = None,
) -> DataFrame:
    """Add the scores of the section of the activity."""
    tallies = _tallies("section", alive) | _omitted("section", alive)
    tallies["section_num_scored"] = strict_sum(F.col("is_scored"), alive)
    rates = _rates("section", F.col("section_num_ques"))
    rates["section_perc_attempted"] = ratio(F.col("section_num_attempted"), F.col("section_num_ques"))
    return attach(frame, [*activity, "section_name"], tallies).withColumns(rates)


def student_tallies(frame: DataFrame, attach: Attach = by_join, alive: Column | None = None) -> DataFrame:
    """Add what the student answered and got right in all activities."""
    return attach(frame, ["student_id"], _tallies("overall", alive))


def student_rates(frame: DataFrame, expected: Column) -> DataFrame:
    return frame.withColumns(_rates("overall", expected))


def activities_per_student(frame: DataFrame) -> DataFrame:
    """(student, activities taken); an unknown activity counts as one."""
    return (
        frame.select("student_id", *ACTIVITY)
        .distinct()
        .groupBy("student_id")
        .agg(F.count("*").alias("num_activities"))
    )


def distinct_items(frame: DataFrame) -> Column:
    """The number of different items in the frame, as a scalar."""
    return frame.select("content_item_name").distinct().agg(F.count("*")).scalar()


# Conditions that remove an activity for too few answers. A null does not.


def below_min_items(total: int | None) -> Column:
    """A section below its own minimum, or the activity below all minimums together."""
    return (F.col("section_num_attempted") < F.col("min_items_per_seq")) | (
        F.col("template_num_attempted") < F.lit(total)
    )


def below_section_threshold() -> Column:
    return F.col("section_perc_attempted") < F.col("section_response_threshold")


def below_test_threshold() -> Column:
    return F.col("section_perc_attempted") < F.col("test_response_threshold")


def below_bank_minimum(min_items: int) -> Column:
    return F.col("template_num_attempted") < min_items


def reaches_threshold() -> Column:
    """Enough of the template was attempted; this one drops rows on null."""
    return F.col("template_perc_attempted") >= F.col("test_response_threshold")


def without_activities_where(frame: DataFrame, condition: Column) -> DataFrame:
    """Drop every activity that has a row on which the condition holds."""
    bad = frame.where(condition).select(*ACTIVITY).distinct()
    return drop_members(frame, bad, ACTIVITY)
