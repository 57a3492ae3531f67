"""Template profile and the test map derived from it; timing profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow import schema
from itemflow.functions.quantiles import summarise_counts, value_counts
from itemflow.operators.rows import answered, is_complete


def template_profile(
    frame: DataFrame, statuses: Sequence[str] = schema.EXPORT_COMPLETE_STATUS
) -> DataFrame:
    """Largest, smallest and median number of responses per student of each template."""
    template = ["template_id", "template_name"]
    per_student = (
        frame.where(is_complete(statuses)).groupBy(*template, "student_id").agg(F.count("*").alias("n"))
    )
    # students are counted by their number of responses first, so the median of a
    # template is taken over a few different numbers
    per_count = per_student.groupBy(*template, "n").agg(F.count("*").alias("users"))
    return per_count.groupBy(*template).agg(
        F.max("n").alias("max_resp"),
        F.min("n").alias("min_resp"),
        F.percentile("n", F.lit(0.5), F.col("users")).alias("median_resp"),
        F.sum("users").alias("num_users"),
    )


def derive_test_map(
    profile: DataFrame, response_threshold: float = 0.75, minutes_allowed: float = 1440.0
) -> DataFrame:
    """One row per template; all templates expect the largest number of responses seen."""
    return profile.select(
        "template_id",
        "template_name",
        profile.agg(F.max("max_resp")).scalar().alias("num_ques"),
        F.lit(response_threshold).alias("response_threshold"),
        F.lit(minutes_allowed).alias("minutes_allowed"),
    )


def timing_profile(frame: DataFrame, column: str = "milliseconds_used") -> DataFrame:
    """Six-number summary of the time of answered responses, and how many took no time."""
    times = answered(frame).select(column)
    summary = summarise_counts(value_counts(times, [], column), [])
    return summary.withColumn(
        "n_not_positive", times.where(F.col(column) <= 0).agg(F.count("*")).scalar()
    )


def timing_effect(frame: DataFrame, limit: float, column: str = "milliseconds_used") -> DataFrame:
    """How many responses a lower limit would touch."""
    return frame.where(F.col(column) <= limit).agg(F.count("*").alias("n_changed"))
