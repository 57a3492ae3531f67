"""Row filters and derived columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemflow import schema
from itemflow.functions.columns import minutes_between
from itemflow.operators.joins import keep_members, natural_join


def prepare_responses(frame: DataFrame, extra_names: dict[str, str] | None = None) -> DataFrame:
    """Canonical names for a response export, with a section and an answer column."""
    frame = schema.canonical(schema.lower_first_letters(frame), schema.RESPONSE_NAMES | (extra_names or {}))
    if "correct_answer" not in frame.columns:
        frame = frame.withColumn("correct_answer", F.lit(None).cast("bigint"))
    if "activity_id_hist" not in frame.columns:
        frame = frame.withColumn("activity_id_hist", F.col("activity_id"))
    return drop_breaks(frame)


def prepare_activities(frame: DataFrame, extra_names: dict[str, str] | None = None) -> DataFrame:
    """Canonical names for an activity export, with the history id."""
    frame = schema.canonical(schema.lower_first_letters(frame), schema.ACTIVITY_NAMES | (extra_names or {}))
    return frame.withColumn("activity_id_hist", F.col("activity_id"))


def prepare_content(frame: DataFrame, extra_names: dict[str, str] | None = None) -> DataFrame:
    """Canonical names for a content-item export."""
    names = schema.CONTENT_NAMES | (extra_names or {})
    return schema.canonical(schema.lower_first_letters(frame), names)


# Conditions that keep a row. A null condition drops it.


def has_position() -> Column:
    return F.col("item_section_position").isNotNull()


def has_enrollment() -> Column:
    return F.col("enrollment_id").isNotNull()


def is_complete(statuses: Iterable[str] = schema.COMPLETE_STATUSES) -> Column:
    return F.col("activity_status").cast("string").isin(*statuses)


def is_not_tutor() -> Column:
    return (F.col("tutor_mode") != "True") | F.col("tutor_mode").isNull()


def total_time() -> Column:
    return minutes_between(F.col("timestamp_created"), F.col("timestamp_completed"))


def is_not_staged() -> Column:
    return F.col("content_item_id") != schema.STAGED_ITEM_ID


def is_scored_item() -> Column:
    return F.col("is_scored") == 1


def drop_breaks(frame: DataFrame) -> DataFrame:
    """Breaks and tutorials have no position in a section."""
    return frame.where(has_position())


def drop_zero_enrollment(frame: DataFrame) -> DataFrame:
    return frame.where(F.col("enrollment_id") != 0)


def drop_no_enrollment(frame: DataFrame) -> DataFrame:
    return frame.where(has_enrollment())


def keep_sections(frame: DataFrame, section_map: DataFrame) -> DataFrame:
    return keep_members(frame, section_map, ["section_name"])


def keep_complete(frame: DataFrame) -> DataFrame:
    return frame.where(is_complete())


def drop_tutor(frame: DataFrame) -> DataFrame:
    return frame.where(is_not_tutor())


def within_total_minutes(frame: DataFrame, minutes: float) -> DataFrame:
    """Keep rows of activities finished in time, and add the minutes taken."""
    return frame.withColumn("total_time", total_time()).where(F.col("total_time") <= minutes)


def drop_staged(frame: DataFrame) -> DataFrame:
    return frame.where(is_not_staged())


def keep_scored(frame: DataFrame) -> DataFrame:
    return frame.where(is_scored_item())


def drop_zero_time(frame: DataFrame) -> DataFrame:
    """Items on which no time was spent count as not reached."""
    return frame.where(F.col("milliseconds_used") > 0)


def answered(frame: DataFrame) -> DataFrame:
    return frame.where(F.col("raw_response") != 0)


def keep_interaction_types(content: DataFrame, types: Sequence[int] = (1,)) -> DataFrame:
    return content.where(F.col("interaction_type_id").isin(*types))


def content_of_template(content: DataFrame, template_id: int) -> DataFrame:
    return content.where(F.col("template_id") == template_id)


def join_activities(responses: DataFrame, activities: DataFrame, how: str = "inner") -> DataFrame:
    """Responses with the columns of their activity; with ``how="left"`` also those without one."""
    keys = ["student_id", "activity_id", "source_system"]
    new = [c for c in activities.columns if c in keys or c not in responses.columns]
    return natural_join(responses, activities.select(*new), how)


def attach_content(
    responses: DataFrame,
    content: DataFrame,
    extra: Sequence[str] = (),
    types: Sequence[int] = (1,),
) -> DataFrame:
    """Responses to content items of the given interaction types, with extra item columns."""
    columns = ["content_item_id", "content_item_name", *extra]
    items = keep_interaction_types(content.distinct(), types).select(*columns)
    return natural_join(responses, items, "inner")


def join_section_map(responses: DataFrame, section_map: DataFrame) -> DataFrame:
    """Responses with what their section promises.

    A map has one row per section or template, so every task can hold it: dealt by
    their few sections, the responses would land in as few tasks.
    """
    return natural_join(responses, F.broadcast(section_map), "inner")


def join_test_map(responses: DataFrame, test_map: DataFrame) -> DataFrame:
    """Responses with what their template promises."""
    return natural_join(responses, F.broadcast(test_columns(test_map)), "inner")


def test_columns(test_map: DataFrame) -> DataFrame:
    return test_map.select(
        "template_name",
        F.col("minutes_allowed").alias("test_minutes_allowed"),
        F.col("num_ques").alias("test_num_ques"),
        F.col("response_threshold").alias("test_response_threshold"),
    )


def join_question_bank_map(responses: DataFrame, test_map: DataFrame) -> DataFrame:
    """Add the single row of a question bank's map to every response."""
    rows = test_map.select("minutes_allowed", "num_ques", "response_threshold").limit(2).collect()
    if len(rows) != 1:
        raise ValueError("the test map of a question bank must have exactly one row")
    (row,) = rows
    kinds = dict(test_map.dtypes)
    return responses.withColumns(
        {
            "test_minutes_allowed": F.lit(row.minutes_allowed).cast(kinds["minutes_allowed"]),
            "test_num_ques": F.lit(row.num_ques).cast(kinds["num_ques"]),
            "test_response_threshold": F.lit(row.response_threshold).cast(kinds["response_threshold"]),
        }
    )


def repeat_enrollments(purchases: DataFrame, products: DataFrame) -> DataFrame:
    """Enrollments that are repeated purchases of an existing product."""
    product_ids = products.select(F.col("product_id").alias("known_product_id"))
    return (
        purchases.where(
            F.col("transaction_code").isin(*schema.REPEAT_PURCHASE_CODES)
            & (F.col("created_on") >= F.lit(schema.REPEAT_PURCHASES_SINCE).cast("timestamp_ntz"))
        )
        .join(product_ids, F.col("product_id") == F.col("known_product_id"))
        .select("enrollment_id")
    )
