"""Tables that describe activities, students and items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.functions.columns import count_where, grouped, ratio, strict, strict_sum
from itemflow.operators.joins import equi_join, natural_join, plain_join

ACTIVITY_COLUMNS = (
    "student_id", "activity_id", "timestamp_created", "timestamp_completed", "template_name",
    "template_num_attempted", "template_raw_correct", "template_pTotal", "template_pPlus",
)


def activity_info(cleaned: DataFrame, columns: Sequence[str] = ACTIVITY_COLUMNS) -> DataFrame:
    """One row per activity with its scores."""
    return cleaned.select(*columns).distinct()


def user_info(cleaned: DataFrame, test_map: DataFrame) -> DataFrame:
    """One row per student. ``test_total`` is the number of questions in the whole map.

    Rows are first combined per student and template, which also counts the
    templates without a distinct count.
    """
    created = F.col("timestamp_created")
    per_template = cleaned.groupBy("student_id", "template_name").agg(
        F.count("*").alias("seen"),
        count_where(F.col("attempted"))(grouped).alias("att"),
        strict_sum(F.col("scored_response"))(grouped).alias("correct"),
        strict(F.min, created)(grouped).alias("first"),
        strict(F.max, created)(grouped).alias("last"),
    )
    per_student = per_template.groupBy("student_id").agg(
        F.count("*").alias("num_seq_taken"),
        F.sum("seen").alias("test_seen"),
        F.sum("att").alias("test_att"),
        strict_sum(F.col("correct"))(grouped).alias("test_correct"),
        strict(F.min, F.col("first"))(grouped).alias("first_test_date"),
        strict(F.max, F.col("last"))(grouped).alias("last_test_date"),
    )
    return per_student.withColumns(
        {
            "test_total": test_map.agg(F.sum("num_ques")).scalar(),
            "test_ptotal": ratio(F.col("test_correct"), F.col("test_seen")),
            "test_pplus": ratio(F.col("test_correct"), F.col("test_att")),
        }
    )


def item_info(
    cleaned: DataFrame,
    key: DataFrame | None = None,
    content: DataFrame | None = None,
    key_item: str = "content_item_id",
) -> DataFrame:
    """One row per item and place, with its answer key and content columns if given."""
    info = cleaned.groupBy(
        "content_item_id", "content_item_name", "template_name", "template_id", "item_section_position"
    ).agg(
        count_where(F.col("attempted"))(grouped).alias("count_att"),
        F.count("*").alias("count_seen"),
        strict_sum(F.col("scored_response"))(grouped).alias("num_correct"),
        F.min("timestamp_created").alias("first_date"),
        F.max("timestamp_created").alias("last_date"),
    )
    if content is not None and key is not None and key_item in content.columns:
        return _met_in_one_dealing(info, content, key, key_item)
    if content is not None:
        info = natural_join(info, content, "left")
    if key is not None:
        info = equi_join(info, key, [key_item], "left")
    return info


def _met_in_one_dealing(info: DataFrame, content: DataFrame, key: DataFrame, item: str) -> DataFrame:
    """Items with the columns of their content and their answers, dealt by item once for both joins.

    Keys travel as one value, in which null equals null: both joins agree on the item, and the
    other columns of the content, of which an item has few, are compared where it lies.
    """
    shared = [c for c in info.columns if c in content.columns and c != item]
    columns = [*info.columns, *[c for c in content.columns if c not in info.columns], *[c for c in key.columns if c != item]]
    keyed = {"__item": F.struct(item), "__shared": F.struct(*shared) if shared else F.lit(0)}
    known = content.withColumns(keyed).drop(item, *shared)
    met = plain_join(info.withColumns(keyed).drop(item, *shared), known, ["__item"], same=["__shared"])
    answers = key.withColumn("__item", keyed["__item"]).drop(item)
    # rows are dealt without a second copy of their keys
    place = {item: f"__item.`{item}`"} | {c: f"__shared.`{c}`" for c in shared}
    return plain_join(met, answers, ["__item"]).select(*[F.col(place.get(c, f"`{c}`")).alias(c) for c in columns])
