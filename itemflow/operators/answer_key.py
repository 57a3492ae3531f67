"""Answer keys, given or inferred, and the items whose key is not unique."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.operators.joins import keep_members, repeated_keys

ID = "content_item_id"
NAME = "content_item_name"


class KeyConflict(ValueError):
    """Some items have more than one right answer."""


def given_keys(frame: DataFrame, item: str = ID) -> DataFrame:
    return frame.where(F.col("correct_answer").isNotNull()).select(item, "correct_answer").distinct()


def inferred_keys(frame: DataFrame, item: str = ID) -> DataFrame:
    """The answers that were scored as right."""
    right = frame.where(F.col("scored_response") == 1)
    return right.select(
        item,
        F.col("raw_response").alias("correct_answer"),
        F.col("rawest_response").alias("correct_answer_rawest"),
    ).distinct()


def answer_key(frame: DataFrame, item: str = ID, infer: bool = False, strict: bool = False) -> DataFrame:
    """One row per item and right answer.

    A given key lists the ``correct_answer`` values; if that column is empty, so
    is the key, and ``infer=True`` takes the answers scored as right instead.
    ``strict`` raises if an item has more than one row.
    """
    key = inferred_keys(frame, item) if infer else given_keys(frame, item)
    if strict:
        repeated = repeated_keys(key, [item]).limit(5).collect()
        if repeated:
            raise KeyConflict("more than one right answer for " + ", ".join(str(r[item]) for r in repeated))
    return key


def _answers(frame: DataFrame, item: str) -> DataFrame:
    """(item, given, answer, total, min_date, max_date): given answers, and those scored as right.

    Both come from one pass. An item without a given answer has a row with none.
    """
    times = [F.col("timestamp_created").alias("at")] if "timestamp_created" in frame.columns else [F.lit(None).cast("timestamp_ntz").alias("at")]
    text = F.col("raw_response").cast("string").alias("answer")
    given = F.struct(F.lit(True).alias("given"), F.col("correct_answer").cast("string").alias("answer"))
    right = F.when(F.col("scored_response") == 1, F.struct(F.lit(False).alias("given"), text))
    kinds = F.filter(F.array(given, right), lambda x: x.isNotNull())
    return frame.select(item, *times, F.inline(kinds)).groupBy(item, "given", "answer").agg(
        F.count("*").alias("total"), F.min("at").alias("min_date"), F.max("at").alias("max_date")
    )


def answer_key_conflicts(frame: DataFrame, item: str = ID) -> DataFrame:
    """For items with several keys: how often and when each answer was scored as right.

    The keys are the given ones if every item has one, else the answers scored as right;
    which of them is a value in the plan. A clean key gives no rows.
    """
    answers = _answers(frame, item)
    given = F.col("given")
    # an answer that is missing is no given one, but it can be scored as right
    per_item = answers.groupBy(item).agg(
        F.count(F.when(given & F.col("answer").isNotNull(), 1)).alias("n_given"), F.count(F.when(~given, 1)).alias("n_right")
    )
    complete = F.coalesce(per_item.agg(F.min(F.col("n_given") > 0)).scalar(), F.lit(True))
    conflicting = per_item.where(F.when(complete, F.col("n_given") > 1).otherwise(F.col("n_right") > 1))
    answer = F.col("answer").cast(frame.schema["raw_response"].dataType).alias("raw_response")
    dates = ["min_date", "max_date"] if "timestamp_created" in frame.columns else []
    scored = answers.where(~given).select(item, answer, "total", *dates)
    # aggregated first: the join sees one row per item and answer
    return keep_members(scored, conflicting, [item])
