"""Answer keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from itemflow.catalog.registry import query
from itemflow.catalog.tables import responses, with_responses
from itemflow.operators import answer_key as keys

_LETTER_SQL = "substr('EABCD', cast(raw_response + 1 as int), 1)"


def _with_letters(spark, sf_dir):
    letter = F.substr(F.lit("EABCD"), (F.col("raw_response") + 1).cast("int"), F.lit(1))
    return responses(spark, sf_dir).withColumn("rawest_response", letter)


@query(
    "answer_key_given",
    with_responses(
        "select distinct content_item_id, correct_answer from responses where correct_answer is not null"
    ),
)
def answer_key_given(spark, sf_dir):
    return keys.answer_key(responses(spark, sf_dir))


@query(
    "answer_key_given_by_name",
    with_responses(
        "select distinct content_item_name, correct_answer from responses where correct_answer is not null"
    ),
)
def answer_key_given_by_name(spark, sf_dir):
    return keys.answer_key(responses(spark, sf_dir), keys.NAME)


_INFERRED = (
    "select distinct {item}, raw_response as correct_answer, "
    f"{_LETTER_SQL} as correct_answer_rawest from responses where scored_response = 1"
)


@query("answer_key_inferred", with_responses(_INFERRED.format(item="content_item_id")))
def answer_key_inferred(spark, sf_dir):
    return keys.answer_key(_with_letters(spark, sf_dir), infer=True)


@query("answer_key_inferred_by_name", with_responses(_INFERRED.format(item="content_item_name")))
def answer_key_inferred_by_name(spark, sf_dir):
    return keys.answer_key(_with_letters(spark, sf_dir), keys.NAME, infer=True)


def _conflicts_sql(item: str, answers: str) -> str:
    return (
        f"with bad as (select {item} from (select distinct {item}, {answers} as answer from responses "
        f"where {'scored_response = 1' if answers == 'raw_response' else 'correct_answer is not null'}) k "
        f"group by {item} having count(*) > 1) "
        f"select r.{item}, raw_response, count(*) as total, min(timestamp_created) as min_date, "
        f"max(timestamp_created) as max_date from responses r join bad b on r.{item} = b.{item} "
        f"where scored_response = 1 group by r.{item}, raw_response"
    )


@query(
    "answer_key_conflicts",
    with_responses(
        _conflicts_sql("content_item_id", "correct_answer"),
        correct_answer="case when activity_id_hist % 40 = 0 and content_item_id % 10 = 0 "
        "then correct_answer % 4 + 1 else correct_answer end",
    ),
)
def answer_key_conflicts(spark, sf_dir):
    # some items had another key in some activities
    changed = (F.col("activity_id_hist") % 40 == 0) & (F.col("content_item_id") % 10 == 0)
    given = F.when(changed, F.col("correct_answer") % 4 + 1).otherwise(F.col("correct_answer"))
    return keys.answer_key_conflicts(responses(spark, sf_dir, correct_answer=given))


@query(
    "answer_key_conflicts_inferred",
    with_responses(
        _conflicts_sql("content_item_name", "raw_response"),
        correct_answer="case when content_item_id = 1 then null else correct_answer end",
    ),
)
def answer_key_conflicts_inferred(spark, sf_dir):
    # one item has no given key, so the answers scored as right are compared
    given = F.when(F.col("content_item_id") != 1, F.col("correct_answer"))
    return keys.answer_key_conflicts(responses(spark, sf_dir, correct_answer=given), keys.NAME)
