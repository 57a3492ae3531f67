"""Counts, scores, order and thresholds."""

from __future__ import annotations

from pyspark.sql import functions as F

from itemflow.catalog.registry import query, rounded
from itemflow.catalog.tables import (
    SECTIONS_SQL,
    response_parts,
    responses,
    section_map,
    test_map,
    test_map_sql,
    with_responses,
)
from itemflow.functions.columns import zero_where
from itemflow.operators import omissions, ranking, rows, scoring
from itemflow.operators.joins import equi_join

# some responses are unscored, so that strict sums have something to do
_UNSCORED_SQL = (
    "case when activity_id_hist % 19 = 0 and item_section_position = 2 then null else scored_response end"
)


def _base(spark, sf_dir):
    unscored = (F.col("activity_id_hist") % 19 == 0) & (F.col("item_section_position") == 2)
    frame = responses(spark, sf_dir, response_parts(spark, sf_dir), scored_response=F.when(~unscored, F.col("scored_response")))
    frame = rows.drop_staged(omissions.add_attempted(frame))
    sections = section_map(spark, sf_dir).select(
        "section_name", "section_num_ques", "section_response_threshold", "min_items_per_seq"
    )
    return rows.join_section_map(rows.join_test_map(frame, test_map(spark, sf_dir, None)), sections)


_BASE = (
    "with base as (select r.*, coalesce(raw_response <> 0, false) as attempted, "
    "m.num_ques as test_num_ques, m.response_threshold as test_response_threshold, "
    "s.section_num_ques, s.section_response_threshold, s.min_items_per_seq "
    f"from responses r join {test_map_sql(None)} m on r.template_name = m.template_name "
    f"join {SECTIONS_SQL} s on r.section_name = s.section_name where content_item_id <> -1)"
)


def _sql(body: str) -> str:
    return with_responses(f"{_BASE}, {body}", scored_response=_UNSCORED_SQL)


def _strict(column: str, window: str) -> str:
    return (
        f"case when count({column}) over {window} = count(*) over {window} "
        f"then cast(sum({column}) over {window} as bigint) end"
    )


def tallies_sql(prefix: str, window: str) -> str:
    return (
        f"{_strict('scored_response', window)} as {prefix}_raw_correct, "
        f"count(*) filter (attempted) over {window} as {prefix}_num_attempted, "
        f"count(*) filter (not attempted) over {window} as {prefix}_num_omitted"
    )


def ratio_sql(part: str, whole: str, name: str) -> str:
    return f"round(cast({part} as double) / nullif({whole}, 0), 6) as {name}"


_ACTIVITY = "(partition by activity_id_hist)"
_SECTION = "(partition by activity_id_hist, section_name)"
_STUDENT = "(partition by student_id)"
_TALLIED = (
    f"tallied as (select *, {tallies_sql('template', _ACTIVITY)}, {tallies_sql('section', _SECTION)}, "
    f"{tallies_sql('overall', _STUDENT)}, {_strict('is_scored', _SECTION)} as section_num_scored from base)"
)


@query(
    "question_counts",
    _sql(
        "counted as (select response_id, activity_id_hist, "
        "count(*) over (partition by activity_id_hist, template_name) as actual_num_ques from base) "
        "select * from counted"
    ),
)
def question_counts(spark, sf_dir):
    counted = scoring.question_counts(_base(spark, sf_dir))
    return counted.select("response_id", "activity_id_hist", "actual_num_ques")


@query(
    "activity_scores",
    _sql(
        f"{_TALLIED} select response_id, activity_id_hist, template_num_omitted, template_num_attempted, "
        "template_raw_correct, "
        + ratio_sql("template_num_attempted", "test_num_ques", "template_perc_attempted") + ", "
        + ratio_sql("template_raw_correct", "test_num_ques", "template_pTotal") + ", "
        + ratio_sql("template_raw_correct", "template_num_attempted", "template_pPlus")
        + " from tallied"
    ),
)
def activity_scores(spark, sf_dir):
    scored = scoring.activity_scores(_base(spark, sf_dir))
    ratios = ["template_perc_attempted", "template_pTotal", "template_pPlus"]
    return rounded(scored, *ratios).select(
        "response_id", "activity_id_hist", "template_num_omitted", "template_num_attempted",
        "template_raw_correct", *ratios,
    )


@query(
    "section_scores",
    _sql(
        f"{_TALLIED} select response_id, activity_id_hist, section_name, section_num_omitted, "
        "section_num_attempted, section_raw_correct, section_num_scored, "
        + ratio_sql("section_num_attempted", "section_num_ques", "section_perc_attempted") + ", "
        + ratio_sql("section_raw_correct", "section_num_ques", "section_pTotal") + ", "
        + ratio_sql("section_raw_correct", "section_num_attempted", "section_pPlus")
        + " from tallied"
    ),
)
def section_scores(spark, sf_dir):
    scored = scoring.section_scores(_base(spark, sf_dir))
    ratios = ["section_perc_attempted", "section_pTotal", "section_pPlus"]
    return rounded(scored, *ratios).select(
        "response_id", "activity_id_hist", "section_name", "section_num_omitted", "section_num_attempted",
        "section_raw_correct", "section_num_scored", *ratios,
    )


_OVERALL = (
    "select response_id, student_id, overall_raw_correct, overall_num_attempted, "
    + ratio_sql("overall_raw_correct", "{whole}", "overall_pTotal") + ", "
    + ratio_sql("overall_raw_correct", "overall_num_attempted", "overall_pPlus")
)


def _overall(frame):
    return rounded(frame, "overall_pTotal", "overall_pPlus").select(
        "response_id", "student_id", "overall_raw_correct", "overall_num_attempted", "overall_pTotal",
        "overall_pPlus",
    )


@query(
    "overall_scores_test",
    _sql(
        f"{_TALLIED}, taken as (select student_id as taker, count(distinct activity_id_hist) * "
        f"(select sum(num_ques) from {test_map_sql(None)} m) as expected from base group by student_id) "
        + _OVERALL.format(whole="expected") + " from tallied join taken on student_id = taker"
    ),
)
def overall_scores_test(spark, sf_dir):
    base = _base(spark, sf_dir)
    scored = scoring.student_tallies(base)
    scored = equi_join(scored, scoring.activities_per_student(base), ["student_id"], "left")
    questions = test_map(spark, sf_dir, None).agg(F.sum("num_ques")).scalar()
    return _overall(scoring.student_rates(scored, F.col("num_activities") * questions))


@query(
    "overall_scores_qbank",
    _sql(
        f"{_TALLIED} "
        + _OVERALL.format(whole="(select count(distinct content_item_name) from base)")
        + " from tallied"
    ),
)
def overall_scores_qbank(spark, sf_dir):
    base = _base(spark, sf_dir)
    return _overall(scoring.student_rates(scoring.student_tallies(base), scoring.distinct_items(base)))


@query(
    "activity_order",
    with_responses(
        "select student_id, activity_id_hist, timestamp_created, row_number() over "
        "(partition by student_id order by timestamp_created, activity_id_hist) as actual_activity_order "
        "from (select distinct student_id, activity_id_hist, timestamp_created from responses) a"
    ),
)
def activity_order(spark, sf_dir):
    return ranking.activity_order(responses(spark, sf_dir))


def _kept_sql(low: str) -> str:
    return _sql(
        f"{_TALLIED} select response_id, activity_id_hist from tallied t where not exists "
        f"(select 1 from tallied b where b.activity_id_hist = t.activity_id_hist and ({low}))"
    )


def _scored(spark, sf_dir):
    return scoring.section_scores(scoring.activity_scores(_base(spark, sf_dir)))


@query(
    "threshold_template",
    _sql(
        f"{_TALLIED} select response_id, activity_id_hist from tallied where "
        "cast(template_num_attempted as double) / nullif(test_num_ques, 0) >= test_response_threshold"
    ),
)
def threshold_template(spark, sf_dir):
    scored = scoring.activity_scores(_base(spark, sf_dir))
    return scored.where(scoring.reaches_threshold()).select("response_id", "activity_id_hist")


@query("threshold_min_items", _kept_sql("section_num_attempted < min_items_per_seq or template_num_attempted < 3"))
def threshold_min_items(spark, sf_dir):
    low = scoring.below_min_items(3)
    return scoring.without_activities_where(_scored(spark, sf_dir), low).select(
        "response_id", "activity_id_hist"
    )


@query(
    "threshold_section",
    _kept_sql("cast(section_num_attempted as double) / section_num_ques < section_response_threshold"),
)
def threshold_section(spark, sf_dir):
    low = scoring.below_section_threshold()
    return scoring.without_activities_where(_scored(spark, sf_dir), low).select(
        "response_id", "activity_id_hist"
    )


@query(
    "threshold_section_test",
    _kept_sql("cast(section_num_attempted as double) / section_num_ques < test_response_threshold + 0.1"),
)
def threshold_section_test(spark, sf_dir):
    scored = _scored(spark, sf_dir).withColumn(
        "test_response_threshold", F.col("test_response_threshold") + 0.1
    )
    return scoring.without_activities_where(scored, scoring.below_test_threshold()).select(
        "response_id", "activity_id_hist"
    )


@query("threshold_qbank", _kept_sql("template_num_attempted < 2"))
def threshold_qbank(spark, sf_dir):
    low = scoring.below_bank_minimum(2)
    return scoring.without_activities_where(_scored(spark, sf_dir), low).select(
        "response_id", "activity_id_hist"
    )


@query(
    "flag_times_number",
    with_responses(
        "select response_id, milliseconds_used * case when is_scored = 1 then 0 else 1 end as unscored_time "
        "from responses"
    ),
)
def flag_times_number(spark, sf_dir):
    value = zero_where(F.col("milliseconds_used"), F.col("is_scored") == 1)
    return responses(spark, sf_dir).select("response_id", value.alias("unscored_time"))
