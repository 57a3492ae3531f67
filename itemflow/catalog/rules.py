"""Rules that remove whole activities."""

from __future__ import annotations

from pyspark.sql import functions as F

from itemflow.catalog.registry import query
from itemflow.catalog.row_filters import ID, ID_SQL
from itemflow.catalog.tables import (
    SECTIONS_SQL,
    response_parts,
    responses,
    section_map,
    table,
    test_map,
    test_map_sql,
    with_responses,
)
from itemflow.operators import exclusions, rows


def _without(bad: str) -> str:
    """SQL that keeps the activities not in ``bad``."""
    return with_responses(
        f"with bad as ({bad}) select {ID_SQL} from responses r "
        "where not exists (select 1 from bad b where b.activity_id_hist = r.activity_id_hist)"
    )


def _kept(frame, bad):
    return exclusions.without(frame, bad).select(*ID)


for _mode, _condition in {
    "scored_without_response": ("null", "raw_response is null"),
    "scored_with_zero_response": ("zero", "raw_response = 0"),
    "scored_with_no_or_zero_response": ("either", "(raw_response is null or raw_response = 0)"),
}.items():

    @query(
        _mode,
        with_responses(
            "with bad as (select distinct activity_id_hist from responses "
            f"where scored_response = 1 and {_condition[1]}) select {ID_SQL} from responses r "
            "where not exists (select 1 from bad b where b.activity_id_hist = r.activity_id_hist)",
            scored_response="case when activity_id_hist % 7 = 0 and item_section_position = 1 "
            "then 1 else scored_response end",
        ),
    )
    def scored_without(spark, sf_dir, mode=_condition[0]):
        forced = (F.col("activity_id_hist") % 7 == 0) & (F.col("item_section_position") == 1)
        frame = responses(
            spark, sf_dir, scored_response=F.when(forced, 1).otherwise(F.col("scored_response"))
        )
        return _kept(frame, exclusions.bad_by_row(frame, exclusions.scored_without_response(mode)))


@query("negative_time", _without("select distinct activity_id_hist from responses where milliseconds_used < 0"))
def negative_time(spark, sf_dir):
    frame = responses(spark, sf_dir)
    return _kept(frame, exclusions.bad_by_row(frame, exclusions.negative_time()))


@query(
    "too_many_questions",
    with_responses(
        f"with mapped as (select r.*, num_ques from responses r join {test_map_sql(None)} m "
        "on r.template_name = m.template_name), bad as (select distinct activity_id_hist from "
        "(select activity_id_hist, template_name, num_ques, count(*) as n from mapped group by all) g "
        f"where n > num_ques) select {ID_SQL} from mapped r "
        "where not exists (select 1 from bad b where b.activity_id_hist = r.activity_id_hist)"
    ),
)
def too_many_questions(spark, sf_dir):
    frame = rows.join_test_map(responses(spark, sf_dir), test_map(spark, sf_dir, None))
    return _kept(frame, exclusions.bad_too_many_questions(frame))


@query(
    "too_many_questions_in_section",
    with_responses(
        f"with mapped as (select r.*, section_num_ques from responses r join {SECTIONS_SQL} m "
        "on r.section_name = m.section_name), bad as (select distinct activity_id_hist from "
        "(select activity_id_hist, section_name, section_num_ques, count(*) as n from mapped group by all) g "
        f"where n > section_num_ques) select {ID_SQL} from mapped r "
        "where not exists (select 1 from bad b where b.activity_id_hist = r.activity_id_hist)"
    ),
)
def too_many_questions_in_section(spark, sf_dir):
    sections = section_map(spark, sf_dir).select("section_name", "section_num_ques")
    frame = rows.join_section_map(responses(spark, sf_dir), sections)
    return _kept(frame, exclusions.bad_too_many_questions(frame, "section_name", "section_num_ques"))


@query(
    "duplicate_items",
    _without(
        "select distinct activity_id_hist from (select activity_id_hist, content_item_name from responses "
        "where content_item_id <> -1 group by activity_id_hist, content_item_name having count(*) > 1) d"
    ),
)
def duplicate_items(spark, sf_dir):
    frame = responses(spark, sf_dir, response_parts(spark, sf_dir))
    return _kept(frame, exclusions.bad_duplicate_items(frame))


@query(
    "repeat_administration",
    _without(
        "select distinct activity_id_hist from (select activity_id_hist, row_number() over "
        "(partition by student_id, template_name order by timestamp_created, activity_id_hist) as sitting "
        "from (select distinct student_id, template_name, activity_id_hist, timestamp_created "
        "from responses where timestamp_created is not null) s) k where sitting > 1"
    ),
)
def repeat_administration(spark, sf_dir):
    frame = responses(spark, sf_dir)
    return _kept(frame, exclusions.bad_repeat_administrations(frame))


@query(
    "manual_exclusion",
    _without("select o_orderkey as activity_id_hist from orders where o_totalprice > 300000"),
)
def manual_exclusion(spark, sf_dir):
    listed = (
        table(spark, sf_dir, "orders")
        .where("o_totalprice > 300000")
        .select(F.col("o_orderkey").alias("activity_id_hist"))
    )
    return _kept(responses(spark, sf_dir), listed)


@query(
    "deleted_activities",
    with_responses(
        "with deleted as (select distinct student_id, enrollment_id, template_id from responses "
        "where activity_status = 'reset' or regexp_matches(template_name, '[0-9]_d')) "
        f"select {ID_SQL} from responses r where not exists (select 1 from deleted d "
        "where d.student_id is not distinct from r.student_id "
        "and d.enrollment_id is not distinct from r.enrollment_id "
        "and d.template_id is not distinct from r.template_id)",
        template_name="case when activity_id % 50 = 0 then concat(template_name, '1_d') else template_name end",
    ),
)
def deleted_activities(spark, sf_dir):
    name = F.col("template_name")
    marked = F.when(F.col("activity_id") % 50 == 0, F.concat(name, F.lit("1_d"))).otherwise(name)
    return exclusions.without_deleted_templates(responses(spark, sf_dir, template_name=marked)).select(*ID)


@query(
    "repeat_enrollments",
    with_responses(
        "with again as (select o_custkey as enrollment_id from "
        "(select *, cast(400 + o_orderkey % 40 as varchar) as code, o_custkey % 25 as product from orders) o "
        "join nation n on o.product = n.n_nationkey "
        "where code in ('404', '405', '406') and o_orderdate + interval 22 year >= timestamp '2019-01-01') "
        f"select {ID_SQL} from responses r where not exists (select 1 from again a "
        "where a.enrollment_id = r.enrollment_id)"
    ),
)
def repeat_enrollments(spark, sf_dir):
    # purchases are dated 22 years later than orders, so that the first date cuts some off
    purchases = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("enrollment_id"),
        (F.col("o_custkey") % 25).alias("product_id"),
        (400 + F.col("o_orderkey") % 40).cast("string").alias("transaction_code"),
        (F.col("o_orderdate") + F.expr("interval 22 years")).alias("created_on"),
    )
    products = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("product_id"))
    again = rows.repeat_enrollments(purchases, products)
    return exclusions.without_repeat_enrollments(responses(spark, sf_dir), again).select(*ID)


@query(
    "over_time",
    _without(
        "select activity_id_hist from responses group by activity_id_hist "
        "having sum(milliseconds_used) / 60000.0 > 3.0"
    ),
)
def over_time(spark, sf_dir):
    frame = responses(spark, sf_dir).withColumn("test_minutes_allowed", F.lit(3.0))
    return _kept(frame, exclusions.bad_over_time(frame))


@query(
    "over_time_in_section",
    with_responses(
        f"with timed as (select r.*, minutes_allowed from responses r join {SECTIONS_SQL} s "
        "on r.section_name = s.section_name), bad as (select distinct activity_id_hist from "
        "(select activity_id_hist, section_name, minutes_allowed, sum(milliseconds_used) / 60000.0 as used "
        "from timed group by all) g where used > minutes_allowed / 2) "
        f"select {ID_SQL} from responses r where not exists "
        "(select 1 from bad b where b.activity_id_hist = r.activity_id_hist)"
    ),
)
def over_time_in_section(spark, sf_dir):
    limits = section_map(spark, sf_dir).select(
        "section_name", (F.col("minutes_allowed") / 2).alias("test_minutes_allowed")
    )
    frame = rows.join_section_map(responses(spark, sf_dir), limits)
    return _kept(frame, exclusions.bad_over_time(frame, ["section_name"]))
