"""Renames, row filters, joins with maps and content."""

from __future__ import annotations

from pyspark.sql import functions as F

from itemflow.catalog.registry import query
from itemflow.catalog.tables import (
    CONTENT_SQL,
    SECTIONS_SQL,
    bank_map,
    content_items,
    responses,
    section_map,
    table,
    test_map,
    test_map_sql,
    with_responses,
)
from itemflow.functions.columns import minutes_between
from itemflow.operators import rows
from itemflow.operators.joins import natural_join

ID = ("response_id", "student_id", "activity_id_hist")
ID_SQL = "response_id, student_id, activity_id_hist"


@query(
    "rename_columns",
    with_responses(
        f"select {ID_SQL}, activity_id, section_name, scored_response as response_status, correct_answer "
        "from responses"
    ),
)
def rename_columns(spark, sf_dir):
    export = responses(spark, sf_dir).select(
        F.col("response_id").alias("Response_id"),
        F.col("student_id").alias("Student_id"),
        F.col("activity_id").alias("Activity_id"),
        F.col("section_name").alias("Section_title"),
        F.col("item_section_position").alias("Item_section_position"),
        F.col("scored_response").alias("Item_status"),
        F.col("correct_answer").alias("CorrectAnswer"),
    )
    return rows.prepare_responses(export).drop("item_section_position")


@query(
    "drop_breaks",
    with_responses(
        f"select {ID_SQL}, item_section_position from responses where item_section_position is not null",
        item_section_position="nullif(item_section_position, 7)",
    ),
)
def drop_breaks(spark, sf_dir):
    position = F.nullif(F.col("item_section_position"), F.lit(7))
    return rows.drop_breaks(responses(spark, sf_dir, item_section_position=position)).select(
        *ID, "item_section_position"
    )


@query(
    "nonzero_enrollment",
    with_responses(
        f"select {ID_SQL}, enrollment_id from responses where enrollment_id <> 0",
        enrollment_id="coalesce(enrollment_id, 0)",
    ),
)
def nonzero_enrollment(spark, sf_dir):
    enrollment = F.coalesce("enrollment_id", F.lit(0))
    return rows.drop_zero_enrollment(responses(spark, sf_dir, enrollment_id=enrollment)).select(
        *ID, "enrollment_id"
    )


@query(
    "section_filter",
    with_responses(
        f"select {ID_SQL}, section_name from responses where section_name in "
        f"(select section_name from {SECTIONS_SQL} s where section_num_ques > 3)"
    ),
)
def section_filter(spark, sf_dir):
    long_sections = section_map(spark, sf_dir).where("section_num_ques > 3")
    return rows.keep_sections(responses(spark, sf_dir), long_sections).select(*ID, "section_name")


@query(
    "no_enrollment",
    with_responses(f"select {ID_SQL}, enrollment_id from responses where enrollment_id is not null"),
)
def no_enrollment(spark, sf_dir):
    return rows.drop_no_enrollment(responses(spark, sf_dir)).select(*ID, "enrollment_id")


@query(
    "complete_only",
    with_responses(
        f"select {ID_SQL}, activity_status from responses "
        "where activity_status in ('4', 'completed', 'Complete')"
    ),
)
def complete_only(spark, sf_dir):
    return rows.keep_complete(responses(spark, sf_dir)).select(*ID, "activity_status")


@query(
    "no_tutor",
    with_responses(
        f"select {ID_SQL}, tutor_mode from responses where tutor_mode <> 'True' or tutor_mode is null"
    ),
)
def no_tutor(spark, sf_dir):
    return rows.drop_tutor(responses(spark, sf_dir)).select(*ID, "tutor_mode")


@query(
    "max_total_minutes",
    with_responses(
        f"with timed as (select {ID_SQL}, "
        "date_diff('microsecond', timestamp_created, timestamp_completed) / 60000000.0 as total_time "
        "from responses) select * replace (round(total_time, 6) as total_time) from timed "
        "where total_time <= 720"
    ),
)
def max_total_minutes(spark, sf_dir):
    kept = rows.within_total_minutes(responses(spark, sf_dir), 720)
    return kept.select(*ID, F.round("total_time", 6).alias("total_time"))


@query(
    "staged_removed",
    with_responses(f"select {ID_SQL}, content_item_id from responses where content_item_id <> -1"),
)
def staged_removed(spark, sf_dir):
    return rows.drop_staged(responses(spark, sf_dir)).select(*ID, "content_item_id")


@query(
    "scored_only",
    with_responses(f"select {ID_SQL}, is_scored from responses where is_scored = 1"),
)
def scored_only(spark, sf_dir):
    return rows.keep_scored(responses(spark, sf_dir)).select(*ID, "is_scored")


@query(
    "zero_time_not_reached",
    with_responses(
        f"select {ID_SQL}, milliseconds_used from responses where milliseconds_used > 0"
    ),
)
def zero_time_not_reached(spark, sf_dir):
    return rows.drop_zero_time(responses(spark, sf_dir)).select(*ID, "milliseconds_used")


@query(
    "interaction_types",
    f"select content_item_id, content_item_name, interaction_type_id from {CONTENT_SQL} c "
    "where interaction_type_id in (1, 10, 11)",
)
def interaction_types(spark, sf_dir):
    kept = rows.keep_interaction_types(content_items(spark, sf_dir), (1, 10, 11))
    return kept.select("content_item_id", "content_item_name", "interaction_type_id")


@query(
    "content_of_template",
    f"select content_item_id, content_item_name, template_id from {CONTENT_SQL} c where template_id = 3",
)
def content_of_template(spark, sf_dir):
    kept = rows.content_of_template(content_items(spark, sf_dir), 3)
    return kept.select("content_item_id", "content_item_name", "template_id")


@query(
    "join_activities",
    with_responses(
        f"select {ID_SQL}, r.source_system, o.o_orderpriority as activity_title, "
        "o.o_orderdate as started from (select *, 'A' as source_system from responses) r "
        "join orders o on r.student_id = cast(o.o_custkey as varchar) and r.activity_id = o.o_orderkey"
    ),
)
def join_activities(spark, sf_dir):
    activities = rows.prepare_activities(
        table(spark, sf_dir, "orders").select(
            F.col("o_custkey").cast("string").alias("student_id"),
            F.col("o_orderkey").alias("activity_id"),
            F.lit("A").alias("source_system"),
            F.col("o_orderpriority").alias("activity_title"),
            F.col("o_orderdate").alias("started"),
            F.col("o_orderstatus").alias("status"),
        )
    )
    shown = responses(spark, sf_dir).select("response_id", "student_id", "activity_id")
    joined = rows.join_activities(shown.withColumn("source_system", F.lit("A")), activities)
    return joined.select(*ID, "source_system", "activity_title", "started")


@query(
    "join_content",
    with_responses(
        f"select {ID_SQL}, r.content_item_id, r.content_item_name, c.brand from responses r join "
        f"(select distinct content_item_id, content_item_name, brand from {CONTENT_SQL} x "
        "where interaction_type_id in (1, 2, 3)) c "
        "on r.content_item_id = c.content_item_id and r.content_item_name = c.content_item_name"
    ),
)
def join_content(spark, sf_dir):
    joined = rows.attach_content(
        responses(spark, sf_dir), content_items(spark, sf_dir), ["brand"], (1, 2, 3)
    )
    return joined.select(*ID, "content_item_id", "content_item_name", "brand")


@query(
    "join_section_map",
    with_responses(
        f"select {ID_SQL}, r.section_name, section_num_ques, section_response_threshold "
        f"from responses r join {SECTIONS_SQL} s on r.section_name = s.section_name"
    ),
)
def join_section_map(spark, sf_dir):
    sections = section_map(spark, sf_dir).select(
        "section_name", "section_num_ques", "section_response_threshold"
    )
    joined = rows.join_section_map(responses(spark, sf_dir), sections)
    return joined.select(*ID, "section_name", "section_num_ques", "section_response_threshold")


@query(
    "join_test_map",
    with_responses(
        f"select {ID_SQL}, r.template_name, minutes_allowed as test_minutes_allowed, "
        f"num_ques as test_num_ques, response_threshold as test_response_threshold "
        f"from responses r join {test_map_sql(None)} m on r.template_name = m.template_name"
    ),
)
def join_test_map(spark, sf_dir):
    joined = rows.join_test_map(responses(spark, sf_dir), test_map(spark, sf_dir, None))
    return joined.select(
        *ID, "template_name", "test_minutes_allowed", "test_num_ques", "test_response_threshold"
    )


@query(
    "join_qbank_map",
    with_responses(
        f"select {ID_SQL}, (select max(minutes_allowed) from {test_map_sql(None)} m) as test_minutes_allowed, "
        f"(select max(num_ques) from {test_map_sql(None)} m) as test_num_ques, "
        f"(select max(response_threshold) from {test_map_sql(None)} m) as test_response_threshold from responses"
    ),
)
def join_qbank_map(spark, sf_dir):
    joined = rows.join_question_bank_map(responses(spark, sf_dir), bank_map(spark, sf_dir))
    return joined.select(*ID, "test_minutes_allowed", "test_num_ques", "test_response_threshold")


@query(
    "null_safe_natural_join",
    with_responses(
        "with e as (select enrollment_id, count(*) as n_responses from responses group by enrollment_id), "
        "t as (select case when c_custkey % 97 = 0 then null else c_custkey end as enrollment_id, "
        "count(*) as n_customers, max(c_nationkey) as last_nation from customer group by 1) "
        "select coalesce(e.enrollment_id, t.enrollment_id) as enrollment_id, n_responses, n_customers, "
        "last_nation from e full join t on e.enrollment_id is not distinct from t.enrollment_id"
    ),
)
def null_safe_natural_join(spark, sf_dir):
    shown = responses(spark, sf_dir)
    per_enrollment = shown.groupBy("enrollment_id").agg(F.count("*").alias("n_responses"))
    # customers without an order match nothing, and null matches null
    key = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").groupBy(F.when(key % 97 != 0, key).alias("enrollment_id")).agg(
        F.count("*").alias("n_customers"), F.max("c_nationkey").alias("last_nation")
    )
    return natural_join(per_enrollment, customers, "full")


@query(
    "minutes_per_activity",
    "select o_orderkey as activity_id, round(date_diff('microsecond', o_orderdate, "
    "o_orderdate + to_minutes(cast(o_orderkey % 1500 as int))) / 60000000.0, 6) as total_time from orders",
)
def minutes_per_activity(spark, sf_dir):
    start = F.col("o_orderdate")
    end = start + F.make_dt_interval(mins=(F.col("o_orderkey") % 1500).cast("int"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("activity_id"),
        F.round(minutes_between(start, end), 6).alias("total_time"),
    )
