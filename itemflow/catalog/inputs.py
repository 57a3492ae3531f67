"""Template profile, test map and the counters at the start of a run."""

from __future__ import annotations

from pyspark.sql import functions as F

from itemflow import schema
from itemflow.catalog.registry import query, rounded
from itemflow.catalog.tables import responses, with_responses
from itemflow.operators import audit, profile

_PROFILE = (
    "select template_id, template_name, max(n) as max_resp, min(n) as min_resp, median(n) as median_resp, "
    "count(*) as num_users from (select template_id, template_name, student_id, count(*) as n "
    "from responses where activity_status in ('4', 'completed', 'Complete') group by all) s group by all"
)


def _profile(spark, sf_dir):
    return profile.template_profile(responses(spark, sf_dir), schema.COMPLETE_STATUSES)


@query("template_profile", with_responses(_PROFILE))
def template_profile(spark, sf_dir):
    return _profile(spark, sf_dir)


@query(
    "derive_test_map",
    with_responses(
        f"with p as ({_PROFILE}) select template_id, template_name, "
        "(select max(max_resp) from p) as num_ques, 0.75::double as response_threshold, "
        "1440.0::double as minutes_allowed from p"
    ),
)
def derive_test_map(spark, sf_dir):
    return profile.derive_test_map(_profile(spark, sf_dir))


@query(
    "starting_counters",
    with_responses(
        "select count(*) as responses_left, count(distinct activity_id_hist) as activities_left, "
        "count(distinct student_id) + max(case when student_id is null then 1 else 0 end) as users_left, "
        "count(distinct content_item_name) as items_left from responses",
        student_id="case when enrollment_id is null then null else student_id end",
    ),
)
def starting_counters(spark, sf_dir):
    known = F.when(F.col("enrollment_id").isNotNull(), F.col("student_id"))
    return audit.counters(responses(spark, sf_dir, student_id=known))
