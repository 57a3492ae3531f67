"""The numbers of the funnel and the shape of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from itemflow.catalog import runs
from itemflow.catalog.tables import responses, table, test_map as make_test_map
from itemflow.operators import exclusions, omissions, rows
from itemflow.plans.clean import CleanConfig, CleanInputs, clean

# step: rows / activities / students / items left, at two scales
FUNNEL = {
    "start": ("6000 1473 150 200", "60000 14743 1500 2000"),
    "no_enrollment": ("5911 1449 148 200", "59311 14589 1484 2000"),
    "incomplete": ("5439 1334 148 200", "54286 13370 1484 2000"),
    "tutor": ("4924 1213 148 200", "49370 12154 1483 2000"),
    "over_total_minutes": ("4721 1164 148 200", "47397 11674 1481 2000"),
    "scored_without_response": ("4297 1077 148 200", "46086 11417 1481 2000"),
    "negative_time": ("4285 1075 148 200", "46002 11394 1481 2000"),
    "too_many_questions": ("4077 1053 148 200", "44023 11185 1481 2000"),
    "duplicate_items": ("3905 1021 148 200", "43838 11149 1481 2000"),
    "repeat_administration": ("2117 539 148 200", "22529 5777 1481 2000"),
    "staged": ("2103 538 148 199", "22403 5774 1481 1990"),
    "below_threshold": ("1685 374 145 199", "18192 4005 1448 1990"),
}
OMITTED = {"staged": (379, 5307), "repeat": (48, 52), "timing_min": (144, 1376), "timing_max": (208, 2068)}
TOTALS = ((1186, 317), (12279, 3055))


@pytest.mark.parametrize("scale, sf", [(0, "0.001"), (1, "0.01")])
def test_golden_funnel(spark, scale, sf):
    result = runs.golden(spark, f"/root/testdata/sf{sf}", audit=True)
    steps = {r.step: r for r in result.audit.collect()}
    left = {s: " ".join(str(steps[s][c]) for c in runs.LEFT) for s in FUNNEL}
    assert left == {s: numbers[scale] for s, numbers in FUNNEL.items()}
    omitted = [steps[s].omitted_responses for s in OMITTED]
    newly = [omitted[0], *[b - a for a, b in zip(omitted, omitted[1:])]]
    assert newly == [n[scale] for n in OMITTED.values()]
    attempted, correct = result.cleaned.agg(
        F.count_if("attempted"), F.sum("scored_response")
    ).first()
    assert (attempted, correct) == TOTALS[scale]


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def written(spark, tmp_path):
    """The responses as a stored table, as in production."""
    path = str(tmp_path / "responses")
    responses(spark, "/root/testdata/sf0.001").repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def test_a_run_shuffles_the_rows_once(spark, tmp_path):
    frame = written(spark, tmp_path)
    inputs = CleanInputs(test_map=make_test_map(spark, "/root/testdata/sf0.001"))
    plan = physical(clean(frame, runs.GOLDEN, inputs).cleaned)
    shuffles = re.findall(r"Exchange hashpartitioning\(([^,]*)", plan)
    by_student = [s for s in shuffles if s.startswith("student_id")]
    # the other one makes the map distinct
    assert len(by_student) == 1 and len(shuffles) == 2, shuffles
    assert "SortMergeJoin" not in plan


def test_a_bank_run_shuffles_the_rows_once_per_pass(spark, tmp_path):
    frame = written(spark, tmp_path)
    from itemflow.catalog.tables import bank_map

    inputs = CleanInputs(test_map=bank_map(spark, "/root/testdata/sf0.001"))
    plan = physical(clean(frame, runs.BANK, inputs).cleaned)
    # the scored rows are stored: counting the items of the bank does not make them again
    assert "hashpartitioning(student_id" not in plan and "Window" not in plan and "response_id" in plan
    saved = physical(clean(frame, runs.BANK, inputs, save_to=str(tmp_path / "bank")).cleaned)
    assert "hashpartitioning(student_id" not in saved and "Window" not in saved


def test_row_rules_reach_the_scan(spark, tmp_path):
    frame = written(spark, tmp_path)
    inputs = CleanInputs(test_map=make_test_map(spark, "/root/testdata/sf0.001"))
    plan = physical(clean(frame, CleanConfig(), inputs).cleaned)
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "IsNotNull(enrollment_id)" in pushed and "activity_status" in pushed


def test_rules_read_only_their_columns(spark, tmp_path):
    frame = written(spark, tmp_path)
    plan = physical(exclusions.bad_by_row(frame, exclusions.negative_time()))
    assert re.search(r"ReadSchema: struct<activity_id_hist:bigint,milliseconds_used:bigint>", plan)
    assert "LessThan(milliseconds_used,0)" in plan


def test_no_plan_has_a_cross_join_or_python(spark):
    from itemflow.catalog import QUERIES

    for name in ("clean_qbank", "user_info", "matrix_summary", "derive_test_map", "combine_sources"):
        plan = physical(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "Python" not in plan and "Pandas" not in plan, name


def test_showings_are_ranked_in_one_pass(spark, tmp_path):
    frame = written(spark, tmp_path)
    plan = physical(omissions.flag_repeats(frame))
    assert len(re.findall(r"Scan parquet", plan)) == 1 and len(re.findall(r"Exchange", plan)) == 1
    assert "SortAggregate" not in plan and "Join" not in plan and "xxhash64" not in plan


def test_queries_read_the_responses_once(spark):
    """One scan of the fact table, and no aggregate that sorts."""
    from itemflow.catalog import QUERIES

    for name in ("matrix_long", "user_info", "repeat_omit"):
        plan = physical(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert len(re.findall(r"Location:[^\n]*lineitem|Scan parquet[^\n]*l_orderkey", plan)) == 1, name
        assert "SortAggregate" not in plan, name


def test_tables_are_read_with_their_schema(spark):
    for name in ("customer", "lineitem", "nation", "orders", "part"):
        stated = table(spark, "/root/testdata/sf0.001", name).schema
        found = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").schema
        assert stated == found
