"""Rows are dealt by their number, and wide rows are made where their cells are."""

import re

import pytest

from itemflow.catalog import QUERIES, outputs, rules
from itemflow.functions import parts
from itemflow.operators import matrix

SF = "/root/testdata/sf0.001"


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def long_rows(spark):
    data = [("s1", "a", 1, 1, 5), ("s1", "b", 1, 0, 0), (None, "a", 1, 1, None), ("s2", None, 1, 1, 3)]
    return spark.createDataFrame(data, "student_id string, content_item_name string, seen long, attempted long, scored_response long")


def test_number_of_parts():
    assert parts.parts_of(0) is None and parts.parts_of(parts.PART_ROWS * parts.FEW_PARTS) is None
    assert parts.parts_of(parts.PART_ROWS * 100 + 1) == 101


def test_dealt(spark):
    frame = spark.range(100)
    assert parts.dealt(frame, None, "id") is frame
    assert parts.dealt(frame, 11, "id").rdd.getNumPartitions() == 11
    # never fewer than the session has
    assert parts.dealt(frame, 3, "id").rdd.getNumPartitions() == 8


@pytest.mark.parametrize("number", [None, 11])
def test_cells_are_dealt_by_student_before_rows_get_wide(spark, number):
    wide = matrix.matrix_wide(long_rows(spark), "scored_response", ["a", "b"], ".", "-99", number)
    found = {r.student_id: (r.a, r.b) for r in wide.collect()}
    assert found == {"s1": ("5", "."), None: (None, "-99"), "s2": ("-99", "-99")}
    plan = physical(wide)
    assert "hashpartitioning(student_id" not in plan[: plan.index("partial_pivotfirst")], plan


@pytest.mark.parametrize("name", ["matrix_responses", "matrix_omit_incorrect", "combine_full", "combine_lookup", "combine_stacked", "duplicate_items"])
def test_large_tables_are_read_in_more_parts(spark, monkeypatch, name):
    expected = sorted(map(str, QUERIES[name](spark, SF).collect()))
    for module in (outputs, rules):
        monkeypatch.setattr(module, "response_parts", lambda spark, sf_dir: 13)
    frame = QUERIES[name](spark, SF)
    assert ", 13), REPARTITION_BY_NUM" in physical(frame)
    assert sorted(map(str, frame.collect())) == expected


@pytest.mark.parametrize("name", ["question_counts", "overall_scores_test", "overall_scores_qbank", "threshold_template"])
def test_responses_are_not_dealt_by_their_few_sections(spark, name):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(QUERIES[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert not re.search(r"SortMergeJoin \[[^\]]*(section_name|template_name|o_orderpriority)[^\]]*\], \[[^\]]*\], Inner", plan), plan
