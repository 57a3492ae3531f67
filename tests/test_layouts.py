"""One student with a third of all rows, and activities that students share.

Every layout must give what the SQL gives on the same responses.
"""

from dataclasses import replace

import pytest
from comparison import connect, differences
from pyspark.sql import functions as F

from itemflow.catalog import runs
from itemflow.catalog.tables import bank_map, responses, section_map, test_map as make_test_map
from itemflow.plans.clean import CleanConfig, CleanInputs, clean
from itemflow.plans.layout import branches, student_loads

SF_DIR = "/root/testdata/sf0.001"
HOT_SQL = "case when activity_id % 3 = 0 then 'hot' else student_id end"
SHARED_SQL = "case when activity_id % 5 = 0 and item_section_position % 2 = 0 then 'twin' else student_id end"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def hot(spark):
    one = F.when(F.col("activity_id") % 3 == 0, "hot").otherwise(F.col("student_id"))
    return responses(spark, SF_DIR, student_id=one)


def shared(spark):
    twin = (F.col("activity_id") % 5 == 0) & (F.col("item_section_position") % 2 == 0)
    return responses(spark, SF_DIR, student_id=F.when(twin, "twin").otherwise(F.col("student_id")))


LAYOUTS = {
    "student": {"layout": "student"},
    "aggregate": {"layout": "aggregate"},
    "split": {"layout": "auto", "hot_rows": 300},
}


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("audit", [False, True])
def test_hot_student_in_a_test(spark, con, layout, audit):
    config = replace(runs.GOLDEN, **LAYOUTS[layout])
    inputs = CleanInputs(test_map=make_test_map(spark, SF_DIR))
    result = clean(hot(spark), config, inputs, audit=audit)
    found = differences(runs.golden_columns(result.cleaned), con, runs.golden_sql(student_id=HOT_SQL))
    assert found is None, found
    if audit:
        funnel = result.audit.select("step_no", "step", *runs.LEFT, *runs.REMOVED)
        found = differences(funnel, con, runs.funnel_sql(student_id=HOT_SQL))
        assert found is None, found


@pytest.mark.parametrize("layout", LAYOUTS)
def test_hot_student_in_a_question_bank(spark, con, layout):
    config = replace(runs.BANK, **LAYOUTS[layout])
    result = clean(hot(spark), config, CleanInputs(test_map=bank_map(spark, SF_DIR)))
    found = differences(runs.bank_columns(result.cleaned), con, runs.bank_sql(student_id=HOT_SQL))
    assert found is None, found


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("audit", [False, True])
def test_hot_student_in_sections(spark, con, layout, audit):
    config = CleanConfig(total_minutes=1440, section_separated=True, **LAYOUTS[layout])
    inputs = CleanInputs(test_map=make_test_map(spark, SF_DIR, None), section_map=section_map(spark, SF_DIR))
    result = clean(hot(spark), config, inputs, audit=audit)
    found = differences(runs.section_columns(result.cleaned), con, runs.section_sql(student_id=HOT_SQL))
    assert found is None, found


def test_shared_activities_are_judged_as_one(spark, con):
    inputs = CleanInputs(test_map=make_test_map(spark, SF_DIR))
    result = clean(shared(spark), runs.GOLDEN, inputs, audit=True)
    found = differences(runs.golden_columns(result.cleaned), con, runs.golden_sql(student_id=SHARED_SQL))
    assert found is None, found
    funnel = result.audit.select("step_no", "step", *runs.LEFT, *runs.REMOVED)
    found = differences(funnel, con, runs.funnel_sql(student_id=SHARED_SQL))
    assert found is None, found


def test_a_bank_with_sections_counts_items_below_the_minimum(spark, con):
    """Alike with an audit, without one, and with rows saved by the caller."""
    from itemflow.catalog import ORACLES, QUERIES

    assert differences(QUERIES["clean_qbank_sections"](spark, SF_DIR), con, ORACLES["clean_qbank_sections"]) is None


@pytest.mark.parametrize("layout", ["auto", "aggregate"])
def test_showings_at_one_time_in_every_layout(spark, layout):
    """Rows that agree in all but nothing: one of them is the first, in a shared activity as well."""
    frame = responses(spark, SF_DIR)
    double = frame.unionByName(frame.where("activity_id % 7 = 0")).unionByName(frame.where("activity_id % 7 = 0"))
    config = CleanConfig(remove_no_response_scored=False, layout=layout)
    inputs = CleanInputs(test_map=make_test_map(spark, SF_DIR))
    rows = clean(double.withColumn("template_name", F.col("template_name")), config, inputs)
    ranks = rows.cleaned.groupBy("student_id", "content_item_id").agg(F.sum(F.when(~F.col("repeat_omitted"), 1).otherwise(0)).alias("firsts"))
    assert ranks.where("firsts > 1").count() == 0


@pytest.mark.parametrize("audit", [False, True])
def test_time_limits_in_every_layout(spark, audit):
    inputs = CleanInputs(section_map=section_map(spark, SF_DIR))
    rows = {}
    for layout in ("student", "aggregate"):
        config = CleanConfig(remove_over_time=True, remove_no_response_scored=False, layout=layout)
        result = clean(hot(spark), config, inputs, audit=audit)
        columns = ["response_id", "actual_num_ques", "overall_raw_correct", "overall_pTotal", "repeat_omitted"]
        rows[layout] = sorted(map(str, result.cleaned.select(*columns).collect())), audit and sorted(map(str, result.audit.collect()))
    assert rows["student"] == rows["aggregate"] and len(rows["student"][0]) > 0


def test_the_rules_on_shared_activities_are_one_saved_aggregate(spark, monkeypatch):
    from itemflow.plans import clean as run

    saved = []
    monkeypatch.setattr(run, "checkpointed", lambda frame: saved.append(frame.columns) or frame)
    inputs = CleanInputs(test_map=make_test_map(spark, SF_DIR))
    clean(shared(spark), CleanConfig(remove_over_time=True), inputs)
    assert len(saved) == 1 and {"kind", "key", "n"} <= set(saved[0])


def test_layout_is_chosen_by_the_data(spark):
    plain, one, twins = responses(spark, SF_DIR), hot(spark), shared(spark)
    assert [b.activity for b in branches(plain, plain, "auto")] == [("student_id", "activity_id_hist")]
    assert len(branches(one, one, "auto", hot_rows=300)) == 2
    mixed = branches(twins, twins, "auto")
    assert [b.activity for b in mixed] == [("student_id", "activity_id_hist"), ("activity_id_hist",)]
    assert sum(b.rows.count() for b in mixed) == twins.count()
    # whoever shares an activity is on the second side, with all their rows, and nobody else
    sharing = twins.groupBy("activity_id_hist").agg(F.countDistinct("student_id").alias("n")).where("n > 1").drop("n")
    students = twins.join(sharing, "activity_id_hist").select("student_id").distinct()
    assert mixed[1].rows.count() == twins.join(students, "student_id").count() < twins.count()
    with pytest.raises(ValueError):
        branches(plain, plain, "other")


def test_student_loads_count_every_row(spark):
    frame = hot(spark)
    loads = student_loads(frame).agg(F.sum("n_rows"), F.max("n_rows")).first()
    assert loads[0] == frame.count()
    assert loads[1] == frame.where("student_id = 'hot'").count()
