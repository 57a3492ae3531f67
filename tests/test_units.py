"""Small frames built around nulls, ties, zero denominators and duplicate keys."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from itemflow import schema
from itemflow.functions.columns import grouped, is_deleted_name, letter_to_number, ratio, strict_sum
from itemflow.functions.quantiles import summarise_counts, value_counts
from itemflow.operators import answer_key as keys
from itemflow.operators import audit, combine, exclusions, joins, matrix, metadata, omissions
from itemflow.operators import profile, ranking, rows, scoring
from itemflow.plans.attach import by_join, by_saved_join, by_window
from itemflow.plans.clean import CleanConfig, CleanInputs, clean

DAY1, DAY2, DAY3 = (datetime(2021, 1, d) for d in (1, 2, 3))
DEFAULTS = {
    "student_id": "s1", "activity_id": 1, "activity_id_hist": 1, "enrollment_id": 7, "source_system": "A",
    "activity_status": "4", "tutor_mode": "False", "template_id": 1, "template_name": "T1",
    "section_name": "S1", "item_section_position": 1, "content_item_id": 1, "content_item_name": "i1",
    "timestamp_created": DAY1, "timestamp_completed": DAY1, "milliseconds_used": 10_000,
    "rawest_response": None, "raw_response": 1, "scored_response": 1, "is_scored": 1, "correct_answer": 1,
}


def frame(spark, *records):
    names = [f.name for f in schema.RESPONSES.fields]
    data = []
    for i, record in enumerate(records):
        full = {"response_id": f"r{i}"} | DEFAULTS | record
        if "activity_id_hist" in record and "activity_id" not in record:
            full["activity_id"] = record["activity_id_hist"]
        if "content_item_id" in record and "content_item_name" not in record:
            full["content_item_name"] = f"i{record['content_item_id']}"
        data.append(tuple(full[n] for n in names))
    return spark.createDataFrame(data, schema.RESPONSES)


def ids(df):
    return sorted(r.response_id for r in df.select("response_id").collect())


def by_id(df, *columns):
    found = {r.response_id: tuple(r[c] for c in columns) for r in df.collect()}
    return {k: v[0] if len(v) == 1 else v for k, v in found.items()}


# Expressions -----------------------------------------------------------------


def test_letters(spark):
    df = spark.createDataFrame([("A",), ("D",), ("E",), (None,)], "x string")
    assert [r[0] for r in df.select(letter_to_number(F.col("x"))).collect()] == [1, 4, None, None]


def test_deleted_names(spark):
    df = spark.createDataFrame([("form 1_d",), ("form_d",), (None,)], "x string")
    assert [r[0] for r in df.select(is_deleted_name(F.col("x"))).collect()] == [True, False, False]


def test_ratio_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None]


def test_strict_sum_is_null_with_a_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", None)], "k string, x int")
    sums = df.groupBy("k").agg(strict_sum(F.col("x"))(grouped).alias("s")).collect()
    assert {r.k: r.s for r in sums} == {"a": 3, "b": None}


@pytest.mark.parametrize("attach", [by_window, by_join, by_saved_join])
def test_attach_ways_agree_on_null_keys(spark, attach):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", None)], "k string, x int")
    out = attach(df, ["k"], {"s": strict_sum(F.col("x"))}).collect()
    assert sorted((str(r.k), r.x or 0, r.s or 0) for r in out) == [
        ("None", 3, 7), ("None", 4, 7), ("a", 1, 3), ("a", 2, 3), ("b", 0, 0),
    ]


@pytest.mark.parametrize("values", [[5], [1, 2], [0, 0, 0, 9], [-7, -1, 3, 1_000_000, 12, 12], list(range(101))])
def test_quartiles_are_exact(spark, values):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    row = summarise_counts(value_counts(df, [], "v"), []).first()
    expected = np.percentile(values, [25, 50, 75])
    assert [row.q1, row.median, row.q3] == pytest.approx(list(expected))
    assert (row.minimum, row.maximum, row.n_values) == (min(values), max(values), len(values))


# Joins -------------------------------------------------------------------------


def test_null_keys_match_in_joins(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, x string")
    right = spark.createDataFrame([(None, "y"), (4, "z")], "k int, w string")
    out = joins.natural_join(left, right, "full").collect()
    assert sorted((str(r.k), str(r.x), str(r.w)) for r in out) == [
        ("1", "a", "None"), ("3", "c", "None"), ("4", "None", "z"), ("None", "b", "y"),
    ]
    with pytest.raises(ValueError):
        joins.natural_join(left, right.toDF("p", "q"))


def test_null_outside_a_list_stays(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    listed = spark.createDataFrame([(1,)], "k int")
    assert sorted(str(r.k) for r in joins.drop_members(df, listed, ["k"]).collect()) == ["2", "None"]
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r.k for r in joins.drop_members(df, with_null, ["k"]).collect()] == [2]
    flags = joins.flag_members(df, with_null, ["k"], "f").collect()
    assert {str(r.k): r.f for r in flags} == {"1": True, "2": False, "None": True}


def test_joins_plan_without_a_job(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    joins.flag_members(df, df.select("k"), ["k"], "f")
    joins.keep_members(df, df.select("k"), ["k"])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before


# Rows ------------------------------------------------------------------------------


def test_row_filters_and_nulls(spark):
    df = frame(
        spark,
        {"enrollment_id": None, "item_section_position": None, "tutor_mode": None, "activity_status": None},
        {"enrollment_id": 0, "tutor_mode": "True", "activity_status": "completed", "content_item_id": -1},
        {"activity_status": "reset", "content_item_id": None, "is_scored": None, "milliseconds_used": 0},
    )
    assert ids(rows.drop_breaks(df)) == ["r1", "r2"]
    assert ids(rows.drop_zero_enrollment(df)) == ["r2"]
    assert ids(rows.drop_no_enrollment(df)) == ["r1", "r2"]
    assert ids(rows.drop_tutor(df)) == ["r0", "r2"]
    assert ids(rows.keep_complete(df)) == ["r1"]
    assert ids(rows.drop_staged(df)) == ["r0"]
    assert ids(rows.keep_scored(df)) == ["r0", "r1"]
    assert ids(rows.drop_zero_time(df)) == ["r0", "r1"]


def test_total_minutes_keep_the_limit_and_drop_unknown_times(spark):
    df = frame(
        spark,
        {"timestamp_completed": datetime(2021, 1, 1, 0, 10)},
        {"timestamp_completed": datetime(2021, 1, 1, 0, 10, 0, 1)},
        {"timestamp_completed": None},
    )
    assert ids(rows.within_total_minutes(df, 10)) == ["r0"]


def test_names_of_exports(spark):
    df = spark.createDataFrame([(1, "x", "Q")], "QuestionNumber int, Product_name string, section_title string")
    out = rows.prepare_content(df, {"questionNumber": "content_item_id"})
    assert out.columns == ["content_item_id", "template_id", "section_title"]


def test_question_bank_map_has_one_row(spark):
    two = spark.createDataFrame(
        [("a", 1, 0.5, 1.0), ("b", 1, 0.5, 1.0)], "template_name string, num_ques int, response_threshold double, minutes_allowed double"
    )
    with pytest.raises(ValueError):
        rows.join_question_bank_map(frame(spark, {}), two)
    out = rows.join_question_bank_map(frame(spark, {}, {}), two.limit(1))
    assert [r.test_num_ques for r in out.collect()] == [1, 1]


# Activities ------------------------------------------------------------------------------


def test_scored_without_response(spark):
    df = frame(
        spark,
        {"activity_id_hist": 1, "raw_response": None, "scored_response": 1},
        {"activity_id_hist": 1},
        {"activity_id_hist": 2, "raw_response": 0, "scored_response": 1},
        {"activity_id_hist": 3, "raw_response": None, "scored_response": 0},
        {"activity_id_hist": 4, "raw_response": None, "scored_response": None},
    )
    kept = {
        mode: ids(exclusions.without(df, exclusions.bad_by_row(df, exclusions.scored_without_response(mode))))
        for mode in ("null", "zero", "either")
    }
    assert kept == {"null": ["r2", "r3", "r4"], "zero": ["r0", "r1", "r3", "r4"], "either": ["r3", "r4"]}
    with pytest.raises(ValueError):
        exclusions.scored_without_response("never")


def test_duplicates_leave_staged_rows_out(spark):
    df = frame(
        spark,
        {"activity_id_hist": 1, "content_item_id": 5},
        {"activity_id_hist": 1, "content_item_id": 5},
        {"activity_id_hist": 2, "content_item_id": -1},
        {"activity_id_hist": 2, "content_item_id": -1},
    )
    assert ids(exclusions.without(df, exclusions.bad_duplicate_items(df))) == ["r2", "r3"]


def test_sittings(spark):
    df = frame(
        spark,
        {"activity_id_hist": 2, "timestamp_created": DAY1},  # same time: the smaller id is first
        {"activity_id_hist": 1, "timestamp_created": DAY1},
        {"activity_id_hist": 3, "timestamp_created": None},  # unknown: never excluded
        {"activity_id_hist": 4, "timestamp_created": DAY2, "template_name": "T2"},
        {"activity_id_hist": 5, "timestamp_created": DAY1, "student_id": "s2"},
        {"activity_id_hist": 5, "timestamp_created": DAY2, "student_id": "s2"},  # excludes itself
        {"activity_id_hist": 6, "timestamp_created": DAY1, "template_name": None},
        {"activity_id_hist": 7, "timestamp_created": DAY2, "template_name": None},
    )
    kept = exclusions.without(df, exclusions.bad_repeat_administrations(df))
    assert ids(kept) == ["r1", "r2", "r3", "r6"]


def test_deleted_templates_match_on_null(spark):
    df = frame(
        spark,
        {"enrollment_id": None, "activity_status": "reset"},
        {"enrollment_id": None, "activity_id_hist": 2},
        {"enrollment_id": 7, "activity_id_hist": 3},
        {"enrollment_id": 8, "activity_id_hist": 4, "template_name": "T1_d", "template_id": None},
        {"enrollment_id": 8, "activity_id_hist": 5, "template_id": None},
    )
    assert ids(exclusions.without_deleted_templates(df)) == ["r2"]


def test_over_time_with_unknown_time_is_kept(spark):
    df = frame(
        spark,
        {"activity_id_hist": 1, "milliseconds_used": 200_000},
        {"activity_id_hist": 2, "milliseconds_used": 200_000},
        {"activity_id_hist": 2, "milliseconds_used": None},
        {"activity_id_hist": 3, "milliseconds_used": 180_000},
    ).withColumn("test_minutes_allowed", F.lit(3.0))
    assert ids(exclusions.without(df, exclusions.bad_over_time(df))) == ["r1", "r2", "r3"]


# Omissions ---------------------------------------------------------------------------


def test_recode_keeps_the_first_originals(spark):
    df = omissions.add_attempted(frame(spark, {"raw_response": 3}, {"raw_response": None}, {"raw_response": 0}))
    once = omissions.recode_as_omitted(df, F.col("raw_response") > 2)
    twice = omissions.recode_as_omitted(once, F.lit(True))
    assert by_id(once, "raw_response", "attempted", "orig_response") == {
        "r0": (0, False, 3), "r1": (None, False, None), "r2": (0, False, 0),
    }
    assert by_id(twice, "raw_response", "orig_response") == {"r0": (0, 3), "r1": (0, None), "r2": (0, 0)}
    assert ids(omissions.marked_omits(twice)) == ["r0"]


def test_cutoffs(spark):
    df = omissions.add_attempted(
        frame(spark, *[{"timestamp_created": t} for t in (DAY1, DAY2, DAY3, None)])
    )
    cutoffs = spark.createDataFrame([("i1", DAY2), ("i1", DAY1), (None, DAY3)], "content_item_name string, cutoff_date timestamp_ntz")
    before = omissions.omit_version_cutoffs(df, cutoffs)
    after = omissions.omit_version_cutoffs(df, cutoffs, "after")
    assert by_id(before, "attempted") == {"r0": False, "r1": True, "r2": True, "r3": True}
    assert by_id(after, "attempted") == {"r0": True, "r1": False, "r2": False, "r3": True}
    with pytest.raises(ValueError):
        omissions.omit_version_cutoffs(df, cutoffs, "around")


def test_repeats(spark):
    df = omissions.add_attempted(
        frame(
            spark,
            {"activity_id_hist": 2, "timestamp_created": DAY2},
            {"activity_id_hist": 1, "timestamp_created": DAY1},
            {"activity_id_hist": 3, "timestamp_created": None},
            {"activity_id_hist": 1, "timestamp_created": DAY1},  # a tie: the first response id is first
            {"student_id": "s2", "timestamp_created": DAY3},
        )
    )
    kept, removed = omissions.repeat_questions(df)
    assert removed is None
    assert by_id(kept, "repeat_omitted", "raw_response") == {
        "r0": (True, 0), "r1": (False, 1), "r2": (None, 1), "r3": (True, 0), "r4": (False, 1),
    }
    fixed = omissions.zero_repeats(kept, ["milliseconds_used"])
    assert by_id(fixed, "milliseconds_used_fixed") == {"r0": 0, "r1": 10_000, "r2": None, "r3": 0, "r4": 10_000}
    kept, removed = omissions.repeat_questions(df, "remove")
    assert (ids(kept), ids(removed)) == (["r1", "r4"], ["r0", "r3"])
    kept, _ = omissions.repeat_questions(df, "ignore")
    assert set(by_id(kept, "repeat_omitted").values()) == {False}
    with pytest.warns(UserWarning):
        assert omissions.check_treatment("maybe") == "omit"


def test_timing_limits(spark):
    df = omissions.add_attempted(
        frame(spark, *[{"milliseconds_used": t} for t in (5000, 5001, 45000, 45001, None)])
    )
    out = omissions.timing_exclusion(df, ms_min=5000, ms_max=45000)
    assert by_id(out, "attempted") == {"r0": False, "r1": True, "r2": True, "r3": False, "r4": True}
    with pytest.warns(UserWarning):
        out = omissions.timing_exclusion(df, sec_min=5)
    assert set(by_id(out, "attempted").values()) == {True}
    assert omissions.timing_exclusion(df).columns == df.columns


def test_lists_of_versions_and_keys(spark):
    df = omissions.add_attempted(
        frame(
            spark,
            {"content_item_id": 1},
            {"content_item_id": 2},
            {"content_item_id": None, "content_item_name": None},
            {"content_item_id": 2, "correct_answer": None},
        )
    )
    items = spark.createDataFrame([(1,), (1,), (None,)], "content_item_id long")
    assert by_id(omissions.omit_version_list(df, items), "attempted") == {"r0": False, "r1": True, "r2": True, "r3": True}
    old = spark.createDataFrame([(2, 1), (2, None), (None, 1)], "content_item_id long, correct_answer long")
    assert by_id(omissions.omit_old_keys(df, old), "attempted") == {"r0": True, "r1": False, "r2": True, "r3": True}
    trial = spark.createDataFrame([("i2",)], "content_item_name string")
    assert by_id(omissions.flag_field_test(df, trial), "field_test") == {"r0": False, "r1": True, "r2": False, "r3": True}


# Scores ----------------------------------------------------------------------------------


def test_scores_with_nulls(spark):
    df = omissions.add_attempted(
        frame(
            spark,
            {"activity_id_hist": 1, "scored_response": None},
            {"activity_id_hist": 1},
            {"activity_id_hist": 2, "raw_response": None, "scored_response": 0},
            {"activity_id_hist": 3, "template_name": "T9"},
        )
    )
    test_map = spark.createDataFrame(
        [("T1", 2, 0.5, 1.0)], "template_name string, num_ques int, response_threshold double, minutes_allowed double"
    )
    mapped = rows.join_test_map(df, test_map)
    assert ids(mapped) == ["r0", "r1", "r2"]  # a template missing from the map loses its rows
    scored = scoring.activity_scores(mapped)
    assert by_id(scored, "template_raw_correct", "template_num_attempted", "template_pTotal", "template_pPlus") == {
        "r0": (None, 2, None, None), "r1": (None, 2, None, None), "r2": (0, 0, 0.0, None),
    }
    assert ids(scored.where(scoring.reaches_threshold())) == ["r0", "r1"]
    unknown = rows.join_test_map(df, test_map.withColumn("num_ques", F.lit(None).cast("int")))
    assert ids(scoring.activity_scores(unknown).where(scoring.reaches_threshold())) == []
    assert exclusions.bad_too_many_questions(unknown).count() == 0


def test_ranks_span_tasks(spark):
    data = [("a", i % 50, i) for i in range(500)] + [(None, 1, 1), ("b", None, 2), ("b", 3, 1)]
    df = spark.createDataFrame(data, "g string, t int, n int")
    out = ranking.ranked(df, ["g"], ["t", "n"], "place").collect()
    expected = {r: i + 1 for i, r in enumerate(sorted((x for x in data if x[0] == "a"), key=lambda x: x[1:]))}
    assert all(expected[(r.g, r.t, r.n)] == r.place for r in out if r.g == "a")
    assert {(r.g, r.t): r.place for r in out if r.g != "a"} == {(None, 1): 1, ("b", 3): 1, ("b", None): 2}


# Keys ---------------------------------------------------------------------------------------


def test_showings_at_one_time(spark):
    rows = [("s", 1, datetime(2021, 1, 1), 7, answer) for answer in (1, 2, 3)]
    df = spark.createDataFrame(rows, "student_id string, content_item_id long, timestamp_created timestamp_ntz, activity_id_hist long, raw_response long")
    assert sorted(r.repeat_omitted for r in omissions.flag_repeats(df).collect()) == [False, True, True]
    named = df.withColumn("response_id", F.lit("same"))
    assert sorted(r.repeat_omitted for r in omissions.flag_repeats(named).collect()) == [False, True, True]


def test_text_responses_count_as_attempted(spark):
    df = spark.createDataFrame([("A",), ("0",), (None,), ("7",)], "raw_response string")
    assert [r.attempted for r in omissions.add_attempted(df).collect()] == [True, False, False, True]


def test_answer_keys(spark):
    df = frame(
        spark,
        {"content_item_id": 1, "correct_answer": 1},
        {"content_item_id": 1, "correct_answer": 2, "raw_response": 2, "rawest_response": "B", "timestamp_created": DAY2},
        {"content_item_id": 2, "correct_answer": None, "raw_response": 3, "rawest_response": "C"},
        {"content_item_id": 2, "correct_answer": None, "raw_response": 4, "scored_response": 0},
    )
    assert keys.answer_key(df).count() == 2
    with pytest.raises(keys.KeyConflict):
        keys.answer_key(df, strict=True)
    assert keys.answer_key(df.where("content_item_id = 2"), strict=True).count() == 0
    inferred = keys.answer_key(df, infer=True).collect()
    assert sorted((r.content_item_id, r.correct_answer, r.correct_answer_rawest) for r in inferred if r.correct_answer > 1) == [
        (1, 2, "B"), (2, 3, "C"),
    ]
    conflicts = keys.answer_key_conflicts(df).collect()
    assert sorted((r.content_item_id, r.raw_response, r.total, r.min_date) for r in conflicts) == [
        (1, 1, 1, DAY1), (1, 2, 1, DAY2),
    ]
    assert keys.answer_key_conflicts(df.where("content_item_id = 2")).count() == 0
    named = keys.answer_key_conflicts(df.drop("timestamp_created"), keys.NAME)
    assert named.columns == ["content_item_name", "raw_response", "total"]


# Matrices --------------------------------------------------------------------------------------


def matrix_frame(spark):
    df = frame(
        spark,
        {"student_id": "s1", "content_item_id": 1, "raw_response": 2, "scored_response": 1},
        {"student_id": "s1", "content_item_id": 2, "raw_response": None, "scored_response": 0},
        {"student_id": "s2", "content_item_id": 3, "raw_response": 1, "scored_response": None, "milliseconds_used": 0},
        {"student_id": "s2", "content_item_id": 3, "raw_response": 1, "scored_response": 1},
    )
    return omissions.add_attempted(df).withColumn("repeat_omitted", F.lit(False))


def cells(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_wide_matrix_and_lines(spark):
    df = matrix_frame(spark)
    long = matrix.matrix_long(df, ["scored_response", "raw_response", "milliseconds_used"])
    items = matrix.item_names(df)
    assert items == ["i1", "i2", "i3"]
    scores = matrix.matrix_wide(long, "scored_response", items, ".", "-99")
    assert cells(scores) == {"s1": ("1", ".", "-99"), "s2": ("-99", "-99", None)}
    times = matrix.matrix_wide(long, "milliseconds_used", items, ".", "-99")
    assert cells(times) == {"s1": ("10000", "10000", "."), "s2": (".", ".", "10000")}
    lines = matrix.matrix_lines(long, "scored_response", matrix.name_order(df), ".", "-99")
    assert cells(lines) == {"s1": ("1,.,-99",), "s2": ("-99,-99,NA",)}
    blocks = matrix.in_blocks(matrix.name_order(df), 2)
    found = {(r.student_id, r.block): r.line for r in matrix.block_lines(long, "raw_response", blocks, "5", "6").collect()}
    assert found == {("s1", 0): "2,5", ("s1", 1): "6", ("s2", 0): "6,6", ("s2", 1): "2"}
    assert {r.block: r.line for r in matrix.block_headers(blocks).collect()} == {0: "i1,i2", 1: "i3"}
    omit_incorrect = matrix.omit_incorrect_matrix(df, items)
    assert cells(omit_incorrect) == {"s1": ("1", "0", "."), "s2": (".", ".", "1")}


def test_display_order_takes_the_first_place(spark):
    df = frame(
        spark,
        {"content_item_id": 1, "template_name": "T2", "item_section_position": 1},
        {"content_item_id": 2, "template_name": "T1", "item_section_position": 2},
        {"content_item_id": 1, "template_name": "T1", "item_section_position": None},
        {"content_item_id": 3, "template_name": None, "item_section_position": 1},
    )
    assert matrix.item_names(df, use_display_order=True) == ["i2", "i1", "i3"]


def test_combined_matrices_agree(spark):
    exams = {
        "A_": matrix.matrix_long(matrix_frame(spark), ["scored_response"]),
        "B_": matrix.matrix_long(matrix_frame(spark).where("student_id = 's2'"), ["scored_response"]),
    }
    items = {"A_": ["i1", "i2", "i3"], "B_": ["i3", "i4"]}
    fast = combine.combine_long(combine.stack_exams(exams), "scored_response", items, ".", "-99")
    slow = combine.combine_wide(
        {p: matrix.matrix_wide(long, "scored_response", items[p], ".", "-99") for p, long in exams.items()}
    )
    assert fast.columns == slow.columns == ["student_id", "A_i1", "A_i2", "A_i3", "B_i3", "B_i4"]
    assert cells(fast) == cells(slow) == {
        "s1": ("1", ".", "-99", None, None), "s2": ("-99", "-99", None, None, "-99"),
    }
    lookup = spark.createDataFrame([("s1", "x"), ("s1", "y")], "student_id string, real_id string")
    with pytest.raises(ValueError):
        combine.with_student_ids(fast, lookup, "student_id")


def test_tables_of_students_and_items(spark):
    df = matrix_frame(spark)
    test_map = spark.createDataFrame([("T1", 2), ("T2", 3)], "template_name string, num_ques int")
    users = {r.student_id: r for r in metadata.user_info(df, test_map).collect()}
    assert (users["s1"].test_total, users["s1"].test_att, users["s1"].test_pplus) == (5, 1, 1.0)
    assert users["s2"].test_correct is None
    key = keys.answer_key(df)
    info = {r.content_item_id: r for r in metadata.item_info(df, key).collect()}
    assert (info[3].count_seen, info[3].num_correct, info[1].correct_answer) == (2, None, 1)


def test_profile_and_map(spark):
    df = frame(spark, *[{"student_id": s, "activity_status": "4"} for s in "aab"], {"activity_status": "Complete"})
    profile_row = profile.template_profile(df)
    row = profile_row.first()
    assert (row.max_resp, row.min_resp, row.median_resp, row.num_users) == (2, 1, 1.5, 2)
    assert profile.derive_test_map(profile_row).first().num_ques == 2


def test_counters_count_null_as_a_value(spark):
    df = frame(spark, {"student_id": None}, {"student_id": "a", "content_item_name": None}, {"student_id": "a"})
    row = audit.counters(df).first()
    assert tuple(row) == (3, 1, 2, 2)


# Whole runs --------------------------------------------------------------------------------


def test_a_map_is_needed(spark):
    with pytest.raises(ValueError):
        clean(frame(spark, {}), CleanConfig(), CleanInputs())


def test_sections_without_their_columns(spark):
    test_map = spark.createDataFrame(
        [("T1", 2, 0.5, 1.0)], "template_name string, num_ques int, response_threshold double, minutes_allowed double"
    )
    with pytest.raises(ValueError, match="section_num_ques"):
        clean(frame(spark, {}), CleanConfig(section_separated=True), CleanInputs(test_map=test_map))


def test_sections_from_the_data(spark):
    test_map = spark.createDataFrame(
        [("T1", 2, 0.5, 1.0)], "template_name string, num_ques int, response_threshold double, minutes_allowed double"
    )
    df = frame(
        spark,
        {"section_name": "S1"},
        {"section_name": "S2", "content_item_id": 2, "raw_response": 0, "scored_response": 0},
        {"section_name": "S1", "activity_id_hist": 2, "content_item_id": 3, "timestamp_created": DAY2},
    ).withColumns({"section_num_ques": F.lit(1), "section_response_threshold": F.lit(0.5)})
    for layout in ("student", "aggregate"):
        config = CleanConfig(section_separated=True, layout=layout)
        out = clean(df, config, CleanInputs(test_map=test_map)).cleaned
        # one weak section removes the whole first activity; the rates were taken before
        assert by_id(out, "overall_raw_correct", "overall_pTotal") == {"r2": (2, 0.5)}


def test_removed_repeats_are_returned_by_every_layout(spark):
    test_map = spark.createDataFrame(
        [("T1", 2, 0.0, 1.0)], "template_name string, num_ques int, response_threshold double, minutes_allowed double"
    )
    df = frame(
        spark,
        *[
            {"student_id": s, "activity_id_hist": a + n, "timestamp_created": t}
            for a, s in ((10, "s1"), (20, "s2"))
            for n, t in ((1, DAY1), (2, DAY2), (3, None))
        ],
    )
    for options in ({"layout": "student"}, {"layout": "aggregate"}, {"layout": "auto", "hot_rows": 2}):
        removing = clean(df, CleanConfig(repeat_treatment="remove", **options), CleanInputs(test_map=test_map))
        assert (ids(removing.cleaned), ids(removing.removed_repeats)) == (["r0", "r3"], ["r1", "r4"])
        omitting = clean(df, CleanConfig(**options), CleanInputs(test_map=test_map))
        assert ids(omitting.marked_omits) == ["r1", "r4"]
        assert ids(omitting.cleaned) == ["r0", "r1", "r2", "r3", "r4", "r5"]


def test_letters_are_recoded_after_the_activity_rules(spark):
    test_map = spark.createDataFrame(
        [("T1", 2, 0.5, 1.0)], "template_name string, num_ques int, response_threshold double, minutes_allowed double"
    )
    text = F.array(F.lit("A"), F.lit("E"))[F.col("content_item_id").cast("int") - 1]
    df = frame(spark, {"content_item_id": 1}, {"content_item_id": 2}).withColumn("raw_response", text)
    out = clean(df, CleanConfig(recode_answers=True), CleanInputs(test_map=test_map)).cleaned
    # E is no answer, but that shows only after the rule on answers has run
    assert by_id(out, "raw_response", "attempted", "rawest_response") == {"r0": (1, True, "A"), "r1": (None, False, "E")}


def test_results_by_section_and_saved_rows(spark, tmp_path):
    sections = spark.createDataFrame([("S1", 1, 0.0), ("S2", 1, 0.0)], "section_name string, section_num_ques int, section_response_threshold double")
    df = frame(spark, {"section_name": "S1"}, {"section_name": "S2", "content_item_id": 2}, {"section_name": "S3"})
    config = CleanConfig(section_separated=True)
    result = clean(df, config, CleanInputs(section_map=sections), audit=True, save_to=str(tmp_path / "run"))
    assert {name: ids(f) for name, f in result.by_section().items()} == {"S1": ["r0"], "S2": ["r1"]}
    steps = {r.step: r.responses_left for r in result.audit.collect()}
    assert (steps["start"], steps["section_filter"], steps["below_threshold"]) == (3, 2, 2)
    assert not [c for c in result.cleaned.columns if c.startswith("__")]
