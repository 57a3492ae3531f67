"""Wide rows are shuffled no more often than their keys need."""

import pytest
from pyspark.sql import functions as F

from itemflow.operators import omissions
from itemflow.operators.joins import flag_members
from itemflow.operators.ranking import ranked


@pytest.fixture
def only_shuffles(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_ranked_rows_are_dealt_once_for_window_and_join(spark, only_shuffles):
    data = [(g, h, i, f"row {i}") for g in ("a", None, "b") for h in (1, None) for i in range(40)]
    frame = spark.createDataFrame(data, "g string, h long, o int, text string").repartition(5)
    found = ranked(frame, ["g", "h"], ["o"], "place")
    assert found.columns == ["g", "h", "o", "text", "place"]
    assert found.where(F.col("place") != F.col("o") + 1).count() == 0 and found.count() == len(data)
    plan = physical(found)
    join, window = plan.index("SortMergeJoin"), plan.index("Window [row_number")
    assert "Exchange" not in plan[join:window], plan


def test_showings_carry_no_copy_of_their_order(spark, monkeypatch):
    given = []
    real = omissions.ranked
    monkeypatch.setattr(omissions, "ranked", lambda rows, *more: given.append(rows.columns) or real(rows, *more))
    data = [("s", 1, None, "r2", 1), ("s", 1, None, "r1", 2), (None, 1, None, "r3", 1), ("s", None, None, "r4", 1)]
    frame = spark.createDataFrame(data, "student_id string, content_item_id long, timestamp_created timestamp, response_id string, raw_response long")
    found = {r.response_id: r.rank for r in omissions.ranked_showings(frame, "rank").collect()}
    assert found == {"r1": 1, "r2": 2, "r3": 1, "r4": 1}
    assert given == [frame.columns]
    # without response ids there is one column more, a hash
    assert omissions.ranked_showings(frame.drop("response_id"), "rank").count() == 4 and len(given[1]) == 5


def test_only_showings_that_no_task_holds_are_written_down(spark, monkeypatch):
    data = [("s", 1, t, f"r{i}") for i, t in enumerate([3, 1, 1, None, 2, 0] * 5)] + [(s, c, 1, f"x{s}{c}") for s in ("s", "t", None) for c in (None, 2)]
    frame = spark.createDataFrame(data, "student_id string, content_item_id long, at int, response_id string")
    frame = frame.withColumn("timestamp_created", F.timestamp_seconds("at"))
    expected = {r.response_id: r.repeat_omitted for r in omissions.flag_repeats(frame).collect()}
    assert sum(v is True for v in expected.values()) == 24 and sum(v is None for v in expected.values()) == 5
    given = []
    real = omissions.ranked
    monkeypatch.setattr(omissions, "ranked", lambda rows, *more: given.append(rows.count()) or real(rows, *more))
    for held, written in ((30, []), (29, [30])):
        monkeypatch.setattr(omissions, "HELD_SHOWINGS", held)
        found = omissions.flag_repeats(frame, spread=True)
        assert found.columns == [*frame.columns, "repeat_omitted"]
        assert {r.response_id: r.repeat_omitted for r in found.collect()} == expected and given == written
        living = omissions.spread_showings(frame, "rank", F.col("at") < 3)
        assert living.where("at < 3 and rank = 1 and student_id = 's' and content_item_id = 1").count() == 1
        given.clear()


def test_the_key_of_items_is_read_from_rows_that_were_not_dealt(spark, monkeypatch):
    from itemflow.catalog import outputs

    seen = []
    real = outputs.given_keys
    monkeypatch.setattr(outputs, "given_keys", lambda frame: seen.append(physical(frame)) or real(frame))
    monkeypatch.setattr(outputs, "response_parts", lambda spark, sf_dir: 13)
    found = outputs.item_info(spark, "/root/testdata/sf0.001")
    assert "REPARTITION_BY_NUM" in physical(found)
    assert len(seen) == 1 and "REPARTITION_BY_NUM" not in seen[0] and "Window" not in seen[0]


def test_rows_of_shared_activities_are_dealt_once_for_the_rules(spark, only_shuffles, monkeypatch):
    from itemflow.catalog import runs
    from itemflow.catalog.tables import responses, test_map as make_test_map
    from itemflow.plans import layout
    from itemflow.plans.clean import CleanInputs, clean

    written = []
    monkeypatch.setattr(layout, "stored", lambda frame: written.append(physical(frame)) or frame)
    twin = F.when(F.col("item_section_position") == 5, "twin").otherwise(F.col("student_id"))
    frame = responses(spark, "/root/testdata/sf0.001", student_id=twin)
    clean(frame, runs.GOLDEN, CleanInputs(test_map=make_test_map(spark, "/root/testdata/sf0.001")))
    (plan,) = written
    # the rows, their verdicts and the later sittings
    assert plan.count("Exchange hashpartitioning(coalesce(activity_id_hist") == 1, plan
    assert plan.count("Exchange hashpartitioning(coalesce(__activity_id_hist") == 2, plan


def test_questions_without_a_template_are_counted_in_every_layout(spark):
    from itemflow.catalog.tables import bank_map, responses
    from itemflow.plans.clean import CleanConfig, CleanInputs, clean

    sf_dir = "/root/testdata/sf0.001"
    name = F.when(F.col("item_section_position") > 2, F.lit("")).when(F.col("item_section_position") > 1, F.col("template_name"))
    frame = responses(spark, sf_dir, template_name=name).where("activity_id % 3 = 0")
    found = {}
    for layout in ("student", "aggregate"):
        rows = clean(frame, CleanConfig(question_bank=True, layout=layout), CleanInputs(test_map=bank_map(spark, sf_dir))).cleaned
        found[layout] = sorted(map(tuple, rows.select("response_id", "actual_num_ques", "repeat_omitted").collect()))
    assert found["student"] == found["aggregate"] and len(found["student"]) > 100


def test_items_are_dealt_once_for_their_content_and_their_key(spark, only_shuffles):
    from itemflow.operators import metadata

    shown = [(1, "a", 1), (1, "b", 1), (None, None, 1), (None, "a", 2), (2, "a", 1), (3, "c", 1), (3, "c", 1)]
    cleaned = spark.createDataFrame([(i, n, "t", 1, p, True, 1) for i, n, p in shown], "content_item_id long, content_item_name string, template_name string, template_id int, item_section_position int, attempted boolean, scored_response int")
    cleaned = cleaned.withColumn("timestamp_created", F.lit("2020-01-01").cast("timestamp"))
    content = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (None, None, "n"), (2, "b", "z")], "content_item_id long, content_item_name string, brand string")
    key = spark.createDataFrame([(1, 7), (1, 8), (None, 9), (3, 5)], "content_item_id long, correct_answer int")
    found = metadata.item_info(cleaned, key, content)
    apart = metadata.equi_join(metadata.natural_join(metadata.item_info(cleaned), content, "left"), key, ["content_item_id"], "left")
    plan = physical(found)
    # the rows to be counted, the items once, content and key
    assert plan.count("Exchange hashpartitioning") == 4 and plan.count("SortMergeJoin") == 2, plan
    assert found.columns == apart.columns and sorted(map(str, found.collect())) == sorted(map(str, apart.collect()))
    assert found.count() == 4 + 2 + 1 + 1 + 1 + 1


def test_rows_dealt_by_activity_are_not_dealt_again_for_a_list(spark, only_shuffles):
    rows = spark.createDataFrame([(a, i) for a in (1, 2, None) for i in range(3)], "activity_id_hist long, n int")
    for listed in ([1], [1, None], [None, None], [], [3, 3]):
        members = spark.createDataFrame([(a,) for a in listed], "activity_id_hist long")
        flagged = flag_members(rows.repartition("activity_id_hist"), members, ["activity_id_hist"], "listed")
        found = flagged.collect()
        assert len(found) == 9 and all(r.listed == (r.activity_id_hist in listed) for r in found), listed
    members = spark.range(5).select(F.col("id").alias("activity_id_hist"))
    plan = physical(flag_members(rows.repartition("activity_id_hist"), members, ["activity_id_hist"], "listed"))
    # the rows' own dealing, that of the list, and the one of a single row that counts its nulls
    assert plan.count("Exchange hashpartitioning") == 2, plan


def test_lists_of_items_are_met_in_one_dealing_of_the_rows(spark, only_shuffles):
    data = [(i, a, n) for n, (i, a) in enumerate([(i, a) for i in (1, 2, 3, None) for a in (1, 2, None)])]
    rows = spark.createDataFrame(data, "content_item_id long, correct_answer int, n int")
    rows = rows.withColumn("timestamp_created", F.lit("2020-01-01").cast("timestamp")).repartition(3)
    cutoffs = spark.createDataFrame([(1, "2021-01-01"), (2, "2019-01-01"), (None, "2021-01-01")], "content_item_id long, cutoff_date string")
    cutoffs = cutoffs.withColumn("cutoff_date", F.col("cutoff_date").cast("timestamp"))
    listed = spark.createDataFrame([(2,), (2,), (None,)], "content_item_id long")
    keys = spark.createDataFrame([(1, 2), (1, 2), (1, 1), (3, 1), (None, 1), (3, None)], "content_item_id long, correct_answer int")
    flagged = omissions.flag_version_cutoffs(rows, cutoffs, "late")
    flagged = omissions.flag_old_keys(omissions.flag_version_list(flagged, listed, "listed"), keys, "old_key")
    plan = physical(flagged)
    # the rows once, cutoffs and list once each, the keys once to be distinct and once by item
    assert plan.count("Exchange hashpartitioning") == 5 and plan.count("SortMergeJoin") == 3, plan
    found = flagged.collect()
    assert sorted(r.n for r in found) == list(range(len(data)))
    for r in found:
        pair = (r.content_item_id, r.correct_answer)
        assert (r.late, r.listed, r.old_key) == (r.content_item_id == 1, r.content_item_id == 2, pair in {(1, 2), (1, 1), (3, 1)})


def test_lines_meet_their_parts_before_their_orders(spark, only_shuffles):
    from itemflow.catalog.tables import responses

    plan = physical(responses(spark, "/root/testdata/sf0.001"))
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert "o_orderkey" in joins[0] and "p_partkey" in joins[1], joins


def test_a_bank_stores_the_columns_that_are_wanted(spark, monkeypatch):
    from itemflow.catalog import QUERIES, runs
    from itemflow.plans import clean as run

    stored = []
    monkeypatch.setattr(run, "stored", lambda frame: stored.append(frame.columns) or frame)
    found = QUERIES["clean_qbank_sections"](spark, "/root/testdata/sf0.001")
    wanted = {*runs.RUN_COLUMNS, *runs.SECTION_COLUMNS, "actual_activity_order"}
    assert set(found.columns) == wanted
    # the rates of students come later, and the pool needs items
    kept = wanted - {"overall_pTotal", "overall_pPlus"} | {"content_item_name", run.BELOW}
    assert set(stored[0]) == kept and len(stored) == 1
