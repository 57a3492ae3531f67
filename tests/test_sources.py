"""Readers, writers and round trips."""

from datetime import datetime

import pytest
from pyspark.sql import types as T

from itemflow import schema
from itemflow.operators.joins import natural_join
from itemflow.sources import readers, writers


def test_tsv_exports(spark, tmp_path):
    path = tmp_path / "activities.tsv"
    path.write_text(
        "student_id\tactivity_id\tsource_system\tactivity_title\tactivity_status\ttemplate_id\t"
        "timestamp_created\ttimestamp_completed\n"
        "007\t1\tA\tNA\t4\t\t2021-01-01 10:00:00\tNA\n"
    )
    row = readers.read_activities(spark, str(path)).first()
    assert (row.student_id, row.activity_title, row.template_id) == ("007", None, None)
    assert (row.timestamp_created, row.timestamp_completed) == (datetime(2021, 1, 1, 10), None)


def test_csv_round_trip_keeps_ids_as_text(spark, tmp_path):
    df = spark.createDataFrame([("007", 1, None)], "student_id string, num_ques int, x double")
    writers.write_frame(df, str(tmp_path / "out"), "csv")
    back = readers.read_csv(spark, str(tmp_path / "out"), df.schema)
    assert [tuple(r) for r in back.collect()] == [("007", 1, None)]


def test_exports_as_they_come(spark, tmp_path):
    """Raw header names, another order, and columns that nobody asked for."""
    (tmp_path / "activities.tsv").write_text(
        "Extra\tstatus\ttemplate_id\ttimestamp_completed\ttimestamp_created\tactivity_title\tactivity_id\tstudent_id\n"
        "x\t4\t3\tNA\t2021-01-01 10:00:00\tT\t9\t007\n"
    )
    row = readers.read_activities(spark, str(tmp_path / "activities.tsv")).first()
    assert (row.student_id, row.activity_id, row.activity_status, row.template_id) == ("007", 9, "4", 3)
    columns = [f.name for f in schema.RESPONSES if f.name not in readers.OPTIONAL]
    values = dict.fromkeys(columns, "1") | {"raw_response": "A", "timestamp_created": "2021-01-01 10:00:00", "timestamp_completed": "NA"}
    heads = {"section_name": "section_title", "student_id": "Student_id"}
    (tmp_path / "responses.tsv").write_text(
        "\t".join([*[heads.get(c, c) for c in reversed(columns)], "other"]) + "\n" + "\t".join([*[values[c] for c in reversed(columns)], "?"]) + "\n"
    )
    row = readers.read_responses(spark, str(tmp_path / "responses.tsv")).first()
    assert (row.raw_response, row.section_name, row.student_id, row.scored_response) == ("A", "1", "1", 1)
    (tmp_path / "content.tsv").write_text("interactionTypeId\tproduct_name\tquestion_number\n1\t2\t3\n")
    row = readers.read_content_items(spark, str(tmp_path / "content.tsv")).first()
    assert (row.content_item_id, row.template_id, row.interaction_type_id) == (3, 2, 1)
    (tmp_path / "map.csv").write_text("minutes_allowed,numQues,template_name,response_threshold\n60,8,T1,0.5\n")
    assert tuple(readers.read_test_map(spark, str(tmp_path / "map.csv")).first()) == ("T1", 8, 0.5, 60.0)
    (tmp_path / "sections.csv").write_text("section_num_ques,sectionName\n4,Math\n")
    assert tuple(readers.read_section_map(spark, str(tmp_path / "sections.csv")).first()) == ("Math", 4)


def test_what_is_no_value_stops_the_run(spark, tmp_path):
    (tmp_path / "content.tsv").write_text("content_item_id\ttemplate_id\tinteraction_type_id\nfive\t2\t1\n")
    with pytest.raises(Exception, match="content_item_id holds no bigint: five"):
        readers.read_content_items(spark, str(tmp_path / "content.tsv")).collect()
    with pytest.raises(ValueError, match="no column student_id, activity_id"):
        readers.read_activities(spark, str(tmp_path / "content.tsv"))


def test_bad_cells_are_sorted_out(spark, tmp_path):
    for name, lines in {
        "a.tsv": ["student_id\tn\twhen", "s1\t1\t2021-01-01", "s2\tone\tnever", "s3\tNA\t2021-01-02"],
        "b.tsv": ["student_id\tn\twhen", "s4\t2.5\t2021-01-03", "s5\t5\tNA"],
        "c.tsv": ["student_id\tn\twhen"],
    }.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    columns = T.StructType([T.StructField("student_id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("when", T.DateType())])
    rows, bad = readers.read_sorted_out(spark, str(tmp_path), columns)
    assert sorted((r.student_id, r.n) for r in rows.collect()) == [("s1", 1), ("s3", None), ("s5", 5)]
    found = sorted((r.file.rsplit("/")[-1], r.column, r.text, "s2" in r.row) for r in bad.collect())
    assert found == [("a.tsv", "n", "one", True), ("a.tsv", "when", "never", True), ("b.tsv", "n", "2.5", False)]
    assert readers.stop_beyond(bad, 2) == {"n": 2, "when": 1}
    with pytest.raises(ValueError, match="more than 1 cells are no values of their types: n: 2"):
        readers.stop_beyond(bad, 1)


def test_block_files(spark, tmp_path):
    headers = spark.createDataFrame([(0, "i1,i2"), (1, "i3")], "block long, line string")
    lines = spark.createDataFrame([("b", 0, "1,."), ("a", 0, "-99,0"), ("a", 1, "5"), ("b", 1, "6")], "student_id string, block long, line string")
    path = str(tmp_path / "T1_Item_Scores")
    writers.write_block_lines(lines, headers, path)
    for block, text in {0: "student_id,i1,i2\na,-99,0\nb,1,.\n", 1: "student_id,i3\na,5\nb,6\n"}.items():
        files = sorted((tmp_path / "T1_Item_Scores" / f"block={block}").glob("part-*"))
        assert "".join(f.read_text() for f in files) == text
    assert sorted(r.value for r in readers.read_block_lines(spark, path).where("block = 1").collect()) == ["a,5", "b,6"]
    writers.write_frame(lines, str(tmp_path / "stage"))
    assert readers.read_stage(spark, str(tmp_path / "stage")).count() == 4


def test_empty_frames_are_not_written(spark, tmp_path):
    full = spark.createDataFrame([("a", "S1")], "student_id string, section_name string")
    assert writers.write_frames({"full": full, "empty": full.limit(0)}, str(tmp_path)) == ["full"]
    writers.write_sections(full, str(tmp_path / "sections"))
    assert [p.name for p in (tmp_path / "sections").glob("section_name=*")] == ["section_name=S1"]


def test_audit_file(spark, tmp_path):
    audit = spark.createDataFrame([(1, "tutor"), (0, "start")], "step_no int, step string")
    writers.write_audit(audit, str(tmp_path / "audit"))
    assert [r.step for r in spark.read.json(str(tmp_path / "audit")).collect()] == ["start", "tutor"]


def test_repeat_enrollment_query():
    text = readers.repeat_enrollment_query("sales.purchases", "sales.products")
    assert "sales.purchases p join sales.products d" in text
    assert "('404', '405', '406')" in text and "'2019-01-01'" in text


def test_schemas_share_the_join_keys(spark):
    left = spark.createDataFrame([], schema.RESPONSES)
    right = spark.createDataFrame([], schema.CONTENT_ITEMS)
    shared = natural_join(left, right).columns
    assert shared.count("content_item_id") == 1
