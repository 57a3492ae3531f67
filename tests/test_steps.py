"""A study from export files to finished tables."""

import pytest
from pyspark.sql import functions as F

from itemflow import schema
from itemflow.catalog.tables import responses, test_map as make_test_map
from itemflow.operators import audit, exclusions, rows
from itemflow.plans import steps
from itemflow.plans.clean import CleanConfig, CleanInputs
from itemflow.sources import readers

SF_DIR = "/root/testdata/sf0.001"
OWN = ("activity_title", "activity_status", "timestamp_created", "timestamp_completed")
EXPORTED = [f for f in schema.RESPONSES.fields if f.name not in ("activity_status",)]


@pytest.fixture(scope="module")
def exports(spark, tmp_path_factory):
    """Responses and activities as TSV, the way a source system exports them."""
    folder = tmp_path_factory.mktemp("exports")
    frame = responses(spark, SF_DIR).withColumns(
        {
            "source_system": F.lit("A"),
            "enrollment_id": F.coalesce("enrollment_id", F.lit(0)),
            "rawest_response": F.lit(None).cast("string"),
            # the profile knows finished activities by this code
            "activity_status": F.when(F.col("activity_status") == "reset", "reset").otherwise("4"),
            "scored_response": F.when(F.col("raw_response").isNull(), 0).otherwise(F.col("scored_response")),
            "correct_answer": F.col("correct_answer").cast("bigint"),
        }
    )
    activities = frame.select(
        "student_id", "activity_id", "source_system", F.col("template_name").alias("activity_title"),
        F.col("activity_status").alias("status"), "template_id", "timestamp_created", "timestamp_completed",
    ).distinct()
    shown = frame.select(*[f.name for f in EXPORTED])

    def write(df, name):
        path = str(folder / name)
        df.write.option("header", True).option("sep", "\t").option("nullValue", "NA").csv(path)
        return path

    return frame, write(shown, "responses"), write(activities.withColumnRenamed("status", "activity_status"), "activities")


def test_prepare_counts_what_it_removes(spark, exports):
    frame, _, _ = exports
    activities = frame.select(
        "student_id", "activity_id", "source_system", F.col("activity_status").alias("status")
    ).distinct()
    again = spark.createDataFrame([(i,) for i in range(7, 150, 7)] + [(None,)], "enrollment_id long")
    out = steps.prepare(frame.drop("activity_status"), activities, None, again)
    first = exclusions.without_repeat_enrollments(frame, again)
    second = rows.drop_zero_enrollment(first)
    third = exclusions.without_deleted_templates(second)
    # all responses have an activity here
    expected = [tuple(audit.counters(f).first()) for f in (frame, frame, first, second, third)]
    found = out.audit.orderBy("step_no").select(
        "responses_left", "activities_left", "users_left", "items_left"
    )
    assert [tuple(r) for r in found.collect()] == expected
    assert expected[1] != expected[2] != expected[3] != expected[4]
    assert out.responses.count() == expected[-1][0]


def test_prepare_accounts_for_rows_that_joins_lose(spark, exports):
    """Whatever the joins do not find is a step: losses and what is left add up to the export."""
    frame, _, _ = exports
    activities = frame.where("activity_status <> 'reset'").select(
        "student_id", "activity_id", "source_system", F.col("activity_status").alias("status")
    ).distinct()
    content = frame.where("template_id = 1 and section_name = 'Math'").select("content_item_id", "content_item_name").distinct()
    out = steps.prepare(frame.drop("activity_status"), activities, content)
    found = {r.step: r for r in out.audit.orderBy("step_no").collect()}
    assert list(found) == ["start", "not_in_activities", "repeat_enrollment", "zero_enrollment", "deleted_template", "not_in_content"]
    unknown = frame.join(activities, ["student_id", "activity_id"], "left_anti").count()
    assert found["not_in_activities"].responses_removed == unknown > 0
    assert found["not_in_content"].responses_removed > 0
    assert sum(r.responses_removed for r in found.values()) + out.responses.count() == frame.count() == found["start"].responses_left


def test_study(spark, exports, tmp_path):
    _, responses_path, activities_path = exports
    folder = str(tmp_path)
    config = CleanConfig(total_minutes=1440, ms_min=5000, remove_no_response_scored=False)
    result = steps.cleaning_step(
        spark, responses_path, activities_path, folder, config, CleanInputs(make_test_map(spark, SF_DIR)),
    )
    # once they are prepared, nothing reads the exports
    for frame in (result.cleaned, result.marked_omits, result.audit):
        assert not any(path in f for f in frame.inputFiles() for path in (responses_path, activities_path))
    n = result.cleaned.count()
    assert n == spark.read.parquet(f"{folder}/cleaned").count() > 0
    assert spark.read.parquet(f"{folder}/test_map").select("num_ques").distinct().count() == 1
    last = spark.read.json(f"{folder}/audit_clean").orderBy(F.desc("step_no")).first()
    assert last.responses_left == n

    names = steps.matrix_step(spark, f"{folder}/cleaned", folder, with_omit_incorrect=True, block_items=100)
    items = result.cleaned.select("content_item_name").distinct().count()
    students = result.cleaned.select("student_id").distinct().count()
    lines = readers.read_block_lines(spark, f"{folder}/Item_Scores")
    per_block = {r.block: (r.n, r.cells) for r in lines.groupBy("block").agg(F.count("*").alias("n"), F.max(F.size(F.split("value", ","))).alias("cells")).collect()}
    assert {b: n for b, (n, _) in per_block.items()} == {b: students for b in range(-(-items // 100))}
    assert sum(cells - 1 for _, cells in per_block.values()) == items
    assert len(names) == 4
    assert spark.read.json(f"{folder}/summary").count() == 3

    steps.metadata_step(spark, f"{folder}/cleaned", f"{folder}/test_map", folder)
    users = spark.read.option("header", True).csv(f"{folder}/user_info")
    assert users.count() == students
    assert users.agg(F.sum("test_seen")).first()[0] == n

    lookup = result.cleaned.select("student_id", F.col("student_id").alias("user_id")).distinct().where("student_id % 2 = 0")
    kinds = ["Item_Scores", "Responses"]
    assert steps.combine_step(spark, {"PE1_": folder, "PE2_": folder}, {"FL1_": folder}, lookup, f"{folder}/combined", kinds=kinds) == kinds
    both = readers.read_block_lines(spark, f"{folder}/combined/Item_Scores")
    assert both.select("exam", "block").distinct().count() == 3 * -(-items // 100)
    assert both.groupBy("exam", "block").count().select("count").distinct().collect()[0][0] == lookup.count()


def test_a_matrix_of_5000_items(spark, tmp_path):
    """More items than a frame has columns; blocks of columns, each with its header."""
    rows = spark.range(5000).select(
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("student_id"), F.format_string("i%05d", "id").alias("content_item_name"),
        F.col("id").alias("content_item_id"), F.lit("T").alias("template_name"), F.col("id").cast("int").alias("item_section_position"),
        F.lit(1).cast("bigint").alias("raw_response"), F.lit(1).alias("scored_response"), F.lit(5).cast("bigint").alias("milliseconds_used"),
        F.lit(True).alias("attempted"), F.lit(False).alias("repeat_omitted"),
    )
    rows.write.parquet(str(tmp_path / "cleaned"))
    steps.matrix_step(spark, str(tmp_path / "cleaned"), str(tmp_path / "out"), block_items=700)
    text = {}
    for block in range(8):
        files = sorted((tmp_path / "out" / "Item_Scores" / f"block={block}").glob("part-*"))
        text[block] = "".join(f.read_text() for f in files).splitlines()
    heads = [name for block in range(8) for name in text[block][0].split(",")[1:]]
    assert heads == [f"i{k:05d}" for k in range(5000)]
    for s in range(3):
        cells = [c for block in range(8) for c in text[block][1 + s].split(",")[1:]]
        assert cells == ["1" if k % 3 == s else "-99" for k in range(5000)]


def test_letters_from_file_to_scores(spark, tmp_path):
    head = [f.name for f in schema.RESPONSES if f.name not in ("activity_status", "rawest_response", "correct_answer")]
    lines = ["\t".join(head)]
    for i, (letter, score) in enumerate([("A", 1), ("B", 0), ("NA", 0), ("D", 1), ("E", 0)]):
        values = dict.fromkeys(head, "1") | {
            "response_id": f"r{i}", "student_id": "007", "content_item_id": str(10 + i), "content_item_name": f"i{i}", "template_name": "T1",
            "raw_response": letter, "scored_response": str(score), "tutor_mode": "False", "milliseconds_used": "9000",
            "timestamp_created": "2021-01-01 10:00:00", "timestamp_completed": "2021-01-01 11:00:00",
        }
        lines.append("\t".join(values[c] for c in head))
    (tmp_path / "responses.tsv").write_text("\n".join(lines) + "\n")
    (tmp_path / "activities.tsv").write_text(
        "student_id\tactivity_id\tsource_system\tactivity_title\tstatus\ttemplate_id\ttimestamp_created\ttimestamp_completed\n"
        "007\t1\t1\tT1\t4\t1\t2021-01-01 10:00:00\t2021-01-01 11:00:00\n"
    )
    maps = CleanInputs(spark.createDataFrame([("T1", 5, 0.25, 1440.0)], "template_name string, num_ques int, response_threshold double, minutes_allowed double"))
    paths = [str(tmp_path / "responses.tsv"), str(tmp_path / "activities.tsv")]
    coded = steps.cleaning_step(spark, *paths, str(tmp_path / "coded"), CleanConfig(recode_answers=True), maps).cleaned
    found = {r.response_id: (r.rawest_response, r.raw_response, r.attempted) for r in coded.collect()}
    assert found == {"r0": ("A", 1, True), "r1": ("B", 2, True), "r2": (None, None, False), "r3": ("D", 4, True), "r4": ("E", None, False)}
    text = steps.cleaning_step(spark, *paths, str(tmp_path / "text"), CleanConfig(), maps, text_responses=True).cleaned
    assert {r.response_id: (r.raw_response, r.attempted) for r in text.collect()}["r4"] == ("E", True)
    with pytest.raises(Exception, match="raw_response holds no bigint: "):
        steps.cleaning_step(spark, *paths, str(tmp_path / "numbers"), CleanConfig(), maps)
    with (tmp_path / "responses.tsv").open("a") as file:
        file.write("\t".join((values | {"response_id": "r5", "milliseconds_used": "slow"})[c] for c in head) + "\n")
    some = steps.cleaning_step(spark, *paths, str(tmp_path / "some"), CleanConfig(), maps, text_responses=True, bad_cells=1).cleaned
    assert sorted(r.response_id for r in some.collect()) == ["r0", "r1", "r2", "r3", "r4"]
    assert [(r["column"], r.text) for r in spark.read.parquet(str(tmp_path / "some" / "bad_cells")).collect()] == [("milliseconds_used", "slow")]
    with pytest.raises(ValueError, match="more than 0 cells"):
        steps.cleaning_step(spark, *paths, str(tmp_path / "none"), CleanConfig(), maps, text_responses=True, bad_cells=0)
