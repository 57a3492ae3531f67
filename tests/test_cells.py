"""Matrices read back from files, quantiles of values close together, keys in one plan."""

import pytest
from pyspark.sql import functions as F

from itemflow.catalog.tables import responses
from itemflow.functions import quantiles
from itemflow.operators import answer_key, cells, matrix, omissions, rows
from itemflow.operators.omissions import zero_repeats
from itemflow.plans import steps
from itemflow.sources import readers, writers

SF_DIR = "/root/testdata/sf0.001"


def test_fields_of_a_line(spark):
    lines = ['a,b,c', ',x,', '"a,b","say ""no""",', '', '""', 'x,"",y', '"' + "long " * 5000 + '",z']
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    found = [r.f for r in frame.select("i", cells.fields(F.col("value")).alias("f")).orderBy("i").collect()]
    assert found[:6] == [["a", "b", "c"], ["", "x", ""], ["a,b", 'say "no"', ""], [""], [""], ["x", "", "y"]]
    assert found[6] == ["long " * 5000, "z"]


def test_lines_without_skipped_cells(spark):
    """The same cells as by reading every field, whatever runs of the skipped text a line holds."""
    lines = ["s1,-99,-99,-99,-99", "-99,-99,1,-99,-99", ",1,-99,.,-99", 's3,-99,"-99",-990,"-99,-99"', 's4,"a,b",-99,-99,NA', '"5,-99",1,1,1,1', "s6,,-99,-99,1-99"]
    text = spark.createDataFrame([(x, b) for x in lines for b in (1, 2)], "value string, block int")
    heads = spark.createDataFrame([('student_id,i1,"i,2",i3,i4', 1), ("student_id,i5,i6,i7,i8", 2)], "value string, block int")
    every = cells.cells_of_lines(text, heads, ["block"]).where("text <> '-99'")
    shown = cells.cells_of_lines(text, heads, ["block"], skip="-99")
    assert shown.columns == every.columns and sorted(map(str, shown.collect())) == sorted(map(str, every.collect()))
    one = cells.cells_of_lines(text.where("block = 1").drop("block"), heads.where("block = 1").drop("block"), skip="-99")
    assert one.count() == shown.where("block = 1").count() > 0
    long = spark.createDataFrame([("s," + "-99," * 5000 + "7,-99", 1)], "value string, block int")
    wide = spark.createDataFrame([("id," + ",".join(f"i{i}" for i in range(5002)), 1)], "value string, block int")
    assert [tuple(r) for r in cells.cells_of_lines(long, wide, ["block"], skip="-99").collect()] == [(1, "s", "i5000", "7")]
    for bad in ("s1,-99,-99,-99", "s1,-99,-99,-99,-99,-99", "s1", "s1,1,-99"):
        with pytest.raises(Exception, match="fields in a line"):
            cells.cells_of_lines(spark.createDataFrame([(bad, 1)], "value string, block int"), heads, ["block"], skip="-99").collect()


def test_lines_are_not_dealt_for_their_headers(spark):
    """However long headers are, lines stay where they are, and those without any other cell are not parsed."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = spark.createDataFrame([("s1,-99,-99", 1), ("s2,-99,3", 1), ("s3,1", 2), ("s4", 3), ("s5,1", 4)], "value string, block int")
        # a header that comes twice, two for one block, one of an id alone, and a block without one
        heads = spark.createDataFrame([("id,a,b", 1), ("id,a,b", 1), ("id,c", 2), ("id,d", 2), ("id", 3)], "value string, block int")
        found = cells.cells_of_lines(text, heads, ["block"], skip="-99")
        assert sorted(map(tuple, found.collect())) == [(1, "s2", "b", "3"), (2, "s3", "c", "1"), (2, "s3", "d", "1")]
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        lines = plan[plan.index("regexp_extract_all") :]
        assert "endswith" in lines.lower() and lines.index("strategy=broadcast") < lines.index("Aggregate"), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_responses_are_read_once_for_a_matrix_and_its_items(spark, monkeypatch):
    from itemflow.catalog import outputs

    made = []
    real = outputs.stored
    monkeypatch.setattr(outputs, "stored", lambda frame: made.append(frame.columns) or real(frame))
    for name in ("matrix_cells", "matrix_block_lines"):
        plan = outputs.__dict__[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" not in plan and made.pop()[:2] == matrix.CELL and not made, plan


def test_the_cells_of_a_matrix_are_not_all_made(spark, monkeypatch):
    """Cells that were not seen take no row and no place in an array of fields."""
    from itemflow.catalog import QUERIES

    plan = QUERIES["matrix_cells"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "(,-99" in plan.replace("\\", "") or "(?:,\\-99" in plan, plan


def cleaned_rows(spark):
    frame, _ = omissions.repeat_questions(omissions.add_attempted(rows.drop_staged(responses(spark, SF_DIR))))
    # names and ids that have to be quoted
    name = F.when(F.col("content_item_id") % 9 == 0, F.concat(F.lit('odd, "'), F.col("content_item_name"), F.lit('"'))).otherwise(F.col("content_item_name"))
    return frame.withColumns({"content_item_name": name, "student_id": F.when(F.col("student_id") == "7", "7, the").otherwise(F.col("student_id"))})


def states(long, variable):
    shown = matrix.with_cell_state(long, variable)
    value = F.when(F.col("cell_state") == "value", F.col("value").cast("bigint"))
    return {(r.student_id, r.content_item_name, r.cell_state, r.v) for r in shown.withColumn("v", value).where("cell_state <> 'value' or v is not null").collect()}


def test_matrices_in_blocks_are_read_back(spark, tmp_path):
    cleaned_rows(spark).write.parquet(str(tmp_path / "cleaned"))
    steps.matrix_step(spark, str(tmp_path / "cleaned"), str(tmp_path / "out"), block_items=30)
    paths = {kind: str(tmp_path / "out" / kind) for kind in matrix.MATRIX_SET}
    steps.import_step(spark, paths, str(tmp_path / "again"), block_items=30)
    first, again = (readers.read_stage(spark, str(tmp_path / f / "long")) for f in ("out", "again"))
    for variable in matrix.MATRIX_SET.values():
        assert states(first, variable) == states(again, variable)
    items = [readers.read_stage(spark, str(tmp_path / f / "items")).select("content_item_name", "display_position", "block", "place", "width") for f in ("out", "again")]
    assert sorted(items[0].collect()) == sorted(items[1].collect())
    # what is combined from files equals what is combined from the long matrices
    lookup = cleaned_rows(spark).select("student_id", F.col("student_id").alias("user_id")).distinct().where("student_id not like '%1'")
    text = []
    for folder in ("out", "again"):
        steps.combine_step(spark, {"A_": str(tmp_path / folder)}, {"B_": str(tmp_path / folder)}, lookup, str(tmp_path / f"both_{folder}"), kinds=["Item_Scores"])
        text.append(sorted(r.value for r in spark.read.text(str(tmp_path / f"both_{folder}" / "Item_Scores")).collect()))
    assert text[0] == text[1] and len(text[0]) > 10


def test_a_wide_file_is_read_back(spark, tmp_path):
    long = matrix.matrix_long(zero_repeats(cleaned_rows(spark), ["milliseconds_used"]), list(matrix.MATRIX_SET.values()))
    names = sorted(r[0] for r in long.select("content_item_name").distinct().collect())[:40]
    few = long.where(F.col("content_item_name").isin(names))
    wide = matrix.matrix_wide(few, "raw_response", names, ".", "-99")
    writers.write_frame(wide.coalesce(1), str(tmp_path / "wide"), "csv")
    # Spark escapes quotes with a backslash; other writers double them
    (text,) = (tmp_path / "wide").glob("*.csv")
    (tmp_path / "wide.csv").write_text(text.read_text().replace('\\"', '""'))
    found = cells.long_of_cells(cells.cells_of_lines(*readers.read_matrix_lines(spark, str(tmp_path / "wide.csv"))), "raw_response", ".", "-99")
    assert states(found, "raw_response") == states(few, "raw_response") == states(cells.long_of_cells(cells.cells_of_wide(wide), "raw_response", ".", "-99"), "raw_response")
    (tmp_path / "short.csv").write_text("student_id,a,b\n1,2\n")
    with pytest.raises(Exception, match="fields in a line: 2, in its header: 3"):
        cells.cells_of_lines(*readers.read_matrix_lines(spark, str(tmp_path / "short.csv"))).collect()
    (tmp_path / "text.csv").write_text("student_id,a\n1,five\n")
    with pytest.raises(Exception, match="holds no bigint: five"):
        cells.long_of_cells(cells.cells_of_lines(*readers.read_matrix_lines(spark, str(tmp_path / "text.csv"))), "raw_response").collect()


def test_quartiles_of_a_million_values_close_together(spark, monkeypatch):
    """All values share one bucket; none of the ranges that are sorted has more than the bound."""
    n = 1_000_000
    values = spark.range(n).select((F.lit(1.0) + F.pow(F.col("id") / n, F.lit(3.0)) / 1000).alias("v"))
    sorted_kinds = []
    real = quantiles._narrowed

    def seen(counts, by, wanted):
        out = real(counts, by, wanted)
        sorted_kinds.extend(r.kinds for r in out.collect())
        return out

    monkeypatch.setattr(quantiles, "_narrowed", seen)
    row = quantiles.summarise_counts(quantiles.value_counts(values, [], "v"), []).first()
    for found, p in ((row.q1, 0.25), (row.median, 0.5), (row.q3, 0.75)):
        assert abs(found - (1 + (p * (n - 1) / n) ** 3 / 1000)) < 1e-12
    assert max(sorted_kinds) <= quantiles.SORTED_KINDS


def test_cut_ranges_equal_sorting(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(quantiles, "SORTED_KINDS", 3)
    monkeypatch.setattr(quantiles, "_PARTS", 4)
    rng = np.random.default_rng(5)
    data = [(g, float(x)) for g in ("a", "b", None) for x in np.concatenate([rng.normal(0, 1e-7, 200) + 5, rng.integers(-3, 4, 60), rng.exponential(2, 77)])]
    out = quantiles.summarise_counts(quantiles.value_counts(spark.createDataFrame(data, "g string, v double"), ["g"], "v"), ["g"])
    for r in out.collect():
        mine = [x for g, x in data if g == r.g]
        assert np.allclose([r.q1, r.median, r.q3], np.quantile(mine, [0.25, 0.5, 0.75]), rtol=0, atol=1e-12)


def test_no_job_runs_while_keys_are_planned(spark):
    group = "keys-plan"
    spark.sparkContext.setJobGroup(group, "")
    frame = answer_key.answer_key_conflicts(responses(spark, SF_DIR))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert frame.count() >= 0


@pytest.mark.parametrize("given", [[1, 1, 2], [1, None, 2], [None, None, None]])
def test_conflicts_by_hand(spark, given):
    data = [("x", given[0], 1, 1), ("x", given[1], 1, 1), ("x", given[2], 2, 1), ("y", 3, 3, 1), ("y", 3, 4, 0), ("z", 5, None, 1), ("z", 5, 5, 1)]
    frame = spark.createDataFrame(data, "content_item_id string, correct_answer long, raw_response long, scored_response int")
    found = {(r.content_item_id, r.raw_response, r.total) for r in answer_key.answer_key_conflicts(frame).collect()}
    complete = any(x is not None for x in given)
    x = {("x", 1, 2), ("x", 2, 1)}
    assert found == (x if complete else x | {("z", None, 1), ("z", 5, 1)})
