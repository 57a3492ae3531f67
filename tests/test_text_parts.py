"""Lines of matrices are made after the last shuffle, in parts that grow with their text."""

import random

from itemflow.functions import parts
from itemflow.operators import matrix


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def long_of(spark, n_students=7, n_items=23):
    draw = random.Random(5)
    rows = [
        (f"s{s}" if s else None, f"i{i:02d}", 1, draw.choice([0, 1]), draw.choice([None, 0, 1]), 10 * i)
        for s in range(n_students) for i in range(n_items) if draw.random() < 0.4
    ]
    # an item that one student alone saw, so that others end with a gap
    rows.append(("s1", "i99", 1, 1, 1, 5))
    return spark.createDataFrame(rows, "student_id string, content_item_name string, seen long, attempted long, scored_response long, ms long")


def expected(long, variable, omit, unseen):
    rows = long.collect()
    items = sorted({r.content_item_name for r in rows})
    cells = {(r.student_id, r.content_item_name): r for r in rows}

    def text(student, item):
        r = cells.get((student, item))
        if r is None:
            return unseen
        if variable == "scored_response" and r.attempted == 0:
            return omit
        return "NA" if r[variable] is None else str(r[variable])

    return items, {s: [text(s, i) for i in items] for s in {r.student_id for r in rows}}


def test_lines_are_the_same_in_any_number_of_parts(spark):
    long = long_of(spark)
    order = matrix.name_order(long)
    for variable, unseen in (("scored_response", "-99"), ("ms", ".")):
        items, lines = expected(long, variable, "o", unseen)
        for n in (None, 3):
            found = matrix.matrix_lines(long, variable, order, "o", "-99", parts=n).collect()
            assert {r.student_id: r.line.split(",") for r in found} == lines and len(found) == len(lines)
            for size in (1, 4, 100):
                blocks = matrix.block_lines(long, variable, matrix.in_blocks(order, size), "o", "-99", parts=n).collect()
                assert {(r.student_id, r.block): r.line.split(",") for r in blocks} == {
                    (s, b): line[b * size : (b + 1) * size] for s, line in lines.items() for b in range(-(-len(items) // size))
                }


def test_blocks_beyond_one_group(spark, monkeypatch):
    monkeypatch.setattr(matrix, "BLOCKS_TOGETHER", 3)
    long = long_of(spark)
    items, lines = expected(long, "ms", "o", ".")
    blocks = matrix.block_lines(long, "ms", matrix.in_blocks(matrix.name_order(long), 2)).collect()
    assert len(blocks) == len(lines) * -(-len(items) // 2)
    assert {(r.student_id, r.block): r.line.split(",") for r in blocks} == {
        (s, b): line[2 * b : 2 * b + 2] for s, line in lines.items() for b in range(-(-len(items) // 2))
    }


def test_no_line_and_no_row_for_each_block_is_shuffled(spark):
    """What is dealt is cells and one row per student and group of blocks."""
    long = long_of(spark)
    lined = matrix.block_lines(long, "ms", matrix.in_blocks(matrix.name_order(long), 1), parts=5)
    rows = lined.count()
    assert rows == 7 * long.select("content_item_name").distinct().count()
    plan = plan_of(lined)
    last = plan.index("REPARTITION_BY_NUM")
    # the blocks are listed above the dealing of the rows, so after it
    assert "Generate inline(members" in plan[:last]


def test_only_lines_with_cells_are_put_together(spark):
    """The lines of blocks without a cell are one text per block, not made again for each student."""
    long = long_of(spark)
    lined = matrix.block_lines(long, "ms", matrix.in_blocks(matrix.name_order(long), 2), parts=5)
    plan = lined._jdf.queryExecution().optimizedPlan().toString()
    # what stands above in a plan works on more rows: one per student and block
    assert plan.index("concat_ws") > plan.index("Generate inline(members"), plan


def test_blocks_of_exams_that_a_student_did_not_take(spark):
    rows = [("A", "s1", "i1", 1), ("A", None, "i3", 2), ("B", "s1", "i9", 3), ("B", "s2", "i8", None)]
    long = spark.createDataFrame([(e, s, i, 1, 1, v) for e, s, i, v in rows], "exam string, student_id string, content_item_name string, seen long, attempted long, ms long")
    names = [("A", "i1", 1), ("A", "i2", 2), ("A", "i3", 3), ("B", "i8", 1), ("B", "i9", 2)]
    blocks = matrix.in_blocks(spark.createDataFrame(names, "exam string, content_item_name string, display_position long"), 2, ["exam"])
    found = matrix.block_lines(long, "ms", blocks, by=["exam"]).collect()
    assert {(r.exam, r.student_id, r.block): r.line for r in found} == {
        ("A", "s1", 0): "1,.", ("A", "s1", 1): ".", ("A", None, 0): ".,.", ("A", None, 1): "2", ("A", "s2", 0): ",", ("A", "s2", 1): "",
        ("B", "s1", 0): ".,3", ("B", "s2", 0): "NA,.", ("B", None, 0): ",",
    } and len(found) == 9


def test_parts_grow_with_the_text():
    assert parts.text_parts(150, 200, 4) is None
    assert parts.text_parts(15_000, 20_000, 4) == 9
    assert parts.text_parts(900_000, 1_200_000, 4) == 32_187
    assert parts.text_parts(900_000_000, 1_200_000, 4) == parts.MOST_PARTS


def test_queries_deal_students_by_the_text_of_their_lines(spark, monkeypatch):
    from itemflow.catalog import QUERIES, outputs

    monkeypatch.setattr(outputs, "text_parts", lambda *sizes: 13)
    for name in ("matrix_lines_scores", "matrix_lines_ms", "matrix_block_lines"):
        assert "REPARTITION_BY_NUM" in plan_of(QUERIES[name](spark, "/root/testdata/sf0.001")), name
