"""Student by item matrices.

The core is long: one row per student and item that was shown. The wide form is
an export, made for a list of items.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemflow.functions.checkpoints import checkpointed
from itemflow.functions.columns import count_where, grouped, strict_sum
from itemflow.functions.parts import dealt
from itemflow.functions.quantiles import summarise_counts
from itemflow.operators.joins import equi_join, natural_join
from itemflow.operators.ranking import ranked
from itemflow.operators.rows import drop_zero_time

CELL = ["student_id", "content_item_name"]
# Items per block of a matrix that is written as lines.
BLOCK_ITEMS = 1_000
# Blocks of which a student's cells are gathered together, before each becomes a line.
BLOCKS_TOGETHER = 256
# Variables whose omitted cells get a code of their own.
CODED_VARIABLES = ("raw_response", "scored_response")
# Fixed value: a cell of any other variable for an item that was not shown.
NOT_SHOWN = "."
# Matrix names, their variables and the codes of the standard set.
MATRIX_SET = {
    "Item_Scores": "scored_response",
    "Responses": "raw_response",
    "Milliseconds_per_Item": "milliseconds_used_fixed",
}
OMIT_CODE, NOT_SEEN_CODE = ".", "-99"
OMIT_INCORRECT_NAME = "Item_Scores_Omit_Incorrect"
OMIT_INCORRECT_CODES = {"omit_code": "0", "not_seen_code": "."}


def matrix_long(frame: DataFrame, variables: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(student, item, seen, attempted, sum of each variable) for every shown item.

    ``by`` adds keys, so that the matrices of several exams come out of one pass.
    """
    return frame.groupBy(*by, *CELL).agg(
        F.count("*").alias("seen"),
        count_where(F.col("attempted"))(grouped).alias("attempted"),
        *[strict_sum(F.col(v))(grouped).alias(v) for v in variables],
    )


def with_cell_state(long: DataFrame, variable: str, by: Sequence[str] = ()) -> DataFrame:
    """(student, item, value, cell_state) of one variable."""
    coded = F.lit(variable in CODED_VARIABLES) & (F.col("attempted") == 0)
    return long.select(
        *by,
        *CELL,
        F.col(variable).alias("value"),
        F.when(coded, "omitted").otherwise("value").alias("cell_state"),
    )


def display_order(frame: DataFrame) -> DataFrame:
    """(item, display_position): items by template and position of their first showing."""
    place = F.struct(
        F.col("template_name").isNull().alias("no_template"),
        "template_name",
        F.col("item_section_position").isNull().alias("no_position"),
        "item_section_position",
    )
    items = frame.groupBy("content_item_name").agg(F.min(place).alias("p"))
    items = items.select("content_item_name", "p.*")
    order = ["no_template", "template_name", "no_position", "item_section_position", "content_item_name"]
    return ranked(items, [], order, "display_position").select("content_item_name", "display_position")


def name_order(frame: DataFrame) -> DataFrame:
    """(item, display_position): items by name."""
    items = frame.select("content_item_name").distinct()
    return ranked(items, [], ["content_item_name"], "display_position")


def item_names(frame: DataFrame, use_display_order: bool = False) -> list[str]:
    """The columns of a wide matrix, by display order or by name: a frame with a column per item.

    For lists of items that a frame can hold as columns; matrices of any number of
    items are ``block_lines``.
    """
    items = (display_order if use_display_order else name_order)(frame).orderBy("display_position")
    return [r.content_item_name for r in items.toLocalIterator()]


def _cell(state: str, value: str, omit_code: str, not_seen_code: str) -> Column:
    return (
        F.when(F.col(state).isNull(), F.lit(not_seen_code))
        .when(F.col(state) == 0, F.lit(omit_code))
        .otherwise(F.col(value).cast("string"))
    )


def pivoted(cells: DataFrame, id_column: str, items: Sequence[str], parts: int | None = None) -> DataFrame:
    """One row per id with a value and a state column per item (``0_v``, ``0_s``, ...).

    Both are numbers, so that one aggregate per row places a cell, however many
    items there are. Cells are dealt by id first: a task that held some cells of every id
    would make a whole wide row for each.
    """
    by_id = dealt(cells, parts, id_column) if parts else cells.repartition(id_column)
    wide = (
        by_id.groupBy(id_column)
        .pivot("content_item_name", list(items))
        .agg(F.first("value").alias("v"), F.first("state").alias("s"))
    )
    return wide.toDF(id_column, *[f"{i}_{part}" for i in range(len(items)) for part in "vs"])


def matrix_wide(
    long: DataFrame,
    variable: str,
    items: Sequence[str],
    omit_code: str = "5",
    not_seen_code: str = "6",
    parts: int | None = None,
) -> DataFrame:
    """One row per student, one text column per item, made in ``parts`` parts if that is given.

    Students who saw none of the items are in it too: the rows of a matrix are
    all students, whatever block of columns is asked for.
    """
    cells = with_cell_state(long, variable).select(
        *CELL, F.col("value"), F.when(F.col("cell_state") == "omitted", 0).otherwise(1).alias("state")
    )
    if variable not in CODED_VARIABLES:
        not_seen_code = NOT_SHOWN
    wide = pivoted(cells, "student_id", items, parts)
    return wide.select(
        "student_id",
        *[
            _cell(f"{i}_s", f"{i}_v", omit_code, not_seen_code).alias(name)
            for i, name in enumerate(items)
        ],
    )


def in_blocks(items: DataFrame, block_items: int, by: Sequence[str] = ()) -> DataFrame:
    """Items (name, display_position from 1) with their block, place in it, and its width."""
    place = F.col("display_position") - 1
    width = F.count("*").over(Window.partitionBy(*by, "block"))
    numbered = items.withColumns({"block": F.floor(place / block_items), "place": (place % block_items).cast("int")})
    return numbered.withColumn("width", width.cast("int"))


def block_headers(blocks: DataFrame, by: Sequence[str] = (), separator: str = ",") -> DataFrame:
    """(block, line): the names of the items of each block, quoted where they hold a separator."""
    name = F.col("content_item_name")
    quoted = F.when(name.rlike('[,"\n]'), F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(name)
    names = F.array_sort(F.collect_list(F.struct("place", quoted.alias("name"))))["name"]
    return blocks.groupBy(*by, "block").agg(F.array_join(names, separator).alias("line"))


def _joined_text(cells: str, gaps: Column, rest: Column, filler: Column, separator: str) -> Column:
    """The text of a line: each cell after its gap, and the cells not seen at the end.

    Pieces carry no separator at either end, so the line is put together in one copy.
    """
    gap = F.concat(filler, F.lit(separator))
    written = F.transform(
        F.arrays_zip(F.col(f"{cells}.text").alias("text"), gaps.alias("gap")),
        lambda c: F.concat(F.repeat(gap, c["gap"]), c["text"]),
    )
    end = F.when(rest > 0, F.concat(F.repeat(gap, (rest - 1).cast("int")), filler))
    return F.concat_ws(separator, written, end)


def block_lines(
    long: DataFrame,
    variable: str,
    blocks: DataFrame,
    omit_code: str = "5",
    not_seen_code: str = "6",
    by: Sequence[str] = (),
    separator: str = ",",
    parts: int | None = None,
) -> DataFrame:
    """(student, block, line): a matrix of any number of items in blocks of columns.

    Every student has a line in every block. ``blocks`` are the items as ``in_blocks``
    gives them. What is gathered is the cells of one student in ``BLOCKS_TOGETHER`` blocks;
    lines are made after that, so rows are dealt by their cells and not by their lines. Lines are
    put together where a student has cells; the others are one text per block. With
    ``by`` there are blocks of their own for each exam; the line of a student who took no part
    in it has empty cells.
    """
    if variable not in CODED_VARIABLES:
        not_seen_code = NOT_SHOWN
    cells = with_cell_state(long, variable, by)
    text = F.when(F.col("cell_state") == "omitted", omit_code).otherwise(F.coalesce(F.col("value").cast("string"), F.lit("NA")))
    cell = F.struct(F.col("place").alias("place"), text.alias("text"))
    group = F.floor(F.col("block") / BLOCKS_TOGETHER).alias("group")
    key = [*by, "student_id", "group"]
    found = equi_join(cells, blocks, [*by, "content_item_name"], "inner").select(*by, "student_id", group, "block", cell.alias("cell"))
    sizes = blocks.groupBy(*by, "block").agg(F.first("width").alias("width"))
    # the lines without any cell are the same for all students: made once, for those who took part and for those who did not
    unseen = F.repeat(F.lit(not_seen_code + separator), F.col("width") - 1)
    member = F.struct(
        "block",
        F.concat(unseen, F.lit(not_seen_code)).alias("empty"),
        *([F.repeat(F.lit(separator), F.col("width") - 1).alias("absent")] if by else []),
    )
    groups = sizes.groupBy(*by, group).agg(F.collect_list(member).alias("members"))
    students = long.select("student_id").distinct()
    # one row per student and group of blocks
    all_groups = F.broadcast(sizes.select(*by, group).distinct().agg(F.collect_list(F.struct(*by, "group")).alias("all")))
    every = students.join(all_groups).select("student_id", F.inline("all"))
    nothing = {c: F.lit(None).cast(found.schema[c].dataType) for c in ("block", "cell")}
    rows = found.unionByName(every.withColumns(nothing).select(*found.columns))
    rows = dealt(rows, parts, *key) if parts else rows.repartition(*key)
    in_block = rows.groupBy(*key, "block").agg(F.array_sort(F.collect_list("cell")).alias("cells"))
    in_block = equi_join(in_block, F.broadcast(sizes), [*by, "block"], "left")
    before = F.expr("transform(cells, (c, i) -> c.place - if(i = 0, -1, cells[i - 1].place) - 1)")
    # a block that is listed has a cell, so its student took part
    rest = F.col("width") - 1 - F.try_element_at("cells", F.lit(-1))["place"]
    line = _joined_text("cells", before, rest, F.lit(not_seen_code), separator)
    entry = F.when(F.col("block").isNotNull(), F.struct("block", line.alias("line")))
    gathered = in_block.groupBy(*key).agg(F.map_from_entries(F.collect_list(entry)).alias("seen"))
    if by:
        taken = long.select(*by, "student_id").distinct().withColumn("taken", F.lit(True))
        gathered = equi_join(gathered, taken, [*by, "student_id"], "left")
    more = ["taken"] if by else []
    lined = equi_join(gathered, F.broadcast(groups), [*by, "group"], "inner").select(*by, "student_id", *more, "seen", F.inline("members"))
    empty = F.when(F.col("taken"), F.col("empty")).otherwise(F.col("absent")) if by else F.col("empty")
    line = F.coalesce(F.try_element_at("seen", F.col("block")), empty)
    return lined.select(*by, "student_id", "block", line.alias("line"))


def matrix_lines(
    long: DataFrame,
    variable: str,
    positions: DataFrame,
    omit_code: str = "5",
    not_seen_code: str = "6",
    separator: str = ",",
    parts: int | None = None,
) -> DataFrame:
    """(student, line): each row of the matrix as the text of all its cells.

    For matrices with more items than a frame has columns. ``positions`` numbers
    the items from 1, as ``display_order`` or ``name_order`` do. A line is put
    together from the cells a student has and the length of the gaps between
    them; a missing value is written as NA. Students are dealt into ``parts`` parts if that
    is given: by the bytes of their few cells, a part would hold far too many lines.
    """
    if variable not in CODED_VARIABLES:
        not_seen_code = NOT_SHOWN
    places = positions.toDF("content_item_name", "position")
    n_items = places.agg(F.count("*")).scalar()
    cells = natural_join(with_cell_state(long, variable), places, "inner")
    text = F.when(F.col("cell_state") == "omitted", omit_code).otherwise(
        F.coalesce(F.col("value").cast("string"), F.lit("NA"))
    )
    cell = F.struct(F.col("position").cast("int").alias("position"), text.alias("text"))
    rows = dealt(cells.select("student_id", cell.alias("cell")), parts, "student_id")
    rows = rows.groupBy("student_id").agg(F.array_sort(F.collect_list("cell")).alias("cells"))
    before = F.expr("transform(cells, (c, i) -> c.position - if(i = 0, 0, cells[i - 1].position) - 1)")
    rest = n_items - F.element_at("cells", -1)["position"]
    return rows.select("student_id", _joined_text("cells", before, rest, F.lit(not_seen_code), separator).alias("line"))


def omit_incorrect_matrix(cleaned: DataFrame, items: Sequence[str], parts: int | None = None) -> DataFrame:
    """Scores with omits as wrong and items without time spent as not seen."""
    return matrix_wide(omit_incorrect_long(cleaned), "scored_response", items, **OMIT_INCORRECT_CODES, parts=parts)


def omit_incorrect_long(cleaned: DataFrame) -> DataFrame:
    return matrix_long(drop_zero_time(cleaned), ["scored_response"])


def matrix_summary(long: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Size and six-number summary of each dense matrix, empty cells counted as 0.

    One pass counts how often each value, student and item occurs. The empty
    cells are only counted: they enter as one value with a weight.
    """

    def entry(kind: str, key: Column, value: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("variable"),
            key.cast("string").alias("key"),
            value.cast("double").alias("value"),
        )

    nothing = F.lit(None)
    entries = long.select(
        F.inline(
            F.array(
                *[entry(name, F.col(name), nothing) for name in CELL],
                *[entry(v, nothing, F.col(v)) for v in variables],
            )
        )
    )
    counts = checkpointed(entries.groupBy("variable", "key", "value").agg(F.count("*").alias("n")))
    # one row per variable, plus one each for the students and the items
    sizes = {
        r.variable: r
        for r in counts.groupBy("variable").agg(F.count("*").alias("kinds"), F.sum("n").alias("cells")).collect()
    }
    if not sizes:
        n_students = n_items = n_cells = 0
    else:
        n_students, n_items = (sizes[name].kinds for name in CELL)
        n_cells = sizes[CELL[0]].cells
    spark = long.sparkSession
    empty = spark.createDataFrame(
        [(v, 0.0, n_students * n_items - n_cells) for v in variables], "variable string, value double, n long"
    )
    shown = counts.where(F.col("variable").isin(*variables) & F.col("value").isNotNull())
    values = (
        shown.select("variable", "value", "n")
        .unionByName(empty.where("n > 0"))
        .groupBy("variable", "value")
        .agg(F.sum("n").alias("n"))
    )
    return summarise_counts(values, ["variable"], saved=True).withColumns(
        {"n_students": F.lit(n_students).cast("bigint"), "n_items": F.lit(n_items).cast("bigint")}
    )
