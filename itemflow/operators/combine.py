"""Matrices of several exams side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.functions.checkpoints import stored
from itemflow.operators.joins import check_unique, equi_join, natural_join
from itemflow.operators.matrix import CODED_VARIABLES, NOT_SHOWN, _cell, pivoted, with_cell_state

# No item is called this.
_TAKEN = "\u0000taken"


def prefixed(matrix: DataFrame, prefix: str, id_column: str) -> DataFrame:
    """Put the exam in front of every item column."""
    return matrix.withColumnsRenamed({c: prefix + c for c in matrix.columns if c != id_column})


def combine_wide(matrices: Mapping[str, DataFrame], id_column: str = "student_id") -> DataFrame:
    """Full outer join of finished matrices; exams a student did not take are null.

    Joins once per exam. Matrices that can be made from their long form are
    combined with one shuffle by ``combine_long``.
    """
    frames = [prefixed(m, prefix, id_column) for prefix, m in matrices.items()]
    return reduce(lambda a, b: equi_join(a, b, [id_column], "full"), frames)


def stack_exams(longs: Mapping[str, DataFrame]) -> DataFrame:
    """Long matrices of several exams as one, with the exam's prefix in ``exam``."""
    return reduce(
        DataFrame.unionByName, [long.withColumn("exam", F.lit(prefix)) for prefix, long in longs.items()]
    )


def combine_long(
    long: DataFrame,
    variable: str,
    items: Mapping[str, Sequence[str]],
    omit_code: str = "5",
    not_seen_code: str = "6",
    id_column: str = "student_id",
    parts: int | None = None,
) -> DataFrame:
    """The same table as ``combine_wide``, from a long matrix with an ``exam`` column.

    One pivot for all exams. Each exam adds one column that says whether the
    student has any row in it; inside an exam taken, an item without a row was
    not seen.
    """
    if variable not in CODED_VARIABLES:
        not_seen_code = NOT_SHOWN
    long = long.withColumnRenamed(id_column, "student_id").where(F.col("exam").isin(*items))
    cells = with_cell_state(long, variable, ["exam"]).select(
        "student_id",
        F.concat("exam", "content_item_name").alias("content_item_name"),
        F.col("value").cast("bigint").alias("value"),
        F.when(F.col("cell_state") == "omitted", 0).otherwise(1).alias("state"),
        F.concat("exam", F.lit(_TAKEN)).alias("taken"),
    )
    cell = F.struct("content_item_name", "value", "state")
    taken = F.struct(
        F.col("taken").alias("content_item_name"), F.lit(1).cast("bigint").alias("value"), F.lit(1).alias("state")
    )
    columns = [(prefix, name) for prefix, names in items.items() for name in names]
    wanted = [prefix + name for prefix, name in columns]
    marks = {prefix: len(wanted) + i for i, prefix in enumerate(items)}
    wide = pivoted(
        cells.select("student_id", F.inline(F.array(cell, taken))),
        "student_id",
        wanted + [prefix + _TAKEN for prefix in items],
        parts,
    )
    return wide.select(
        F.col("student_id").alias(id_column),
        *[
            F.when(
                F.col(f"{marks[prefix]}_s").isNotNull(), _cell(f"{i}_s", f"{i}_v", omit_code, not_seen_code)
            ).alias(prefix + name)
            for i, (prefix, name) in enumerate(columns)
        ],
    )


def with_student_ids(combined: DataFrame, lookup: DataFrame, id_column: str = "user_id") -> DataFrame:
    """Add the student of each user id; users without one are dropped."""
    check_unique(lookup, [id_column], "the id lookup")
    return equi_join(combined, lookup, [id_column], "inner")


def combine_sources(
    long: DataFrame,
    variable: str,
    first: Mapping[str, Sequence[str]],
    second: Mapping[str, Sequence[str]],
    lookup: DataFrame,
    omit_code: str = "5",
    not_seen_code: str = "6",
    id_column: str = "user_id",
    parts: int | None = None,
) -> DataFrame:
    """Students with exams in both of two sources, side by side.

    ``long`` is one long matrix with an ``exam`` column; its ``student_id`` is what the
    source of the exam calls the student: ``id_column`` in the first, the student in the
    second. ``first`` and ``second`` give the items of the exams of each source. All exams
    are pivoted together in one pass; what is joined afterwards has one row per student.
    """
    check_unique(lookup, [id_column], "the id lookup")
    source = F.when(F.col("exam").isin(*first), F.lit("1")).when(F.col("exam").isin(*second), F.lit("2"))
    tagged = long.withColumn("student_id", F.concat(source, F.col("student_id").cast("string")))
    # a student without an id is in no other source
    wide = stored(combine_long(tagged.where(F.col("student_id").isNotNull()), variable, {**first, **second}, omit_code, not_seen_code, parts=parts))

    def of(number: str, exams: Mapping[str, Sequence[str]], id_name: str) -> DataFrame:
        columns = [prefix + name for prefix, names in exams.items() for name in names]
        mine = wide.where(F.col("student_id").startswith(number))
        return mine.select(F.substring("student_id", 2, 2**31 - 1).alias(id_name), *columns)

    known = with_student_ids(of("1", first, id_column), lookup, id_column)
    return natural_join(known, of("2", second, "student_id"), "inner")
