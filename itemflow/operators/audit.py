"""How many responses, activities, students and items each step leaves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Tags on the rows of a run: the step that removed the row, and the step that
# omitted its response (0: it was omitted from the start). Both may be null.
DROP_STEP = "__drop_step"
OMIT_STEP = "__omit_step"

COUNTED = {"activities": "activity_id_hist", "users": "student_id", "items": "content_item_name"}


def counters(frame: DataFrame) -> DataFrame:
    """Rows, activities, students and items; null counts as a value.

    One row; the keys are combined before the shuffle and no distinct count has
    to expand the rows of the others.
    """
    tagged = frame.withColumns({DROP_STEP: F.lit(None).cast("int"), OMIT_STEP: F.lit(None).cast("int")})
    return funnel(tagged, ["start"], []).select(
        "responses_left", "activities_left", "users_left", "items_left"
    )


def _bit(step: str) -> Column:
    return F.expr(f"shiftleft(1L, {step})")


def funnel(tagged: DataFrame, steps: Sequence[str], omit_steps: Sequence[str]) -> DataFrame:
    """One row per step, from one pass over the tagged rows.

    A row carries two bit sets: the steps after which it is still there, and
    those after which it is there and omitted. The sets of an activity, student
    or item are the unions of those of its rows, so each is one aggregate that
    combines before the shuffle, and a step's count is the number of sets that
    hold its bit.
    """
    if len(steps) > 62:
        raise ValueError("too many steps")
    everywhere = F.lit((1 << len(steps)) - 1).cast("bigint")
    left = F.when(F.col(DROP_STEP).isNull(), everywhere).otherwise(_bit(DROP_STEP) - 1)
    omitted = F.when(F.col(OMIT_STEP).isNull(), F.lit(0).cast("bigint")).otherwise(
        F.col("left").bitwiseAND(F.bitwise_not(_bit(OMIT_STEP) - 1))
    )
    rows = tagged.select(
        *COUNTED.values(), left.alias("left"), F.col(OMIT_STEP)
    ).withColumn("omitted", omitted)

    def entry(level: str, key: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), key.cast("string").alias("key"))

    same = F.concat_ws(" ", F.col("left"), F.col("omitted"))
    entries = rows.select(
        "left", "omitted",
        F.inline(
            F.array(
                entry("responses", same),
                *[entry(level, F.col(column)) for level, column in COUNTED.items()],
            )
        ),
    )
    sets = (
        entries.groupBy("level", "key")
        .agg(
            F.bit_or("left").alias("left"), F.bit_or("omitted").alias("omitted"), F.count("*").alias("n")
        )
        .groupBy("level", "left", "omitted")
        .agg(F.sum(F.when(F.col("level") == "responses", F.col("n")).otherwise(F.lit(1))).alias("n"))
    )

    # from here on there are only as many rows as there are different bit sets
    step_list = F.array(
        *[
            F.struct(
                F.lit(i).alias("step_no"), F.lit(s).alias("step"), F.lit(s in omit_steps).alias("omits")
            )
            for i, s in enumerate(steps)
        ]
    )
    per_step = sets.select("level", "left", "omitted", "n", F.inline(step_list))

    def holds(bits: str) -> Column:
        return F.expr(f"({bits} & shiftleft(1L, step_no)) != 0")

    def left_of(level: str) -> Column:
        return F.coalesce(
            F.sum(F.when((F.col("level") == level) & holds("left"), F.col("n"))), F.lit(0)
        ).alias(f"{level}_left")

    def omitted_of(level: str) -> Column:
        count = F.sum(F.when((F.col("level") == level) & holds("omitted"), F.col("n")))
        return F.when(F.col("omits"), F.coalesce(count, F.lit(0))).alias(f"omitted_{level}")

    counts = per_step.groupBy("step_no", "step", "omits").agg(
        *[left_of(level) for level in ("responses", *COUNTED)],
        *[omitted_of(level) for level in ("responses", "activities", "users")],
    )
    before = Window.orderBy("step_no")
    return counts.withColumns(
        {
            f"{level}_removed": F.coalesce(
                F.lag(f"{level}_left").over(before) - F.col(f"{level}_left"), F.lit(0)
            )
            for level in ("responses", *COUNTED)
        }
    ).drop("omits")
