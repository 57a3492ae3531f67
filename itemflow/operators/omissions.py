"""Rules that turn responses into omitted ones."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from itemflow.functions.columns import cast_or_refuse, is_attempted, letter_to_number, zero_where
from itemflow.operators.joins import flag_members, plain_join
from itemflow.operators.ranking import ranked

TREATMENTS = ("omit", "remove", "ignore")


def add_attempted(frame: DataFrame) -> DataFrame:
    text = dict(frame.dtypes)["raw_response"] == "string"
    return frame.withColumn("attempted", is_attempted(F.col("raw_response"), text))


def keep_originals(frame: DataFrame) -> DataFrame:
    """Save response and score before the first recode."""
    if "orig_response" in frame.columns or "orig_score" in frame.columns:
        return frame
    return frame.withColumns(
        {"orig_response": F.col("raw_response"), "orig_score": F.col("scored_response")}
    )


def recode_as_omitted(frame: DataFrame, condition: Column) -> DataFrame:
    """Where the condition holds, the response is 0, wrong and not attempted."""
    omit = F.coalesce(condition, F.lit(False))

    def zeroed(name: str) -> Column:
        return F.when(omit, F.lit(0).cast(frame.schema[name].dataType)).otherwise(F.col(name))

    frame = keep_originals(frame)
    return frame.withColumns(
        {
            "raw_response": zeroed("raw_response"),
            "scored_response": zeroed("scored_response"),
            "attempted": F.when(omit, F.lit(False)).otherwise(F.col("attempted")),
        }
    )


# Old versions of items ------------------------------------------------------


def flag_version_cutoffs(
    frame: DataFrame, cutoffs: DataFrame, flag: str, before_after: str = "before"
) -> DataFrame:
    """Flag responses given to a version on the wrong side of the item's cutoff date.

    Cutoffs by item name count before or after the date; cutoffs by item id
    always count before it. Several cutoffs of one item add up, so the latest
    (or earliest) one decides.
    """
    if before_after not in ("before", "after"):
        raise ValueError("before_after must be 'before' or 'after'")
    key = "content_item_name" if "content_item_name" in cutoffs.columns else "content_item_id"
    before = key == "content_item_id" or before_after == "before"
    latest = F.max("cutoff_date") if before else F.min("cutoff_date")
    # an item without a name or id equals no listed one
    per_item = cutoffs.where(F.col(key).isNotNull()).groupBy(key).agg(latest.alias("__cutoff"))
    created = F.col("timestamp_created")
    old = created < F.col("__cutoff") if before else created > F.col("__cutoff")
    joined = plain_join(frame, per_item, [key])
    return joined.withColumn(flag, F.coalesce(old, F.lit(False))).drop("__cutoff")


def omit_version_cutoffs(frame: DataFrame, cutoffs: DataFrame, before_after: str = "before") -> DataFrame:
    flagged = flag_version_cutoffs(frame, cutoffs, "__old", before_after)
    return recode_as_omitted(flagged, F.col("__old")).drop("__old")


def flag_version_list(frame: DataFrame, items: DataFrame, flag: str) -> DataFrame:
    return flag_members(frame, items.where("content_item_id is not null"), ["content_item_id"], flag)


def omit_version_list(frame: DataFrame, items: DataFrame) -> DataFrame:
    """Omit all responses to the listed item ids."""
    return recode_as_omitted(flag_version_list(frame, items, "__old"), F.col("__old")).drop("__old")


def flag_old_keys(frame: DataFrame, old_keys: DataFrame, flag: str) -> DataFrame:
    """Flag responses scored with a listed pair of item id and answer.

    The rows are dealt by the item alone, as for the other lists of items.
    """
    pair = ["content_item_id", "correct_answer"]
    known = old_keys.where("content_item_id is not null and correct_answer is not null").select(*pair).distinct()
    joined = plain_join(frame, known.withColumn(flag, F.lit(True)), pair[:1], same=pair[1:])
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def omit_old_keys(frame: DataFrame, old_keys: DataFrame) -> DataFrame:
    return recode_as_omitted(flag_old_keys(frame, old_keys, "__old"), F.col("__old")).drop("__old")


# Repeated questions ---------------------------------------------------------


# What tells showings at one time apart, in this order, where a frame has it.
SHOWING_TIES = (
    "response_id", "activity_id_hist", "section_name", "item_section_position",
    "raw_response", "scored_response", "milliseconds_used",
)
SHOWING = ("student_id", "content_item_id")
# Showings are counted in so many buckets before they are spread.
SHOWING_BUCKETS = 65_536
# A bucket with more showings than this is ranked over range partitions.
HELD_SHOWINGS = 1_000_000


def showing_order(columns: list[str]) -> list[Column]:
    """Orders the times a student saw an item; unknown times come last.

    Showings at one time are told apart by the response and by what was answered. Rows
    that agree in all of this are ranked one after the other, in no matter which order.
    Rows without response ids are told apart by a hash of all their columns.
    """
    ties = [F.col(c) for c in SHOWING_TIES if c in columns]
    whole = [] if "response_id" in columns else [F.xxhash64(*[F.col(c) for c in sorted(columns)])]
    return [F.col("timestamp_created").asc_nulls_last(), *ties, *whole]


def is_repeat(rank: Column) -> Column:
    """Not the first showing; null where the time, and so the place in the order, is unknown."""
    return F.when(F.col("timestamp_created").isNotNull(), rank > 1)


def flag_repeats(frame: DataFrame, spread: bool = False) -> DataFrame:
    """Add ``repeat_omitted``: the student has seen this item at an earlier time.

    A response of unknown time has no place in the order: its flag is null. The rows are
    read and shuffled once, by student and item, and ranked in order; the showings of one
    item to one student are in one task. With ``spread`` they may be any number: where they
    are very many, rows are ranked over range partitions.
    """
    rank = spread_showings if spread else held_showings
    return rank(frame, "__rank").withColumn("repeat_omitted", is_repeat(F.col("__rank"))).drop("__rank")


def held_showings(frame: DataFrame, rank: str, alive: Column | None = None) -> DataFrame:
    """Number the showings of each item to each student, those of a pair in one task; removed rows by themselves."""
    kept = [] if alive is None else [alive]
    shown = Window.partitionBy(*SHOWING, *kept).orderBy(*showing_order(frame.columns))
    return frame.withColumn(rank, F.row_number().over(shown))


def spread_showings(frame: DataFrame, rank: str, alive: Column | None = None) -> DataFrame:
    """Number the showings of each item to each student, however many.

    A pass over the two keys counts showings by buckets of pairs. Only rows of buckets that one
    task does not hold are ranked over range partitions, for which rows are written down.
    """
    bucket = F.pmod(F.xxhash64(*SHOWING), F.lit(SHOWING_BUCKETS))
    counts = frame.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    full = [r.bucket for r in counts.where(F.col("n") > HELD_SHOWINGS).select("bucket").collect()]
    if not full:
        return held_showings(frame, rank, alive)
    held = held_showings(frame.where(~bucket.isin(full)), rank, alive)
    return held.unionByName(ranked_showings(frame.where(bucket.isin(full)), rank, alive))


def ranked_showings(frame: DataFrame, rank: str, alive: Column | None = None) -> DataFrame:
    """Number the showings of each item to each student, however many; removed rows by themselves."""
    ties = [c for c in SHOWING_TIES if c in frame.columns]
    # rows carry no second copy of what they are ordered by, only the hash if there is one
    whole = {f"__order_{i}": c for i, c in enumerate(showing_order(frame.columns)[1 + len(ties) :])}
    group = {} if alive is None else {"__living": alive}
    keyed = frame.withColumns(whole | group)
    numbered = ranked(keyed, [*SHOWING, *group], ["timestamp_created", *ties, *whole], rank)
    return numbered.drop(*whole, *group)


def check_treatment(treatment: str) -> str:
    if treatment not in TREATMENTS:
        warnings.warn(f"unknown repeat treatment {treatment!r}: repeated questions are omitted")
        return "omit"
    return treatment


def repeat_questions(
    frame: DataFrame, treatment: str = "omit", spread: bool = False
) -> tuple[DataFrame, DataFrame | None]:
    """Treat repeated questions; returns the rows and, for ``remove``, the removed ones.

    ``remove`` keeps first showings only, so responses of unknown time are in
    neither of the two frames. ``spread`` as in ``flag_repeats``.
    """
    treatment = check_treatment(treatment)
    if treatment == "ignore":
        return frame.withColumn("repeat_omitted", F.lit(False)), None
    flagged = flag_repeats(frame, spread)
    if treatment == "remove":
        return flagged.where(~F.col("repeat_omitted")), flagged.where(F.col("repeat_omitted"))
    return recode_as_omitted(flagged, F.col("repeat_omitted")), None


# Timing ---------------------------------------------------------------------


def timing_conditions(
    columns: list[str],
    ms_min: float | None = None,
    ms_max: float | None = None,
    sec_min: float | None = None,
    sec_max: float | None = None,
) -> dict[str, Column]:
    """The conditions that omit a response for its time, by limit.

    Milliseconds come first; seconds are used when no limit in milliseconds is
    given, or when there is no such column.
    """
    found = {}
    limits = {
        "timing_min": (ms_min, sec_min, lambda used, limit: used <= limit),
        "timing_max": (ms_max, sec_max, lambda used, limit: used > limit),
    }
    for name, (ms, sec, breaks) in limits.items():
        if ms is not None and "milliseconds_used" in columns:
            found[name] = breaks(F.col("milliseconds_used"), F.lit(ms))
        elif sec is not None and "seconds_used" in columns:
            found[name] = breaks(F.col("seconds_used"), F.lit(sec))
        elif ms is not None or sec is not None:
            unit = "milliseconds_used" if ms is not None else "seconds_used"
            warnings.warn(f"no column {unit}: no response recoded by {name}")
    return found


def timing_exclusion(frame: DataFrame, **limits: float | None) -> DataFrame:
    """Omit responses that took too little or too much time."""
    for condition in timing_conditions(frame.columns, **limits).values():
        frame = recode_as_omitted(frame, condition)
    return frame


# Other recodes --------------------------------------------------------------


def recode_letters(frame: DataFrame) -> DataFrame:
    """Turn text responses A-D into 1-4 and keep the text; numbers stay as they are."""
    if dict(frame.dtypes)["raw_response"] != "string":
        return frame
    return frame.withColumns(
        {"rawest_response": F.col("raw_response"), "raw_response": letter_to_number(F.col("raw_response"))}
    )


def numeric_responses(frame: DataFrame) -> DataFrame:
    """Text responses as numbers; any that is none is refused, never lost."""
    if dict(frame.dtypes)["raw_response"] != "string":
        return frame
    number = cast_or_refuse(F.col("raw_response"), LongType(), "raw_response")
    return frame.withColumn("raw_response", number)


def zero_repeats(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<column>_fixed``, which is 0 on repeated questions."""
    return frame.withColumns({f"{c}_fixed": zero_where(F.col(c), F.col("repeat_omitted")) for c in columns})


def flag_field_test(frame: DataFrame, items: DataFrame) -> DataFrame:
    """Add ``field_test``: the item is on the list of items under trial."""
    return flag_members(frame, items, ["content_item_name"], "field_test")


def marked_omits(frame: DataFrame) -> DataFrame:
    """Responses that a recode changed; responses that were missing are not among them."""
    return frame.where(F.col("raw_response") != F.col("orig_response"))
