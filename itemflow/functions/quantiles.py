"""Exact quantiles that never bring all values to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemflow.functions.checkpoints import checkpointed
from itemflow.operators.joins import natural_join

# Buckets per doubling of the value: the number of buckets depends on the range
# of the values only, never on how many there are.
_BUCKETS_PER_DOUBLING = 1024
# So many different values of a range are sorted; a range with more is cut.
SORTED_KINDS = 10_000
_PARTS = 1024


def _bucket(value: Column) -> Column:
    size = F.floor(F.log2(F.abs(value) + 1) * _BUCKETS_PER_DOUBLING)
    return F.when(value < 0, -size).otherwise(size)


def value_counts(values: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by..., value, n): how often each non-null value occurs."""
    return (
        values.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("value"))
        .agg(F.count("*").alias("n"))
    )


def _extent() -> list[Column]:
    """What is known of a bucket: how many values, how many different ones, least and greatest."""
    return [F.sum("n").alias("bucket_n"), F.count("*").alias("kinds"), F.min("value").alias("low"), F.max("value").alias("high")]


def _in_range(counts: DataFrame, by: Sequence[str], wanted: DataFrame) -> DataFrame:
    """Counts with each wanted rank whose range they are in; at most six ranks per group."""
    inside = (F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high"))
    for c in by:
        inside = inside & F.col(c).eqNullSafe(F.col(f"w_{c}"))
    return counts.join(F.broadcast(wanted), inside)


def _narrowed(counts: DataFrame, by: Sequence[str], wanted: DataFrame) -> DataFrame:
    """Wanted ranks with ranges of at most ``SORTED_KINDS`` different values.

    Where a range has more, it is cut into ``_PARTS`` parts of equal width between its
    least and its greatest value; the part that holds the rank is the next range. Every
    cut parts at least these two, and each is one pass over the counts.
    """
    group = [*[f"w_{c}" for c in by], "probability", "rank"]
    while (wanted.agg(F.max("kinds")).first()[0] or 0) > SORTED_KINDS:
        wide = wanted.where(F.col("kinds") > SORTED_KINDS)
        part = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * _PARTS)
        cut = _in_range(counts, by, wide).select(
            *group, "weight", "start", "value", "n", F.least(part, F.lit(_PARTS - 1)).alias("part")
        )
        # at most _PARTS rows per wanted rank
        parts = cut.groupBy(*group, "weight", "start", "part").agg(*_extent())
        end = F.col("start") + F.sum("bucket_n").over(Window.partitionBy(*group).orderBy("part"))
        found = parts.withColumn("end", end).withColumn("start", F.col("end") - F.col("bucket_n"))
        found = found.where((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("end"))).select(*wanted.columns)
        wanted = checkpointed(wanted.where(F.col("kinds") <= SORTED_KINDS).unionByName(found))
    return wanted


def summarise_counts(counts: DataFrame, by: Sequence[str], saved: bool = False) -> DataFrame:
    """Minimum, quartiles, mean and maximum of a (by..., value, n) frame.

    Quartiles interpolate linearly between the two nearest order statistics.
    The ranks they need are found first among buckets of neighbouring values, so
    the only values that are sorted are those of the few buckets that hold a
    wanted rank; a bucket with very many different values is cut until it has few.
    The counts are read twice, and checkpointed unless they come
    from saved rows.
    """
    by = list(by)
    counts = counts.withColumn("bucket", _bucket(F.col("value")))
    if not saved:
        counts = checkpointed(counts)
    totals = counts.groupBy(*by).agg(
        F.sum("n").alias("n_values"),
        F.min("value").alias("minimum"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.max("value").alias("maximum"),
    )

    ordered = Window.partitionBy(*by).orderBy("bucket")
    whole = Window.partitionBy(*by)
    position = (F.col("total") - 1) * F.col("probability")
    wanted = (
        counts.groupBy(*by, "bucket")
        .agg(*_extent())
        .withColumn("end", F.sum("bucket_n").over(ordered))
        .withColumn("start", F.col("end") - F.col("bucket_n"))
        .withColumn("total", F.sum("bucket_n").over(whole))
        .withColumn("probability", F.explode(F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position)))))
        .where((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("end")))
        .withColumn("weight", 1 - F.abs(position - F.col("rank")))
        .select(
            *[F.col(c).alias(f"w_{c}") for c in by],
            "low", "high", "kinds", "start", "probability", "rank", "weight",
        )
    )
    wanted = _narrowed(counts, by, checkpointed(wanted))
    within = Window.partitionBy(*by, "probability", "rank").orderBy("value")
    hit = (
        _in_range(counts, by, wanted)
        .withColumn("last", F.col("start") + F.sum("n").over(within))
        .where((F.col("rank") < F.col("last")) & (F.col("rank") >= F.col("last") - F.col("n")))
    )

    def quartile(probability: float) -> Column:
        return F.sum(F.when(F.col("probability") == probability, F.col("value") * F.col("weight")))

    quartiles = hit.groupBy(*by).agg(
        quartile(0.25).alias("q1"), quartile(0.5).alias("median"), quartile(0.75).alias("q3")
    )
    columns = ["n_values", "minimum", "q1", "median", "mean", "q3", "maximum"]
    if not by:
        return totals.select(
            "n_values", "minimum",
            quartiles.select("q1").scalar().alias("q1"),
            quartiles.select("median").scalar().alias("median"),
            "mean",
            quartiles.select("q3").scalar().alias("q3"),
            "maximum",
        )
    return natural_join(totals, quartiles, "left").select(*by, *columns)
