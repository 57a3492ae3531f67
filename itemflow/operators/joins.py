"""Joins and memberships in which null matches null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def null_safe_equal(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__{k}"]) for k in keys])


def _marked(right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return right.withColumnsRenamed({k: f"__{k}" for k in keys})


def equi_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on named keys, null matching null, with one copy of each key.

    Whether a side is broadcast is left to its size in bytes, known from files or, once
    it has been computed, by adaptive execution.
    """
    right = _marked(right, keys)
    joined = left.join(right, null_safe_equal(left, right, keys), how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("full", "right"):
        joined = joined.withColumns({k: F.coalesce(F.col(k), F.col(f"__{k}")) for k in keys})
    return joined.drop(*[f"__{k}" for k in keys])


def plain_join(left: DataFrame, right: DataFrame, keys: Sequence[str], same: Sequence[str] = ()) -> DataFrame:
    """Left join on named keys of which null matches nothing.

    Rows are dealt by ``keys`` alone; the columns in ``same`` have to be equal as well, but are
    compared in order instead of being a part of the key, so that lists with more and with
    fewer columns are met in one dealing of the rows.
    """
    right = _marked(right, [*keys, *same])
    met = [left[k] == right[f"__{k}"] for k in keys]
    met += [c for k in same for c in (left[k] <= right[f"__{k}"], left[k] >= right[f"__{k}"])]
    return left.join(right, reduce(lambda a, b: a & b, met), "left").drop(*[f"__{k}" for k in [*keys, *same]])


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every shared column name, null matching null."""
    keys = [c for c in left.columns if c in right.columns]
    if not keys:
        raise ValueError("the two frames share no column")
    return equi_join(left, right, keys, how)


def keep_members(frame: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are listed."""
    return equi_join(frame, members.select(*keys), keys, "left_semi")


def drop_members(frame: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not listed; a null that is not listed stays."""
    return equi_join(frame, members.select(*keys), keys, "left_anti")


def flag_members(frame: DataFrame, members: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Add a boolean column that tells whether the keys are listed.

    One key is joined by plain equality, so that rows that are dealt by it already stay where
    they are; whether a null is listed is asked once, and not joined.
    """
    if len(keys) > 1:
        listed = members.select(*keys).distinct().withColumn(flag, F.lit(True))
        joined = equi_join(frame, listed, keys, "left")
        return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    (key,) = keys
    listed = members.select(key).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
    null_listed = members.where(F.col(key).isNull()).agg(F.count("*") > 0).scalar()
    joined = plain_join(frame, listed, [key])
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.col(key).isNull() & null_listed))


def repeated_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur on more than one row."""
    return frame.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def check_unique(frame: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise if a lookup would multiply the rows it is joined to."""
    repeated = repeated_keys(frame, keys).limit(5).collect()
    if repeated:
        shown = ", ".join(str(tuple(row[k] for k in keys)) for row in repeated)
        raise ValueError(f"{what} has more than one row for {shown}")
