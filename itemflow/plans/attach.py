"""Two ways of giving each row an aggregate of its group.

``by_window`` needs no shuffle when the rows are already partitioned by a part of
the key, but it holds a group in one task. ``by_join`` aggregates before it
shuffles and joins the totals back; a group may be of any size, because adaptive
execution splits the row side of a skewed join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window

from itemflow.functions.checkpoints import checkpointed
from itemflow.functions.columns import Aggregate, grouped
from itemflow.operators.joins import equi_join

Attach = Callable[[DataFrame, Sequence[str], Mapping[str, Aggregate]], DataFrame]


def by_window(rows: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Aggregate]) -> DataFrame:
    window = Window.partitionBy(*keys)
    return rows.withColumns({name: a(lambda c: c.over(window)) for name, a in aggregates.items()})


def totals(rows: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Aggregate]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[a(grouped).alias(name) for name, a in aggregates.items()])


def by_join(rows: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Aggregate]) -> DataFrame:
    return equi_join(rows, totals(rows, keys, aggregates), keys, "left")


def by_saved_join(rows: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Aggregate]) -> DataFrame:
    """As ``by_join``, with the totals checkpointed.

    In a chain of several attachments each one reads the rows before it; saved
    totals keep the number of scans equal to the number of attachments.
    """
    return equi_join(rows, checkpointed(totals(rows, keys, aggregates)), keys, "left")
