"""How many parts rows are dealt into, from their number."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Rows aimed at per part, where groups of rows are held in memory.
PART_ROWS = 500_000
# Up to as many parts the session's number and adaptive execution decide.
FEW_PARTS = 8
# Bytes of text aimed at per part, where a few cells become a long line.
TEXT_BYTES = 128 * 1024 * 1024
# More parts than this a driver does not keep track of; they are only larger then.
MOST_PARTS = 50_000


def parts_of(n_rows: int) -> int | None:
    """The number of parts for so many rows; none where the session's own number will do."""
    wanted = -(-n_rows // PART_ROWS)
    return wanted if wanted > FEW_PARTS else None


def text_parts(n_rows: int, n_cells: int, cell_bytes: int) -> int | None:
    """The number of parts for so many lines of so many cells; none where one part will do."""
    wanted = -(-n_rows * n_cells * cell_bytes // TEXT_BYTES)
    return min(wanted, MOST_PARTS) if wanted > 1 else None


def dealt(frame: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """The rows dealt by keys into that many parts, or more if the session has more.

    Parts with a given number are not merged again: narrow rows are small once they are
    compressed, and merged by their bytes they would fill the memory of a task.
    """
    if parts is None:
        return frame
    default = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(max(parts, default), *keys)
