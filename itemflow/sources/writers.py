"""Writers for cleaned responses, matrices, summaries and the audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMATS = ("parquet", "csv", "json")


def write_frame(
    frame: DataFrame, path: str, kind: str = "parquet", order_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write one frame as a folder. CSV gets a header; an order sorts the whole output."""
    if kind not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    if order_by:
        frame = frame.orderBy(*order_by)
    writer = frame.write.mode(mode)
    if kind == "csv":
        writer = writer.option("header", True)
    writer.format(kind).save(path)


def write_frames(frames: Mapping[str, DataFrame], folder: str, kind: str = "parquet") -> list[str]:
    """Write each frame that has rows to its own folder; returns their names."""
    written = []
    for name, frame in frames.items():
        if not frame.isEmpty():
            write_frame(frame, f"{folder}/{name}", kind)
            written.append(name)
    return written


def write_sections(cleaned: DataFrame, path: str) -> None:
    """All sections in one pass, one folder each; a section without rows has none."""
    cleaned.write.mode("overwrite").partitionBy("section_name").parquet(path)


def write_block_lines(lines: DataFrame, headers: DataFrame, path: str, by: Sequence[str] = (), id_column: str = "student_id") -> None:
    """A matrix in blocks as CSV text: one folder per block, students in order, the header line first.

    Lines are dealt by range, so that a block with very many students is several files;
    the first of them begins with the header.
    """
    keys = [*by, "block"]
    # an id may hold a separator
    id_text = F.col(id_column).cast("string")
    quoted = F.when(id_text.rlike('[,"\n]'), F.concat(F.lit('"'), F.replace(id_text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(id_text)
    rows = lines.select(*keys, F.lit(1).alias("rank"), quoted.alias("id"), "line")
    heads = headers.select(*keys, F.lit(0).alias("rank"), F.lit(id_column).alias("id"), "line")
    order = [*keys, "rank", "id"]
    text = rows.unionByName(heads).repartitionByRange(*order).sortWithinPartitions(*order)
    text.select(*keys, F.concat_ws(",", F.coalesce("id", F.lit("")), "line").alias("value")).write.mode("overwrite").partitionBy(*keys).text(path)


def write_audit(audit: DataFrame, path: str) -> None:
    write_frame(audit, path, "json", order_by=["step_no"])
