"""What the operators share: work tables, keys of documents, batches of words."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters that separate words: the space and the five ASCII controls from tab to carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
# Text handled at once inside a task.
CHUNK_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """The shared folder of the session.

    It is the one the cluster names in ``spark.checkpoint.dir``. Where nothing is
    named, a folder inside the warehouse is set, which is shared as well.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        context.setCheckpointDir(named or f"{warehouse.rstrip('/')}/_work")
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs a read, not a recomputation. The
    folder belongs to the run; whoever named it clears it afterwards.
    """
    spark = frame.sparkSession
    path = new_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_key(column: str = "text") -> Column:
    """With doc_id the key of a document: rows that agree in both are one document."""
    return F.xxhash64(F.col(column))


def free_name(frame: DataFrame, name: str) -> str:
    """The name, with lines in front until no column of the frame has it."""
    taken = {c.lower() for c in frame.columns}
    while name in taken:
        name = f"_{name}"
    return name


def match(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> Column:
    """Null-safe equality of left columns with right columns."""
    condition = F.lit(True)
    for a, b in pairs.items():
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


# Words ------------------------------------------------------------------------


def slices(batch: pa.RecordBatch, column: int, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded amount of text each; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(first, last - first)
        first = last


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class Words:
    """The words of some texts in one buffer, each followed by one space.

    ``offsets[i]`` is where word i begins; ``counts`` has the words per text and
    ``firsts`` the index of each text's first word.
    """

    def __init__(self, rows: list[bytes]):
        parts = [row.split() for row in rows]
        self.counts = np.fromiter(map(len, parts), np.int64, len(parts))
        self.firsts = np.cumsum(self.counts) - self.counts
        self.buffer = b" ".join(chain.from_iterable(parts)) + b" " if self.counts.sum() else b""
        self.offsets = word_offsets(self.buffer)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def encoded(self) -> tuple[np.ndarray, list[bytes]]:
        return encoded(self.buffer, self.offsets)


def word_offsets(buffer: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.frombuffer(buffer, np.uint8) == 32) + 1
    return np.concatenate([[0], ends]).astype(np.int64)


def encoded(buffer: bytes, offsets: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(id of each piece of the buffer, distinct pieces); a piece ends where the next begins."""
    n = len(offsets) - 1
    if n <= 0:
        return np.zeros(0, np.int32), []
    pieces = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(buffer)])
    coded = pieces.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[i], starts[i] + 1, ... of each i, lengths[i] of them, in one array."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)
