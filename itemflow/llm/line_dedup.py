"""Removal of repeated runs of lines, by prefix doubling and intervals of common prefixes.

The lines of all documents form one sequence, documents kept apart by gaps. Every
suffix of it gets a name such that two suffixes have one name exactly if their first
1, 2, 4, ... lines agree: the name of twice as many lines is that of a pair of names.
A name is the least position that bears it, as a rank in a suffix array would be, and
suffixes that share theirs with no other drop out; rounds go on until none is left.

Then the intervals of the longest common prefixes are found from the deepest names
up: an interval is all suffixes that share their first m lines, known by its earliest
suffix and m. Intervals are cut by names of half the length, a quarter and so on. Those
who agree further form an interval inside, which its earliest suffix stands for in
the outer one; so the intervals together hold each suffix twice at most. The deepest
interval in which a suffix is not the earliest gives the longest run of lines from it
that also stands earlier: if it has enough words, it is a later copy and goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.llm.common import match, saved, slices, text_key, texts


def _line_ids(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(i, k, lines): for each document its lines with a word, packed as id (128 bits) and words."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("i"), text_key(text).alias("k"), F.col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                packed = []
                for whole in texts(part.column(2)):
                    lines = whole.split(b"\n")
                    words = np.fromiter((len(x.split()) for x in lines), np.int64, len(lines))
                    kept = np.flatnonzero(words)
                    ids = b"".join([xxhash.xxh128_digest(lines[j]) for j in kept.tolist()])
                    packed.append(np.column_stack([np.frombuffer(ids, np.int64).reshape(-1, 2), words[kept]]).astype(np.int64).tobytes())
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(packed, pa.binary())], ["i", "k", "lines"])

    return rows.mapInArrow(run, "i long, k long, lines binary")


def lines_needed(words: np.ndarray, least: int) -> np.ndarray:
    """Lines of the shortest run with enough words that begins at each line; 0 if none."""
    sums = np.concatenate([[0], np.cumsum(words)])
    ends = np.searchsorted(sums, sums[:-1] + least)
    return np.where(ends < len(sums), ends - np.arange(len(words)), 0)


def covered(begin: np.ndarray, long: np.ndarray, n: int) -> np.ndarray:
    """Which of n lines some run holds."""
    edges = np.bincount(begin, minlength=n + 1) - np.bincount(begin + long, minlength=n + 1)
    return np.cumsum(edges)[:n] > 0


def _sequence(docs: DataFrame, least: int, doc_id: str, text: str) -> DataFrame:
    """(pos, h1, h2, need, i, k, at), one row per line; pos is in document order, ``at`` in the document.

    Positions count up in each range partition. One position between documents is
    free: what follows a run inside a document is a line of it, or nothing.
    """
    order = [F.col("i").asc_nulls_last(), F.col("k")]
    # saved, since the sort looks at its input twice
    ordered = saved(_line_ids(docs, doc_id, text), "line-ids").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        last = None
        for batch in batches:
            for i, k, packed in zip(*[batch.column(c).to_pylist() for c in range(3)]):
                if (i, k) == last:  # a row that repeats is the same document
                    continue
                last = (i, k)
                lines = np.frombuffer(packed, np.int64).reshape(-1, 3)
                n = len(lines)
                if not n:
                    continue
                columns = [at + np.arange(n), lines[:, 0], lines[:, 1], lines_needed(lines[:, 2], least)]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c.astype(np.int64)) for c in columns], pa.array([i] * n, pa.int64()), pa.array([k] * n, pa.int64()), pa.array(np.arange(n))],
                    ["pos", "h1", "h2", "need", "i", "k", "at"],
                )
                at += n + 1

    return saved(ordered.mapInArrow(run, "pos long, h1 long, h2 long, need long, i long, k long, at long"), "lines")


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(pos, need, name) of the rows whose keys are not unique; the name is the least position."""
    classes = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("pos").alias("class")).where("n > 1").drop("n")
    return rows.join(classes, keys).select("pos", "need", F.col("class").alias("name"))


def _levels(lines: DataFrame) -> list[DataFrame]:
    """Names of runs of 1, 2, 4, ... lines, as far as any run repeats."""
    levels = [saved(_named(lines.select("pos", "need", "h1", "h2"), ["h1", "h2"]), "names")]
    while not levels[-1].isEmpty():
        names = levels[-1]
        after = names.select((F.col("pos") - (1 << len(levels) - 1)).alias("pos"), F.col("name").alias("next"))
        levels.append(saved(_named(names.join(after, "pos"), ["name", "next"]), "names"))
    return levels[:-1]


def _cut(intervals: DataFrame, names: DataFrame, length: int) -> DataFrame:
    """Intervals with those inside them whose suffixes agree in ``length`` more lines."""
    after = names.select(F.col("pos").alias("end"), F.col("name").alias("next"))
    rows = intervals.withColumn("end", F.col("s") + F.col("m")).join(after, "end", "left").drop("end")
    inside = rows.where("next is not null").groupBy("first", "m", "next").agg(F.min("s").alias("inner"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(inside, ["first", "m", "next"], "left")
    stays = F.when(F.col("inner").isNull() | (F.col("s") == F.col("inner")), F.struct("first", "m"))
    goes = F.when(F.col("inner").isNotNull(), F.struct(F.col("inner").alias("first"), (F.col("m") + length).alias("m")))
    return rows.select("s", "need", F.explode(F.array_compact(F.array(stays, goes))).alias("of")).select("s", "need", "of.first", "of.m")


def common_intervals(lines: DataFrame) -> DataFrame:
    """(s, need, first, m): suffix s shares m lines with the suffix ``first``, the earliest of its interval.

    A suffix that is not the earliest has one row at most, that of the deepest such
    interval. Suffixes whose common lines cannot hold enough words are left out:
    whoever shares enough words with them could not either.
    """
    levels = _levels(lines)
    intervals = lines.select(F.col("pos").alias("s"), "need", F.col("pos").alias("first"), F.lit(0).cast("bigint").alias("m")).where(F.lit(False))
    for level in reversed(range(len(levels))):
        length = 1 << level
        names = levels[level]
        # those in deeper intervals already, but for the earliest of each
        begun = names.select(F.col("pos").alias("s"), "need", F.col("name").alias("first"), F.lit(length).cast("bigint").alias("m"))
        if level + 1 < len(levels):
            begun = begun.join(levels[level + 1].where("pos <> name").select(F.col("pos").alias("s")), "s", "left_anti")
            begun = begun.unionByName(_cut(intervals, names, length))
        rows = saved(begun.where((F.col("need") > 0) & (F.col("need") < F.col("m") + length)), "intervals")
        # a suffix that is left alone in an outer interval can share nothing more there
        later = rows.where("s <> first")
        intervals = later.unionByName(rows.where("s = first").join(later.select("first", "m").distinct(), ["first", "m"], "left_semi").select(later.columns))
    return intervals


def repeated_runs(lines: DataFrame) -> DataFrame:
    """(s, m): the longest run of m lines from position s that also stands earlier, where it has enough words."""
    return common_intervals(lines).where("s <> first and m >= need").select("s", "m")


def without_repeated_lines(docs: DataFrame, keep: list[str], least: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The kept columns of every row, ``kept_text``, ``n_lines`` and ``n_removed``.

    Lines end at a newline; lines without a word are no part of a run, and stay. A
    run of lines that holds at least ``least`` words and also stands earlier, in a
    smaller doc_id or before in the same document, goes; what overlaps goes together.

    Null and empty texts have no lines with a word and come back empty. Null doc_ids
    come last. Rows that share a doc_id are told apart and ordered by a hash of the
    text; rows that agree in both are one document, and neither is a copy of the
    other. Very long texts and lines are read whole. An empty table gives an empty
    result. A kept column with the name of a result column is replaced by it.
    """
    lines = _sequence(docs, least, doc_id, text)
    # one run per line of the document at most
    runs = lines.select(F.col("pos").alias("s"), "i", "k", "at").join(repeated_runs(lines), "s").groupBy("i", "k").agg(F.collect_list(F.struct("at", "m")).alias("runs"))
    removed = runs.select(F.col("i").alias("r_i"), F.col("k").alias("r_k"), F.col("runs.at").alias("begin"), F.col("runs.m").alias("long"))
    names = ["kept_text", "n_lines", "n_removed"]
    keep = [c for c in keep if c not in names]
    rows = docs.select(*[F.col(c).alias(f"k_{j}") for j, c in enumerate(keep)], F.col(doc_id).cast("bigint").alias("i"), text_key(text).alias("k"), F.col(text).cast("string").alias("t"))
    joined = rows.join(removed, match(rows, removed, {"i": "r_i", "k": "r_k"}), "left").drop("i", "k", "r_i", "r_k")
    last = len(keep)
    schema = joined.drop("t", "begin", "long").withColumns({"kept_text": F.lit(""), "n_lines": F.lit(0).cast("bigint"), "n_removed": F.lit(0).cast("bigint")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, last):
                kept, counts, lost = [], [], []
                for whole, begin, long in zip(texts(part.column(last)), part.column(last + 1).to_pylist(), part.column(last + 2).to_pylist()):
                    lines = whole.split(b"\n")
                    numbers = [j for j, x in enumerate(lines) if x and not x.isspace()]
                    counts.append(len(numbers))
                    away: set[int] = set()
                    if begin:
                        gone = covered(np.array(begin), np.array(long), len(numbers))
                        away = set(np.array(numbers)[gone].tolist())
                        lines = [x for j, x in enumerate(lines) if j not in away]
                    kept.append(b"\n".join(lines))
                    lost.append(len(away))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:last], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(lost, pa.int64())],
                    [*part.schema.names[:last], *names],
                )

    return joined.mapInArrow(run, schema).withColumnsRenamed({f"k_{j}": c for j, c in enumerate(keep)})
