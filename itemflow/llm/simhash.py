"""SimHash near-duplicates found through deletion variants of fingerprint halves.

Two 64-bit fingerprints that differ in at most two bits differ in at most one bit
of one of their two halves. So each half is indexed under its 32 variants with one
bit taken out; fingerprints that share a variant are candidates, joined by equality
and verified by their distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.llm.common import free_name, saved, slices, texts
from itemflow.llm.components import connected_components

SEED = 42
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Fingerprints of one variant that are compared with each other; a variant with more of them
# goes the other way, which is exact as well and needs no comparison.
COMPARED = 64


def fingerprint(text: bytes, words: int, seed: int = SEED) -> int:
    """Majority of the bits of all shingle hashes; 0 for a text without words."""
    parts = text.translate(LOWER).split()
    if not parts:
        return 0
    size = min(words, len(parts))
    whole = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(parts) - size + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(whole[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for first in range(0, n, 100_000):
        bits = np.unpackbits(hashes[first : first + 100_000].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, keep: list[str], words: int, text: str = "text") -> DataFrame:
    """The kept columns and the fingerprint of every row, as a signed long ``fp``."""
    rows = docs.select(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("t"))
    schema = rows.drop("t").withColumn("fp", F.lit(0).cast("bigint")).schema
    last = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, last):
                prints = np.array([fingerprint(x, words) for x in texts(part.column(last))], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns[:last], pa.array(prints)], [*part.schema.names[:last], "fp"])

    return rows.mapInArrow(run, schema).withColumnsRenamed({f"k_{i}": c for i, c in enumerate(keep)})


def _variants(prints: DataFrame) -> DataFrame:
    """(key, fp): 64 keys of each fingerprint. A key names the half, the bit taken out and the rest."""
    fp = F.col("fp")
    halves = [fp.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(fp, 32)]
    keys = [
        (F.lit((half * 32 + bit) << 32).bitwiseOR(value.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << bit)))))
        for half, value in enumerate(halves)
        for bit in range(32)
    ]
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and fingerprints of sorted batches; a run that a batch cuts goes on in the next.

    What is held back of a cut run is bounded: of a run beyond the bound the
    fingerprints are passed on as they come, with a few of them in front as a sign
    that the run is long.
    """
    keys = np.zeros(0, np.int64)
    prints = np.zeros(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        prints = np.concatenate([prints, batch.column(1).to_numpy()])
        cut = int(np.searchsorted(keys, keys[-1]))
        yield keys[:cut], prints[:cut]
        if len(keys) - cut > COMPARED:
            yield keys[cut:], prints[cut:]
            cut = len(keys) - COMPARED - 1
        keys, prints = keys[cut:], prints[cut:]
    yield keys, prints


def _links(prints: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the fingerprints of one variant under the distance bound."""
    parent = list(range(len(prints)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    values = prints.view(np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= most
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        a, b = root(int(i)), root(int(j))
        if a != b:
            parent[b] = a
            yield int(prints[i]), int(prints[j])


def linked(prints: DataFrame, most: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints that differ in at most two bits.

    Enough of them to connect what is connected; not every pair. A variant with
    very many fingerprints hands them on: there each fingerprint names itself and
    the 64 values one bit away, two fingerprints differ in at most two bits exactly
    if they name a common value, and a value has at most 65 fingerprints around it.
    """
    if not 0 <= most <= 2:
        raise ValueError("two halves and one bit serve distances up to 2")
    variants = _variants(prints).repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, values in _runs(batches):
            found: list[tuple[int, int | None]] = []
            if len(keys) > 1:
                starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                sizes = np.diff(np.append(starts, len(keys)))
                for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                    members = values[start : start + size]
                    if size > COMPARED:
                        found += [(int(x), None) for x in members]
                    else:
                        found += _links(members, most)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    found = saved(variants.mapInArrow(run, "a long, b long"), "links")
    crowded = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    flips = [F.col("fp"), *([F.col("fp").bitwiseXOR(F.lit(_signed(1 << bit))) for bit in range(64)] if most == 2 else [])]
    centres = crowded.select("fp", F.explode(F.array(*flips)).alias("centre"))
    if most == 1:
        wild = [F.struct(F.lit(bit).alias("bit"), F.col("fp").bitwiseAND(F.lit(_signed(~(1 << bit) & (2**64 - 1)))).alias("rest")) for bit in range(64)]
        centres = crowded.select("fp", F.explode(F.array(*wild)).alias("centre"))
    around = centres.groupBy("centre").agg(F.collect_list("fp").alias("all"))  # at most 65
    star = around.where(F.size("all") > 1).select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b")
    return found.where("b is not null").unionByName(star)


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def near_duplicates(docs: DataFrame, keep: list[str], words: int = 3, most: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The kept columns of every row, ``fp``, ``root`` (the least fingerprint that it reaches)
    and ``component_id`` (the least doc_id that it reaches).

    Null text is empty. A text without words has fingerprint zero, linked like any
    other; one shorter than a shingle is one shingle. Texts are read whole. Copies
    and repeated rows share a fingerprint and so a component. Null doc_ids have
    fingerprints but never name a component, unless all of its doc_ids are null:
    then component_id is null. An empty table gives an empty result. Columns that
    are not kept are not looked at; kept ones with the names of new ones are replaced.
    """
    names = [c for c in dict.fromkeys([doc_id, *keep]) if c not in ("fp", "root", "component_id")]
    marked = saved(with_fingerprints(docs, names, words, text), "fingerprints")
    prints = marked.groupBy("fp").agg(F.min(doc_id).alias("least"))
    groups = connected_components(linked(prints.select("fp"), most)).withColumnsRenamed({"a": "fp", "b": "root"})
    rooted = prints.join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # only fingerprints with links meet: a lone one is its own component
    shared = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.select("fp", "root").join(shared, "root")
    return marked.join(labels, "fp")


def one_of_each(docs: DataFrame, words: int = 3, most: int = 2) -> DataFrame:
    """The documents with one row of each near-duplicate group, that of the least doc_id.

    Of rows that share the least doc_id the first by place stays; of a group without
    doc_ids the first by place; rows that repeat are such copies. All columns are
    returned as they are, whatever their names; an empty table gives an empty result.
    """
    row = free_name(docs, "row")
    kept = saved(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    marked = near_duplicates(kept, [row], words, most)
    able = marked.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = able.groupBy("root").agg(F.min(row).alias(row))
    return kept.join(first.select(row), row, "left_semi").drop(row)
