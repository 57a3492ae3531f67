"""Exact removal of repeated word windows through super-k-mers.

A window is a run of consecutive words. Its minimiser is the least hash among its
short word groups. Consecutive windows with one minimiser overlap in all but a word,
so they travel together as one packed string, to the bucket of that minimiser: equal
windows have equal minimisers and meet there. In a bucket the windows are sorted,
and in each run of equal windows all but the earliest are later copies.

Hot groups: word groups that very many windows choose are found first and then
chosen only where a window has nothing else, so that what surrounds a common passage
is spread over many buckets. Copies inside a batch are settled where they are read,
and one representative travels on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.llm.common import Words, encoded, match, ranges, saved, slices, text_key, texts, word_offsets

GROUP = 3
# Words aimed at per bucket.
BUCKET_WORDS = 400_000
# A word group is hot if it is chosen by more than this share of all super-k-mers: so there
# are fewer than 20,000 of them, 8 bytes each.
HOT_SHARE = 1 / 20_000
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
RANGE = "array<struct<a:bigint,b:bigint>>"


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX[0]
    return x ^ (x >> np.uint64(29))


def word_hashes(words: Words) -> np.ndarray:
    ids, distinct = words.encoded()
    hashes = np.fromiter((xxhash.xxh64_intdigest(x) for x in distinct), np.uint64, len(distinct))
    return hashes[ids]


def _least_of(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` consecutive values, by doubling."""
    reach = 1
    while 2 * reach <= size:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = size - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def super_kmers(words: Words, size: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, number of words, minimiser) of each super-k-mer."""
    nothing = np.zeros(0, np.int64)
    if len(words) < size:
        return nothing, nothing, nothing, nothing.astype(np.uint64)
    h = word_hashes(words)
    groups = h[: len(h) - GROUP + 1].copy()
    for k in range(1, GROUP):
        groups = _scrambled(groups) + h[k : len(h) - GROUP + 1 + k] * MIX[k]
    groups = _scrambled(groups) >> np.uint64(1)
    if len(hot):
        place = np.minimum(np.searchsorted(hot, groups), len(hot) - 1)
        groups |= (hot[place] == groups).astype(np.uint64) << np.uint64(63)
    least = _least_of(groups, size - GROUP + 1)
    able = np.maximum(words.counts - size + 1, 0)
    windows = ranges(words.firsts, able)
    row = np.repeat(np.arange(len(able)), able)
    chosen = least[windows]
    first = np.ones(len(windows), bool)
    first[1:] = (row[1:] != row[:-1]) | (chosen[1:] != chosen[:-1])
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(windows))) + size - 1
    return row[starts], windows[starts], lengths, chosen[starts] & np.uint64(2**63 - 1)


def _hot_groups(docs: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Minimisers with a large share of all super-k-mers, and the number of words."""
    empty = np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                words = Words(texts(part.column(0)))
                chosen = super_kmers(words, size, empty)[3]
                values, counts = np.unique(chosen, return_counts=True)
                many = counts > max(2, HOT_SHARE * len(chosen) / 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(values[many].view(np.int64), -1)),
                        pa.array(np.append(counts[many], len(chosen)).astype(np.int64)),
                        pa.array(np.append(np.zeros(many.sum(), np.int64), len(words))),
                    ],
                    ["value", "n", "words"],
                )

    counts = docs.select("t").mapInArrow(run, "value long, n long, words long").groupBy("value").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    counts = saved(counts, "minimisers")
    total = counts.where("value = -1").first()
    if total is None:
        return empty, 0
    hot = counts.where((F.col("value") >= 0) & (F.col("n") > HOT_SHARE * total.n)).select("value").toPandas()
    return np.sort(hot["value"].to_numpy().astype(np.uint64)), total.words


def _sent(docs: DataFrame, size: int, hot: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, meta, words, done): packed super-k-mers, or settled ranges, of a batch and bucket.

    meta has four longs per super-k-mer: doc_id is null, doc_id, text key, first word
    in the text; a fifth has the number of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            seen: dict[bytes, tuple[int, int, int, int]] = {}
            bucket_of: dict[bytes, int] = {}
            done: list[tuple[int, int, int, int, int]] = []
            for part in slices(batch, 2):
                null = part.column(0).is_null().to_numpy(False).astype(np.int64)
                ids = part.column(0).fill_null(0).to_numpy()
                keys = part.column(1).to_numpy()
                words = Words(texts(part.column(2)))
                rows, starts, lengths, least = super_kmers(words, size, hot)
                places = (starts - words.firsts[rows]).tolist() if len(rows) else []
                begins = words.offsets[starts].tolist()
                ends = words.offsets[starts + lengths].tolist()
                homes = (_scrambled(least) % np.uint64(buckets)).tolist()
                for null_, id_, key, place, begin, end, home, n in zip(null[rows].tolist(), ids[rows].tolist(), keys[rows].tolist(), places, begins, ends, homes, lengths.tolist()):
                    packed = words.buffer[begin:end]
                    here = (null_, id_, key, place)
                    known = seen.get(packed)
                    if known is None:
                        seen[packed] = here
                        bucket_of[packed] = home
                    elif here != known:
                        if here < known:
                            seen[packed] = here
                            here = known
                        done.append((*here, n))
            yield from _packed(seen, bucket_of, packer)
            if done:
                settled = np.array(done, np.int64)
                home = settled[:, 2].view(np.uint64) % np.uint64(buckets)
                order = np.argsort(home, kind="stable")
                cuts = np.flatnonzero(np.diff(home[order])) + 1
                groups = np.split(order, cuts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(home[g[0]]) for g in groups], pa.int32()),
                        pa.array([settled[g].tobytes() for g in groups], pa.binary()),
                        pa.nulls(len(groups), pa.binary()),
                    ],
                    ["bucket", "meta", "words"],
                )

    return docs.mapInArrow(run, "bucket int, meta binary, words binary")


def _packed(seen: dict, bucket_of: dict, packer: zstandard.ZstdCompressor) -> Iterator[pa.RecordBatch]:
    strings = list(seen)
    homes = np.fromiter(bucket_of.values(), np.int64, len(strings))
    meta = np.array(list(seen.values()), np.int64).reshape(-1, 4)
    counts = np.fromiter((x.count(b" ") for x in strings), np.int64, len(strings))
    meta = np.column_stack([meta, counts])
    order = np.argsort(homes, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(homes[order])) + 1) if len(order) else []
    for first in range(0, len(groups), 64):
        some = groups[first : first + 64]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(homes[g[0]]) for g in some], pa.int32()),
                pa.array([meta[g].tobytes() for g in some], pa.binary()),
                pa.array([packer.compress(b"".join([strings[i] for i in g.tolist()])) for g in some], pa.binary()),
            ],
            ["bucket", "meta", "words"],
        )


def later_windows(buffer: bytes, meta: np.ndarray, size: int) -> np.ndarray:
    """Rows (null, doc_id, key, first word, words) covered by windows that also start earlier."""
    offsets = word_offsets(buffer)
    ids, distinct = encoded(buffer, offsets)
    word_firsts = np.cumsum(meta[:, 4]) - meta[:, 4]
    # in order of position, so that the first of equal windows is the earliest
    order = np.lexsort((meta[:, 3], meta[:, 2], meta[:, 1], meta[:, 0]))
    meta, word_firsts = meta[order], word_firsts[order]
    able = meta[:, 4] - size + 1
    windows = ranges(word_firsts, able)
    owner = np.repeat(np.arange(len(meta)), able)
    inside = ranges(np.zeros(len(able), np.int64), able)
    codes = _scrambled(np.arange(1, len(distinct) + 1, dtype=np.uint64) * MIX[1])[ids]
    powers = np.cumprod(np.full(len(codes) + 1, MIX[0], np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers[:-1])])
    # scaled to the same power, the difference of prefix sums names the window
    named = (sums[windows + size] - sums[windows]) * powers[len(codes) - windows]
    rank = np.argsort(named, kind="stable")
    equal = named[rank[1:]] == named[rank[:-1]]
    a, b = windows[rank[:-1][equal]], windows[rank[1:][equal]]
    for k in range(size):
        if not np.array_equal(ids[a + k], ids[b + k]):  # two windows with one name: sort the words themselves
            rank = np.lexsort((np.arange(len(windows)), *[ids[windows + j] for j in range(size)]))
            equal = np.ones(len(rank) - 1, bool)
            for j in range(size):
                equal &= ids[windows[rank[1:]] + j] == ids[windows[rank[:-1]] + j]
            break
    run = np.concatenate([[0], np.cumsum(~equal)])
    heads = np.concatenate([[0], np.flatnonzero(~equal) + 1])
    head = rank[heads[run]]
    # a row that repeats has the position of its first; neither comes earlier
    same_text = (meta[owner[head], :3] == meta[owner[rank], :3]).all(1)
    same = same_text & (meta[owner[head], 3] + inside[head] == meta[owner[rank], 3] + inside[rank])
    later = np.zeros(len(windows), bool)
    later[rank] = ~same
    starts = later.copy()
    starts[1:] &= ~(later[:-1] & (owner[1:] == owner[:-1]))
    ends = later.copy()
    ends[:-1] &= ~(later[1:] & (owner[1:] == owner[:-1]))
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    found = meta[owner[s]].copy()
    found[:, 3] += inside[s]
    found[:, 4] = e - s + size
    return found


def _counted(sent: DataFrame, size: int) -> DataFrame:
    def run(key: tuple, group: pa.Table) -> pa.Table:
        done, meta, parts = [], [], []
        opener = zstandard.ZstdDecompressor()
        for m, w in zip(group.column("meta"), group.column("words")):
            rows = np.frombuffer(m.as_buffer(), np.int64).reshape(-1, 5)
            if w.is_valid:
                meta.append(rows)
                parts.append(opener.decompress(w.as_buffer()))
            else:
                done.append(rows)
        if meta:
            done.append(later_windows(b"".join(parts), np.concatenate(meta), size))
        rows = np.concatenate(done)
        return pa.table(
            {
                "r_id": pa.array(rows[:, 1], mask=rows[:, 0] == 1),
                "r_key": pa.array(rows[:, 2]),
                "a": pa.array(rows[:, 3]),
                "b": pa.array(rows[:, 3] + rows[:, 4]),
            }
        )

    return sent.groupBy("bucket").applyInArrow(run, "r_id long, r_key long, a long, b long")


def repeated_ranges(docs: DataFrame, size: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(r_id, r_key, removed): word ranges of each document covered by windows that also start earlier."""
    slim = docs.select(F.col(doc_id).cast("bigint").alias("i"), text_key(text).alias("k"), F.col(text).cast("string").alias("t"))
    hot, words = _hot_groups(slim, size)
    buckets = max(256, -(-words // BUCKET_WORDS))
    found = _counted(_sent(slim, size, hot, buckets), size)
    return found.groupBy("r_id", "r_key").agg(F.collect_list(F.struct("a", "b")).alias("removed"))


def without_repeats(docs: DataFrame, size: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): every row without later copies of word windows.

    A word goes if a window of ``size`` words covers it whose words also start
    earlier: in a smaller doc_id, or before in the same document. Windows are judged
    on the input. Kept words are joined by one space.

    Null and empty texts have no words. Null doc_ids come last. Rows that share a
    doc_id are told apart and ordered by a hash of the text; rows that agree in both
    are one document, and neither is a copy of the other. Texts are read whole. An
    empty table gives an empty result; other columns are not looked at.
    """
    removed = repeated_ranges(docs, size, doc_id, text)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("i"), text_key(text).alias("k"), F.col(text).cast("string").alias("t"))
    joined = rows.join(removed, match(rows, removed, {"i": "r_id", "k": "r_key"}), "left").select("i", "t", "removed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                n_words, n_removed, kept = [], [], []
                for whole, gone in zip(texts(part.column(1)), part.column(2).to_pylist()):
                    words = whole.split()
                    n_words.append(len(words))
                    if gone:
                        stays = np.zeros(len(words) + 1, np.int64)
                        for x in gone:
                            stays[x["a"]] += 1
                            stays[x["b"]] -= 1
                        stays = np.cumsum(stays)[:-1] == 0
                        words = [words[j] for j in np.flatnonzero(stays).tolist()]
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_text"],
                )

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")
