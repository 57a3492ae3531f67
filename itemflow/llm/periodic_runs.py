"""Periodic runs of words: stretches that repeat one passage at least three times over.

The words of some texts are sorted into a suffix array by prefix doubling; the names that
doubling gives to blocks of 8, 16, 32, ... words stay at hand. A run of period q with at
least three periods and 24 words holds a block that is aligned in its text, has about q
words, and occurs again q words later. So each aligned block asks, in the wavelet tree of
the suffix array, where it occurs next in the window of its neighbours (internal pattern
matching). Occurrences within one block's length of each other form a progression: one or
two are candidates as they stand; of three or more only those are, at which the periodic
stretches of both sides begin or end together. Names of blocks tell how far a candidate
period reaches to either side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.llm.common import Words, ranges, slices, texts

LEAST_WORDS = 24
LEAST_PERIODS = 3
# Shortest block: a run of 24 words and a period under 8 holds an aligned one and its next occurrence.
SHORTEST = 3
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


@dataclass
class Suffixes:
    """Suffixes of the words in order, each ending with its text, and names of blocks of 2**k words.

    The name of a block is where the suffixes that begin with it begin in ``order``.
    """

    words: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    order: np.ndarray
    names: dict[int, np.ndarray]


def sorted_suffixes(words: np.ndarray, counts: np.ndarray) -> Suffixes:
    """The suffix array by prefix doubling; suffixes that are settled are not sorted again."""
    n = len(words)
    firsts = np.cumsum(counts) - counts
    begin, end = np.repeat(firsts, counts), np.repeat(firsts + counts, counts)
    order = np.argsort(words, kind="stable")
    rank, open_slots = _regroup(np.arange(n), words[order], order, np.zeros(n, np.int64), np.ones(n, bool))
    names = {}
    level = 0
    while len(open_slots):
        items = order[open_slots]
        after = items + (1 << level)
        inside = after < end[items]
        key = rank[items] * (n + 1) + np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        place = np.argsort(key, kind="stable")
        order[open_slots] = items[place]
        rank, open_slots = _regroup(open_slots, key[place], items[place], rank, inside[place])
        level += 1
        if level >= SHORTEST:
            names[level] = rank.astype(np.int32)
    return Suffixes(words, begin, end, order, names)


def _regroup(
    slots: np.ndarray, keys: np.ndarray, items: np.ndarray, rank: np.ndarray, goes_on: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ranks after a sort, and the slots of items that share their key with another and have not ended."""
    if not len(slots):
        return rank, slots
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(keys)))
    rank = rank.copy()
    rank[items] = np.repeat(slots[heads], sizes)
    return rank, slots[np.repeat(sizes > 1, sizes) & goes_on]


class WaveletTree:
    """Ranges of an array of distinct numbers: how many are below a bound, and the k-th smallest."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros = []
        now = values.astype(np.int32)
        for bit in range(self.bits - 1, -1, -1):
            one = ((now >> bit) & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int32))
            now = np.concatenate([now[~one], now[one]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of values[low:high] are less than the bound."""
        beyond = bound >= 1 << self.bits
        count = np.zeros(len(low), np.int64)
        size = high - low
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            low0, high0 = zeros[low], zeros[high]
            one = ((bound >> bit) & 1).astype(bool)
            count += np.where(one, high0 - low0, 0)
            low = np.where(one, zeros[-1] + low - low0, low0)
            high = np.where(one, zeros[-1] + high - high0, high0)
        return np.where(beyond, size, count)

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest, from 0, of values[low:high]."""
        value = np.zeros(len(low), np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            low0, high0 = zeros[low], zeros[high]
            one = k >= high0 - low0
            k = np.where(one, k - (high0 - low0), k)
            value |= np.where(one, 1 << bit, 0)
            low = np.where(one, zeros[-1] + low - low0, low0)
            high = np.where(one, zeros[-1] + high - high0, high0)
        return value


def agree_after(s: Suffixes, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many words from x on equal those from y on; x < y in one text."""
    far = np.zeros(len(x), np.int64)
    end = s.end[y]
    last = len(s.words) - 1
    for level in sorted(s.names, reverse=True):
        name = s.names[level]
        a, b = np.minimum(x + far, last), np.minimum(y + far, last)
        far += np.where((y + far < end) & (name[a] == name[b]), 1 << level, 0)
    going = np.ones(len(x), bool)
    for _ in range((1 << SHORTEST) - 1):
        a, b = np.minimum(x + far, last), np.minimum(y + far, last)
        going &= (y + far < end) & (s.words[a] == s.words[b])
        far += going
    return far


def agree_before(s: Suffixes, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many words before x equal those before y; x < y in one text."""
    far = np.zeros(len(x), np.int64)
    begin = s.begin[x]
    for level in sorted(s.names, reverse=True):
        name, step = s.names[level], 1 << level
        a, b = np.maximum(x - far - step, 0), np.maximum(y - far - step, 0)
        far += np.where((x - far - step >= begin) & (name[a] == name[b]), step, 0)
    going = np.ones(len(x), bool)
    for _ in range((1 << SHORTEST) - 1):
        a, b = np.maximum(x - far - 1, 0), np.maximum(y - far - 1, 0)
        going &= (x - far - 1 >= begin) & (s.words[a] == s.words[b])
        far += going
    return far


def candidate_periods(s: Suffixes, firsts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and the periods that may begin there, from the blocks' next occurrences."""
    tree = None
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for level, name in sorted(s.names.items()):
        size = 1 << level
        blocks = counts // size
        at = np.repeat(firsts, blocks) + size * ranges(np.zeros(len(blocks), np.int64), blocks)
        sizes = np.bincount(name, minlength=len(name))
        low = name[at].astype(np.int64)
        often = sizes[low] > 1
        at, low = at[often], low[often]
        if not len(at):
            continue
        tree = tree or WaveletTree(s.order)
        high = low + sizes[low]
        windows = [(size, 2 * size)] if level > SHORTEST else [(1, size), (size, 2 * size)]
        for nearest, farthest in windows:
            skipped = tree.below(low, high, at + nearest)
            times = tree.below(low, high, np.minimum(at + farthest, s.end[at])) - skipped
            hit = times > 0
            if not hit.any():
                continue
            x, lo, hi, k, times = at[hit], low[hit], high[hit], skipped[hit], times[hit]
            first = tree.smallest(lo, hi, k)
            found.append((x, first - x))
            more = times > 1
            x, first, times = x[more], first[more], times[more]
            second = tree.smallest(lo[more], hi[more], k[more] + 1)
            two = times == 2
            found.append((x[two], second[two] - x[two]))
            # a progression: the block repeats itself with the step as its period
            x, first, step = x[~two], first[~two], (second - first)[~two]
            ends = first + agree_after(s, first, first + step) - x - agree_after(s, x, x + step)
            begins = first - agree_before(s, first, first + step) - x + agree_before(s, x, x + step)
            for period in (ends, begins):
                fits = (period >= nearest) & (period < farthest) & (x + period < s.end[x])
                found.append((x[fits], period[fits]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def runs_of(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and period; numbers of words over all texts."""
    none = np.zeros((0, 3), np.int64)
    if not len(words):
        return none
    firsts = np.cumsum(counts) - counts
    s = sorted_suffixes(words, counts)
    x, period = candidate_periods(s, firsts, counts)
    if not len(x):
        return none
    y = x + period
    start = x - agree_before(s, x, y)
    end = y + agree_after(s, x, y)
    long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    # the smallest period of a stretch stands first
    rows = np.unique(np.stack([start[long], end[long], period[long]], 1), axis=0)
    smallest = np.ones(len(rows), bool)
    smallest[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[smallest]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _collapsed(words: Words, runs: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(buffer of the words that stay, where each text ends in it)."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    stays = np.cumsum(change[:-1]) == 0
    lengths = np.diff(words.offsets)
    text = np.frombuffer(words.buffer, np.uint8)[np.repeat(stays, lengths)].tobytes() if len(runs) else words.buffer
    total = np.concatenate([[0], np.cumsum(np.where(stays, lengths, 0))])
    return text, total[np.append(words.firsts, len(words))]


def periodic_runs(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, ``n_words``, ``runs`` (start, length, period) and ``collapsed_text``.

    A run is a stretch of 24 words or more with three or more of its smallest period that
    cannot be longer. ``runs`` are in order of start, then period. ``collapsed_text`` has
    all words but those that some run covers after its first period, joined by one space.
    Each row is judged alone, whole, however long its text is, so that ties, repeated rows
    and copies get equal results. A null or empty text has no words, no runs and an empty
    collapsed text. Kept columns with the names of new ones are replaced; an empty table
    gives an empty result.
    """
    keep = [c for c in keep if c not in ("n_words", "runs", "collapsed_text")]
    rows = docs.select(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("t"))
    new = {"n_words": F.lit(0).cast("bigint"), "runs": F.array().cast(RUNS), "collapsed_text": F.lit("")}
    schema = rows.drop("t").withColumns(new).schema
    last = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, last):
                # copies are judged once
                coded = part.column(last).fill_null("").dictionary_encode()
                place = coded.indices.to_numpy()
                words = Words(texts(coded.dictionary))
                codes, _ = words.encoded()
                found = runs_of(codes.astype(np.int64), words.counts)
                buffer, ends = _collapsed(words, found)
                spans = list(zip(ends[:-1].tolist(), ends[1:].tolist()))
                short = pa.array([buffer[a : max(a, b - 1)].decode() for a, b in spans], pa.string())
                owner = np.searchsorted(words.firsts + words.counts, found[:, 0], "right")
                per_text = np.bincount(owner, minlength=len(words.counts))
                values = np.stack([found[:, 0] - words.firsts[owner], found[:, 1] - found[:, 0], found[:, 2]], 1)
                pick = ranges((np.cumsum(per_text) - per_text)[place], per_text[place])
                values = values[pick]
                struct = pa.StructArray.from_arrays([pa.array(values[:, i]) for i in range(3)], ["start", "length", "period"])
                offsets = np.concatenate([[0], np.cumsum(per_text[place])]).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(offsets), struct)
                columns = [*part.columns[:last], pa.array(words.counts[place]), runs, short.take(coded.indices)]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:last], "n_words", "runs", "collapsed_text"])

    return rows.mapInArrow(run, schema).withColumnsRenamed({f"k_{i}": c for i, c in enumerate(keep)})
