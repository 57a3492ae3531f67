"""Collocations: phrases whose words stand together far more often than apart.

Texts are cut into shards. Over the word ids of a shard stands an FM-index in both
directions: suffixes sorted as deep as phrases are extended, the word before each (the
Burrows-Wheeler transform), and the same of the reversed words. Phrases are intervals of
it. An interval is extended by every word to its left, which gives the interval of each
longer phrase and, in step with it, that of the reversed phrase; from there it is extended
to the right. The counts of a shard are sums over its own words; Spark adds them up.

Phrases of three words are enumerated in a second pass, only where both pairs in them are
frequent in the whole corpus. A bit table of fixed size tells so; a pair it takes for
frequent by chance costs a row, and no result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemflow.llm.common import encoded, ranges, saved, slices, texts, word_offsets

# Text indexed together.
SHARD_BYTES = 8_000_000
# Bits of the table of frequent pairs; it has two megabytes, whatever the corpus.
TABLE_BITS = 24
# Intervals of so many words are extended: phrases have one word more.
DEPTH = 2
SALTS = 64
BREAKS = b".,;:!?\n\x0b\x0c\r"
PLAIN = bytes.maketrans(bytes(range(65, 91)) + BREAKS + b"\t", bytes(range(97, 123)) + b"\n" * len(BREAKS) + b" ")


@dataclass
class Pieces:
    """Ids of the words of some texts, from 1, with a 0 after each piece, and the word of each id."""

    ids: np.ndarray
    words: pa.Array


def pieces_of(rows: list[bytes]) -> Pieces:
    buffer = (b"\n".join(rows) + b"\n").translate(PLAIN)
    a = np.frombuffer(buffer, np.uint8)
    gap = (a == 32) | (a == 10)
    before = np.concatenate([[True], gap[:-1]])
    # a word is what stands before the first gap behind it; further gaps only count as breaks
    packed = np.where(gap, np.uint8(32), a)[~gap | ~before].tobytes()
    starts = np.flatnonzero(~gap & before)
    codes, distinct = encoded(packed, word_offsets(packed))
    if not len(codes):
        return Pieces(np.zeros(0, np.int64), pa.array([], pa.string()))
    lines = np.cumsum(a == 10)
    piece = lines[starts]
    ends = np.append(piece[1:] != piece[:-1], True)
    place = np.arange(len(codes)) + np.concatenate([[0], np.cumsum(ends)[:-1]])
    ids = np.zeros(len(codes) + int(ends.sum()), np.int64)
    ids[place] = codes.astype(np.int64) + 1
    return Pieces(ids, pa.array([b"", *[x[:-1] for x in distinct]], pa.binary()).cast(pa.string()))


class Index:
    """One direction of the FM-index, sorted by the first ``DEPTH`` words of each suffix."""

    def __init__(self, ids: np.ndarray, symbols: int):
        # DEPTH words: the first and the one after it
        order = np.argsort(ids * symbols + np.append(ids[1:], 0))
        self.bwt = ids[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=symbols))])
        self.symbols = symbols

    def extend(self, low: np.ndarray, high: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
        """All phrases one word longer than those of the intervals.

        Returns (number of the interval, word, count, begin of the longer phrase's
        interval in the other direction); ``other`` has the begins of the given intervals
        there. Separators extend nothing.
        """
        sizes = high - low
        owner = np.repeat(np.arange(len(low)), sizes)
        key = np.sort(owner * self.symbols + self.bwt[ranges(low, sizes)])
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        counts = np.diff(np.append(heads, len(key)))
        owner, word = key[heads] // self.symbols, key[heads] % self.symbols
        # in the other direction, smaller words come first
        before = np.cumsum(sizes) - sizes
        there = other[owner] + heads - before[owner]
        real = word > 0
        return owner[real], word[real], counts[real], there[real]


class Phrases:
    """Phrases of a shard, as ids of their words with their counts."""

    def __init__(self, pieces: Pieces):
        symbols = len(pieces.words)
        self.words = pieces.words
        self.ids = pieces.ids
        self.forward = Index(pieces.ids, symbols)
        low, high = self.forward.first[1:-1], self.forward.first[2:]
        self.single = (np.arange(1, symbols), high - low)
        # pairs: every word extended to the left
        owner, left, count, there = self.forward.extend(low, high, low)
        self.pairs = (left, owner + 1, count)
        self.pair_begins = there

    def keys(self, lang: str, *ids: np.ndarray) -> pa.Array:
        """The words of each phrase joined by spaces, then a line break, which no word holds, and the language."""
        parts = [self.words.take(pa.array(i)) for i in ids[:-1]]
        last = pc.binary_join_element_wise(self.words, pa.scalar(lang), "\n").take(pa.array(ids[-1]))
        return pc.binary_join_element_wise(*parts, last, " ") if parts else last

    def triples(self, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
        """Wanted pairs extended to the right by words with which they form a wanted pair again."""
        left, right, count = self.pairs
        backward = Index(self.ids[::-1], self.forward.symbols)
        low = self.pair_begins[wanted]
        owner, word, times, _ = backward.extend(low, low + count[wanted], low)
        symbols = self.forward.symbols
        first, second = left[wanted][owner], right[wanted][owner]
        known = np.sort((left * symbols + right)[wanted])
        pair = second * symbols + word
        place = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
        good = known[place] == pair if len(known) else np.zeros(0, bool)
        return first[good], second[good], word[good], times[good]


def _shards(docs: DataFrame, lang: str, text: str, enumerate_phrases) -> DataFrame:
    """(key, n) of the phrases of each shard, not yet added up."""
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ordered = batch.take(pc.sort_indices(batch.column(0)))
            for part in slices(ordered, 1, SHARD_BYTES):
                for value in pc.unique(part.column(0)).to_pylist():
                    pieces = pieces_of(texts(part.filter(pc.equal(part.column(0), value)).column(1)))
                    if len(pieces.ids):
                        for keys, counts in enumerate_phrases(value, Phrases(pieces)):
                            yield pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64())], ["key", "n"])

    return rows.mapInArrow(run, "key string, n bigint")


def _added_up(shards: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, n) of single words, and of longer phrases with n >= least."""
    total = shards.groupBy("key").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | ~F.col("key").rlike("^[^\n]* "))
    phrase = F.substring_index("key", "\n", 1)
    lang = F.expr("substring(key, char_length(substring_index(key, '\n', 1)) + 2)")
    words = (F.char_length(phrase) - F.char_length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1).alias("words")
    return total.select(lang.alias("lang"), words, phrase.alias("phrase"), "n")


def _singles_and_pairs(lang: str, found: Phrases):
    word, count = found.single
    yield found.keys(lang, word), count
    left, right, count = found.pairs
    yield found.keys(lang, left, right), count


def _triples(table: np.ndarray):
    def enumerate_phrases(lang: str, found: Phrases):
        left, right, _ = found.pairs
        keys = found.keys(lang, left, right).cast(pa.binary()).to_pylist()
        place = np.fromiter(map(zlib.crc32, keys), np.int64, len(keys)) & ((1 << TABLE_BITS) - 1)
        frequent = (table[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0
        *words, count = found.triples(frequent)
        yield found.keys(lang, *words), count

    return enumerate_phrases


def frequent_table(pairs: DataFrame) -> np.ndarray:
    """A bit for each frequent pair: at most 2**18 numbers of 64 bits reach the driver."""
    key = F.concat_ws("\n", "phrase", "lang")
    place = F.crc32(key.cast("binary")).bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = pairs.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    table = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
    for row in words.collect():
        table[row.word] = row.bits & (2**64 - 1)
    return table


def phrase_counts(docs: DataFrame, least: int = 10, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, n) of phrases of one to three words with n >= least, (lang, n) of all words).

    Two passes over the texts; the counts are whole sums over all shards.
    """
    short = saved(_added_up(_shards(docs, lang, text, _singles_and_pairs), least), "phrases")
    totals = short.where("words = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    common = short.where(F.col("n") >= least)
    table = frequent_table(common.where("words = 2"))
    long = saved(_added_up(_shards(docs, lang, text, _triples(table)), least), "phrases")
    return common.unionByName(long), totals


def _exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in decimal numbers; counts stay under 10**15."""
    a, left, right = [x.cast("decimal(15,0)") for x in (a, left, right)]
    million = F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", million * (a * a), left * right)


def collocations(docs: DataFrame, most: int = 2000, least: int = 10, lang: str = "lang", text: str = "text") -> DataFrame:
    """The ``most`` best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts in lower-case A-Z are split at ``.,;:!?`` and line breaks into pieces, and these
    at spaces and tabs into words. A phrase is two or three words that stand ``least``
    times or more in a row within pieces: ``a`` times. ``l`` and ``r`` count its two parts,
    cut where the score, the floor of 1000000 * a * a / (l * r), is lowest (of equal ones
    after the first word). A phrase is dropped if a longer one that holds its words in a row
    has half its count or more. Ties in score are broken by a, then by the phrase in byte
    order. ``n`` counts the words of the language. A null language is ``und``; a null or
    empty text has no words; rows that repeat count as often as they stand; other columns
    are not read, whatever their names; an empty table gives an empty result. Texts of any
    length are indexed whole.
    """
    counts, totals = phrase_counts(docs, least, lang, text)
    # a phrase with its parts: (first words, last words) of every cut
    word = F.split("phrase", " ")
    parts = counts.select("lang", "phrase", "words", F.col("n").alias("a"), word.alias("w")).where("words > 1")
    cuts = parts.select(
        "*", F.explode(F.when(F.col("words") == 2, F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2)))).alias("k")
    ).select(
        "lang", "phrase", "words", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("last"),
    )
    known = counts.select("lang", "phrase", "n")
    lefts = known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rights = known.select("lang", F.col("phrase").alias("last"), F.col("n").alias("r"))
    scored = cuts.join(lefts, ["lang", "first"]).join(rights, ["lang", "last"])
    scored = scored.withColumn("score", _exact_score(F.col("a"), F.col("l"), F.col("r")))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    phrases = scored.groupBy("lang", "phrase", "words", "a").agg(lowest)
    # the most frequent longer phrase around each pair
    around = (
        cuts.where("words = 3")
        .select("lang", "a", F.when(F.col("k") == 1, F.col("last")).otherwise(F.col("first")).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    kept = phrases.join(around, ["lang", "phrase"], "left").where("longer is null or words = 3 or 100 * longer < 50 * a")
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first the best of parts of each language, then the best of these
    salted = flat.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= most)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
