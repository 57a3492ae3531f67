"""Toxicity of texts that hide their words.

Words written in leetspeak, with letters set apart or repeated, are restored first: a
word is a lattice of what each of its characters may stand for, and the best path
under a character language model and the costs of the noise is taken. The model is
counted over the whole corpus. Then the restored text is scored: words, and
beginnings of words, that mark toxic documents are learned from labels. A mark
has to explain documents that no stronger mark explains, or to stand beside many
different words: so words that merely stand beside a mark in copies of one text are
not learned.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.llm.common import Words, saved, slices, texts

# What a character may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = " .-_*~'’·,/\\"
EDGES = ".,;:!?*%&#()[]{}<>\"'`~^=_-|/\\…«»“”„’"
# Log costs of the channel: a character stands for another, a repetition, a separator that means nothing.
COSTS = {"itself": -2.5, "replaced": -0.7, "kept_run": -3.0, "dropped_run": -0.7, "kept_separator": -1.5, "dropped_separator": -0.7}
CLASSES = 64
# Labelled documents learned from, the first by a hash of their id, and lengths of word beginnings.
TRAIN_DOCUMENTS = 20_000
BEGINNINGS = (4, 5, 6, 7)
LEAST_SUPPORT = 3
LEAST_PRECISION = 0.6
# Marks that explain nothing new: different neighbours, and precision, that they need.
LEAST_CONTEXTS = 6
SURE = 0.9
KNOWN_WORDS = 300_000


def class_table() -> bytes:
    """Class of each byte: 0 for a space, 1 to 26 for letters, 27 other signs, 28 digits, then bytes of other letters."""
    table = []
    for b in range(256):
        c = chr(b)
        if c in " \t\n\x0b\x0c\r":
            table.append(0)
        elif c.isascii() and c.isalpha():
            table.append(ord(c.lower()) - ord("a") + 1)
        elif c.isascii():
            table.append(28 if c.isdigit() else 27)
        else:
            table.append(29 + (b & 31))
    return bytes(table)


TABLE = class_table()


def character_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n): trigrams of character classes over all texts; at most CLASSES ** 3 rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                codes = np.frombuffer((b"  " + b"  ".join(texts(part.column(0))) + b"  ").translate(TABLE), np.uint8).astype(np.int32)
                counts += np.bincount(codes[:-2] * CLASSES**2 + codes[1:-1] * CLASSES + codes[2:], minlength=CLASSES**3)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["gram", "n"])

    grams = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "gram long, n long")
    return grams.groupBy("gram").agg(F.sum("n").alias("n"))


class CharacterModel:
    """Log probability of a character class after two others, backed off to one and none."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        three = np.zeros(CLASSES**3)
        three[grams] = counts
        three = three.reshape(CLASSES, CLASSES, CLASSES)
        two, one = three.sum(0), three.sum((0, 1))
        p1 = (one + 1) / (one.sum() + CLASSES)
        p2 = (two + 20 * p1) / (two.sum(1, keepdims=True) + 20)
        p3 = (three + 20 * p2[None]) / (three.sum(2, keepdims=True) + 20)
        self.log = np.log(p3).astype(np.float32)

    def decode(self, word: str) -> str:
        """The best reading of a noisy word: Viterbi over (last two classes), of ties the first found.

        Paths share their beginnings, so that time and memory grow with the length alone.
        """
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for options in chain(_lattice(word), [[(" ", 0.0)]]):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in states.items():
                for reading, cost in options:
                    x, y, total = a, b, score + cost
                    for byte in reading.encode():
                        c = TABLE[byte]
                        total += float(self.log[x, y, c])
                        x, y = y, c
                    known = after.get((x, y))
                    if known is None or total > known[0]:
                        after[x, y] = (total, (path, reading))
            states = after
        path, readings = max(states.values(), key=lambda s: s[0])[1], []
        while path is not None:
            path, reading = path
            readings.append(reading)
        return "".join(reversed(readings)).strip()


def _lattice(word: str) -> Iterator[list[tuple[str, float]]]:
    """For each run of one character its readings and their costs."""
    i = 0
    while i < len(word):
        c = word[i]
        n = 1
        while i + n < len(word) and word[i + n] == c:
            n += 1
        i += n
        readings: list[tuple[str, float]] = []
        if c in STANDS_FOR:
            readings += [(s * k, COSTS["replaced"] + (COSTS["dropped_run"] if k < n else 0)) for s in STANDS_FOR[c] for k in {1, min(n, 2)}]
            readings.append((c * n, COSTS["itself"] * n))
        elif c in SEPARATORS:
            readings += [("", COSTS["dropped_separator"]), (" ", COSTS["kept_separator"])]
        elif n > 2:
            readings += [(c, COSTS["dropped_run"]), (c * 2, COSTS["dropped_run"]), (c * n, COSTS["kept_run"])]
        else:
            readings.append((c * n, 0.0))
            if n == 2:
                readings.append((c, COSTS["kept_run"]))
        yield readings


ALL_TWICE = re.compile(r"(?:(.)\1+){2,}", re.DOTALL)


def noisy(word: str) -> bool:
    """Letters together with signs that may stand for letters or part them, nothing but such
    signs (other than digits alone), a run of one letter, or every letter repeated."""
    if word.isalpha():
        return any(a == b == c for a, b, c in zip(word, word[1:], word[2:])) or ALL_TWICE.fullmatch(word) is not None
    if len(word) < 3:
        return False
    return any(map(str.isalpha, word)) or (not word.isdigit() and all(c in STANDS_FOR for c in word))


class Restorer:
    """Words as they are meant; remembers a bounded number of them."""

    def __init__(self, model: CharacterModel):
        self.model = model
        self.known: dict[bytes, tuple[str, ...]] = {}

    def __call__(self, raw: bytes) -> tuple[str, ...]:
        found = self.known.get(raw)
        if found is None:
            if len(self.known) > KNOWN_WORDS:
                self.known.clear()
            whole = raw.decode().lower().strip()
            word = whole.strip(EDGES)
            if noisy(word):
                found = tuple(dict.fromkeys([*self.model.decode(word).split(), *[x for x in [word.strip(EDGES)] if x.isalpha()]]))
            else:
                found = (word,) if word else ()
            # a sign in front may be a letter
            front = whole.find(word) - 1 if word else -1
            if front >= 0 and whole[front] in STANDS_FOR:
                found = tuple(dict.fromkeys([*found, *self.model.decode(whole[front] + word).split()]))
            self.known[raw] = found
        return found


def spaced_words(words: Words) -> list[tuple[int, bytes]]:
    """(text, letters set apart by spaces) where three or more single characters, or ASCII
    characters twice, follow each other; whole runs of any length."""
    if not len(words):
        return []
    sign = np.frombuffer(words.buffer, np.uint8)
    starts = words.offsets[:-1]
    # bytes that begin a character; the space after each word is one
    begins = np.add.reduceat((sign & 0xC0) != 0x80, starts, dtype=np.int64)
    twice = (np.diff(words.offsets) == 3) & (sign[starts] == sign[np.minimum(starts + 1, len(sign) - 1)])
    single = (begins == 2) | twice
    if not single.any():
        return []
    row = np.repeat(np.arange(len(words.counts)), words.counts)
    edge = np.ones(len(single) + 1, bool)
    edge[1:-1] = (single[1:] != single[:-1]) | (row[1:] != row[:-1])
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    long = single[starts] & (ends - starts >= 3)
    return [(int(row[s]), words.buffer[words.offsets[s] : words.offsets[e]]) for s, e in zip(starts[long], ends[long])]


def marks_of(word: str) -> list[str]:
    """The word, and its beginnings with a star."""
    return [word, *[f"{word[:n]}*" for n in BEGINNINGS if len(word) > n]]


def _restored(rows: list[bytes], restore: Restorer) -> Iterator[tuple[int, list[str]]]:
    """(text, restored words) for each distinct word of a text, in any order."""
    words = Words(rows)
    codes, distinct = words.encoded()
    for i, (first, n) in enumerate(zip(words.firsts.tolist(), words.counts.tolist())):
        for code in np.unique(codes[first : first + n]).tolist():
            yield i, restore(distinct[code])
    for i, letters in spaced_words(words):
        yield i, restore(letters)


def learn(sample: DataFrame, model: CharacterModel) -> tuple[dict[str, float], float]:
    """(probability that a document with a mark is toxic, probability without any mark).

    ``sample``: t, toxic; a bounded number of documents. Marks are counted where the
    texts are. Then marks are chosen one by one: the one that marks most of the toxic
    documents not yet explained.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        for batch in batches:
            counts: Counter[tuple[str, int]] = Counter()
            for part in slices(batch, 0):
                toxic = part.column(1).to_pylist()
                marks = defaultdict(set)
                for i, found in _restored(texts(part.column(0)), restore):
                    for word in found:
                        marks[i].update(marks_of(word))
                for i, names in marks.items():
                    counts.update((name, toxic[i]) for name in names)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int64()), pa.array(counts.values(), pa.int64())], ["mark", "toxic", "n"])

    tallies = sample.mapInArrow(count, "mark string, toxic long, n long").groupBy("mark").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("neg")
    )
    able = tallies.where((F.col("pos") >= LEAST_SUPPORT) & (F.col("pos") >= LEAST_PRECISION * (F.col("pos") + F.col("neg"))))
    tally = {r.mark: (r.pos, r.neg) for r in saved(able, "marks").toLocalIterator()}
    totals = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        for batch in batches:
            ids = batch.column(2).to_pylist()
            at = 0
            for part in slices(batch, 0):
                rows = set(_marked_places(texts(part.column(0)), restore, tally))
                yield pa.RecordBatch.from_arrays([pa.array([ids[at + i] for i, _, _ in rows], pa.int64()), pa.array([m for _, m, _ in rows], pa.string()), pa.array([x for _, _, x in rows], pa.int64())], ["doc", "mark", "beside"])
                at += part.num_rows

    toxic_rows = sample.where("toxic = 1").withColumn("doc", F.monotonically_increasing_id())
    places = saved(toxic_rows.mapInArrow(occurrences, "doc long, mark string, beside long"), "places")
    contexts = {r.mark: r.n for r in places.groupBy("mark").agg(F.countDistinct("beside").alias("n")).toLocalIterator()}
    toxic_docs = [set(r.marks) for r in places.groupBy("doc").agg(F.collect_set("mark").alias("marks")).toLocalIterator()]
    return choose(toxic_docs, tally, contexts, totals.get(0, 0), totals.get(1, 0))


def _marked_places(rows: list[bytes], restore: Restorer, tally: dict) -> Iterator[tuple[int, str, int]]:
    """(text, mark, hash of the word before it) of all words with marks under discussion."""
    words = Words(rows)
    codes, distinct = words.encoded()
    marks = [[m for word in restore(raw) for m in marks_of(word) if m in tally] for raw in distinct]
    row = np.repeat(np.arange(len(words.counts)), words.counts)
    for i, place in zip(row.tolist(), range(len(codes))):
        if found := marks[codes[place]]:
            before = distinct[codes[place - 1]] if place > words.firsts[i] else b""
            for mark in found:
                yield i, mark, zlib.crc32(before)
    for i, letters in spaced_words(words):
        for word in restore(letters):
            yield from ((i, m, zlib.crc32(letters)) for m in marks_of(word) if m in tally)


def choose(toxic_docs: list[set[str]], tally: dict[str, tuple[int, int]], contexts: dict[str, int], clean: int, toxic: int) -> tuple[dict[str, float], float]:
    """Marks and their weights, and the weight of a text without marks.

    First those that explain most of the toxic documents. Then, of the others, those
    that stand beside many different words: what is only copied along always has the
    same neighbours.
    """
    where = defaultdict(set)
    for i, marks in enumerate(toxic_docs):
        for mark in marks:
            where[mark].add(i)
    precision = {m: (pos + 0.5) / (pos + neg + 1) for m, (pos, neg) in tally.items()}
    chosen: dict[str, float] = {}
    left = {m: set(x) for m, x in where.items()}
    while left:
        # of equal marks the longest says most exactly what it is
        best = max(left, key=lambda m: (len(left[m]) * precision[m] ** 4, len(m), m))
        if len(left[best]) < LEAST_SUPPORT:
            break
        chosen[best] = precision[best]
        explained = left.pop(best)
        for mark in {m for i in explained for m in toxic_docs[i]}:
            if mark in left:
                left[mark] -= explained
                if len(left[mark]) < LEAST_SUPPORT:
                    del left[mark]
    # a beginning adds nothing to a longer mark that is nearly all of it
    longer: dict[str, int] = defaultdict(int)
    for mark in sorted(contexts, key=len, reverse=True):
        pos, stem = tally[mark][0], mark.rstrip("*")
        sure = contexts[mark] >= max(LEAST_CONTEXTS, pos / 4) and precision[mark] >= SURE
        if mark in chosen or sure and (stem == mark or longer[stem] < 0.9 * pos):
            chosen[mark] = precision[mark]
            for k in range(1, len(stem)):
                longer[stem[:k]] = max(longer[stem[:k]], pos)
    missed = sum(1 for marks in toxic_docs if not marks & chosen.keys()) + max(0, toxic - len(toxic_docs))
    return chosen, min(0.25, (missed + 0.5) / (missed + clean + 1))


def toxicity(docs: DataFrame, labels: DataFrame, keep: list[str], train: int = TRAIN_DOCUMENTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The kept columns of every row, ``held_out``, ``score`` (0 to 1) and ``predicted``.

    Learned from at most ``train`` labelled documents, the first by a hash of their
    id, of those whose id has not the remainder 2 in crc32 modulo 4; held_out tells
    which ids have it. A score sees the text alone. The character model is counted
    over all documents.

    Null and empty texts have the score of a text without marks. Null ids are not
    held out and have no label; null labels are left out, ids labelled twice count
    twice. Texts are read whole. Empty tables, or no toxic label, give no marks.
    A kept column with the name of a result column is replaced by it.
    """
    names = ["held_out", "score", "predicted"]
    keep = [c for c in keep if c not in names]
    grams = saved(character_counts(docs, text), "grams").toPandas()
    model = CharacterModel(grams["gram"].to_numpy(np.int64), grams["n"].to_numpy(np.int64))
    held = lambda c: F.coalesce(F.crc32(F.col(c).cast("string")) % 4 == 2, F.lit(False))
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held("doc_id"))
    first = usable.select(F.col("doc_id").alias("l"), F.col("toxic").cast("bigint").alias("toxic"), F.xxhash64("doc_id").alias("h")).orderBy("h", "l", "toxic").limit(train)
    ids = F.broadcast(saved(first, "sample"))  # at most ``train`` rows of three numbers
    sample = docs.join(ids, F.col(doc_id) == F.col("l")).select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"), "toxic")
    weights, base = learn(saved(sample, "training"), model)

    rows = docs.select(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)], held(doc_id).alias("h"), F.col(text).cast("string").alias("t"))
    last = len(keep) + 1
    schema = rows.drop("h", "t").withColumns({"held_out": F.lit(True), "score": F.lit(0.0), "predicted": F.lit(0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        marked: dict[bytes, tuple[str, ...]] = {}

        def marks(raw: bytes) -> tuple[str, ...]:
            found = marked.get(raw)
            if found is None:
                if len(marked) > KNOWN_WORDS:
                    marked.clear()
                found = marked[raw] = tuple(m for word in restore(raw) for m in marks_of(word) if m in weights)
            return found

        for batch in batches:
            for part in slices(batch, last):
                words = Words(texts(part.column(last)))
                codes, distinct = words.encoded()
                flagged = np.zeros(len(distinct), bool)
                for j, word in enumerate(distinct):
                    if marks(word):
                        flagged[j] = True
                hits = np.flatnonzero(flagged[codes]) if len(codes) else np.zeros(0, np.int64)
                found: dict[int, set[str]] = defaultdict(set)
                row = np.searchsorted(words.firsts + words.counts, hits, "right")
                for i, code in zip(row.tolist(), codes[hits].tolist()):
                    found[i].update(marks(distinct[code]))
                for i, letters in spaced_words(words):
                    found[i].update(marks(letters))
                score = np.full(part.num_rows, base)
                for i, names_ in found.items():
                    if names_:
                        score[i] = 1 - math.prod(1 - weights[m] for m in sorted(names_))
                yield pa.RecordBatch.from_arrays([*part.columns[: last - 1], part.column(last - 1), pa.array(score), pa.array((score >= 0.3).astype(np.int32))], [*part.schema.names[: last - 1], *names])

    return rows.mapInArrow(run, schema).withColumnsRenamed({f"k_{i}": c for i, c in enumerate(keep)})
