"""Personal data, and the terms that give it away.

Addresses, numbers of networks, cards and phones are found by their form; each distinct
value is an entity to protect. Terms are runs of letters. From all documents it is counted
how often a term stands in the neighbourhood of an entity (``NEAR`` terms to either side)
and how often it stands anywhere. What a term tells of an entity is their pointwise mutual
information; what there is to tell is the entity's information content:

    disclosure(c, t) = PMI(c; t) / IC(c) = 1 - log P(c | t) / log P(c)

with P(c | t) the share of the term's places that are near the entity and P(c) the share of
all places that are. A term that discloses ``THRESHOLD`` of some entity to ``SUPPORT``
independent witnesses is replaced wherever it stands: by its longest beginning that, as the
class of all terms that begin so, stays under the threshold for every entity, or by nothing
where there is none.

Neighbourhoods in copies and near copies of one text are no independent witnesses. Equal
ones count once. Of the others, ``SKETCHES`` min-hashes are taken, which near copies mostly
share; the number of witnesses is the mean, over the hashes, of the effective number of
values (the inverse of the chance that two neighbourhoods have the same).
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemflow.llm.common import encoded, saved, slices, word_offsets

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "term")
NEAR = 10
SUPPORT = 3
SKETCHES = 4
THRESHOLD = 0.75
SHORTEST_STEM = 3
# So many terms to replace, of so many characters in all, are handed to every worker; more are joined.
TERMS_HELD, CHARS_HELD = 200_000, 8_000_000
# Bits of the table of terms to replace; it has half a megabyte, whatever the corpus.
TABLE_BITS = 22
SPANS = "array<struct<kind:string,start:bigint,end:bigint,replacement:string>>"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TERM = re.compile("[A-Za-z\x80-\U0010ffff]+")
LOWER = {x: x + 32 for x in range(65, 91)}
# A-Z in lower case; what is no letter separates.
LETTERS = bytes(x + 32 if 65 <= x < 91 else x if 97 <= x < 123 or x >= 128 else 32 for x in range(256))

Span = tuple[int, int, int]


# What is found by its form ------------------------------------------------------


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; time is linear in the text, also in long runs of letters without an @."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        found = DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            done = found.end()
            yield begin, done
        at = text.find("@", max(at + 1, done))


def passes_luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """(start, number of the kind, end) of personal data, in order."""
    found = [(a, 0, b) for a, b in _emails(text)]
    if DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and passes_luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(DIGIT.findall(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def entity(text: str, span: Span) -> str:
    """The value behind a span: spellings of one address or number are one entity."""
    start, kind, end = span
    value = text[start:end]
    if kind in (2, 3):
        value = "".join(DIGIT.findall(value))
    return f"{KINDS[kind]}:{value.translate(LOWER)}"


def masked(text: str, spans: list[Span]) -> str:
    """The text with personal data as zeros, of the same length."""
    parts, done = [], 0
    for start, _, end in spans:
        if end > done:
            start = max(start, done)
            parts += [text[done:start], "0" * (end - start)]
            done = end
    return "".join([*parts, text[done:]])


def sketch(terms: Iterable[str]) -> list[int]:
    """Min-hashes of the terms."""
    return [min((zlib.crc32(x.encode(), seed) for x in terms), default=0) for seed in range(SKETCHES)]


def neighbourhoods(text: str, spans: list[Span]) -> Iterator[tuple[str, int, Counter, list[int]]]:
    """(entity, number of the neighbourhood, its terms, their min-hashes) for each span."""
    terms = [(m.start(), m[0].translate(LOWER)) for m in TERM.finditer(masked(text, spans))]
    starts = [x for x, _ in terms]
    for span in spans:
        a, b = bisect_left(starts, span[0]), bisect_left(starts, span[2])
        near = [x for _, x in [*terms[max(0, a - NEAR) : a], *terms[b : b + NEAR]]]
        place = xxhash.xxh64_intdigest(" ".join(near).encode())
        yield entity(text, span), place - 2**63, Counter(near), sketch(set(near))


# Counts over all documents ------------------------------------------------------


def _plain_texts(column: pa.Array) -> tuple[list[str], list[list[Span]], list[bytes]]:
    """(texts, their spans, texts in bytes with personal data masked)."""
    rows = ["" if x is None else x for x in column.to_pylist()]
    spans = [base_spans(x) for x in rows]
    return rows, spans, [(masked(x, s) if s else x).encode() for x, s in zip(rows, spans)]


def _terms(rows: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(id of each term, distinct terms with a space behind, text of each term)."""
    buffer = b" ".join([*rows, b""]).translate(LETTERS)
    a = np.frombuffer(buffer, np.uint8)
    gap = a == 32
    before = np.concatenate([[True], gap[:-1]])
    packed = a[~gap | ~before].tobytes()
    codes, distinct = encoded(packed, word_offsets(packed))
    ends = np.cumsum([len(x) + 1 for x in rows])
    return codes, distinct, np.searchsorted(ends, np.flatnonzero(~gap & before), "right")


def evidence(docs: DataFrame, text: str) -> DataFrame:
    """(entity, place, term, n, sketch): terms of each neighbourhood of an entity, and, without entity, of all texts."""
    rows = docs.select(F.col(text).cast("string").alias("t"))
    kinds = {"entity": pa.string(), "place": pa.int64(), "term": pa.string(), "n": pa.int64(), "sketch": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                plain, spans, blank = _plain_texts(part.column(0))
                codes, distinct, _ = _terms(blank)
                if len(codes):
                    n = len(distinct)
                    words = pa.array([x[:-1].decode() for x in distinct], pa.string())
                    counts = pa.array(np.bincount(codes, minlength=n), pa.int64())
                    columns = [pa.nulls(n, kinds["entity"]), pa.nulls(n, kinds["place"]), words, counts, pa.nulls(n, kinds["sketch"])]
                    yield pa.RecordBatch.from_arrays(columns, list(kinds))
                near = [
                    (value, place, term, times, hashes)
                    for x, s in zip(plain, spans)
                    if s
                    for value, place, terms, hashes in neighbourhoods(x, s)
                    for term, times in terms.items()
                ]
                if near:
                    columns = [pa.array(x, kind) for x, kind in zip(zip(*near), kinds.values())]
                    yield pa.RecordBatch.from_arrays(columns, list(kinds))

    found = rows.mapInArrow(run, "entity string, place bigint, term string, n bigint, sketch array<bigint>")
    hashes = [F.max(F.get("sketch", F.lit(i))).alias(f"sketch_{i}") for i in range(SKETCHES)]
    # the same neighbourhood in copies of a text is one row; its places all count
    return found.groupBy("entity", "place", "term").agg(F.sum("n").alias("n"), *hashes)


def witnesses(near: DataFrame) -> DataFrame:
    """(entity, term, witnesses) from neighbourhoods: the mean effective number of their min-hashes."""
    hashes = F.posexplode(F.array(*[f"sketch_{i}" for i in range(SKETCHES)])).alias("at", "hash")
    each = near.select("entity", "term", hashes).groupBy("entity", "term", "at", "hash").agg(F.count("*").cast("double").alias("n"))
    effective = F.sum("n") * F.sum("n") / F.sum(F.col("n") * F.col("n"))
    return each.groupBy("entity", "term", "at").agg(effective.alias("effective")).groupBy("entity", "term").agg(F.avg("effective").alias("witnesses"))


def disclosed(near: Column, all_: Column, entity_near: Column, places: Column) -> Column:
    """PMI over information content; null where the entity fills the whole corpus."""
    given = F.least(near / all_, F.lit(1.0))
    content = F.log(entity_near / places)
    return F.when(content < 0, 1 - F.log(given) / content)


def revealing_terms(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT, text: str = "text") -> DataFrame:
    """(term, disclosure, replacement) of the terms to replace; a removed one has an empty replacement."""
    counted = saved(evidence(docs, text), "evidence")
    vocabulary = counted.where("entity is null").select("term", F.col("n").alias("all_n"))
    near = counted.where("entity is not null")
    joint = near.groupBy("entity", "term").agg(F.sum("n").alias("near_n"), F.count("*").alias("places"))
    # one row: how many terms stand in all texts
    total = vocabulary.agg(F.sum("all_n").alias("total_n"))
    entities = near.groupBy("entity").agg(F.sum("n").alias("entity_n")).crossJoin(total)
    known = joint.join(vocabulary, "term").join(entities, "entity")
    told = known.withColumn("disclosure", disclosed(F.col("near_n"), F.col("all_n"), F.col("entity_n"), F.col("total_n")))
    strong = saved(
        told.where((F.col("places") >= support) & (F.col("disclosure") >= threshold)).select("entity", "term", "disclosure"), "strong"
    )
    seen = witnesses(near.join(strong, ["entity", "term"], "left_semi")).where(F.col("witnesses") >= support)
    marked = saved(strong.join(seen, ["entity", "term"]).groupBy("term").agg(F.max("disclosure").alias("disclosure")), "revealing")
    # beginnings of the marked terms, as classes of all terms that begin so
    lengths = F.sequence(F.lit(SHORTEST_STEM), F.greatest(F.char_length("term") - 1, F.lit(SHORTEST_STEM)))
    stems = F.explode(F.transform(lengths, lambda k: F.left(F.col("term"), k))).alias("stem")
    longer = F.char_length("term") > SHORTEST_STEM
    wanted = marked.where(longer).select("term", stems)
    each = wanted.select("stem").distinct()
    class_all = vocabulary.where(longer).select(stems, "all_n").join(each, "stem", "left_semi").groupBy("stem").agg(F.sum("all_n").alias("all_n"))
    class_near = (
        joint.where(longer).select("entity", stems, "near_n").join(each, "stem", "left_semi").groupBy("entity", "stem").agg(F.sum("near_n").alias("near_n"))
    )
    worst = (
        class_near.join(class_all, "stem")
        .join(entities, "entity")
        .groupBy("stem")
        .agg(F.max(disclosed(F.col("near_n"), F.col("all_n"), F.col("entity_n"), F.col("total_n"))).alias("worst"))
        .where(F.col("worst") < threshold)
    )
    general = wanted.join(worst, "stem").groupBy("term").agg(F.max_by("stem", F.char_length("stem")).alias("stem"))
    replacement = F.coalesce(F.concat("stem", F.lit("*")), F.lit(""))
    return marked.join(general, "term", "left").select("term", "disclosure", replacement.alias("replacement"))


# Replacing ------------------------------------------------------------------------


def term_table(terms: DataFrame) -> np.ndarray:
    """A bit for each term: at most 2**16 numbers of 64 bits reach the driver."""
    place = F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit((1 << TABLE_BITS) - 1)).alias("place")
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = terms.select(place).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    table = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
    for row in words.collect():
        table[row.word] = row.bits & (2**64 - 1)
    return table


def _text_key(text: str) -> list[Column]:
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return [F.xxhash64(value).alias("k1"), F.hash(value).alias("k2")]


def term_spans(docs: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """(k1, k2, terms): where the terms to replace stand, by the key of the text."""
    table = term_table(terms)
    if not table.any():
        return docs.sparkSession.createDataFrame([], "k1 bigint, k2 int, terms array<struct<start:bigint,end:bigint,replacement:string>>")
    rows = docs.select(*_text_key(text), F.col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                plain, spans, blank = _plain_texts(part.column(2))
                codes, distinct, owner = _terms(blank)
                places = np.array([zlib.crc32(x[:-1]) for x in distinct], np.int64) & ((1 << TABLE_BITS) - 1)
                maybe = (table[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) > 0
                words = {distinct[k][:-1].decode() for k in np.flatnonzero(maybe).tolist()}
                found = []
                for k in np.unique(owner[maybe[codes]]).tolist():
                    for m in TERM.finditer(masked(plain[k], spans[k])):
                        term = m[0].translate(LOWER)
                        if term in words:
                            found.append((k, m.start(), m.end(), term))
                if found:
                    at, start, end, term = zip(*found)
                    keys = [part.column(i).take(pa.array(at)) for i in range(2)]
                    columns = [*keys, pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(term, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "start", "end", "term"])

    places = rows.mapInArrow(run, "k1 bigint, k2 int, start bigint, end bigint, term string").distinct()
    found = places.join(terms, "term").groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end", "replacement")).alias("terms"))
    return saved(found, "term-spans")


def without_personal_data(
    docs: DataFrame, keep: list[str], threshold: float = THRESHOLD, support: int = SUPPORT, text: str = "text"
) -> DataFrame:
    """The kept columns, ``spans`` (kind, start, end, replacement) and ``clean_text``.

    Spans are in code points, the end exclusive, in order of start and then of kind: email,
    ip, card, phone, term. They cover the whole text; the first four are as found by form
    and may overlap each other, a term overlaps none of them. ``clean_text`` has
    ``[EMAIL]`` and so on in place of personal data and the generalised terms; a removed
    term leaves ``[...]``. Equal texts get equal results, so that ties and repeated rows do
    not matter; copies of a neighbourhood are one witness against a term. A null or empty
    text has no spans and an empty clean text. Very long texts are read whole. Kept columns
    with the names of new ones are replaced; an empty table gives an empty result.
    """
    keep = [c for c in keep if c not in ("spans", "clean_text")]
    terms = saved(revealing_terms(docs, threshold, support, text), "terms")
    own = [*[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("t")]
    size = terms.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.char_length("term")), F.lit(0)).alias("chars")).first()
    if size.n <= TERMS_HELD and size.chars <= CHARS_HELD:
        held = {r.term: r.replacement for r in terms.collect()}
        rows = docs.select(*own, F.lit(None).cast("array<struct<start:bigint,end:bigint,replacement:string>>").alias("terms"))
    else:
        held = {}
        found = term_spans(docs, terms, text)
        rows = docs.select(*own, *_text_key(text)).join(found, ["k1", "k2"], "left").drop("k1", "k2")
    schema = rows.drop("t", "terms").withColumns({"spans": F.array().cast(SPANS), "clean_text": F.lit("")}).schema
    last = len(keep)
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("replacement", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, last):
                plain, found, blank = _plain_texts(part.column(last))
                more = [[(t["start"], 4, t["end"], t["replacement"]) for t in x or []] for x in part.column(last + 1).to_pylist()]
                if held:
                    codes, distinct, owner = _terms(blank)
                    there = np.array([x[:-1].decode() in held for x in distinct], bool)
                    for k in np.unique(owner[there[codes]]).tolist() if len(codes) else []:
                        every = [(m.start(), m.end(), m[0].translate(LOWER)) for m in TERM.finditer(masked(plain[k], found[k]))]
                        more[k] = [(a, 4, b, held[x]) for a, b, x in every if x in held]
                spans, clean = [], []
                for x, base, others in zip(plain, found, more):
                    mine = sorted([*((a, k, b, f"[{KINDS[k].upper()}]") for a, k, b in base), *others])
                    spans.append([{"kind": KINDS[k], "start": a, "end": b, "replacement": r} for a, k, b, r in mine])
                    clean.append(_replaced(x, mine))
                columns = [*part.columns[:last], pa.array(spans, span_type), pa.array(clean, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:last], "spans", "clean_text"])

    return rows.mapInArrow(run, schema).withColumnsRenamed({f"k_{i}": c for i, c in enumerate(keep)})


def _replaced(text: str, spans: list[tuple[int, int, int, str]]) -> str:
    if not spans:
        return text
    parts, done = [], 0
    for start, _, end, replacement in spans:
        if start >= done:
            parts += [text[done:start], replacement or "[...]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])
