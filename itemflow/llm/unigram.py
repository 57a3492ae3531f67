"""SentencePiece encoding: the best path through the pieces of a text, and its inverse.

Pieces and their log scores come from a model file. They are kept in a double-array
trie over UTF-8 bytes. A text is cut where no piece reaches across, before each run
of spaces and around newlines; every distinct unit is encoded once, many units at a
time: the Viterbi recurrence runs over an array of units of like length. A character
that no piece spells becomes the pieces of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.llm.common import encoded, slices, texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Longer units are encoded one by one.
TOGETHER_BYTES = 96
KNOWN_UNITS = 200_000
KNOWN: dict[str, dict[bytes, bytes]] = {}


@dataclass
class Trie:
    """``base[s] + byte + 1`` is the next state if ``check`` of it is s; ``leaf`` has piece ids."""

    base: np.ndarray
    check: np.ndarray
    leaf: np.ndarray


def build_trie(pieces: dict[bytes, int]) -> Trie:
    tree: dict = {}
    for piece, id_ in pieces.items():
        node = tree
        for byte in piece:
            node = node.setdefault(byte, {})
        node[-1] = id_
    size = 1 << 16
    base, check, leaf = [np.full(size, -1, np.int32) for _ in range(3)]
    taken = np.zeros(size, bool)
    taken[0] = True
    free = begin = 257  # no slot below ``free`` serves; nodes of several children look from ``begin`` on
    block = np.arange(512)
    todo = [(0, tree)]
    while todo:
        state, node = todo.pop()
        leaf[state] = node.get(-1, -1)
        children = np.array(sorted(x for x in node if x >= 0), np.int64) + 1
        if not len(children):
            base[state] = 0
            continue
        while taken[free]:
            free += 1
        if len(children) == 1 and free + 300 < size:
            at = max(0, free - int(children[0]))
            while taken[at + children[0]]:
                at += 1
            base[state] = at
            taken[at + children[0]] = True
            check[at + children[0]] = state
            todo.append((int(at + children[0]), node[int(children[0]) - 1]))
            continue
        begin = max(begin, free)
        at = max(0, (free if len(children) == 1 else begin) - int(children[0]))
        while True:
            if at + 1200 > size:
                base, check, leaf = [np.concatenate([x, np.full(size, -1, np.int32)]) for x in (base, check, leaf)]
                taken = np.concatenate([taken, np.zeros(size, bool)])
                size *= 2
            able = ~taken[at + block[:, None] + children].any(1)
            if able.any():
                at += int(able.argmax())
                break
            at += len(block)
        if at > begin + 4 * len(block):
            begin = at - 2 * len(block)
        base[state] = at
        taken[at + children] = True
        check[at + children] = state
        todo += [(int(at + c), node[int(c) - 1]) for c in children]
    return Trie(base, check, leaf)


class Unigram:
    """Pieces of a model file; encodes and decodes texts."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.bytes = np.array([model.piece_to_id(f"<0x{x:02X}>") for x in range(256)], np.int32)
        self.fallback = all(model.is_byte(int(i)) for i in self.bytes)
        self.unknown = model.unk_id()
        self.spelled = [b""] * n
        for i in plain:
            self.spelled[i] = names[i].replace(MARK, " ").encode()
        if self.fallback:
            for x in range(256):
                self.spelled[int(self.bytes[x])] = bytes([x])
        self.scores = np.array([model.get_score(i) for i in range(n)], np.float64)
        self.unknown_score = float(self.scores[plain].min()) - UNKNOWN_PENALTY
        pieces = {self.spelled[i]: i for i in plain}
        if any(b" " in x.lstrip(b" ") for x in pieces):
            raise ValueError("a piece reaches over a space behind a word")
        self.cut_lines = not any(b"\n" in x for x in pieces)
        self.trie = build_trie(pieces)
        self.path = path

    @property
    def known(self) -> dict[bytes, bytes]:
        """Ids of units, kept by the worker process for all its tasks."""
        return KNOWN.setdefault(self.path, {})

    # Units ----------------------------------------------------------------------

    def units(self, rows: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """(buffer, where units begin, units per text); a text that is not empty gets a space in front."""
        mark = MARK.encode()
        fronted = [b" " + x.replace(mark, b" ") if x else b"" for x in rows]
        buffer = b"".join(fronted)
        if not buffer:
            return b"", np.zeros(1, np.int64), np.zeros(len(rows), np.int64)
        a = np.frombuffer(buffer, np.uint8)
        lengths = np.fromiter(map(len, fronted), np.int64, len(fronted))
        firsts = np.cumsum(lengths) - lengths
        begin = np.zeros(len(a), bool)
        space = a == 32
        begin[1:] = space[1:] & ~space[:-1]
        if self.cut_lines:
            line = a == 10
            begin |= line
            begin[1:] |= line[:-1]
        begin[firsts[lengths > 0]] = True
        starts = np.flatnonzero(begin)
        counts = np.diff(np.searchsorted(starts, np.append(firsts, len(a))))
        return buffer, np.append(starts, len(a)), counts

    def encode_units(self, distinct: list[bytes]) -> list[bytes]:
        """The ids of each unit, as native 32-bit integers in bytes."""
        known = self.known
        if len(known) > KNOWN_UNITS:
            known.clear()
        new = [x for x in distinct if x not in known]
        short = sorted((x for x in new if len(x) <= TOGETHER_BYTES), key=len)
        for first in range(0, len(short), 8_000):
            some = short[first : first + 8_000]
            known.update(zip(some, self._many(some)))
        long = {x: self._one(x).tobytes() for x in new if len(x) > TOGETHER_BYTES}
        return [long[x] if len(x) > TOGETHER_BYTES else known[x] for x in distinct]

    def _many(self, units: list[bytes]) -> list[bytes]:
        """Viterbi over all units at once. Of equal scores the longest first piece wins."""
        n, width = len(units), max(map(len, units))
        lengths = np.fromiter(map(len, units), np.int64, n)
        text = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in units), np.uint8).reshape(n, width)
        leads = (text & 0xC0) != 0x80
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        piece = np.full((n, width + 1), -1, np.int32)
        origin = np.zeros((n, width + 1), np.int32)
        base, check, leaf = self.trie.base, self.trie.check, self.trie.leaf
        char = np.where(text < 0x80, 1, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4)))
        for i in range(width):
            here = np.flatnonzero((lengths > i) & leads[:, i])
            if not len(here):
                continue
            rows, state = here, np.zeros(len(here), np.int32)
            single = np.zeros(n, bool)
            for j in range(i, width):
                inside = lengths[rows] > j
                rows, state = rows[inside], state[inside]
                after = base[state] + text[rows, j] + 1
                going = check[after] == state
                rows, state = rows[going], after[going]
                if not len(rows):
                    break
                found = leaf[state]
                ends = found >= 0
                r, p = rows[ends], found[ends]
                single[r[char[r, i] == j + 1 - i]] = True
                score = best[r, i] + self.scores[p]
                better = score > best[r, j + 1]
                r, p = r[better], p[better]
                best[r, j + 1], piece[r, j + 1], origin[r, j + 1] = score[better], p, i
            lost = here[~single[here]]
            if len(lost):
                end = i + char[lost, i]
                score = best[lost, i] + self.unknown_score
                better = score > best[lost, end]
                lost, end = lost[better], end[better]
                best[lost, end], piece[lost, end], origin[lost, end] = score[better], -1, i
        # back from the end of every unit
        at = lengths.copy()
        steps = []
        rows = np.arange(n)
        while len(rows):
            p, o = piece[rows, at[rows]], origin[rows, at[rows]]
            steps.append((rows, p, o.astype(np.int64), at[rows]))
            at[rows] = o
            rows = rows[o > 0]
        rows, p, o, e = [np.concatenate(x[::-1]) for x in zip(*steps)]
        order = np.lexsort((o, rows))
        rows, p, o, e = rows[order], p[order], o[order], e[order]
        if (p < 0).any():
            times = np.where(p < 0, e - o if self.fallback else 1, 1)
            spread = np.repeat(np.arange(len(p)), times)
            inside = np.arange(len(spread)) - np.repeat(np.cumsum(times) - times, times)
            raw = self.bytes[text[rows[spread], np.minimum(o[spread] + inside, width - 1)]] if self.fallback else self.unknown
            p = np.where(p[spread] < 0, raw, p[spread]).astype(np.int32)
            rows = rows[spread]
        ids = p.astype(np.int32).tobytes()
        ends = np.cumsum(np.bincount(rows, minlength=n)) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _one(self, unit: bytes) -> np.ndarray:
        """Viterbi over one unit, however long."""
        n = len(unit)
        base, check, leaf = self.trie.base, self.trie.check, self.trie.leaf
        best, piece, origin = [float("-inf")] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            if unit[i] & 0xC0 == 0x80:
                continue
            char = 1 if unit[i] < 0x80 else 2 if unit[i] < 0xE0 else 3 if unit[i] < 0xF0 else 4
            state, single = 0, False
            for j in range(i, n):
                after = int(base[state]) + unit[j] + 1
                if check[after] != state:
                    break
                state = after
                p = int(leaf[state])
                if p >= 0:
                    single |= j + 1 - i == char
                    score = best[i] + float(self.scores[p])
                    if score > best[j + 1]:
                        best[j + 1], piece[j + 1], origin[j + 1] = score, p, i
            if not single and best[i] + self.unknown_score > best[i + char]:
                best[i + char], piece[i + char], origin[i + char] = best[i] + self.unknown_score, -1, i
        ids: list[int] = []
        end = n
        while end:
            start = origin[end]
            if piece[end] >= 0:
                ids.append(piece[end])
            elif self.fallback:
                ids += [int(self.bytes[x]) for x in reversed(unit[start:end])]
            else:
                ids.append(self.unknown)
            end = start
        return np.array(ids[::-1], np.int32)

    # Texts ----------------------------------------------------------------------

    def encode(self, rows: list[bytes]) -> list[bytes]:
        buffer, offsets, counts = self.units(rows)
        codes, distinct = encoded(buffer, offsets)
        pieces = self.encode_units(distinct)
        ends = np.cumsum(counts).tolist()
        return [b"".join([pieces[k] for k in codes[a:b].tolist()]) for a, b in zip([0, *ends[:-1]], ends)]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text: bytes of the pieces, without the space that encoding put in front."""
        return self.spell(ids).decode(errors="replace")

    def spell(self, ids: list[int] | np.ndarray) -> bytes:
        spelled = self.spelled
        return b"".join([spelled[i] for i in ids]).removeprefix(b" ")


def encode_documents(docs: DataFrame, model: str, keep: list[str], text: str = "text", check: bool = False) -> DataFrame:
    """The kept columns and ``ids``, the piece ids of the whole text.

    With ``check``, also ``round_trip``: the ids, decoded again, give the text. The same
    worker encodes and decodes, so that one model is held per core.

    Null and empty texts have no ids. The marker character in a text counts as a
    space, as it does in the format. Very long texts, also without a space, are
    encoded whole. Equal scores are settled by position, so that rows that repeat
    get the same ids. Kept columns named ``ids`` or, with ``check``, ``round_trip`` are
    replaced; an empty table gives an empty result.
    """
    new = {"ids": F.array().cast("array<int>")} | ({"round_trip": F.lit(True)} if check else {})
    keep = [c for c in keep if c not in new]
    rows = docs.select(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("t"))
    schema = rows.drop("t").withColumns(new).schema
    last, names = len(keep), list(new)

    unigram = Unigram(model)  # goes to the tasks as it is: its size is that of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, last):
                plain = texts(part.column(last))
                ids = unigram.encode(plain)
                ends = np.cumsum([0, *map(len, ids)]) // 4
                values = np.frombuffer(b"".join(ids), np.int32)
                columns = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))]
                if check:
                    columns.append(pa.array([unigram.spell(np.frombuffer(i, np.int32).tolist()) == x for i, x in zip(ids, plain)], pa.bool_()))
                yield pa.RecordBatch.from_arrays([*part.columns[:last], *columns], [*part.schema.names[:last], *names])

    return rows.mapInArrow(run, schema).withColumnsRenamed({f"k_{i}": c for i, c in enumerate(keep)})


def decode_documents(encoded_docs: DataFrame, model: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """The kept columns and ``decoded``, the text of the ids; null ids give an empty text."""
    keep = [c for c in keep if c != "decoded"]
    rows = encoded_docs.select(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)], F.col(ids).alias("i"))
    schema = rows.drop("i").withColumn("decoded", F.lit("")).schema
    last = len(keep)

    unigram = Unigram(model)  # goes to the tasks as it is: its size is that of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                column = part.column(last)
                values = column.flatten().to_numpy()
                counts = np.array([0 if x is None else x for x in pc.list_value_length(column).to_pylist()], np.int64)
                ends = np.cumsum(counts).tolist()
                decoded = [unigram.decode(values[a:b].tolist()) for a, b in zip([0, *ends[:-1]], ends)]
                yield pa.RecordBatch.from_arrays([*part.columns[:last], pa.array(decoded, pa.string())], [*part.schema.names[:last], "decoded"])

    return rows.mapInArrow(run, schema).withColumnsRenamed({f"k_{i}": c for i, c in enumerate(keep)})
