"""Token-id files: one zstandard frame per document, a seek table at the end.

A file is a row of independent frames, each the ids of one document as little-endian
unsigned 32-bit integers; then a skippable frame with the doc_ids; then, as the last
frame, the seek table of the seekable zstandard format, with sizes and a checksum for
each frame. Any zstandard reader can read a file through; a reader that wants some
documents reads the two tables and decompresses only their frames.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemflow.llm.common import Words, new_folder, ranges, saved, slices, texts

# Fixed values of the seekable zstandard format.
SEEK_MAGIC = 0x184D2A5E
SEEK_END = 0x8F92EAB1
CHECKSUMS = 0x80
# A skippable frame of our own: the doc_ids.
IDS_MAGIC = 0x184D2A50
END_ID = 1
# Remembered by a worker, about 200 bytes each: common words are not encoded again and again.
KNOWN_WORDS = 1_200_000
# Signs that end a word as a unit of their own.
STOPS = b".,;:!?"


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file named by Spark."""
    if re.match(r"[a-z0-9]+:", uri):
        # Spark's names of S3 are its own
        return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", uri)))
    return fs.LocalFileSystem(), uri


class WordEncoder:
    """Ids of words. The tokenizer drops white space and splits at it, so that the ids of a
    text are those of its words, and each distinct word is encoded once.

    A word of ASCII letters is one unit, in lower case, and goes to the merges of the
    tokenizer at once; other words go through all of it, many together where each is one
    unit, which the marks of word ends tell.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, id_ in vocabulary.items():
            self.ends[id_] = piece.endswith("</w>")
        self.stops: dict[bytes, bytes] = {b"": b""}
        self.known: dict[bytes, bytes] = {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, distinct: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian bytes. Words end in one space."""
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        other = []
        merge = self.tokenizer.model.tokenize
        for x in distinct:
            if x in known:
                continue
            word = x[:-1]
            stem = word.rstrip(STOPS)
            if not stem.isalpha():
                other.append(x)
                continue
            stop = word[len(stem) :]
            if stop not in self.stops:
                self.stops[stop] = self._encode([stop.decode()])[0].tobytes()
            known[x] = b"".join([t.id.to_bytes(4, "little") for t in merge(stem.lower().decode())]) + self.stops[stop]
        if len(self.stops) > 10_000:
            self.stops = {b"": b""}
        single = [x for x in other if x[:-1].decode().isalpha()]
        for first in range(0, len(single), 1000):
            some = single[first : first + 1000]
            ids = self._encode(["".join([x.decode() for x in some])])[0]
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(ends) == len(some):  # each is one unit at least, so each is just one
                raw = ids.tobytes()
                known.update((x, raw[a:b]) for x, a, b in zip(some, [0, *ends[:-1].tolist()], ends.tolist()))
        alone = [x for x in other if x not in known]
        for first in range(0, len(alone), 1000):
            some = alone[first : first + 1000]
            known.update(zip(some, (x.tobytes() for x in self._encode([x.decode() for x in some]))))
        return [known[x] for x in distinct]

    def documents(self, rows: list[bytes]) -> Iterator[bytes]:
        words = Words(rows)
        codes, distinct = words.encoded()
        pieces = self.words(distinct)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        firsts = np.cumsum(lengths) - lengths
        values = np.frombuffer(b"".join(pieces), "<u4")
        raw = values[ranges(firsts[codes], lengths[codes])].tobytes()
        sums = np.concatenate([[0], np.cumsum(lengths[codes])]) * 4
        end = struct.pack("<I", END_ID)
        for a, b in zip(sums[words.firsts].tolist(), sums[words.firsts + words.counts].tolist()):
            yield raw[a:b] + end


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a worker process."""
    return WordEncoder(path)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text and write the files; (part, path, n_docs, n_ids) of each file, in order.

    Files follow each other in ascending doc_id, and documents inside a file do. Only
    files listed in the result count: one that a lost task left behind has another name.

    Null and empty texts have the end id alone. Null doc_ids come last. Rows that share
    a doc_id are written each, ordered by a hash of the text. Texts are encoded whole.
    An empty table gives no files. Other columns are not looked at.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    # texts are sorted, not ids: the sort looks at its input twice
    rows = slim.select("doc_id", F.xxhash64("t").alias("k"), F.monotonically_increasing_id().alias("place"), "t")
    order = [F.col("doc_id").asc_nulls_last(), F.col("k"), F.col("place")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        packer = zstandard.ZstdCompressor(level=3, write_checksum=True)
        out, entries, ids, nulls = None, [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                system, root = place(folder)
                system.create_dir(root, recursive=True)
                task = TaskContext.get()
                path = f"{root}/{task.partitionId():07d}-{task.taskAttemptId()}.tok"
                out = system.open_output_stream(path)
            for part in slices(batch, 1):
                for raw in encoder.documents(texts(part.column(1))):
                    frame = packer.compress(raw)
                    out.write(frame)
                    entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            nulls.append(batch.column(0).is_null().to_numpy(False).astype(np.uint8))
            ids.append(batch.column(0).fill_null(0).to_numpy())
        if out is None:
            return
        table = np.concatenate(ids).astype("<i8").tobytes() + np.concatenate(nulls).tobytes()
        out.write(struct.pack("<II", IDS_MAGIC, len(table)) + table)
        seek = np.array(entries, "<u4").tobytes() + struct.pack("<IBI", len(entries), CHECKSUMS, SEEK_END)
        out.write(struct.pack("<II", SEEK_MAGIC, len(seek)) + seek)
        out.close()
        uri = f"{folder.rstrip('/')}/{os.path.basename(path)}"
        rows = [[task.partitionId()], [uri], [len(entries)], [sum(x[1] for x in entries) // 4]]
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1]), *[pa.array(x, pa.int64()) for x in rows[2:]]], ["part", "path", "n_docs", "n_ids"])

    return saved(ordered.mapInArrow(run, "part int, path string, n_docs long, n_ids long"), "files")


class TokenFile:
    """One file, open for reading; decompresses the frames that are asked for."""

    def __init__(self, uri: str):
        system, path = place(uri)
        self.source = system.open_input_file(path)
        size = self.source.size()
        n, flags, end = struct.unpack("<IBI", self._at(size - 9, 9))
        if end != SEEK_END or flags != CHECKSUMS:
            raise ValueError(f"{uri} has no seek table")
        table = size - 9 - 12 * n
        self.entries = np.frombuffer(self._at(table, 12 * n), "<u4").reshape(n, 3)
        self.starts = np.cumsum(self.entries[:, 0], dtype=np.int64) - self.entries[:, 0]
        raw = self._at(table - 8 - 9 * n, 9 * n)
        self.ids = np.frombuffer(raw[: 8 * n], "<i8")
        self.null = np.frombuffer(raw[8 * n :], np.uint8).astype(bool)
        self.opener = zstandard.ZstdDecompressor()

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def __len__(self) -> int:
        return len(self.entries)

    def frame(self, i: int) -> bytes:
        """The ids of document i as bytes; raises if the checksum differs."""
        packed, size, checksum = (int(x) for x in self.entries[i])
        ids = self.opener.decompress(self._at(int(self.starts[i]), packed), max_output_size=size)
        if len(ids) != size or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} is damaged")
        return ids

    def documents(self, wanted: Iterable[int]) -> dict[int, np.ndarray]:
        """The ids of the wanted documents that the file holds."""
        found = np.flatnonzero(np.isin(self.ids, list(wanted)) & ~self.null)
        return {int(self.ids[i]): np.frombuffer(self.frame(int(i)), "<u4") for i in found}


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files.

    ``start``: ids of all documents before it. Frames are read one at a time.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    # a number, so that files of few rows are not read by one task
    partitions = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = placed.select("path", "base").repartition(partitions, "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source = TokenFile(path)
                sums = [zlib.crc32(source.frame(i)) for i in range(len(source))]
                sizes = source.entries[:, 1].astype(np.int64) // 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(source.ids, mask=source.null), pa.array(base + np.cumsum(sizes) - sizes), pa.array(sizes), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
