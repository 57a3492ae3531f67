"""From raw documents to token ids: each stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemflow.llm.common import saved, table
from itemflow.llm.line_dedup import without_repeated_lines
from itemflow.llm.mixing import mixed_documents
from itemflow.llm.quality import CUTOFF, quality_verdicts
from itemflow.llm.simhash import one_of_each
from itemflow.llm.unigram import encode_documents


READ = ("doc_id", "text", "lang", "source", "n_chars")


def packed(docs: DataFrame) -> DataFrame:
    """The columns that stages read, and all others in one struct, so that no operator meets their names."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in READ]
    return docs.select(*READ, F.struct(*others).alias("others")) if others else docs.select(*READ)


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the documents in their order."""
    return rows.select(*[F.col(c) if c in READ else F.col(f"others.`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows = packed(docs)
    return unpacked(quality_verdicts(rows, rows.columns, CUTOFF).where("kept"), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of runs of lines."""
    rows = packed(docs)
    kept = without_repeated_lines(rows, [c for c in rows.columns if c != "text"])
    changed = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("bigint")}
    return unpacked(kept.withColumns(changed), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs, words=3, most=2)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document stands as many times as it is taken."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with whether they decode to its text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    ids = encode_documents(docs, model, ["doc_id", "lang", "source", "n_chars"], check=True)
    return ids.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_copies),
    ("mixing to target weights", mixture),
    ("sentencepiece", tokens),
]

# No SQL for robust outliers, SimHash or the mix; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
