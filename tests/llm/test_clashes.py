"""Columns of users with names that operators use, and ties that only the text settles."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from itemflow.llm.chat import rotate
from itemflow.llm.mixing import mix, mixed_documents
from itemflow.llm.simhash import near_duplicates, one_of_each

NAMES = ["fp", "root", "row", "_row", "__row", "__n", "__i", "n", "i", "k", "extra", "whole", "all", "n_words", "n_lines", "kept", "others", "kept_text", "times", "copy", "ids", "round_trip"]


def test_five_turns_with_one_number_follow_their_texts(spark):
    turns = [("c", 1, "ann", f"t{i}") for i in (3, 1, 5, 2, 4)] + [("c", 0, "bob", "first"), ("c", None, "bob", "last")]
    frame = spark.createDataFrame(turns, "conv_id string, turn long, role string, text string").repartition(5)
    for row in rotate(frame).collect():
        said = [line.removesuffix("<|im_end|>") for line in row.text.split("\n")]
        assert [x for x in said if x and not x.startswith("<|im_start|>")] == ["first", "t1", "t2", "t3", "t4", "t5", "last"]


def with_names(frame):
    return frame.withColumns({c: F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in NAMES})


def test_groups_keep_all_columns(documents):
    frame = with_names(documents())
    plain = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in one_of_each(documents()).collect())
    rows = one_of_each(frame).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows) == plain
    for r in rows:
        assert all(r[c] == f"{c}-{'none' if r.doc_id is None else r.doc_id}" for c in NAMES)
    kept = near_duplicates(frame, ["doc_id", "fp", "n_words"])
    assert kept.columns.count("fp") == 1 and dict(kept.dtypes)["fp"] == "bigint" and kept.count() == frame.count()


def test_the_mix_keeps_all_columns(documents):
    frame = with_names(documents())
    rows = mixed_documents(frame).collect()
    assert mixed_documents(frame).columns == frame.columns
    plan = mix(documents()).select("extra", "whole", "n").collect()
    assert len(rows) == sum(r.extra + r.whole * r.n for r in plan)
    for r in rows:
        assert all(r[c] == f"{c}-{'none' if r.doc_id is None else r.doc_id}" for c in NAMES)


def test_stages_keep_all_columns(spark, documents):
    rng = random.Random(1)
    words = [f"word{i}" for i in range(500)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(60)) + ("\n" + "same line " * 12) * (i % 2), "en", f"s{i % 3}", 1) for i in range(80)]
    docs = with_names(documents(rows))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, "")
        assert result.columns == docs.columns, name
        for r in result.collect():
            assert all(r[c] == f"{c}-{r.doc_id}" for c in NAMES), name
