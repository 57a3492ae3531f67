import random

import pytest
import xxhash
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# names that operators use for columns of their own
CLASHES = ["kept", "n_words", "size", "t", "i", "k", "ids", "score", "fp", "root", "source_size", "kept_text", "place", "name"]


@pytest.fixture(scope="session", autouse=True)
def work(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("work")))


def text_hash(text):
    """The signed hash that orders documents with one doc_id."""
    value = xxhash.xxh64_intdigest((text or "").encode(), 42) if text is not None else 42
    return value - 2**64 if value >= 2**63 else value


def awkward(seed=3):
    """Documents with nulls, empties, odd spaces, copies, shared passages, repeated rows and a long text."""
    rng = random.Random(seed)
    vocabulary = ["der", "the", "é", "ñandú", "word", "tree", "house", "run", "a", "of", "light", "梦"]
    passage = " ".join(rng.choice(vocabulary) + str(i) for i in range(45))
    texts = []
    for n in (1, 5, 19, 20, 21, 60, 120, 300):
        texts.append(" ".join(rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(n)))
    texts += [f"{texts[5]}\n{passage}\n{texts[3]}", f"{texts[6]} {passage}", passage, texts[7], texts[7], texts[6] + " one more"]
    texts += ["x " * 50, "", " \t\n", None, "a b\x0bc\x0cd\x1ce", "line one\nline one\n\nline two\nline one", "y" * 40_000, " ".join(f"w{i % 977}" for i in range(30_000))]
    rows = [(i, t, "en" if i % 3 else "de", f"src{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, texts[7], None, None, 1), (None, None, None, "src1", None), (2, texts[6], "en", "src9", 2)]
    rows += [rows[6], rows[6], rows[9]]  # rows that repeat
    rng.shuffle(rows)
    return rows


@pytest.fixture
def documents(spark):
    def make(rows=None, clash=False):
        frame = spark.createDataFrame(awkward() if rows is None else rows, DOCUMENTS).repartition(3)
        if clash:
            from pyspark.sql import functions as F

            frame = frame.withColumns({c: F.lit("clash") for c in CLASHES})
        return frame

    return make


def components(nodes, links):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}
