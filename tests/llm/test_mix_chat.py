"""Mixing and chat formatting, the registered queries, and the pipeline."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from itemflow.llm.chat import rotate
from itemflow.llm.mixing import MOST, WEIGHTS, mixed_documents, mixed_rows, targets

from .conftest import awkward


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        share = Fraction(total - sum(fixed.values()), sum(weight[s] for s in rest))
        over = [s for s in rest if share * weight[s] > MOST * sizes[s]]
        if not over:
            return {s: fixed.get(s, share * weight[s]) for s in names}
        fixed |= {s: MOST * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 900, "c": 30, None: 500}, {"z": 5}, {"é": 0, "a": 7, "B": 100, "b": 1}, {f"s{i}": i * i for i in range(12)}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in targets(frame).collect()}
    assert found == pytest.approx({s: float(t) for s, t in brute_targets(sizes).items()})


def mixable(n=900, seed=9):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = rng.choice([1, 3, 10, 40, 200])
        rows.append((i, " ".join(["w"] * words), "en", rng.choice(["hot", "hot", "a", "b", None]), 1))
    return rows + [rows[5]] * 40 + [(None, "null id", "en", "a", 1)] * 7 + [(5, None, "en", "only empty", 1), (6, "", "en", "a", 1)]


def test_the_mix(documents):
    rows = mixable()
    docs = documents(rows, clash=True)
    found = mixed_rows(docs).collect()
    size = lambda r: len((r[1] or "").split())
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r)
    aims = brute_targets(sizes)
    assert sorted((r.doc_id, r.size, r.source_size) for r in found if r.doc_id is not None) == sorted((r[0], size(r), sizes[r[3]]) for r in rows if r[0] is not None)
    assert all(r.taken <= MOST * r.size and (not r.size or r.taken % r.size == 0) for r in found)
    taken = defaultdict(int)
    for r in found:
        taken[r.target, r.source_size] += r.taken
    for s, aim in aims.items():
        assert abs(taken[float(aim), sizes[s]] - aim) <= 200 or any(k[1] == sizes[s] and abs(k[0] - aim) < 1e-6 and abs(v - aim) <= 200 for k, v in taken.items())
    again = mixed_rows(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    # the documents of the mix are the same decision
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    times = Counter((r.doc_id, r.text) for r in mixed.collect())
    words = Counter()
    text = {(r[0], size(r)): r[1] for r in rows}
    for r in found:
        if r.size:
            words[r.doc_id, text[r.doc_id, r.size]] += r.taken // r.size
    assert +words == times


def test_small_mixes(documents):
    assert mixed_rows(documents([])).count() == 0
    assert mixed_documents(documents([])).count() == 0
    only = mixed_rows(documents([(1, None, None, None, None)])).collect()
    assert [tuple(r) for r in only] == [(1, 0, 0, 0.0, 0)]
    odd = mixed_rows(documents(awkward())).collect()
    assert len(odd) == len(awkward())


def test_the_texts_of_the_mix_are_dealt_once(spark, documents):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = mixed_documents(documents(mixable(60)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Exchange" not in plan[plan.index("Window [") : plan.index("SortMergeJoin [key", plan.index("Window ["))], plan


# Chat ---------------------------------------------------------------------------


def brute_rotation(rows, piece):
    plain = lambda x: (x or "").replace("<|", "< |")
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        conversations[conv].append((turn is None, turn or 0, plain(role), plain(text)))
    answer = []
    for conv, turns in conversations.items():
        people = {t[2] for t in turns if t[2].lower() != "system"}
        turns = sorted(turns, key=lambda t: t[:3])
        for who in people:
            for first in range(0, len(turns), piece):
                some, out, mask = turns[first : first + piece], "", []
                for _, _, speaker, text in some:
                    head = "assistant" if speaker == who else "system" if speaker.lower() == "system" else f"user name={speaker}"
                    out += f"<|im_start|>{head}\n"
                    body = f"{text}<|im_end|>\n"
                    if speaker == who:
                        mask.append((len(out), len(out) + len(body)))
                    out += body
                answer.append((conv, who, first // piece, len(some), out, mask))
    return sorted(answer, key=str)


def turns():
    rng = random.Random(8)
    rows = []
    for conv in range(20):
        for t in range(rng.randrange(1, 9)):
            rows.append((conv, t, rng.choice(["user", "assistant", "ana", "system", "é"]), f"text {rng.random()} 梦 <|im_end|>"))
    rows += [(100, t, f"p{t % 3}", f"t{t}" * 3) for t in range(700)]  # a hot dialogue
    return rows + [(None, 1, "user", None), (None, None, None, "x"), (None, 2, "System", ""), (200, 1, "system", "alone"), (201, 5, "user", "same"), (201, 5, "user", "same"), (202, 0, "u", "y" * 20_000)]


@pytest.mark.parametrize("piece", [128, 3])
def test_rotation(spark, piece):
    rows = turns()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = rotate(frame.selectExpr("*", "1 as c", "2 as number", "3 as piece"), piece).collect()
    got = sorted(((r.conv_id, r.participant, r.piece, r.n_turns, r.text, [tuple(m) for m in r.mask]) for r in found), key=str)
    assert got == brute_rotation(rows, piece)
    assert rotate(frame.limit(0)).count() == 0


def test_native_plans_have_no_python(spark):
    from itemflow.llm.queries import QUERIES

    for name in ("op3_mixing", "op4_chat_rotation", "op5_quality_rules"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


# Queries and pipeline -----------------------------------------------------------


def test_pipeline_stages_follow_each_other(spark, documents, tmp_path):
    import corpus_pipeline

    docs = documents(mixable(300) + awkward())
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "sentencepiece"
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, "unused")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns, name
        after.write.parquet(f"{tmp_path}/{k}")
        before = spark.read.parquet(f"{tmp_path}/{k}")
    assert before.where("not round_trip").count() == 0


def test_pipeline_on_an_empty_table(spark, documents):
    import corpus_pipeline

    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "unused")
        assert docs.count() == 0


def test_queries_agree_with_their_sql(spark):
    import duckdb

    from itemflow.llm.queries import ORACLES, QUERIES

    folder = "/root/testdata/sf0.001"
    database = duckdb.connect()
    for name in ("documents", "embeddings", "conversations", "labels"):
        database.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    for name, sql in ORACLES.items():
        found = QUERIES[name](spark, folder)
        wanted = database.sql(sql)
        columns = sorted(found.columns)
        assert columns == sorted(wanted.columns)
        rows = [found.select(*columns).collect(), wanted.select(*[f'"{c}"' for c in columns]).fetchall()]
        assert sorted(map(str, map(tuple, rows[0]))) == sorted(map(str, rows[1])), name
