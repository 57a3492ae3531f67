"""Substring, line, SimHash and vector dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from itemflow.llm.common import table
from itemflow.llm.components import connected_components
from itemflow.llm.line_dedup import common_intervals, lines_needed, without_repeated_lines
from itemflow.llm.nn_descent import near_vectors
from itemflow.llm.simhash import fingerprint, linked, near_duplicates, one_of_each
from itemflow.llm.substring_dedup import later_windows, without_repeats

from .conftest import DOCUMENTS, awkward, components, text_hash

SPACES = b" \t\n\x0b\x0c\r"


def in_order(rows):
    """Distinct documents (doc_id, text), as the operators order them."""
    distinct = {(r[0], r[1]) for r in rows}
    return sorted(distinct, key=lambda d: (d[0] is None, d[0] or 0, text_hash(d[1])))


# Substring dedup ----------------------------------------------------------------


def brute_windows(rows, size):
    seen, kept = set(), {}
    docs = in_order(rows)
    for doc in docs:
        words = (doc[1] or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone[i : i + size] = [True] * size
            seen.add(window)
        kept[doc] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode())
    return sorted(((r[0], *kept[r[0], r[1]]) for r in rows), key=str)


@pytest.mark.parametrize("size", [20, 5])
def test_windows_that_start_earlier_go(documents, size):
    found = without_repeats(documents(clash=True), size).collect()
    assert sorted(map(tuple, found), key=str) == brute_windows(awkward(), size)


def test_no_documents_no_windows(documents):
    assert without_repeats(documents([])).count() == 0
    assert without_repeats(documents([(1, None, None, None, None)])).collect()[0][1:] == (0, 0, "")


def test_windows_with_one_name_are_told_apart(monkeypatch):
    import itemflow.llm.substring_dedup as module

    buffer = b"a b c d a b x y a b c d "
    meta = np.array([[0, 1, 0, 0, 12]], np.int64)
    expected = later_windows(buffer, meta, 2).tolist()
    monkeypatch.setattr(module, "_scrambled", lambda x: x * np.uint64(0))  # every window has the same name
    assert later_windows(buffer, meta, 2).tolist() == expected == [[0, 1, 0, 4, 2], [0, 1, 0, 8, 4]]


def test_a_passage_in_a_third_of_all_documents(documents):
    rng = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = []
    for i in range(300):
        own = " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
        rows.append((i, f"{own[:80]} {passage} {own[80:]}" if i % 3 == 0 else own, "en", "s", 1))
    found = without_repeats(documents(rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute_windows(rows, 20)


# Line dedup ---------------------------------------------------------------------


def brute_lines(rows, least):
    docs = in_order(rows)
    sequence, removed = [], {d: set() for d in docs}
    for d in docs:
        for j, line in enumerate((d[1] or "").encode().split(b"\n")):
            if line.split():
                sequence.append((d, j, line, len(line.split())))
    for i in range(len(sequence)):
        for j in range(i):
            n = 0
            while i + n < len(sequence) and sequence[i + n][2] == sequence[j + n][2] and sequence[i + n][0] == sequence[i][0] and sequence[j + n][0] == sequence[j][0]:
                n += 1
            if sum(x[3] for x in sequence[i : i + n]) >= least:
                removed[sequence[i][0]].update(x[1] for x in sequence[i : i + n])
    answer = []
    for r in rows:
        lines = (r[1] or "").encode().split(b"\n")
        gone = removed[r[0], r[1]]
        text = b"\n".join(x for j, x in enumerate(lines) if j not in gone).decode()
        answer.append((r[0], text, sum(1 for x in lines if x.split()), len(gone)))
    return sorted(answer, key=str)


def lined(seed=5):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefg") for _ in range(n)) for n in (1, 2, 3, 5, 8, 13, 25) for _ in range(2)]
    rows = []
    for i in range(40):
        rows.append((i, "\n".join(rng.choice([*pool, "", " "]) for _ in range(rng.randrange(1, 30))), "en", "s", 1))
    return [*rows, (3, rows[9][1], "en", "s", 1), rows[7], rows[7], (None, rows[12][1], None, None, None), (None, None, None, None, None)]


@pytest.mark.parametrize("least", [1, 9, 20])
def test_runs_of_lines_that_stand_earlier_go(documents, least):
    rows = lined() + awkward()[:12]
    found = without_repeated_lines(documents(rows, clash=True), ["doc_id", "kept_text"], least)
    assert sorted(map(tuple, found.select("doc_id", "kept_text", "n_lines", "n_removed").collect()), key=str) == brute_lines(rows, least)


def test_no_documents_no_lines(documents):
    assert without_repeated_lines(documents([]), ["doc_id"]).count() == 0


def test_lines_needed():
    assert lines_needed(np.array([3, 1, 5, 2]), 4).tolist() == [2, 2, 1, 0]


def longest_earlier(sequences):
    """Position of each line: the most lines from it that also begin at an earlier position."""
    places, at = [], 0
    for lines in sequences:
        places += [(at + j, lines[j:]) for j in range(len(lines))]
        at += len(lines) + 1
    found = {}
    for n, (pos, rest) in enumerate(places):
        for _, other in places[:n]:
            m = next((j for j, (a, b) in enumerate(zip(rest, other)) if a != b), min(len(rest), len(other)))
            if m:
                found[pos] = max(m, found.get(pos, 0))
    return found


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh"])
def test_intervals_give_the_longest_earlier_run_at_any_depth(spark, letters):
    rng = random.Random(5)
    long = [rng.choice(letters) for _ in range(90)]
    sequences = [long, long[7:80], *[[rng.choice(letters) for _ in range(rng.randrange(12))] for _ in range(12)], ["z", *long[3:75], "z"], long[:1]]
    rows, at = [], 0
    for lines in sequences:
        rows += [(at + j, ord(x), 0, 1) for j, x in enumerate(lines)]
        at += len(lines) + 1
    found = common_intervals(spark.createDataFrame(rows, "pos long, h1 long, h2 long, need long")).collect()
    later = [(r.s, r.m) for r in found if r.s != r["first"]]
    assert len(later) == len(dict(later))
    assert dict(later) == longest_earlier(sequences)
    assert len(found) <= 2 * len(rows)


# SimHash ------------------------------------------------------------------------


def brute_print(text, words=3):
    lowered = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    if not lowered:
        return 0
    n = min(words, len(lowered))
    hashes = [xxhash.xxh64_intdigest(b" ".join(lowered[i : i + n]), 42) for i in range(len(lowered) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    for row in awkward():
        assert fingerprint((row[1] or "").encode(), 3) == brute_print(row[1])
    # the hash of the contract is that of the database function
    assert spark.sql("select xxhash64('the ñandú')").first()[0] == text_hash("the ñandú")


def families(seed=2, large=150):
    """Fingerprints with families beyond the size that is compared pair by pair."""
    rng = random.Random(seed)
    values = {0, 1, 3, 2**63, 2**64 - 1}
    for size in (2, 5, 30, large):
        centre = rng.getrandbits(64)
        for _ in range(size):
            value = centre
            for _ in range(rng.randrange(4)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    centre = rng.getrandbits(64)
    for bit in range(32):  # all share a half
        for other in range(32):
            values.add(centre ^ (1 << bit) ^ (1 << other))
    return sorted(values)


@pytest.mark.parametrize("most", [0, 1, 2])
def test_links_connect_what_brute_force_connects(spark, most):
    values = families()
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    edges = linked(spark.createDataFrame([(v,) for v in signed], "fp long"), most)
    groups = {r.a: r.b for r in connected_components(edges).collect()}
    assert all((r.a ^ r.b).bit_count() <= most for r in edges.selectExpr("a", "b").collect() if (r.a >= 0) == (r.b >= 0))
    near = [(signed[i], signed[j]) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= most]
    expected = components(signed, near)
    assert {v: groups.get(v, v) for v in signed} == expected


def test_near_duplicates(documents):
    rows = awkward()
    found = near_duplicates(documents(clash=True), ["doc_id"]).select("doc_id", "fp", "component_id").collect()
    prints = [(brute_print(r[1]), r[0]) for r in rows]
    links = [(a, b) for a, _ in prints for b, _ in prints if (a ^ b).bit_count() <= 2]
    roots = components({p for p, _ in prints}, links)
    least = {}
    for p, i in prints:
        least.setdefault(roots[p], []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    expected = sorted(((i, p, least[roots[p]]) for p, i in prints), key=str)
    assert sorted(((r[0], r[1] % 2**64, r[2]) for r in found), key=str) == expected
    kept = one_of_each(documents(clash=True))
    assert kept.count() == len(least)
    assert kept.columns == documents(clash=True).columns
    assert {r.doc_id for r in kept.collect()} == set(least.values())


def test_no_documents_no_prints(documents):
    assert near_duplicates(documents([]), ["doc_id"]).count() == 0
    assert one_of_each(documents([])).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 100)] + [(7, 7), (3, 2)]
    found = {r.a: r.b for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 100)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# Vectors ------------------------------------------------------------------------


def brute_vectors(rows, least):
    def usable(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    able = [usable(v, label) for _, v, label in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None for (_, v, _), ok in zip(rows, able)]
    links = [(i, j) for i in range(n) for j in range(i) if able[i] and able[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least]
    count = [0] * n
    for i, j in links:
        count[i] += 1
        count[j] += 1
    roots = components(range(n), links)
    ids = {}
    for i in range(n):
        ids.setdefault(roots[i], []).append(rows[i][0])
    best = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return sorted(((rows[i][0], count[i], best[roots[i]] if able[i] else rows[i][0]) for i in range(n)), key=str)


def vectors(seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(150):
        rows.append((len(rows), rng.standard_normal(24).tolist(), i % 3))
    for size in (2, 3, 60):
        centre = rng.standard_normal(24)
        for _ in range(size):
            rows.append((len(rows), (centre + 0.08 * rng.standard_normal(24)).tolist(), 1))
    along = rng.standard_normal(24)
    across = rng.standard_normal(24)
    for step in range(40):  # a chain: its ends do not link
        rows.append((len(rows), (np.cos(step / 8) * along + np.sin(step / 8) * across).tolist(), 2))
    rows += [(900 + i, rows[3][1], rows[3][2]) for i in range(5)]
    rows += [(950, [2 * x for x in rows[3][1]], rows[3][2]), (951, rows[3][1], None), (952, None, 1), (953, [], 1), (954, [0.0] * 24, 1)]
    rows += [(955, [float("nan")] * 24, 1), (956, [None] * 24, 1), (957, [float("inf")] * 24, 1), (958, [1.0, 2.0], 1), (959, [1.0, 2.0], 1), (None, rows[4][1], rows[4][2]), (None, [5.0, 1.0], 7)]
    return rows


def test_near_vectors(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    found = near_vectors(frame.selectExpr("*", "'x' as node", "1 as n", "2 as root")).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == brute_vectors(rows, 0.93)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert near_vectors(frame.limit(0)).count() == 0


def around(rng, centre, size, spread):
    """Unit vectors whose cosines with each other are about 1 / (1 + spread ** 2)."""
    noise = rng.standard_normal((size, len(centre)))
    noise -= np.outer(noise @ centre, centre)
    return centre + spread * noise / np.linalg.norm(noise, axis=1, keepdims=True)


def test_full_lists_find_links_outside_their_component(spark, monkeypatch):
    monkeypatch.setattr("itemflow.llm.nn_descent.AUDITED", 1)  # else the audit repairs what the lists lack
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(rng.standard_normal((300, 64)))]
    for label in (0, 1):
        a, b = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        for centre in (a, 0.9494 * a + np.sqrt(1 - 0.9494**2) * b):
            rows += [(len(rows) + i, v.tolist(), label) for i, v in enumerate(around(rng, centre, 60, 0.1))]
    expected = brute_vectors(rows, 0.93)
    assert max(n for _, n, _ in expected) > 100  # the two families of a label link
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    found = near_vectors(frame).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == expected


def test_a_chain_of_families_is_one_component(spark, monkeypatch):
    monkeypatch.setattr("itemflow.llm.nn_descent.AUDITED", 1)
    rng = np.random.default_rng(8)
    axes = np.linalg.qr(rng.standard_normal((64, 31)))[0].T
    centre, rows = axes[0], []
    for axis in axes[1:]:  # neighbouring families link, others do not
        rows += [(len(rows) + i, v.tolist(), 0) for i, v in enumerate(around(rng, centre, 40, 0.1))]
        centre = 0.9494 * centre + np.sqrt(1 - 0.9494**2) * axis
    expected = brute_vectors(rows, 0.93)
    assert {c for _, _, c in expected} == {0}
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    found = near_vectors(frame).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == expected


def test_pairs_beside_a_large_group(spark, monkeypatch):
    for name, value in (("AUDITED", 16), ("CHUNK", 4), ("TABLES", 1)):
        monkeypatch.setattr(f"itemflow.llm.nn_descent.{name}", value)
    rng = np.random.default_rng(6)
    unit = lambda: (v := rng.standard_normal(32)) / np.linalg.norm(v)
    vectors = [*around(rng, unit(), 300, 0.1)]
    for _ in range(200):
        vectors += [*around(rng, unit(), 2, 0.1)]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    found = near_vectors(frame).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == brute_vectors(rows, 0.93)
