"""Collocations, periodic runs and personal data against brute force."""

import random
import re
import zlib
from collections import Counter
from math import log

import numpy as np
import pytest

from itemflow.llm import disclosure, periodic_runs
from itemflow.llm.collocations import collocations
from itemflow.llm.disclosure import base_spans, without_personal_data

from .conftest import CLASHES, awkward

CLASHING = [*CLASHES, "lang_", "phrase", "n", "runs", "spans", "terms", "k1", "term", "entity", "clean_text", "collapsed_text", "key"]


# Collocations ---------------------------------------------------------------------


def brute_collocations(rows, most=2000, least=10):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {}
    for (lang, phrase), a in counts.items():
        if len(phrase) > 1 and a >= least:
            cuts = [(10**6 * a * a // (counts[lang, phrase[:k]] * counts[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found[lang, phrase] = (score, a, counts[lang, phrase[:k]], counts[lang, phrase[k:]])
    longer = Counter()
    for (lang, phrase), (_, a, *_) in found.items():
        if len(phrase) == 3:
            for part in (phrase[:2], phrase[1:]):
                longer[lang, part] = max(longer[lang, part], a)
    kept = [(lang, -s, -a, " ".join(p).encode(), left, r) for (lang, p), (s, a, left, r) in found.items() if len(p) == 3 or 100 * longer[lang, p] < 50 * a]
    out, rank = set(), Counter()
    for lang, s, a, phrase, left, r in sorted(kept):
        rank[lang] += 1
        if rank[lang] <= most:
            out.add((lang, rank[lang], phrase.decode(), -a, left, r, totals[lang], -s))
    return out


def phrases_of(frame):
    return {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in frame.collect()}


def texts_with_phrases(seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(60)):
            words.append(rng.choice(["New York City", "new york", "of the", "THE", "Ünder öath", "a", "b", "c,", "d.\n", "e\x0b", "f\x1cg"]))
        rows.append((i, " ".join(words), rng.choice(["en", "en", "de", None, "und"]), "s", 1))
    return rows


@pytest.mark.parametrize("most", [2000, 3])
def test_collocations_equal_brute_force(documents, most):
    rows = texts_with_phrases() + awkward()
    assert phrases_of(collocations(documents(rows), most)) == brute_collocations(rows, most)


def test_collocations_with_small_shards_and_clashing_columns(documents, monkeypatch):
    monkeypatch.setattr("itemflow.llm.collocations.SHARD_BYTES", 300)
    rows = texts_with_phrases(6)
    frame = documents(rows).selectExpr("*", *[f"'clash' as {c}" for c in CLASHING])
    assert phrases_of(collocations(frame)) == brute_collocations(rows)
    assert collocations(documents([])).count() == 0
    assert collocations(documents([(1, None, None, None, None), (2, "", "en", "s", 0)])).count() == 0


def test_a_full_bit_table_loses_nothing(documents, monkeypatch):
    """Where every pair seems frequent, the counts still decide."""
    monkeypatch.setattr("itemflow.llm.collocations.frequent_table", lambda pairs: np.full(1 << 18, 2**64 - 1, np.uint64))
    rows = texts_with_phrases(7)
    assert phrases_of(collocations(documents(rows))) == brute_collocations(rows)


# Periodic runs ----------------------------------------------------------------------


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, q, e - s) for (s, e), q in found.items())


def repeating(rng):
    words = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randrange(120))]
    if words and rng.random() < 0.7:
        a, p = rng.randrange(len(words)), rng.randint(1, 20)
        words = [*words[:a], *(words[a + (i - a) % min(p, len(words) - a)] for i in range(a, len(words)))]
    if rng.random() < 0.4:
        unit = [rng.randrange(2) for _ in range(rng.randint(1, 9))] * rng.randint(1, 9)
        words = (words + unit + [7] + unit) * rng.randint(1, 3)
    return words


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(150):
        texts = [repeating(rng) for _ in range(rng.randint(1, 4))]
        counts = np.array(list(map(len, texts)), np.int64)
        firsts = np.cumsum(counts) - counts
        want = [(s + f, e_len + s + f, q) for t, f in zip(texts, firsts.tolist()) for s, q, e_len in brute_runs(t)]
        got = periodic_runs.runs_of(np.array(sum(texts, []), np.int64), counts)
        assert [tuple(x) for x in got.tolist()] == sorted(want, key=lambda x: (x[0], x[2]))


def test_one_word_many_times_is_one_run():
    n = 50_000
    assert periodic_runs.runs_of(np.zeros(n, np.int64), np.array([n])).tolist() == [[0, n, 1]]
    # runs of runs: progressions on both sides of a break
    words = ([0] * 40 + [1]) * 6
    got = [tuple(x) for x in periodic_runs.runs_of(np.array(words), np.array([len(words)])).tolist()]
    assert got == sorted([(s, s + n, q) for s, q, n in brute_runs(words)], key=lambda x: (x[0], x[2]))


def test_wavelet_tree():
    rng = np.random.default_rng(3)
    values = rng.permutation(300)
    tree = periodic_runs.WaveletTree(values)
    low = rng.integers(0, 300, 200)
    high = low + 1 + (rng.random(200) * (300 - low)).astype(int).clip(0, 299 - low)
    bound = rng.integers(0, 700, 200)
    assert tree.below(low, high, bound).tolist() == [(values[a:b] < x).sum() for a, b, x in zip(low, high, bound)]
    k = (rng.random(200) * (high - low)).astype(int)
    assert tree.smallest(low, high, k).tolist() == [sorted(values[a:b])[i] for a, b, i in zip(low, high, k)]


def test_periodic_runs_of_documents(documents):
    rng = random.Random(4)
    rows = awkward() + [(1000 + i, "\n ".join(f"w{x}" for x in repeating(rng)), "en", "s", 1) for i in range(60)]
    rows += [(2000, "ü ý " * 40 + "end", "en", "s", 1)]
    frame = documents(rows).selectExpr("*", *[f"'clash' as {c}" for c in CLASHING])
    got = periodic_runs.periodic_runs(frame, ["doc_id", "text", "runs", "term"]).collect()
    assert len(got) == len(rows)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = [(x.start, x.period, x.length) for x in r.runs]
        if len(words) < 3000:
            assert runs == brute_runs(words)
        gone = {i for s, q, n in runs for i in range(s + q, s + n)}
        assert (r.n_words, r.term) == (len(words), "clash")
        assert r.collapsed_text == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert periodic_runs.periodic_runs(documents([]), ["doc_id"]).count() == 0


# Personal data ------------------------------------------------------------------------


def plain_spans(text):
    """The patterns as they are stated, by backtracking."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(x) for x in m[0] if x.isdigit()]
        doubled = [x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_forms_equal_the_patterns():
    rng = random.Random(8)
    parts = ["a@b.c", "@", ".", "x", "é", "9", "255", "256", ".1.2.3", "1.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+", "+1 (499) 555-6503", " ", "-", "_d@e.f", "٣", "0007", "+49"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert base_spans(text) == plain_spans(text), text
    long = "a" * 300_000 + "1" * 300_000 + " +1" + " " * 300_000
    assert base_spans(long + "@x") == []


def brute_disclosure(texts, threshold, support):
    """(terms to replace, disclosure) by dictionaries."""
    all_n, near_n, entity_n, places = Counter(), Counter(), Counter(), {}
    for text in texts:
        spans = plain_spans(text)
        blank = list(text)
        for a, _, b in spans:
            blank[a:b] = "0" * (b - a)
        terms = [(m.start(), "".join(c.lower() if c.isascii() else c for c in m[0])) for m in re.finditer("[A-Za-z\x80-\U0010ffff]+", "".join(blank))]
        all_n.update(x for _, x in terms)
        for a, kind, b in spans:
            value = disclosure.entity(text, (a, kind, b))
            near = [x for at, x in terms if at < a][-10:] + [x for at, x in terms if at >= b][:10]
            for x in near:
                near_n[value, x] += 1
                entity_n[value] += 1
                places.setdefault((value, x), set()).add(tuple(near))
    total = sum(all_n.values())

    def told(near, everywhere, value):
        content = log(entity_n[value] / total)
        return 1 - log(min(1, near / everywhere)) / content if content < 0 else -1

    def seen(neighbourhoods):
        hashes = [Counter(zlib.crc32(min(set(p), key=lambda y: zlib.crc32(y.encode(), i)).encode(), i) for p in neighbourhoods) for i in range(4)]
        return sum(sum(h.values()) ** 2 / sum(n * n for n in h.values()) for h in hashes) / 4

    marked = {}
    for (value, x), n in near_n.items():
        d = told(n, all_n[x], value)
        if len(places[value, x]) >= support and seen(places[value, x]) >= support and d >= threshold:
            marked[x] = max(d, marked.get(x, 0))

    def stem(x):
        for k in range(len(x) - 1, 2, -1):
            everywhere = sum(n for y, n in all_n.items() if len(y) > 3 and y.startswith(x[:k]))
            near = Counter()
            for (value, y), n in near_n.items():
                if len(y) > 3 and y.startswith(x[:k]):
                    near[value] += n
            if all(told(n, everywhere, value) < threshold for value, n in near.items()):
                return x[:k] + "*"
        return ""

    return {x: (round(d, 9), stem(x)) for x, d in marked.items()}


def letters_of_people(seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(80)] + ["zörn", "Zorbas"]
    texts = []
    for i in range(150):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        if i % 5 == 0:
            text[3:3] = ["Zorblatt,", "mail", "me:", "zorb@Example.com"]
        if i % 7 == 0:
            text += ["call", "+1 (499) 555-6503", "ask", "Quux"]
        if i % 50 == 0:
            text += ["lonely@mail.org", "onlyhere"]
        texts.append(" ".join(text))
    return texts + [" ".join(["Zorblattian"] * 40), "Zorblatt alone, É", "quux", texts[0], texts[0], texts[0]]


def test_revealing_terms_equal_brute_force(documents):
    texts = letters_of_people()
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(None, None, None, None, None), (900, "", "en", "s", 0)]
    for threshold, support in ((0.75, 3), (0.5, 2)):
        got = disclosure.revealing_terms(documents(rows), threshold, support).collect()
        want = brute_disclosure(texts, threshold, support)
        assert {r.term: (round(r.disclosure, 9), r.replacement) for r in got} == want
    assert {"zorblatt", "quux"} <= set(brute_disclosure(texts, 0.75, 3))


def test_near_copies_are_no_witnesses(documents):
    """A passage with an address in many copies, each with a word or two of its own, reveals nothing by itself."""
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in "abcdefg" for b in "hijkl" for c in "mnopq"]
    passage = [rng.choice(words) for _ in range(20)] + ["rareword", "copied@mail.org"] + [rng.choice(words) for _ in range(20)]
    rows = []
    for i in range(200):
        own = list(passage)
        for _ in range(2):
            at = rng.randrange(len(own))
            own[at] = own[at] if "@" in own[at] else rng.choice(words)
        rows.append((i, " ".join(own), "en", "s", 1))
    rows += [(1000 + i, " ".join(rng.choice(words) for _ in range(60)), "en", "s", 1) for i in range(300)]
    assert disclosure.revealing_terms(documents(rows)).count() == 0


@pytest.mark.parametrize("held", [200_000, 0])
def test_spans_and_clean_text(documents, monkeypatch, held):
    monkeypatch.setattr(disclosure, "TERMS_HELD", held)
    texts = letters_of_people()
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(900, None, None, None, None)] + awkward()
    frame = documents(rows).selectExpr("*", *[f"'clash' as {c}" for c in CLASHING])
    marked = brute_disclosure([t or "" for _, t, *_ in rows], 0.75, 3)
    assert "zorblatt" in marked
    got = without_personal_data(frame, ["doc_id", "text", "spans", "term"]).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.text or ""
        base = [(a, k, b, f"[{disclosure.KINDS[k].upper()}]") for a, k, b in plain_spans(text)]
        blank = list(text)
        for a, _, b, _ in base:
            blank[a:b] = "0" * (b - a)
        terms = [(m.start(), 4, m.end(), marked[m[0].lower()][1]) for m in re.finditer("[A-Za-z\x80-\U0010ffff]+", "".join(blank)) if m[0].lower() in marked]
        want = sorted(base + terms)
        assert [(s.start, disclosure.KINDS.index(s.kind), s.end, s.replacement) for s in r.spans] == want
        clean, done = "", 0
        for a, _, b, x in want:
            if a >= done:
                clean += text[done:a] + (x or "[...]")
            done = max(done, b)
        assert r.clean_text == clean + text[done:] and r.term == "clash"
    assert without_personal_data(documents([]), ["doc_id"]).count() == 0
