"""Quality rules, toxicity, token files and SentencePiece."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from itemflow.llm import common, quality, toxicity
from itemflow.llm.queries import op5_quality_rules
from itemflow.llm.token_files import TokenFile, read_token_files, write_token_files
from itemflow.llm.unigram import Unigram, decode_documents, encode_documents

from .conftest import awkward

# Quality ------------------------------------------------------------------------


def counts(text):
    words = (text or "").encode().split()
    n = len(words)
    windows = [tuple(words[i : i + 5]) for i in range(n - 4)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    return (n, sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(lines))


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["x" * rng.choice([2, 3, 4, 5, 6, 9]) + str(rng.randrange(100)) for _ in range(rng.randrange(12, 90))]
        text = " ".join(words)
        if i % 17 == 0:
            text = " ".join(w + "***" for w in words)
        if i % 23 == 0:
            text = " ".join("z" * 60 for _ in words[:11]) + " q" * 0
        rows.append((i, text, "en" if i % 3 else "de", f"s{i % 2}", len(text)))
    return rows


def brute_verdicts(rows):
    """The method again, with arrays."""
    data = []
    for r in rows:
        n, chars, symbols, dup, repeat, lines = counts(r[1])
        failed = n < 10 or 100 * repeat > 20 * n
        z = [math.log(max(chars, 1) / max(n, 1)), math.log1p(20 * symbols / (n + 20)), math.log1p(10 * dup / (lines + 10)), math.log1p(10 * repeat / (n + 50))]
        data.append((r, failed, [math.floor(abs(x) * 1024 + 0.5) * (1 if x >= 0 else -1) for x in z]))
    groups = {}
    for r, failed, z in data:
        if not failed:
            groups.setdefault((r[2], r[3]), []).append(z)
    small = {}
    for (lang, _), z in groups.items():
        if len(z) < 40:
            small.setdefault(lang, []).extend(z)
    tiny = [z for v in small.values() if len(v) < 40 for z in v]

    def members(r):
        own = groups[r[2], r[3]]
        return own if len(own) >= 40 else small[r[2]] if len(small[r[2]]) >= 40 else tiny

    passed = np.sort(np.array([z for v in groups.values() for z in v] or [[0] * 4]), axis=0)
    point = passed[-(-99 * len(passed) // 100) - 1] / 1024 / 2.576
    floor = np.diag((1024 * np.clip(point * [0, 1, 1, 1], 0.05, 0.3)) ** 2)
    cut = quality.chi_square_at(1 - 1e-8, 4)

    def scatter(x, factor):
        return x.mean(0), factor * (x.T @ x / len(x) - np.outer(x.mean(0), x.mean(0))) + floor

    def distances(x, centre, cov):
        d = x - centre
        return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)

    def lower_median(v):
        return np.sort(v, axis=0)[(len(v) + 1) // 2 - 1]

    def fit(x):
        middle = lower_median(x)
        starts = [(middle, np.diag((1.4826 * lower_median(np.abs(x - middle))) ** 2) + floor), scatter(x, 1.0)]
        found = []
        for centre, cov in starts:
            for _ in range(quality.STEPS):
                bins = np.floor(32 * np.log(distances(x, centre, cov) + 1e-6))
                order = np.sort(bins)
                edge = order[(len(x) + 1) // 2 - 1]
                centre, cov = scatter(x[bins <= edge], quality.consistency(0.5))
            found.append((np.linalg.slogdet(cov)[1], centre, cov))
        _, centre, cov = min(found, key=lambda f: f[0])
        return scatter(x[distances(x, centre, cov) <= quality.chi_square_at(0.975, 4)], quality.consistency(0.975))

    fits, answer = {}, []
    for r, failed, z in data:
        kept = not failed
        if kept:
            own = members(r)
            if len(own) >= 40:
                if id(own) not in fits:
                    fits[id(own)] = fit(np.array(own, float))
                kept = bool(distances(np.array([z], float), *fits[id(own)])[0] <= cut)
        answer.append((r[0], *counts(r[1])[:5], failed, kept))
    return sorted(answer, key=str)


@pytest.mark.parametrize("rows", [corpus() + awkward(), awkward(), corpus(2, 60)], ids=["groups", "few", "small groups"])
def test_quality_verdicts(documents, rows):
    found = quality.quality_verdicts(documents(rows, clash=True), ["doc_id", "kept"]).collect()
    expected = brute_verdicts(rows)
    assert sorted(map(tuple, found), key=str) == expected
    if len(rows) > 300:
        assert {r[-1] for r in expected if not r[-2]} == {True, False}  # some are outliers


def test_each_statistic_rejects_moderate_outliers(spark, documents, tmp_path):
    rng = random.Random(8)
    word = lambda n=5: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    words = lambda n, size=5: [word(size + rng.choice((-1, 0, 1))) for _ in range(n)]
    lines = lambda w: "\n".join(" ".join(w[i : i + 4]) for i in range(0, len(w), 4))
    texts = [lines(words(rng.randrange(80, 120))) for _ in range(300)]
    again = words(8)
    short = lines(words(160)).split("\n")
    planted = {
        "word length": lines(words(100, 10)),
        "symbols": lines([w + "#" * (i % 10 == 0) for i, w in enumerate(words(100))]),
        "repeated lines": "\n".join([*short, *short[::5]]),
        "repeated words": " ".join([*again, *words(42), *again, *words(42)]),
    }
    rows = [(i, t, "en", "web", len(t)) for i, t in enumerate([*texts, *planted.values()])]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in op5_quality_rules(spark, str(tmp_path)).collect()}
    assert not any(r.base_failed for r in found.values())
    assert {name: found[300 + i].kept for i, name in enumerate(planted)} == dict.fromkeys(planted, False)
    assert sum(found[i].kept for i in range(300)) >= 297


def test_few_clean_documents_are_rejected(documents):
    rng = random.Random(9)
    rows = []
    for i in range(2000):
        lines = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(6, 14))) for _ in range(rng.randrange(20, 100))]
        if i % 20 == 0:  # one line twice
            lines.append(rng.choice(lines))
        if i % 25 == 1:  # one symbol
            lines[0] += " 5%"
        rows.append((i, "\n".join(lines), rng.choice(["en", "de"]), rng.choice(["web", "book"]), 0))
    found = quality.quality_verdicts(documents(rows), ["doc_id"], quality.CUTOFF).collect()
    assert not any(r.base_failed for r in found)
    assert sum(not r.kept for r in found) < 20
    assert all(r.kept for r in found if r.n_dup_lines == 1 and r.n_words >= 500)


def test_no_documents_no_verdicts(documents):
    assert quality.quality_verdicts(documents([]), ["doc_id"]).count() == 0


def test_chi_square():
    assert quality.chi_square_at(0.975, 4) == pytest.approx(11.1433, abs=1e-3)
    assert quality.chi_square_at(0.5, 4) == pytest.approx(3.3567, abs=1e-3)


# Toxicity -----------------------------------------------------------------------


def model_of(text):
    codes = np.frombuffer(text.encode().translate(toxicity.TABLE), np.uint8).astype(int)
    grams = codes[:-2] * 4096 + codes[1:-1] * 64 + codes[2:]
    values, n = np.unique(grams, return_counts=True)
    return toxicity.CharacterModel(values, n)


ENGLISH = "  the loser is an idiot  and a moron  all seller and letter write to a stupid person  she sells it  good tool  see  " * 30


@pytest.mark.parametrize(
    "noisy, meant",
    [("l0ser", "loser"), ("1d10t", "idiot"), ("looooser", "loser"), ("l.o.s.e.r", "loser"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("i-d-i-o-t", "idiot"), ("l o s e r", "loser"), ("st00000pid", None), ("letter", "letter")],
)
def test_noisy_words_are_restored(noisy, meant):
    found = model_of(ENGLISH).decode(noisy)
    assert found == meant if meant else isinstance(found, str)


@pytest.mark.parametrize(
    "text, meant",
    [("!diot", "idiot"), ("iiddiioott", "idiot"), (".".join("you are an idiot " * 8).replace(" ", "_"), "idiot"), ("x " + " ".join("idiot" * 40), "idiot"), ("$$$ @ll", "all")],
)
def test_disguise_of_any_length_is_restored(text, meant):
    restore = toxicity.Restorer(model_of(ENGLISH))
    found = [w for _, some in toxicity._restored([text.encode()], restore) for w in some]
    assert any(meant in w for w in found)


def test_characters_set_apart_are_joined_whole():
    text = "une d é b i l e là. п р и в е т ! ii dd ii oo tt no " + "a b " * 100
    rows = [text.encode(), b"", b"a b", b"c d"]
    assert [x.decode().strip() for _, x in toxicity.spaced_words(common.Words(rows))] == ["d é b i l e", "п р и в е т ! ii dd ii oo tt", ("a b " * 100).strip()]



def brute_decode(model, word):
    """Every path through the lattice."""
    from itertools import product

    best = (-math.inf, "")
    for path in product(*toxicity._lattice(word)):
        out = "".join(r for r, _ in path)
        score = sum(c for _, c in path)
        a = b = 0
        for byte in (out + " ").encode():
            c = toxicity.TABLE[byte]
            score += float(model.log[a, b, c])
            a, b = b, c
        best = max(best, (score, out))
    return best


@pytest.mark.parametrize("word", ["l0s3r", "1.d.1", "aa!!l", "b@d $ee", "é0é"])
def test_the_best_path_is_found(word):
    model = model_of(ENGLISH)
    assert model.decode(word) == brute_decode(model, word)[1].strip()


def test_toxicity_learns_and_holds_out(spark, documents):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        words = [f"{rng.choice('bdfgkm')}{rng.choice('aeiou')}{rng.choice('lnrst')}{rng.choice('aeiou')}" for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            mark = rng.choice(["loser", "idiot"])
            if i % 4 == 0:
                mark = rng.choice([mark.replace("o", "0").replace("i", "1"), " ".join(mark), mark[:2] + mark[2] * 4 + mark[3:]])
            words.insert(rng.randrange(30), mark)
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, int(toxic)))
    rows += [(10_000, None, None, None, None), (10_001, "", None, None, None), (None, "what a loser", None, None, None), (0, rows[0][1], "en", "s", 1), (10_002, "y" * 5000, None, None, None)]
    labels += [(None, 1), (5, None)]
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.toxicity(documents(rows, clash=True), known, ["doc_id", "score"]).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, toxic in labels[:-2]:
        assert by_id[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert by_id[i].predicted == (by_id[i].score >= 0.3)
    held = [(by_id[i].predicted, t) for i, t in labels[:-2] if by_id[i].held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.97
    assert by_id[10_000].score == by_id[10_001].score < 0.3
    assert by_id[None].predicted == 1 and not by_id[None].held_out
    empty = documents([])
    assert toxicity.toxicity(empty, known, ["doc_id"]).count() == 0
    assert toxicity.toxicity(documents(rows), known.limit(0), ["doc_id"]).where("predicted = 1").count() == 0


def test_labels_that_are_held_out_change_nothing(spark, documents):
    rows = [(i, f"bad{i % 3} word w{i}" if i % 2 else f"good word w{i}", "en", "s", 1) for i in range(80)]
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    one = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    other = spark.createDataFrame([(i, (1 - i % 2) if held(i) else i % 2) for i in range(80)], "doc_id long, toxic int")
    docs = documents(rows)
    a, b = [sorted(map(tuple, toxicity.toxicity(docs, labels, ["doc_id"]).collect())) for labels in (one, other)]
    assert a == b


# Token files --------------------------------------------------------------------

BPE = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(BPE).encode(text or "", add_special_tokens=False).ids, 1]


def test_token_files(spark, documents, tmp_path):
    rows = [*awkward(), (77, "a <|endoftext|> b<|startoftext|>c ΑΣ Σ don't", "en", "s", 1), (78, "<|startoftext|>", "en", "s", 1)]
    files = write_token_files(documents(rows, clash=True), BPE, f"file://{tmp_path}/tokens")
    found = read_token_files(files).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is None, i))
    assert [r.start for r in found] == np.cumsum([0, *[r.n_tokens for r in found[:-1]]]).tolist()
    expected = {}
    for r in rows:
        ids = np.array(whole_ids(r[1]), "<u4")
        expected.setdefault(r[0], []).append((len(ids), zlib.crc32(ids.tobytes())))
    got = {}
    for r in found:
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    # any reader can read a file through, and a reader of some documents decompresses only these
    paths = [r.path for r in files.orderBy("part").collect()]
    stream = b"".join(zstandard.ZstdDecompressor().stream_reader(open(p.removeprefix("file://"), "rb"), read_across_frames=True).read() for p in paths)
    assert len(stream) == 4 * sum(r.n_tokens for r in found)
    picked = {}
    for p in paths:
        picked |= TokenFile(p).documents([77])
    assert picked[77].tolist() == whole_ids(rows[-2][1])


def test_a_damaged_frame_is_noticed(documents, tmp_path):
    files = write_token_files(documents([(1, "some words to damage", "en", "s", 1)]), BPE, f"file://{tmp_path}/tokens")
    path = files.first().path.removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    raw[10] ^= 255
    open(path, "wb").write(raw)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        TokenFile(path).frame(0)


def test_no_documents_no_files(documents):
    files = write_token_files(documents([]), BPE)
    assert files.count() == 0 and read_token_files(files).count() == 0


# SentencePiece ------------------------------------------------------------------

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def unigram():
    return Unigram(MODEL)


def naive(unigram, text):
    """Best total score of a text by the plain recurrence over its characters."""
    pieces = {unigram.spelled[i].decode(): unigram.scores[i] for i in range(len(unigram.spelled)) if unigram.spelled[i] and i not in set(unigram.bytes.tolist())}
    text = " " + text.replace("▁", " ") if text else ""
    best = [0.0] + [-math.inf] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + 48) + 1):
            if (score := pieces.get(text[i:j])) is not None:
                best[j] = max(best[j], best[i] + score)
        if text[i] not in pieces:
            best[i + 1] = max(best[i + 1], best[i] + unigram.unknown_score)
    return best[-1]


def total(unigram, ids):
    unknown = set(unigram.bytes.tolist())
    score, raw = 0.0, b""
    for i in [*ids, None]:
        if i in unknown:
            raw += unigram.spelled[i]
            continue
        score += len(raw.decode(errors="replace")) * unigram.unknown_score
        raw = b""
        score += unigram.scores[i] if i is not None else 0
    return score


TEXTS = ["", " ", "a", "  a  b\n c\td ﬁ é  ", "ünïcode 梦 😀 x\n\n  y", "loooong" * 40, "\n", "日本語テキスト" * 30, "a▁b", "\x00\x1f", "é"]


@pytest.mark.parametrize("text", TEXTS)
def test_the_best_segmentation(unigram, text):
    ids = np.frombuffer(unigram.encode([text.encode()])[0], np.int32).tolist()
    assert total(unigram, ids) == pytest.approx(naive(unigram, text), rel=1e-12)
    assert unigram.decode(ids) == text.replace("▁", " ")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_round_trip(texts):
    unigram = test_round_trip.unigram = getattr(test_round_trip, "unigram", None) or Unigram(MODEL)
    rows = [t.encode("utf-8", "ignore") for t in texts]
    for raw, ids in zip(rows, unigram.encode(rows)):
        assert unigram.decode(np.frombuffer(ids, np.int32)) == raw.decode().replace("▁", " ")


def test_no_worse_than_the_library(unigram):
    """The library on the same pieces: no segmentation of it has a better score, and both decode alike."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=MODEL)
    for r in awkward():
        text = (r[1] or "")[:3000]
        ids = np.frombuffer(unigram.encode([text.encode()])[0], np.int32).tolist()
        theirs = library.encode(text)
        assert library.decode(theirs) == library.decode(ids) == unigram.decode(ids)
        assert total(unigram, ids) >= total(unigram, theirs) - 1e-6


def test_long_and_short_units_agree(unigram):
    unit = (" " + "abracadabra梦é" * 6).encode()
    assert unigram._many([unit])[0] == unigram._one(unit).tobytes()


def test_encode_documents(documents):
    rows = awkward()
    ids = encode_documents(documents(rows, clash=True), MODEL, ["doc_id", "text", "ids"])
    back = decode_documents(ids, MODEL, ["doc_id", "text", "ids"]).collect()
    assert len(back) == len(rows)
    assert all(r.decoded == (r.text or "") for r in back)
    assert encode_documents(documents([]), MODEL, ["doc_id"]).count() == 0
