"""Language, quality, toxicity and likelihood against direct computation, and on held-out rows."""

import itertools
import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import documents
from pyspark.sql import functions as F

from starrung.llm import language, lattice, quality, toxicity
from starrung.llm import words as W
from starrung.llm.sample import labelled_sample, without_copies
from starrung.llm.tables import fold

SYLLABLES = {"en": ["the", "ing", "er", "on", "and"], "fr": ["éle", "eau", "que", "ment", "oi"], "es": ["ción", "ñas", "os", "ar", "el"]}
ODD = [(900, None), (901, ""), (902, "12 34 !?"), (None, "the and"), (903, "the " * 60_000), (904, "x"), (904, "x"), (905, "日本語 テキスト")]


def prose(draw, syllables, words):
    return " ".join("".join(draw.choice(syllables) for _ in range(draw.randrange(1, 4))) for _ in range(words))


def test_hashes_and_spans_are_those_of_words():
    texts = ["a bb  a", "", " bb\x0b", "ünï a", None, "a"]
    for limit in (1, 4, 1 << 20):
        got = []
        for chunk in W.chunks(pa.array(texts), limit):
            starts, ends, row = W.spans(chunk.data, chunk.offsets, W.NOT_SPACE)
            got += [(int(r) + chunk.first, int(h)) for r, h in zip(row, W.hashes(W.sums(chunk.data, starts, ends), starts, ends))]
        want = [(i, int(W.hash_words([w.encode()])[0])) for i, t in enumerate(texts) for w in (t or "").split()]
        assert got == want


def test_bundle_is_the_sum_of_bound_letters():
    texts = ["Ab a", "", "12", "é x yz"]
    got = language.bundle(texts, 256)
    for row, text in zip(got, texts):
        padded = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
        want = np.zeros(256)
        vector = [language.letter_vector(0 if c == " " else ord(c), 256).astype(int) for c in padded]
        for a, b, c in zip(vector, vector[1:], vector[2:]):
            want += np.roll(a, 2) * np.roll(b, 1) * c
        assert (row == (want if padded.strip() else 0)).all()


def test_language(spark):
    draw = random.Random(2)
    rows = [(i, prose(draw, SYLLABLES[lang], draw.randrange(5, 60)), lang)
            for i, lang in enumerate(draw.choice(list(SYLLABLES)) for _ in range(300))]
    docs = spark.createDataFrame(rows + [(k, t, "en") for k, t in ODD] + [(906, "the and", None)], "doc_id long, text string, lang string")
    got = {(r.doc_id, r.lang_pred, r.score) for r in language.identify_language(docs, fold(F.col("doc_id"), 3) != 1).collect()}
    by = {k: (lang, score) for k, lang, score in got}
    assert sum(by[k][0] == lang for k, _, lang in rows) >= 297
    assert by[900] == by[901] == by[902] == ("und", 0.0) and by[903][0] == by[None][0] == "en"
    assert all(0 <= s <= 1 for _, _, s in got)
    assert language.identify_language(docs.limit(0), F.lit(True)).collect() == []
    none = language.identify_language(docs, F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)} and len(none) == len(rows) + len(ODD) + 1


def labels(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id long, {name} int")


def test_sample_is_bounded_and_free_of_contradictions(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(50)] + [(1, "again"), (60, None), (61, "x" * 100)])
    marks = labels(spark, [(i, i % 2) for i in range(50)] + [(0, 1), (3, None), (60, 1), (61, 1), (None, 1), (99, 0), (5, 1)], "quality")
    got = labelled_sample(docs, marks, "quality", F.lit(True), "doc_id", "text", {0: 10, 1: 100}, 50).to_pylist()
    texts = {r["text"]: r["label"] for r in got}
    assert sum(v == 0 for v in texts.values()) == 10 and "text 0" not in texts and len(texts) == len(got) == 35
    some = pa.table({"text": ["a b c d e f g h i j k l"] * 3 + ["other words here", ""] * 2, "label": [1] * 7})
    assert without_copies(some).column("text").to_pylist() == ["a b c d e f g h i j k l", "other words here", "", ""]


def test_quality(spark):
    draw = random.Random(3)
    rows, marks = [], []
    for i in range(400):
        good = i % 2
        text = prose(draw, SYLLABLES["en"], draw.randrange(30, 200))
        if not good:  # a stretch of junk somewhere
            junk = [" ".join(w + "###" for w in text.split()[:60]), "spam " * 60, text[:200].upper() + "!!"][i // 2 % 3]
            text = text + "\n" + junk if i % 4 else junk + "\n" + text
        rows.append((i, text))
        marks.append((i, good))
    docs, train = documents(spark, rows + ODD), fold(F.col("doc_id"), 4) != 2
    got = quality.score_quality(docs, labels(spark, marks, "quality"), train).collect()
    by = {r.doc_id: r for r in got}
    held = [(k, g) for k, g in marks if fold_of(k, 4) == 2]
    assert sum((by[k].score >= 0.7) == g for k, g in held) >= 0.95 * len(held)
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.score <= 1 and 0 < r.attention <= 1 for r in got)
    assert by[900].score == by[901].score
    assert quality.score_quality(docs.limit(0), labels(spark, marks, "quality"), train).collect() == []
    none = quality.score_quality(docs, labels(spark, [(None, None)], "quality"), train).collect()
    assert {r.score for r in none} == {0.5}


def fold_of(key, n):
    import zlib

    return zlib.crc32(str(key).encode()) % n


def test_quality_gradient_lowers_the_loss_and_attention_adds_up():
    sample = pa.table({"text": ["good words here " * 30, "### ### " * 60 + "fine words " * 40] * 20, "label": pa.array([1, 0] * 20, pa.int32())})
    model = quality.fit_model(sample, rounds=100)
    chunk = next(W.chunks(sample.column("text").combine_chunks()))
    x, bag = quality.passages(chunk)
    f = model.forward(x.astype(float), bag, len(chunk))
    assert np.add.reduceat(f["a"], f["first"]) == pytest.approx(np.ones(40))
    assert (f["p"][::2] > 0.9).all() and (f["p"][1::2] < 0.1).all()


def test_marginals_are_those_of_all_taggings():
    rng = np.random.default_rng(1)
    field = toxicity.Field(np.zeros(0, np.uint64), np.zeros(0), -1.0, rng.normal(size=(2, 2)), np.zeros(1, bool), np.zeros(4))
    counts = np.array([7, 1, 0, 9, 4])
    row = np.repeat(np.arange(5), counts)
    extra = np.where(rng.random(21) < 0.4, rng.normal(size=21) * 2, 0.0)
    marked = np.flatnonzero(extra != 0)
    got = toxicity.marginals(field, row, marked, extra, counts)
    first = np.concatenate([[0], np.cumsum(counts)])
    for m, p in zip(marked, got):
        d = row[m]
        total = toxic = 0.0
        for tags in itertools.product((0, 1), repeat=int(counts[d])):
            score, before = 0.0, 0
            for t, tag in enumerate(tags):
                score += field.change[before, tag] + (field.bias + extra[first[d] + t]) * tag
                before = tag
            total += math.exp(score)
            toxic += math.exp(score) * tags[m - first[d]]
        assert p == pytest.approx(toxic / total)


def test_toxicity(spark):
    draw = random.Random(5)
    bad = [s + e for s in ("vilex", "scorn") for e in ("or", "a", "ing", "th", "")]
    rows, marks = [], []
    for i in range(400):
        words = prose(draw, SYLLABLES["en"], draw.randrange(20, 120)).split()
        for _ in range(3 if i % 4 == 0 else 0):
            words.insert(draw.randrange(len(words)), draw.choice(bad).upper())
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 4 == 0)))
    rows += [(700 + i, rows[1][1] + f" copy{i}") for i in range(60)]
    docs, train = documents(spark, rows + ODD + [(906, "é vilexing!")]), fold(F.col("doc_id"), 5) != 0
    got = toxicity.find_toxicity(docs, labels(spark, marks, "toxic"), train).collect()
    by = {r.doc_id: r for r in got}
    assert sum((by[k].score >= 0.5) == m for k, m in marks) >= 398
    assert all(by[k].score < 0.5 for k, _ in rows[400:]) and all(by[k].score == 0 for k, _ in ODD if k not in (None, 903))
    texts = dict(rows)
    for k, m in marks:
        if m:
            assert {texts[k][s.start : s.end].lower() for s in by[k].spans} and all(
                w.lower().startswith(("vilex", "scorn")) for s in by[k].spans for w in texts[k][s.start : s.end].split())
    assert [(s.start, s.end) for s in by[906].spans] == [(2, 10)]
    assert len(got) == docs.count()
    assert toxicity.find_toxicity(docs.limit(0), labels(spark, marks, "toxic"), train).collect() == []
    assert {r.score for r in toxicity.find_toxicity(docs, labels(spark, [(1, 1)], "toxic"), train).collect()} == {0.0}


def small_pieces(words):
    names = sorted({w[i:j] for w in words for i in range(len(w)) for j in range(i + 1, min(len(w), i + 4) + 1)})
    rng = np.random.default_rng(0)
    h = W.hash_words(names)
    order = np.argsort(h)
    maybe = np.zeros(1 << 20, bool)
    maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    weight = rng.random(len(names))
    weight /= weight.sum()
    return lattice.Pieces(order, h[order], np.log(weight[order]), 4, maybe), dict(zip(names, weight)), names


def test_lattice_sums_all_segmentations(monkeypatch):
    words = ["a", "abc", "abcabc", "cab", "bbbbb"]
    marked = [("▁" + w).encode() for w in words]
    pieces, weight, names = small_pieces(marked)

    def segmentations(w):
        if not w:
            yield []
        for i in range(1, min(4, len(w)) + 1):
            for rest in segmentations(w[i:]):
                yield [w[:i]] + rest

    counts = np.array([3.0, 1, 2, 5, 1])
    expected, want = dict.fromkeys(names, 0.0), []
    for w, c in zip(marked, counts):
        p = [(s, math.prod(weight[x] for x in s)) for s in segmentations(w)]
        want.append(math.log(sum(q for _, q in p)))
        for s, q in p:
            for x in s:
                expected[x] += c * q / sum(q for _, q in p)
    for cells in (1 << 20, 8):
        monkeypatch.setattr(lattice, "CELLS", cells)
        got, seen = lattice.word_log_probs(pa.array(words), pieces, counts)
        assert got == pytest.approx(want)
        assert {names[o]: s for o, s in zip(pieces.order, seen)} == pytest.approx(expected, abs=1e-9)


def test_long_words_by_windows_are_those_of_one_recursion(monkeypatch):
    draw = random.Random(9)
    names = ["the", "ing", "a", "b", "é", "日", "est", "0"]
    words = ["".join(draw.choice(names) for _ in range(n)) for n in (1, 2, 10, 70, 200, 500)] + ["the"] * 3
    counts = np.arange(1.0, len(words) + 1)
    for pieces in (lattice.read_pieces(), small_pieces([("▁" + w).encode() for w in words[:5] + ["日0é"]])[0]):
        monkeypatch.setattr(lattice, "LONG_WORD", 1 << 30)
        want, seen = lattice.word_log_probs(pa.array(words), pieces, counts)
        for window, strip in ((64, 1), (64, 3), (100, 2)):
            monkeypatch.setattr(lattice, "LONG_WORD", 20)
            monkeypatch.setattr(lattice, "WINDOW", window)
            monkeypatch.setattr(lattice, "STRIP_WINDOWS", strip)
            got, again = lattice.word_log_probs(pa.array(words), pieces, counts)
            assert got == pytest.approx(want, rel=1e-12) and again == pytest.approx(seen, abs=1e-7)
            assert lattice.word_log_probs(pa.array(words), pieces)[0] == pytest.approx(want, rel=1e-12)


def test_a_word_of_a_megabyte_takes_seconds():
    draw = random.Random(2)
    began = time.monotonic()
    got, _ = lattice.word_log_probs(pa.array(["".join(draw.choice("abcdefghijklmnop0123=+") for _ in range(1 << 20))]), lattice.read_pieces())
    assert math.isfinite(got[0]) and time.monotonic() - began < 30


def test_slices_of_a_text_make_no_difference(monkeypatch):
    texts = ["one two, three" * 20, "", "12 34", "é" * 50, " x", "日本語 テキスト. " * 5, "y "]
    want = language.bundle(texts, 256)
    for size in (1, 2, 3, 16):
        monkeypatch.setattr(language, "SLICE", size)
        assert (language.bundle_whole(texts, 256) == want).all()


def test_language_like_direct_cosines(spark):
    """The prediction by sums of bound vectors, letter by letter."""
    draw = random.Random(4)
    rows = [(i, prose(draw, SYLLABLES[x], draw.randrange(1, 12)), x) for i, x in enumerate(draw.choice(list(SYLLABLES)) for _ in range(40))]

    def vector(text):
        padded = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
        v = [language.letter_vector(0 if c == " " else ord(c)).astype(float) for c in padded]
        return sum(np.roll(a, 2) * np.roll(b, 1) * c for a, b, c in zip(v, v[1:], v[2:]))

    def unit(v):
        return v / np.linalg.norm(v)

    names = sorted(SYLLABLES)
    prototypes = [unit(sum(unit(vector(t)) for k, t, x in rows if x == name and fold_of(k, 3) != 1)) for name in names]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify_language(docs, fold(F.col("doc_id"), 3) != 1).collect()}
    for k, t, _ in rows:
        near = [float(unit(vector(t)) @ p) for p in prototypes]
        assert got[k].lang_pred == names[int(np.argmax(near))] and got[k].score == pytest.approx(max(0, max(near)), abs=1e-4)


def test_plain_segments_count_as_often_as_they_occur():
    """One segment with a weight is the same as its copies."""
    rng = np.random.default_rng(3)
    y = (rng.random((6, toxicity.SEGMENT)) < 0.1).astype(np.int64)
    y[3:] = 0
    size = np.array([toxicity.SEGMENT, 10, 30, 48, 48, 48])
    y *= np.arange(toxicity.SEGMENT) < size[:, None]
    cells = np.flatnonzero(y.ravel())
    feature = np.zeros(len(cells), np.int64)
    chosen = np.array([1], np.uint64)
    many = toxicity._maximise(chosen, feature, cells, y, size, np.ones(6), 40)
    few = toxicity._maximise(chosen, feature, cells, y[:4], size[:4], np.array([1.0, 1, 1, 3]), 40)
    assert few.weights == pytest.approx(many.weights) and few.bias == pytest.approx(many.bias)
    assert few.change == pytest.approx(many.change)


def test_every_word_has_a_segmentation_and_long_words_do_not_underflow():
    pieces = lattice.read_pieces()
    assert np.exp(pieces.log_weight).sum() == pytest.approx(1)
    got, _ = lattice.word_log_probs(pa.array(["the", "日本", "\x00", "z" * 3000, "the"]), pieces)
    assert np.isfinite(got).all() and got[0] == got[4] > got[1] and got[3] < -3000


@pytest.mark.parametrize("head", [1 << 19, 5, 0])
def test_likelihood(spark, ws, head):
    draw = random.Random(7)
    rows = [(i, prose(draw, SYLLABLES["en"] + ["THE"], draw.randrange(30))) for i in range(120)] + ODD
    docs = documents(spark, rows)
    train = fold(F.col("doc_id"), 7) != 2
    got = lattice.lattice_likelihood(ws, docs, train, head_words=head).collect()
    count, n = {}, 0
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for k, t in rows:
        if fold_of("" if k is None else k, 7) != 2:
            for w in [*(t or "").translate(low).split(), None]:
                count[w] = count.get(w, 0) + 1
                n += 1
    want = []
    for k, t in rows:
        w = [*(t or "").translate(low).split(), None]
        want.append((str(k), len(w), sum(x in count for x in w), n, round(sum(math.log10((count.get(x, 0) + 1) / (n + len(count) + 1)) for x in w), 4)))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == sorted(want)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    scores = {(r.doc_id, r.n_tokens): r.score for r in got}
    assert scores[900, 1] == scores[901, 1] > scores[904, 2]
    if head == 5:
        other = lattice.lattice_likelihood(ws, docs, train).collect()
        assert {(r.doc_id, r.n_tokens): r.score for r in other} == pytest.approx(scores)
    assert lattice.lattice_likelihood(ws, docs.limit(0), train).collect() == []
