"""Words that a polynomial modulo a power of two takes for each other, and one key in a third of all rows without broadcasts."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import documents
from pyspark.sql import functions as F
from test_exact import plain as plain_exact
from test_exact import result as exact_result
from test_jaccard import families
from test_jaccard import plain as plain_jaccard
from test_jaccard import result as jaccard_result

from starrung.llm import toxicity
from starrung.llm import words as W
from starrung.llm.decontam import find_benchmark
from starrung.llm.exact import exact_duplicates
from starrung.llm.jaccard import jaccard_components
from starrung.llm.lattice import lattice_likelihood
from starrung.llm.lines import remove_shared_lines
from starrung.llm.mixing import mix
from starrung.llm.tables import fold


def regular(length):
    """The word whose letters follow the parity of the ones in the place, and the one with both letters exchanged."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(length))
    return word, word.translate(str.maketrans("ab", "ba"))


LENGTHS = (64, 1024, 2048, 4096)


def test_hashes_of_regular_words_differ():
    words = [w.encode() for n in LENGTHS for w in regular(n)] + [b"a" * n for n in (1, 2, 3, 1000)]
    h = W.hash_words(words)
    assert len(set(h.tolist())) == len(words)
    data = np.frombuffer(b"".join(words), np.uint8)
    for length, hashes in W.growing_hashes(data[:500], 40):
        want = W.hash_words([data[i : i + length].tobytes() for i in range(500 - length + 1)])
        assert (hashes == want).all() and (W.stretch_hashes(data[:500], np.arange(len(want)), length) == want).all()
    # The beginnings of words, as the tagger uses them.
    text = b"abcdef  abc xabc"
    starts, ends = np.array([0, 8, 12]), np.array([6, 11, 16])
    total = W.sums(np.frombuffer(text, np.uint8), starts, ends)
    got = W.hashes(total, starts, starts + 3)
    assert got[0] == got[1] == W.hash_words([b"abc"])[0] != got[2]


def test_hashes_do_not_depend_on_stretches(monkeypatch):
    draw = random.Random(1)
    words = ["".join(draw.choice("abcü") for _ in range(draw.randrange(1, 60))) for _ in range(300)]
    chunk = next(W.chunks(pa.array(["  ".join(words)])))
    starts, ends, _ = W.spans(chunk.data, chunk.offsets, W.NOT_SPACE)
    want = W.hash_words([w.encode() for w in words])
    for stretch in (1, 7, 64, 1 << 18):
        monkeypatch.setattr(W, "_STRETCH", stretch)
        assert (W.hashes(W.sums(chunk.data, starts, ends), starts, ends) == want).all()


def test_regular_words_in_operators(spark, ws):
    pairs = [regular(n) for n in LENGTHS]
    rows = [(2 * i + j, w) for i, pair in enumerate(pairs) for j, w in enumerate(pair)]
    docs = documents(spark, rows)
    assert jaccard_result(jaccard_components(ws, docs)) == plain_jaccard(rows)
    got = lattice_likelihood(ws, docs, F.lit(True)).collect()
    n, v = 2 * len(rows), len(rows) + 1
    want = math.log10(2 / (n + v + 1)) + math.log10((len(rows) + 1) / (n + v + 1))
    assert [round(r.base_score, 6) for r in got] == [round(want, 6)] * len(rows)
    items = spark.createDataFrame([(i, pair[0]) for i, pair in enumerate(pairs)], "item_id long, text string")
    hit = {r.doc_id: r["items"] for r in find_benchmark(ws, docs, items).collect()}
    assert hit == {2 * i + j: [] if j else [str(i)] for i in range(len(pairs)) for j in (0, 1)}
    data = np.frombuffer("".join(w for _, w in rows).encode(), np.uint8)
    ends = np.cumsum([len(w) for _, w in rows])
    whole = toxicity.features_of(data, ends - [len(w) for _, w in rows], ends)[0][1]
    assert len(set(whole.tolist())) == len(rows)


@pytest.mark.usefixtures("no_broadcast")
def test_hot_keys_without_broadcasts(spark, ws):
    draw = random.Random(8)
    rows = families(7, 20, 6, [3, 6, 12, 40])
    hot = " ".join(f"h{i}" for i in range(30))
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    rows += [(1000 + i, hot) for i in range(len(rows) // 3)] + [(2000 + i, hot + f" end{i}") for i in range(len(rows) // 3)]
    rows += [(None, hot), (None, hot), (None, "null"), (3, "again")]
    draw.shuffle(rows)
    docs = documents(spark, rows)
    assert jaccard_result(jaccard_components(ws, docs)) == plain_jaccard(rows)
    assert exact_result(exact_duplicates(ws, docs)) == plain_exact(rows)
    sites = [(k, f"{t}\nshared {i % 4}\n{hot}", f"s{i % 7}") for i, (k, t) in enumerate(rows)]
    lines = remove_shared_lines(ws, documents(spark, sites), min_sites=3).collect()
    assert len(lines) == len(rows) and not any("shared" in r.text or hot in r.text.split("\n") for r in lines)
    taken = mix(ws, documents(spark, [(k, t, "a" if i % 3 else f"s{i}") for i, (k, t) in enumerate(rows)])).collect()
    assert len(taken) == len(rows)
    train = fold(F.col("doc_id"), 7) != 2
    scores = [sorted(((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in
                      lattice_likelihood(ws, docs, train, head_words=head).collect())) for head in (3, 1 << 19)]
    assert scores[0] == scores[1]
