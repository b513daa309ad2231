"""Benchmark search against a plain search over word lists."""

import hashlib
import re

import numpy as np
import pytest
from conftest import DATA
from llm_rows import documents, read

from starrung.llm.decontam import find_benchmark
from starrung.llm.fm_index import FMIndex, suffix_array
from starrung.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def spans_of(text):
    text = (text or "").translate(CAPITALS)
    return [(m.group(), m.start(), m.end()) for m in WORD.finditer(text)]


def plain(docs, bench, window=10):
    phrases = {}
    for item, text in bench:
        w = [x[0] for x in spans_of(text)]
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    lengths = {len(p) for p in phrases}
    out = []
    for key, text in docs:
        found = spans_of(text)
        w, hit, items = [x[0] for x in found], set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                names = phrases.get(tuple(w[i : i + n]))
                if names:
                    items |= names
                    hit |= set(range(i, i + n))
        spans = []
        for i in sorted(hit):
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        out.append((key, len(w), len(hit), [(found[a][1], found[b - 1][2]) for a, b in spans], sorted(items)))
    return sorted(out, key=str)


def result(rows):
    return sorted([(r[0], r.n_words, r.n_hit, [(s.start, s.end) for s in r.spans], r["items"]) for r in rows], key=str)


@pytest.mark.parametrize("part_bytes", [1 << 24, 2000])
def test_like_plain_search(spark, ws, part_bytes):
    docs, bench = read(spark, "documents"), read(spark, "benchmark")
    got = find_benchmark(ws, docs, bench, part_bytes=part_bytes).collect()
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert result(got) == want and any(r[2] for r in want)


def test_query_digests(spark):
    got = {r.doc_id: r for r in QUERIES["op7_decontaminate"](spark, DATA).collect()}
    for key, n, hits, spans, items in plain([(r.doc_id, r.text) for r in read(spark, "documents").collect()],
                                            [(r.item_id, r.text) for r in read(spark, "benchmark").collect()]):
        r = got[key]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hits, len(items), hits > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(items).encode()).hexdigest()
        assert r.spans == ",".join(f"{a}:{b}" for a, b in spans)


def test_edge_cases(spark, ws):
    phrase = "Größe one two three four five six seven eight nine ten"
    rows = [(1, None), (2, ""), (3, "!!"), (4, phrase), (5, "x " * 30_000 + phrase + " y"), (6, "short ITEM, here"),
            (6, "short ITEM, here"), (None, "a short. item"), (7, "short"), (8, phrase.replace(" ", "-") + " " + phrase)]
    bench = [(1, phrase), (1, phrase), (2, "short item"), (3, None), (4, ""), (None, "short")]
    docs = documents(spark, rows)
    items = spark.createDataFrame(bench, "item_id long, text string")
    assert result(find_benchmark(ws, docs, items).collect()) == plain(rows, bench)
    assert {r.n_hit for r in find_benchmark(ws, docs, items.limit(0)).collect()} == {0}
    assert find_benchmark(ws, docs.limit(0), items).collect() == []


def test_repeated_rows_with_a_benchmark_of_parts(spark, ws):
    rows = [(1, "one two three"), (1, "one two three"), (1, "four"), (None, "none"), (None, "none"), (2, None), (2, None),
            (2, ""), (None, "four five"), (None, "four five")]
    bench = [(1, "two three"), (2, "four"), (3, "five"), (4, "six")]
    docs, items = documents(spark, rows), spark.createDataFrame(bench, "item_id long, text string")
    for part_bytes in (1 << 24, 1):
        assert result(find_benchmark(ws, docs, items, part_bytes=part_bytes).collect()) == plain(rows, bench)


def test_index():
    rng = np.random.default_rng(1)
    for n, sigma in ((1, 1), (50, 2), (500, 3), (3000, 40)):
        text = rng.integers(1, sigma + 1, n)
        assert suffix_array(np.append(text, 0)).tolist() == sorted(range(n + 1), key=lambda i: np.append(text, 0)[i:].tolist())
        index = FMIndex(text, sample=7)
        for m in (1, 2, 5):
            patterns = rng.integers(1, sigma + 3, (20, m))
            low, high = index.search(patterns)
            for p, a, b in zip(patterns, low, high):
                want = [i for i in range(n - m + 1) if (text[i : i + m] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want
