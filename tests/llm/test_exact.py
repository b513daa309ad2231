"""Exact duplicates against grouping by the normalised text."""

import hashlib
import random
import re
from collections import Counter

from llm_rows import documents

from starrung.llm.exact import exact_duplicates


def plain(rows):
    texts = [(key, re.sub(r"[\x20\x09-\x0D]+", " ", text or "")) for key, text in rows]
    least, size, same = {}, Counter(t for _, t in texts), Counter(texts)
    for key, t in texts:
        if key is not None and (t not in least or key < least[t]):
            least[t] = key
    return sorted(((key, least.get(t), size[t], key == least.get(t), hashlib.sha256(t.encode()).hexdigest(), same[key, t])
                   for key, t in texts), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_texts_that_agree_for_long(spark, ws):
    draw, stem = random.Random(1), "abc\tdéf " * 3000
    rows = []
    for i in range(300):
        cut = draw.choice([0, 1, 7, 8, 9, 63, 64, 65, 1000, len(stem)])
        rows.append((i, stem[:cut] + draw.choice(["", "x", "y", " ", "\n\n"])))
    rows += [(1000 + i, "hot") for i in range(500)]
    for first, growth in ((64, 16), (3, 2)):
        assert result(exact_duplicates(ws, documents(spark, rows), first=first, growth=growth)) == plain(rows)


def test_edge_cases(spark, ws):
    rows = [(1, None), (2, ""), (3, " "), (4, "\t\n"), (None, "a"), (5, "a"), (5, "a"), (6, "b"), (6, "a  b"), (7, "a b"),
            (None, "n"), (None, "n"), (8, "x" * 200_000), (9, "x" * 200_000), (10, "x" * 200_001)]
    assert result(exact_duplicates(ws, documents(spark, rows))) == plain(rows)
    assert exact_duplicates(ws, documents(spark, rows).limit(0)).collect() == []
    assert result(exact_duplicates(ws, documents(spark, rows[:1]))) == plain(rows[:1])


def test_long_texts_under_repeated_and_null_ids(spark, ws):
    x, y = "x" * 64, "y" * 64
    rows = [(5, x + "t"), (6, x + "t"), (5, y + "t"), (7, y + "t"), (None, x + "u"), (None, x + "u"), (None, y + "u"),
            (None, y + "u"), (8, x * 40), (8, y * 40), (9, x * 40), (9, y * 40), (9, y * 40 + "z")]
    assert result(exact_duplicates(ws, documents(spark, rows))) == plain(rows)
