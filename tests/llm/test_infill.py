"""Cutting and restoring on small inputs; the query is compared with SQL in test_llm_queries."""

from hashlib import sha256

import pytest
from llm_rows import documents

from starrung.llm import infill
from starrung.llm.infill import fill_in_middle, restore_middle


def plain(key, text):
    text = text or ""
    digest = sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return key, n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return key, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return key, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


ROWS = [(1, None), (2, ""), (3, "a"), (3, "a"), (3, "other"), (None, "null id"), (None, None), (4, "has <P> mark"), (5, "<M>"),
        (6, "é中🙂" * 500), (7, "<" * 50), (8, "<P" * 30), (9, "S>" * 40), (10, "a\x00b\n\r\n"), (11, "x" * 3_000_000)]
ROWS += [(100 + i, "some words to cut ü " * (i % 7) + "<P<S<M"[: i % 7]) for i in range(300)]


def check(spark, rows):
    made = fill_in_middle(documents(spark, rows))
    got = [tuple(r) for r in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()]
    assert sorted(got, key=str) == sorted((plain(k, t) for k, t in rows), key=str)
    back = restore_middle(made, carry=("form",)).collect()
    assert sorted(((r.doc_id, r.restored) for r in back), key=str) == sorted(((k, t or "") for k, t in rows), key=str)


def test_like_plain(spark):
    check(spark, ROWS)
    assert {plain(k, t)[2] for k, t in ROWS} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("stretch", [8, 64])
def test_stretches_make_no_difference(stretch, monkeypatch):
    import pyarrow as pa

    texts = ["é中🙂a" * 40, "b", "c" * 100, "", "<S>" * 9]
    keys = [5, 6, 7, 8, 9]
    draws = [pa.array([int(sha256(f"1:{k}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for k in keys]) for i in range(4)]
    monkeypatch.setattr(infill, "STRETCH", stretch)
    for i, (k, t) in enumerate(zip(keys, texts)):
        made = infill.transformed(pa.array([t]), [d.slice(i, 1) for d in draws])
        assert (k, *(made[c][0].as_py() for c in ("n", "form", "prefix_chars", "middle_chars", "output"))) == plain(k, t)


def test_shares_and_odd_forms(spark):
    rows = documents(spark, [(i, "abc def") for i in range(2000)])
    forms = {r.form: r["count"] / 2000 for r in fill_in_middle(rows).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 0.1) < 0.03 and abs(forms["spm"] - 0.18) < 0.03
    only = fill_in_middle(rows, plain_from=100, spm_below=0).select("form").distinct().collect()
    assert [r.form for r in only] == ["psm"]
    odd = spark.createDataFrame([(1, "other", "x"), (2, None, None), (3, "plain", "<P>")], "doc_id long, form string, output string")
    assert {r.doc_id: r.restored for r in restore_middle(odd).collect()} == {1: "x", 2: "", 3: "<P>"}


def test_empty_table(spark):
    made = fill_in_middle(documents(spark, ROWS).limit(0))
    assert made.collect() == [] and restore_middle(made).collect() == []
