"""Mixing, personal data and shared lines on small inputs; their queries are compared with SQL in test_llm_queries."""

import random
import time
from collections import defaultdict

import pytest
from llm_rows import documents
from pyspark.sql import functions as F

from starrung.llm.lines import remove_shared_lines
from starrung.llm.mixing import mix, source_targets
from starrung.llm.pii import find_personal_data


def reshared(sizes, weights=(5.0, 2.0, 1.0), most=3.0):
    """Targets by sharing again and again what sources cannot take."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, left = {}, float(sum(sizes.values()))
    open_ = set(order)
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > most * sizes[s]}
        if not full:
            target |= {s: share * weight[s] for s in open_}
            break
        target |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 3, None: 50, "d": 0, "é": 700}, {"a": 0}, {None: 5}, {"x": 7, "y": 7, "z": 7}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    assert got == pytest.approx(reshared(sizes))


@pytest.mark.parametrize("cell_rows", [4096, 7])
def test_mix(spark, ws, cell_rows):
    draw = random.Random(4)
    rows = [(i, "w " * draw.randrange(40), draw.choice(["a", "a", "a", "b", "c", None])) for i in range(900)]
    rows += [(None, "a b c", "b"), (901, None, "c"), (902, "", None), (5, "same id", "a")]
    docs = documents(spark, rows)
    got = mix(ws, docs, cell_rows=cell_rows).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (k is None, k or 0, len((t or "").split())) for k, t, _ in rows)
    sums = defaultdict(lambda: [0, 0, 0.0])
    for r in got:
        assert r.size == 0 or (r.taken % r.size == 0 and 0 <= r.taken <= 3 * r.size)
        sums[r.source][0] += r.taken
        sums[r.source][1] += r.size
        sums[r.source][2] = r.target
    assert {s: v[2] for s, v in sums.items()} == pytest.approx(reshared({s: v[1] for s, v in sums.items()}))
    assert all(abs(taken - target) <= 20 for taken, _, target in sums.values())
    again = mix(ws, docs.repartition(5), cell_rows=cell_rows).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mix(ws, docs.limit(0)).collect() == []


def test_better_texts_come_first(spark, ws):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("w w w w").alias("text"),
                                    F.when(F.col("id") < 3000, "a").otherwise("b").alias("source"),
                                    F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.2).alias("good"))
    got = mix(ws, docs, quality=F.col("good"), weights=(1.0, 2.0)).where("source = 'a'").groupBy(
        (F.col("doc_id") % 2).alias("odd")).agg((F.sum("taken") / F.sum("size")).alias("share"))
    share = {r.odd: r.share for r in got.collect()}
    assert share[0] > 2 * share[1] > 0


def spans(spark, text):
    found = find_personal_data(documents(spark, [(1, text)])).first().found
    return [(s.kind, s.start, s.end, text[s.start : s.end] == s.value, round(s.score, 2)) for s in found]


def test_personal_data(spark):
    assert spans(spark, "é mail a.b+c@x-y.example.com, a@b") == [("email", 7, 28, True, 1.0)]
    assert spans(spark, "1.2.3.4.5.6.7.8 and 256.1.1.1") == [("ip", 0, 7, True, 0.6), ("ip", 8, 15, True, 0.6)]
    assert spans(spark, "4111 1111-1111 1111 4111111111111112") == []  # one run of 32 digits
    assert spans(spark, "my card 4111 1111-1111 1111.") == [("card", 8, 27, True, 0.9)]
    assert spans(spark, "x 4111111111111112 y") == []
    assert spans(spark, "+1 (017) 555-7713 or +1234567") == [("phone", 0, 17, True, 0.7)]
    assert spans(spark, "GB82WEST12345698765432; GB82 WEST 1234 5698 7654 32; GB83WEST12345698765432") == [
        ("iban", 0, 22, True, 0.8), ("iban", 24, 51, True, 0.8)]
    assert spans(spark, "ssn 123-45-6789") == [("ssn", 4, 15, True, 0.5)]
    assert spans(spark, "no 123-45-6789, ssn 000-45-6789") == [("ssn", 3, 14, True, 0.5)]
    assert spans(spark, "part 123-45-6789") == []


def test_personal_data_in_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "9" * 100_000), (4, "1 " * 50_000), (5, "a@b" + ".c" * 50_000), (6, "x" * 200_000 + " +"),
            (7, "1.1." * 30_000), (None, "a@b.c"), (8, "a@b.c"), (8, "a@b.c"), (9, "@" * 50_000 + "+" * 50_000)]
    found = find_personal_data(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: len(r.found) for r in found}
    assert by[1] == by[2] == by[3] == by[4] == by[6] == by[9] == 0 and by[5] == by[8] == by[None] == 1 and by[7] == 15_000
    assert find_personal_data(documents(spark, rows).limit(0)).collect() == []


def test_shared_lines(spark, ws):
    draw = random.Random(9)
    common = [f"this line is on many sites, number {i}" for i in range(30)]
    rows = []
    for i in range(400):
        lines = [f"own line of document number {i}"] + draw.sample(common, 3) + ["short", "", f" {common[0]}\t"]
        rows.append((i, "\n".join(lines), draw.choice([f"s{j}" for j in range(12)] + [None])))
    rows += [(500, None, "s0"), (501, "", "s1"), (None, common[1], "s2"), (1, common[2], "s1"), (502, "x" * 100_000, None)]
    for least in (2, 5, 12, 13):
        sites = defaultdict(set)
        for _, text, site in rows:
            for line in (text or "").split("\n"):
                sites[line.strip(" \t")].add(site)
        want = []
        for key, text, _ in rows:
            lines = (text or "").split("\n")
            kept = [x for x in lines if not x.strip(" \t") or len(sites[x.strip(" \t")]) < least]
            want.append((key, "\n".join(kept), len(lines), len(lines) - len(kept)))
        got = [tuple(r) for r in remove_shared_lines(ws, documents(spark, rows), min_sites=least).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert remove_shared_lines(ws, documents(spark, rows).limit(0)).collect() == []


def test_short_lines_and_a_text_of_very_many_shared_lines(spark, ws):
    many = "\n".join(f"l{i % 500}" if i % 3 else f"own {i}" for i in range(100_000))
    rows = [(1, many, "a"), (2, many, "b"), (3, "l1\nx\nl2", "c"), (4, "", "c"), (5, "\n \n\t", "d"), (6, " \n ", "e"), (6, "x", "e")]
    began = time.monotonic()
    got = {(r.doc_id, r.n_lines): r for r in remove_shared_lines(ws, documents(spark, rows), min_sites=3).collect()}
    assert time.monotonic() - began < 60
    assert got[3, 3].text == "x" and got[4, 1].text == "" and got[5, 3].text == "\n \n\t" and got[6, 2].text == " \n "
    gone = {x for x in many.split("\n") if x in ("l1", "l2")}
    assert got[1, 100_000].text == got[2, 100_000].text == "\n".join(x for x in many.split("\n") if x not in gone)


@pytest.mark.parametrize("dense", ["12 ab ", "1.2.3.4 ", "a@b.c "])
def test_personal_data_takes_a_megabyte_of_matches(spark, dense):
    text = dense * (1_000_000 // len(dense)) + "4111 1111 1111 1111"
    began = time.monotonic()
    found = find_personal_data(documents(spark, [(1, text)])).first().found
    assert time.monotonic() - began < 20
    assert all(text[s.start : s.end] == s.value for s in found)
    assert [s.start for s in found if s.kind == "card"] == ([len(text) - 19] if "ab" in dense or "@" in dense else [])
    if "ab" not in dense:
        assert len(found) >= 100_000
