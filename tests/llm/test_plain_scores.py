"""Scores of whole queries and stages against computations document by document, word by word."""

import hashlib
import math
import random
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA
from llm_rows import read
from pyspark.sql import functions as F
from test_native import reshared

from starrung.llm import quality, toxicity
from starrung.llm import words as W
from starrung.llm.queries import QUERIES
from starrung.llm.sample import labelled_sample
from starrung.llm.tables import fold


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in read(spark, "documents").collect()}


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def toxic_by_words(field, text):
    """Score of a text: all its words one after the other, forward and backward, no stretch left out."""
    weight_of = dict(zip(field.hashes.tolist(), field.weights.tolist()))
    words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), text.encode()))
    if not words:
        return 0.0
    parts = [(w, 0) for w in words]
    parts += [(w[:n], n) for w in words for n in (3, 4, 5, 6) if len(w) > n]
    parts += [(w[-4:], 99) for w in words if len(w) > 4]
    hashes = W.hash_words([p for p, _ in parts])
    named = {}
    for (part, kind), h in zip(parts, hashes):
        named[part, kind] = int(h) if kind == 0 else int(W.mix(np.array([h]) + np.uint64(kind))[0])
    steps, marked = [], []
    for w in words:
        features = [named[w, 0]] + [named[w[:n], n] for n in (3, 4, 5, 6) if len(w) > n]
        features += [named[w[-4:], 99]] if len(w) > 4 else []
        known = [weight_of[f] for f in features if f in weight_of]
        marked.append(bool(known))
        steps.append((0.0, field.bias + sum(known)))
    if not any(marked):
        return 0.0
    change = field.change
    forward, before = [], (0.0, -math.inf)
    for step in steps:
        before = tuple(np.logaddexp(before[0] + change[0, b], before[1] + change[1, b]) + step[b] for b in (0, 1))
        forward.append(before)
    backward, after = [], (0.0, 0.0)
    for step in reversed(steps):
        backward.append(after)
        after = tuple(np.logaddexp(change[a, 0] + step[0] + after[0], change[a, 1] + step[1] + after[1]) for a in (0, 1))
    p = [sigmoid(f[1] + b[1] - f[0] - b[0]) for f, b, m in zip(forward, reversed(backward), marked) if m]
    x = (1.0, math.log1p(sum(p)), max(p), math.log1p(100 * sum(p) / len(words)))
    return sigmoid(float(np.dot(x, field.document)))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """A folder with the documents, toxic words in every fourth (the table has few by itself), and labels that say so."""
    draw, rows = random.Random(8), []
    for r in read(spark, "documents").orderBy("doc_id").collect():
        words = (r.text or "").split(" ")
        for _ in range(draw.randrange(1, 6) if r.doc_id % 4 == 0 else draw.randrange(10) == 0):
            begin = draw.choice(["vilex", "scorn"]) if r.doc_id % 4 == 0 else "vilest"
            words.insert(draw.randrange(len(words) + 1), begin + draw.choice(["or", "ING", "é", ""]))
        rows.append((r.doc_id, " ".join(words), r.lang, r.source))
    folder = str(tmp_path_factory.mktemp("planted"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{folder}/documents.parquet")
    docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")).write.parquet(f"{folder}/labels.parquet")
    return folder


def test_toxicity_of_documents_and_its_stage(spark, planted):
    docs, labels = (spark.read.parquet(f"{planted}/{name}.parquet") for name in ("documents", "labels"))
    sample = labelled_sample(docs, labels, "toxic", fold(F.col("doc_id"), 5) != 0, "doc_id", "text",
                             toxicity.MOST_DOCUMENTS, toxicity.MOST_BYTES)
    field = toxicity.fit_field(sample)
    want = {r.doc_id: toxic_by_words(field, r.text) for r in docs.collect()}
    got = {r.doc_id: r.score for r in QUERIES["op5_toxicity"](spark, planted).collect()}
    assert got == pytest.approx(want, abs=1e-6)
    assert len(want) / 5 < sum(s >= 0.5 for s in want.values()) < len(want) / 3
    stayed = {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, planted).collect()}
    assert stayed == {k for k, s in want.items() if s < 0.5}


def quality_by_passages(model, text):
    """Score of a text, passage by passage, with its attention weights."""
    chunk = next(W.chunks(pa.array([text])))
    encoded, gates = [], []
    for x in quality.passages(chunk)[0].astype(float):
        h = np.tanh(np.clip((x - model.mean) / model.scale, -8, 8) @ model.encode + model.encode_bias)
        encoded.append(h)
        gates.append(sum(math.tanh(v) * sigmoid(u) * a for v, u, a in zip(h @ model.gate_v, h @ model.gate_u, model.attend)))
    attention = [math.exp(g) for g in gates]
    z = sum(a * h for a, h in zip(attention, encoded)) / sum(attention)
    return sigmoid(float(z @ model.score) + model.score_bias[0]), max(attention) / sum(attention)


def test_quality_of_documents(spark, texts):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    sample = labelled_sample(docs, labels, "quality", fold(F.col("doc_id"), 4) != 2, "doc_id", "text",
                             quality.MOST_DOCUMENTS, quality.MOST_BYTES)
    model = quality.fit_model(sample)
    want = {k: quality_by_passages(model, t) for k, t in texts.items()}
    got = QUERIES["op3_quality"](spark, DATA).collect()
    assert {r.doc_id: r.score for r in got} == pytest.approx({k: s for k, (s, _) in want.items()}, abs=1e-4)
    assert {r.doc_id: r.attention for r in got} == pytest.approx({k: a for k, (_, a) in want.items()}, abs=1e-4)


def taken_in_order(rows):
    """Words taken per name of rows (name, text, source), each source sorted whole by its keys."""
    sizes, order = {}, {}
    for name, text, source in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        odd = len(re.findall(r"[0-9#$%&*+/<=>@\[\\\]^_`{|}~!]", text))
        weight = max(0.1, 1 - odd / len(text)) if text else 0.1
        draw = (int(hashlib.md5(f"1:{name}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        sizes[source] = sizes.get(source, 0) + size
        order.setdefault(source, []).append((-math.log(draw) / weight, name, size))
    out = {}
    for source, target in reshared(sizes).items():
        epochs = int(target // sizes[source]) if sizes[source] else 0
        budget, end = target - epochs * sizes[source], 0
        for _, name, size in sorted(order[source]):
            end += size
            out[name] = size * (epochs + (end - size / 2 <= budget))
    return out


def test_mixing_stage_takes_what_sorted_sources_give(spark):
    docs = read(spark, "documents").dropDuplicates(["doc_id"])
    names = docs.select(F.struct(corpus_pipeline.row_key().alias("k"), "source").alias("s"), "doc_id", "text", "source")
    names = names.select(F.struct("s.k.*", "source").cast("string").alias("name"), "doc_id", "text", "source").collect()
    want = taken_in_order([(r.name, r.text or "", r.source) for r in names])
    got = {r.doc_id: r.taken for r in corpus_pipeline.mixing(spark, docs, DATA).collect()}
    assert got == {r.doc_id: want[r.name] for r in names if want[r.name] > 0}
