"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded as a vector, gated
attention gives each a weight, and the document is scored by a logistic
function of the weighted mean of its encoded passages. Attention, encoder and
score are learned together from labels of documents; no passage has a label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starrung.llm import words as W
from starrung.llm.sample import labelled_sample

PASSAGE_WORDS = 48
SHAPES = 24
HIDDEN = 12
GATES = 8
# Bounds of the sample that is fitted: documents per label and bytes of a text.
MOST_DOCUMENTS = {0: 2500, 1: 2500}
MOST_BYTES = 20_000
ROUNDS = 300
RIDGE = 1e-3
SEED = 5

# Classes of bytes: small letter, capital, digit, full stop and such, bracket and quote, symbol, white space, beyond ASCII.
_CLASS = np.full(256, 5, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[list(b".,;:?")] = 3
_CLASS[list(b"()[]{}<>\"'")] = 4
_CLASS[list(W.SPACES)] = 6
_CLASS[128:] = 7
_CLASSES = 8
FEATURES = _CLASSES + 8 + SHAPES


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for the outline of each word: its classes of bytes, runs taken once, without length."""
    kind = _CLASS[data].astype(np.uint8)
    kind[kind == 7] = 0
    first = np.ones(len(data), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[starts] = True
    place = np.cumsum(first) - 1
    outline = kind[first]
    begin, end = place[starts], place[ends - 1] + 1
    return W.hashes(W.sums(outline, begin, end), begin, end)


def passages(chunk: W.Texts, size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of ``size`` words, and the document of each; a text without words has one of zeros."""
    starts, ends, row = W.spans(chunk.data, chunk.offsets, W.NOT_SPACE)
    counts = np.bincount(row, minlength=len(chunk))
    per = np.maximum(1, -(-counts // size))
    bag = np.repeat(np.arange(len(chunk)), per)
    out = np.zeros((len(bag), FEATURES), np.float32)
    if not len(starts):
        return out, bag
    begin = np.concatenate([[0], np.cumsum(per)])[:-1]
    place = np.arange(len(starts)) - np.concatenate([[0], np.cumsum(counts)])[row]
    passage = begin[row] + place // size
    first = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    full = passage[first]
    many = np.diff(np.append(first, len(starts))).astype(np.float64)
    low, high = starts[first], ends[np.append(first[1:], len(starts)) - 1]
    span = np.maximum(high - low, 1)
    kind = _CLASS[chunk.data]
    for c in range(_CLASSES):
        upto = np.concatenate([[0], np.cumsum(kind == c, dtype=np.int32)])
        out[full, c] = (upto[high] - upto[low]) / span
    size_ = (ends - starts).astype(np.float64)
    mean = np.add.reduceat(size_, first) / many
    h = W.hashes(W.sums(W.LOWER[chunk.data], starts, ends), starts, ends)
    order = np.lexsort((h, passage))
    ph, pp = h[order], passage[order]
    new = np.concatenate([[True], (ph[1:] != ph[:-1]) | (pp[1:] != pp[:-1])])
    group = np.flatnonzero(new)
    often = np.diff(np.append(group, len(ph)))
    top = np.zeros(len(bag))
    np.maximum.at(top, pp[group], often)
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])])
    edge = kind[ends - 1]
    columns = [
        np.bincount(pp[group], minlength=len(bag))[full] / many,
        top[full] / many,
        np.add.reduceat(same.astype(np.float64), first) / many,
        np.log1p(mean),
        np.sqrt(np.maximum(np.add.reduceat(size_**2, first) / many - mean**2, 0)) / 8,
        np.add.reduceat((edge == 5).astype(np.float64), first) / many,
        np.add.reduceat((size_ == 1).astype(np.float64), first) / many,
        np.minimum(many / size, 1.0),
    ]
    for i, column in enumerate(columns):
        out[full, _CLASSES + i] = column
    shape = (_shapes(chunk.data, starts, ends) % np.uint64(SHAPES)).astype(np.int64)
    seen = np.bincount(passage * SHAPES + shape, minlength=len(bag) * SHAPES).reshape(-1, SHAPES)
    out[full, _CLASSES + 8 :] = seen[full] / many[:, None]
    return out, bag


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    encode: np.ndarray
    encode_bias: np.ndarray
    gate_v: np.ndarray
    gate_u: np.ndarray
    attend: np.ndarray
    score: np.ndarray
    score_bias: np.ndarray

    FITTED = ("encode", "encode_bias", "gate_v", "gate_u", "attend", "score", "score_bias")

    def forward(self, x: np.ndarray, bag: np.ndarray, bags: int) -> dict[str, np.ndarray]:
        """Attention weights ``a`` of passages and scores ``p`` of documents, with what the gradient needs."""
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ self.encode + self.encode_bias)
        v, u = np.tanh(h @ self.gate_v), 1 / (1 + np.exp(-(h @ self.gate_u)))
        e = (v * u) @ self.attend
        first = np.flatnonzero(np.concatenate([[True], bag[1:] != bag[:-1]]))
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        p = 1 / (1 + np.exp(-np.clip(z @ self.score + self.score_bias, -30, 30)))
        return {"x": x, "h": h, "v": v, "u": u, "a": a, "z": z, "p": p, "first": first}


def fit_model(sample: pa.Table, rounds: int = ROUNDS) -> Model:
    """Gradient descent on the log loss, labels weighted to count alike; a sample of one label gives its share as score."""
    xs, bags, done = [], [], 0
    for column in sample.column("text").chunks:
        for chunk in W.chunks(column):
            x, bag = passages(chunk)
            xs.append(x)
            bags.append(bag + done + chunk.first)
        done += len(column)
    y = sample.column("label").to_numpy().astype(np.float64)
    rng = np.random.default_rng(SEED)
    model = Model(np.zeros(FEATURES), np.ones(FEATURES), rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)),
                  np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATES)), rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATES)),
                  rng.normal(0, GATES**-0.5, GATES), np.zeros(HIDDEN), np.zeros(1))
    if not len(y) or y.min() == y.max():
        model.score_bias[:] = 0.0 if not len(y) else (2.0 if y[0] else -2.0)
        return model
    x, bag = np.concatenate(xs).astype(np.float64), np.concatenate(bags)
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    n = len(y)
    importance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / n
    moment = {k: np.zeros_like(getattr(model, k)) for k in Model.FITTED}
    square = {k: np.zeros_like(getattr(model, k)) for k in Model.FITTED}
    for step in range(1, rounds + 1):
        f = model.forward(x, bag, n)
        d = (f["p"] - y) * importance
        dz = d[:, None] * model.score
        dh = f["a"][:, None] * dz[bag]
        da = (dz[bag] * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["first"])[bag])
        dvu = de[:, None] * model.attend
        dv, du = dvu * f["u"] * (1 - f["v"] ** 2), dvu * f["v"] * f["u"] * (1 - f["u"])
        dh = (dh + dv @ model.gate_v.T + du @ model.gate_u.T) * (1 - f["h"] ** 2)
        slope = {"encode": f["x"].T @ dh, "encode_bias": dh.sum(axis=0), "gate_v": f["h"].T @ dv, "gate_u": f["h"].T @ du,
                 "attend": (f["v"] * f["u"]).T @ de, "score": f["z"].T @ d, "score_bias": d.sum(keepdims=True)}
        rate = 0.05 * min(1.0, 2 * (1 - step / (rounds + 1)))
        for k in Model.FITTED:
            g = slope[k] + RIDGE * getattr(model, k)
            moment[k] = 0.9 * moment[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g**2
            move = moment[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
            setattr(model, k, getattr(model, k) - rate * move)
    return model


FOUND = "score double, passage long, attention double"


def score_quality(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", text: str = "text",
                  label: str = "quality", most: dict[int, int] | None = None) -> DataFrame:
    """One row per row of ``docs``: the key, ``score``, and the ``passage`` with the most ``attention``.

    ``train`` is a condition on the rows of ``labels``. A text that is null or
    has no words is one passage of zeros, and scored like any other. Passages
    count from 0; of equal ones the first is named. Repeated rows are scored
    alike, other columns are ignored. Without usable labels all scores are 0.5.
    """
    model = fit_model(labelled_sample(docs, labels, label, train, key, text, most or MOST_DOCUMENTS, MOST_BYTES))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("row"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["row"]

    def score(batches):
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                x, bag = passages(chunk)
                f = shared.value.forward(x.astype(np.float64), bag, len(chunk))
                first = f["first"]
                top = np.maximum.reduceat(f["a"], first)
                at = np.flatnonzero(f["a"] == top[bag])
                at = at[np.unique(bag[at], return_index=True)[1]] - first
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(chunk.first, len(chunk)), pa.array(f["p"]), pa.array(at), pa.array(top)],
                    names=["row", "score", "passage", "attention"])

    return rows.mapInArrow(score, f"row {kind}, {FOUND}").withColumnRenamed("row", key)
