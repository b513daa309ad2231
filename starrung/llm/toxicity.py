"""Toxic spans by a linear-chain conditional random field over words, and document scores from its marginals.

Words have two tags, toxic or not. Features are the word, its beginnings and
its ending; those that occur in toxic training documents significantly more
often than in others are kept, the surest of them label the words of the
training documents, and the field is fitted to these labels. A word without any such feature has the same
potentials as every other, so the forward and backward messages pass a stretch
of them by one power of the step matrix.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starrung.llm import words as W
from starrung.llm.sample import labelled_sample, without_copies

# Bounds of the sample that is fitted: documents per label and bytes of a text.
MOST_DOCUMENTS = {0: 2500, 1: 1250}
MOST_BYTES = 20_000
# The driver looks at so many bytes of the sample at a time.
SAMPLE_BYTES = 1 << 19
SEGMENT = 48
ROUNDS = 120
RIDGE = 0.02
THRESHOLD = 0.5
# A word with a feature that is so much likelier in toxic documents is labelled toxic there.
SURE_ODDS = 25.0
MIN_ODDS = 6.0

_INSIDE = W.class_of(bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122)))
_BEGINNINGS = (3, 4, 5, 6)
_ENDING = 4
_FEATURES = 2 + len(_BEGINNINGS)


def features_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per kind of feature: the words that have it, and its hash."""
    total = W.sums(data, starts, ends)
    out = [(np.arange(len(starts)), W.hashes(total, starts, ends))]
    for n in _BEGINNINGS:
        long = np.flatnonzero(ends - starts > n)
        out.append((long, W.mix(W.hashes(total, starts[long], starts[long] + n) + np.uint64(n))))
    long = np.flatnonzero(ends - starts > _ENDING)
    out.append((long, W.mix(W.stretch_hashes(data, ends[long] - _ENDING, _ENDING) + np.uint64(99))))
    return out


@dataclass
class Field:
    """Hashes and weights of the features; bias of the toxic tag; log potentials of tag changes; weights of a document's score."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    change: np.ndarray
    maybe: np.ndarray
    document: np.ndarray

    def score(self, row: np.ndarray, marked: np.ndarray, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Score of each document from the marginals of its marked words; 0 without any."""
        some = np.bincount(row[marked], minlength=len(counts)) > 0
        x = _document_features(row, marked, p, counts)
        return np.where(some, 1 / (1 + np.exp(-np.clip(x @ self.document, -30, 30))), 0.0)

    def words(self, chunk: W.Texts):
        """All words of some texts: where they are, which have features, and the sum of their weights."""
        data = W.LOWER[chunk.data]
        starts, ends, row = W.spans(data, chunk.offsets, _INSIDE)
        extra, marked = np.zeros(len(starts)), np.zeros(len(starts), bool)
        if len(starts) and len(self.hashes):
            for which, h in features_of(data, starts, ends):
                near = np.flatnonzero(self.maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.hashes, h[near]), len(self.hashes) - 1)
                same = self.hashes[at] == h[near]
                word = which[near[same]]
                extra[word] += self.weights[at[same]]
                marked[word] = True
        return starts, ends, row, np.flatnonzero(marked), extra


def _document_features(row: np.ndarray, marked: np.ndarray, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A constant, the expected number of toxic words, the largest marginal, and the expected number in a hundred words."""
    n = len(counts)
    expected = np.bincount(row[marked], p, n) if len(marked) else np.zeros(n)
    largest = np.zeros(n)
    np.maximum.at(largest, row[marked], p)
    return np.stack([np.ones(n), np.log1p(expected), largest, np.log1p(100 * expected / np.maximum(counts, 1))], axis=1)


def _fit_documents(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic regression of the documents' labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = x.T @ (x * (p * (1 - p))[:, None]) + RIDGE * np.eye(len(w))
        w = w + np.linalg.solve(curve, x.T @ (label - p) - RIDGE * w)
    return w


def _maybe(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 20, bool)
    out[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    return out


def _powers(step: np.ndarray, most: int) -> list[tuple[np.ndarray, float]]:
    """step to the powers 1, 2, 4, ...; each scaled to a largest entry of 1, with the log of the scale."""
    out, scale = [], 0.0
    current = step.copy()
    for _ in range(max(1, int(most).bit_length())):
        top = current.max()
        current, scale = current / top, scale + math.log(top)
        out.append((current, scale))
        current, scale = current @ current, 2 * scale
    return out


def _pass_plain(vectors: np.ndarray, gaps: np.ndarray, powers, right: bool) -> np.ndarray:
    """Messages across stretches of plain words, scaled to add up to 1."""
    for k, (power, _) in enumerate(powers):
        use = (gaps >> k & 1).astype(bool)
        if use.any():
            vectors[use] = vectors[use] @ (power.T if right else power)
    return vectors / vectors.sum(axis=1, keepdims=True)


def marginals(field: Field, row: np.ndarray, marked: np.ndarray, extra: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag of each marked word, by forward and backward messages over its document.

    ``row`` is the document of every word and ``counts`` the words of each
    document. Documents go side by side, marked word by marked word.
    """
    out = np.zeros(len(marked))
    if not len(marked):
        return out
    of = row[marked]
    first = np.concatenate([[0], np.cumsum(counts)])[of]
    place = marked - first
    docs, begin, many = np.unique(of, return_index=True, return_counts=True)
    change = np.exp(field.change)
    plain = change * np.array([1.0, math.exp(field.bias)])
    powers = _powers(plain, int(counts.max()))
    score = np.exp(np.clip(field.bias + extra[marked], -60, 60))
    nth = np.arange(len(marked)) - np.repeat(begin, many)
    before = np.where(nth == 0, place, place - np.concatenate([[0], place[:-1]]) - 1)
    after = np.where(nth == np.repeat(many, many) - 1, counts[of] - 1 - place, 0)
    order = np.argsort(-many, kind="stable")
    begin, many = begin[order], many[order]
    forward = np.zeros((len(marked), 2))
    # A virtual plain tag before the first word, so that the first word has a change too.
    message = np.tile([1.0, 0.0], (len(docs), 1))
    for j in range(int(many[0])):
        n = int(np.searchsorted(-many, -j, side="left"))
        at = begin[:n] + j
        message = _pass_plain(message[:n], before[at], powers, False) @ change
        message[:, 1] *= score[at]
        message /= message.sum(axis=1, keepdims=True)
        forward[at] = message
    backward = np.ones((len(docs), 2))
    for j in range(int(many[0]) - 1, -1, -1):
        n = int(np.searchsorted(-many, -j, side="left"))
        at = begin[:n] + j
        last = j == many[:n] - 1
        here = backward[:n]
        here[last] = _pass_plain(np.ones((int(last.sum()), 2)), after[at[last]], powers, True)
        both = forward[at] * here
        out[at] = both[:, 1] / both.sum(axis=1)
        here = here * np.stack([np.ones(n), score[at]], axis=1)
        here = _pass_plain(here @ change.T, before[at], powers, True)
        backward[:n] = here
    return out


def _words_of(sample: pa.Table):
    """Words of the sample, some texts at a time: their bytes, starts, ends, and the document of each."""
    done = 0
    for column in sample.column("text").chunks:
        for chunk in W.chunks(column, SAMPLE_BYTES):
            data = W.LOWER[chunk.data]
            starts, ends, row = W.spans(data, chunk.offsets, _INSIDE)
            yield data, starts, ends, row + done + chunk.first
        done += len(column)


def _documents_with(sample: pa.Table, label: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All features of one kind in order, with the toxic and the other documents that have each."""
    known, toxic, clean = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    for data, starts, ends, row in _words_of(sample):
        which, h = features_of(data, starts, ends)[kind]
        order = np.lexsort((row[which], h))
        h, d = h[order], row[which][order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        h, y = h[new], label[d[new]]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        ones = np.add.reduceat(y, first).astype(np.int32) if len(h) else toxic[:0]
        rest = np.diff(np.append(first, len(h))).astype(np.int32) - ones
        h = h[first]
        at = np.searchsorted(known, h)
        have = np.zeros(len(h), bool)
        inside = at < len(known)
        have[inside] = known[at[inside]] == h[inside]
        toxic[at[have]] += ones[have]
        clean[at[have]] += rest[have]
        known, toxic, clean = (np.insert(old, at[~have], more[~have])
                               for old, more in ((known, h), (toxic, ones), (clean, rest)))
    return known, toxic, clean


def _associated(sample: pa.Table, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of features that toxic documents have significantly more often, in order, and which are sure signs.

    The bound of the likelihood ratio grows with the number of features that are tested.
    """
    share, tested, found = label.mean(), 1, []
    for kind in range(_FEATURES):
        known, toxic, clean = _documents_with(sample, label, kind)
        tested += len(known)
        likely = toxic > 0
        known, toxic, clean = known[likely], toxic[likely].astype(np.float64), clean[likely].astype(np.float64)
        both = toxic + clean
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = toxic * np.log(toxic / (both * share)) + np.where(
                clean > 0, clean * np.log(clean / (both * (1 - share))), 0)
        odds = np.log((toxic + 0.5) / (label.sum() + 1)) - np.log((clean + 0.5) / ((1 - label).sum() + 1))
        some = odds > math.log(MIN_ODDS)
        found.append((known[some], ratio[some], odds[some]))
    known, ratio, odds = map(np.concatenate, zip(*found))
    known, first = np.unique(known, return_index=True)
    chosen = ratio[first] > math.log(tested) + 1
    return known[chosen], odds[first][chosen] > math.log(SURE_ODDS)


def fit_field(sample: pa.Table, rounds: int = ROUNDS) -> Field:
    """Fits the field on ``text, label``; without both labels it has no features and tags nothing."""
    sample = without_copies(sample)
    label = sample.column("label").to_numpy().astype(np.int64)
    empty = Field(np.zeros(0, np.uint64), np.zeros(0), -8.0, np.zeros((2, 2)), _maybe(np.zeros(0, np.uint64)), np.zeros(4))
    if not len(label) or label.min() == label.max():
        return empty
    chosen, sure = _associated(sample, label)
    if not len(chosen):
        return empty
    rows, word_of, feature, words = [], [], [], 0
    for data, starts, ends, row in _words_of(sample):
        for which, h in features_of(data, starts, ends):
            at = np.minimum(np.searchsorted(chosen, h), len(chosen) - 1)
            has = chosen[at] == h
            word_of.append(which[has] + words)
            feature.append(at[has])
        rows.append(row.astype(np.int32))
        words += len(starts)
    row, word_of, feature = np.concatenate(rows), np.concatenate(word_of), np.concatenate(feature)
    all_words, all_features = word_of, feature
    marked, signed = np.zeros(len(row), bool), np.zeros(len(row), bool)
    marked[word_of] = True
    signed[word_of[sure[feature]]] = True
    tag = signed & (label[row] == 1)
    # Segments of whole documents' words. Of those without any marked word the ones of a length are all alike: one is
    # kept, which counts as often as they occur.
    place = np.arange(len(row)) - np.searchsorted(row, row)
    segment = np.cumsum((place % SEGMENT == 0).astype(np.int64)) - 1
    n = int(segment[-1]) + 1
    with_mark = np.bincount(segment, marked, n) > 0
    used = with_mark.copy()
    size, weight = np.bincount(segment, minlength=n), np.ones(n)
    plain = np.flatnonzero(~with_mark)
    _, first, many = np.unique(size[plain], return_index=True, return_counts=True)
    used[plain[first]], weight[plain[first]] = True, many
    number = np.cumsum(used) - 1
    size, weight = size[used], weight[used]
    inside = used[segment]
    y = np.zeros((int(used.sum()), SEGMENT), np.int64)
    y[number[segment[inside]], place[inside] % SEGMENT] = tag[inside]
    cell = np.full(len(row), -1, np.int64)
    cell[inside] = number[segment[inside]] * SEGMENT + place[inside] % SEGMENT
    feature, cells = feature[cell[word_of] >= 0], cell[word_of][cell[word_of] >= 0]
    field = _maximise(chosen, feature, cells, y, size, weight, rounds)
    extra = np.bincount(all_words, field.weights[all_features], len(row))
    counts = np.bincount(row, minlength=len(label))
    at = np.flatnonzero(marked)
    p = marginals(field, row.astype(np.int64), at, extra, counts)
    return replace(field, document=_fit_documents(_document_features(row, at, p, counts), label))


def _maximise(chosen, feature, cells, y, size, weight, rounds) -> Field:
    """Penalised likelihood of the tags of all segments, which count by ``weight``, by gradient steps of adapted length."""
    n, width = y.shape
    valid = np.arange(width) < size[:, None]
    counted = valid * weight[:, None]
    weights, bias, change = np.zeros(len(chosen)), -3.0, np.zeros((2, 2))
    previous = np.concatenate([np.zeros((n, 1), np.int64), y[:, :-1]], axis=1)
    seen_change = np.array([[np.sum(counted * ((previous == a) & (y == b))) for b in (0, 1)] for a in (0, 1)], float)
    seen_weights = np.bincount(feature, (y * counted).ravel()[cells], len(chosen))
    seen_bias = float((y * counted).sum())
    theta = np.concatenate([weights, [bias], change.ravel()])
    step, last = np.full(len(theta), 0.1), np.zeros(len(theta))
    for _ in range(rounds):
        weights, bias, change = theta[: len(chosen)], theta[len(chosen)], theta[len(chosen) + 1 :].reshape(2, 2)
        extra = np.bincount(cells, weights[feature], n * width).reshape(n, width)
        score = np.exp(np.clip(bias + extra, -40, 40))
        a = np.exp(change)
        forward, pairs = np.zeros((width, n, 2)), np.zeros((2, 2))
        message = np.tile([1.0, 0.0], (n, 1))
        for t in range(width):
            message = message @ a
            message[:, 1] *= score[:, t]
            message /= message.sum(axis=1, keepdims=True)
            message = np.where(valid[:, t, None], message, forward[t - 1] if t else message)
            forward[t] = message
        back, p = np.ones((n, 2)), np.zeros((n, width))
        for t in range(width - 1, -1, -1):
            both = forward[t] * back
            p[:, t] = both[:, 1] / both.sum(axis=1) * counted[:, t]
            before = forward[t - 1] if t else np.tile([1.0, 0.0], (n, 1))
            here = back * np.stack([np.ones(n), score[:, t]], axis=1)
            joint = before[:, :, None] * a[None] * here[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            pairs += (joint * counted[:, t, None, None]).sum(axis=0)
            new = here @ a.T
            new /= new.sum(axis=1, keepdims=True)
            back = np.where(valid[:, t, None], new, back)
        slope = np.concatenate([seen_weights - np.bincount(feature, p.ravel()[cells], len(chosen)),
                                [seen_bias - p.sum()], (seen_change - pairs).ravel()]) - RIDGE * theta
        same = slope * last
        step = np.clip(np.where(same > 0, step * 1.2, np.where(same < 0, step * 0.5, step)), 1e-6, 1.0)
        theta = theta + np.sign(slope) * step
        last = np.where(same < 0, 0.0, slope)
    weights, bias, change = theta[: len(chosen)], theta[len(chosen)], theta[len(chosen) + 1 :].reshape(2, 2)
    return Field(chosen, weights, float(bias), change, _maybe(chosen), np.zeros(4))


FOUND = "score double, spans array<struct<start:long,end:long,p:double>>"


def find_toxicity(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", text: str = "text",
                  label: str = "toxic", most: dict[int, int] | None = None, threshold: float = THRESHOLD,
                  carry: str | None = None) -> DataFrame:
    """One row per row of ``docs``: the key, ``score`` and ``spans`` of offending words.

    ``train`` is a condition on the rows of ``labels``, which are found by the
    key. ``carry`` names a column that rows are returned with instead of it. The score is a
    logistic function of the marginals, fitted on the sample: of the expected
    number of toxic words, their density and the largest marginal; a text that is null, empty or without marked words has 0.
    ``spans`` are runs of words whose marginal reaches ``threshold``, in code
    points with an exclusive end, with the largest marginal. Repeated rows are
    treated alike, other columns are ignored. Without usable labels all scores are 0.
    """
    field = fit_field(labelled_sample(docs, labels, label, train, key, text, most or MOST_DOCUMENTS, MOST_BYTES))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    key = carry or key
    rows = docs.select(F.col(key).alias("row"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["row"]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def tag(batches):
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                n = len(chunk)
                starts, ends, row, marked, extra = shared.value.words(chunk)
                counts = np.bincount(row, minlength=n)
                p = marginals(shared.value, row, marked, extra, counts)
                score = shared.value.score(row, marked, p, counts)
                spans: list[list[dict]] = [[] for _ in range(n)]
                bad = marked[p >= threshold]
                if len(bad):
                    points = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
                    new = np.concatenate([[True], (bad[1:] != bad[:-1] + 1) | (row[bad[1:]] != row[bad[:-1]])])
                    run = np.cumsum(new) - 1
                    top = np.zeros(run[-1] + 1)
                    np.maximum.at(top, run, p[p >= threshold])
                    last = np.append(np.flatnonzero(new)[1:], len(bad)) - 1
                    for a, b, q in zip(bad[new].tolist(), bad[last].tolist(), top.tolist()):
                        zero = points[chunk.offsets[row[a]]]
                        spans[row[a]].append({"start": int(points[starts[a]] - zero), "end": int(points[ends[b]] - zero), "p": q})
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(chunk.first, n), pa.array(np.clip(score, 0.0, 1.0)),
                     pa.array(spans, span)], names=["row", "score", "spans"])

    return rows.mapInArrow(tag, f"row {kind}, {FOUND}").withColumnRenamed("row", key)
