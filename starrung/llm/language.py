"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point. A
letter's place in an n-gram is a permutation of its vector, the product of the
permuted vectors stands for the n-gram, and the sum over a document's n-grams
for the document. A language's prototype is the sum over its training
documents; a document takes the language with the nearest prototype by cosine.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starrung.llm import words as W

DIMENSIONS = 1024
SEED = 11
UNKNOWN = "und"
# Documents have length 1 in a prototype; integers in these units add up the same in any order.
UNITS = 1 << 24
COLUMNS = 4096
SLICE = 1 << 20
MOST_BYTES = 64 << 20

_letter = np.full(0x110000, -1, np.int32)
_vectors: dict[tuple[int, int], np.ndarray] = {}


def _folded(points: np.ndarray) -> np.ndarray:
    """Lower-cased letters, and 0 for everything else."""
    for p in np.unique(points[_letter[points] < 0]).tolist():
        low = chr(p).lower()
        _letter[p] = (ord(low) if len(low) == 1 else p) if chr(p).isalpha() else 0
    return _letter[points]


def letter_vector(point: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The random vector of a letter; 0 stands for the stretch between words."""
    if (point, dimensions) not in _vectors:
        if len(_vectors) > 20_000:
            _vectors.clear()
        draw = np.random.Generator(np.random.Philox(key=[SEED, point]))
        _vectors[point, dimensions] = (draw.integers(0, 2, dimensions, np.int8) * 2 - 1).astype(np.int8)
    return _vectors[point, dimensions]


def bundle(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """The sum of the trigram vectors of each text, as rows; zeros for a text without letters."""
    points = np.frombuffer(("\n" + "".join(t + "\n" for t in texts)).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    row = np.concatenate([[0], row])
    letters = _folded(points)
    kept = letters != 0
    kept[0] = True
    kept[1:] |= letters[:-1] != 0
    return _bundled(letters[kept], row[kept], len(texts), dimensions)


def _bundled(letters: np.ndarray, row: np.ndarray, rows: int, dimensions: int) -> np.ndarray:
    """The sums over all runs of three letters, with one 0 between words; a 0 in the middle counts within a row only."""
    out = np.zeros((rows, dimensions), np.float32)
    if len(letters) < 3:
        return out
    alphabet, code = np.unique(letters, return_inverse=True)
    base = len(alphabet)
    code = code.astype(np.int64)
    middle = letters[1:-1] != 0
    whole = middle | (row[:-2] == row[2:])
    gram = ((code[:-2] * base + code[1:-1]) * base + code[2:])[whole]
    of = np.where(middle, row[1:-1], row[:-2])[whole]
    key = np.sort(of * base**3 + gram)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(first, len(key))).astype(np.float32)
    of, gram = np.divmod(key[first], base**3)
    kinds, column = np.unique(gram, return_inverse=True)
    basis = np.stack([letter_vector(int(p), dimensions) for p in alphabet])
    turned, twice = np.roll(basis, 1, axis=1), np.roll(basis, 2, axis=1)
    order = np.argsort(column, kind="stable")
    of, column, count = of[order], column[order], count[order]
    for low in range(0, len(kinds), COLUMNS):
        part = kinds[low : low + COLUMNS]
        vectors = twice[part // base**2] * turned[part // base % base] * basis[part % base]
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        counts = np.zeros((rows, len(part)), np.float32)
        counts[of[a:b], column[a:b] - low] = count[a:b]
        out += counts @ vectors.astype(np.float32)
    return out


def bundle_whole(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """``bundle``, with a very long text added up from slices; each takes over the last two letters of the one before."""
    if max(map(len, texts), default=0) <= SLICE:
        return bundle(texts, dimensions)
    out = np.zeros((len(texts), dimensions), np.float32)
    for i, text in enumerate(texts):
        last = np.zeros(1, np.int32)
        for at in range(0, len(text), SLICE):
            part = text[at : at + SLICE] + ("\n" if at + SLICE >= len(text) else "")
            new = _folded(np.frombuffer(part.encode("utf-32-le"), np.uint32))
            letters = np.concatenate([last, new])
            kept = letters != 0
            kept[: len(last)] = True
            kept[1:] |= letters[:-1] != 0
            letters = letters[kept]
            out[i] += _bundled(letters, np.zeros(len(letters), np.int64), 1, dimensions)[0]
            last = letters[-2:]
    return out


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def _pieces(batch: pa.RecordBatch):
    """Row ranges and texts of a batch, a few megabytes at a time."""
    for chunk in W.chunks(batch.column("text")):
        part = slice(chunk.first, chunk.first + len(chunk))
        yield part, pc.fill_null(batch.column("text").slice(chunk.first, len(chunk)), "").to_pylist()


def learn_prototypes(docs: DataFrame, text: str, lang: str, train: Column,
                     dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages by code point, and their prototypes as rows; over all rows that ``train`` marks.

    Every task adds up its documents by language; only the sums are shuffled.
    What comes to the driver is one vector per language.
    """
    rows = docs.where(train & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.where(F.col("text").isNotNull())

    def add(batches):
        total: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(dimensions, np.int64))
        for batch in batches:
            for part, texts in _pieces(batch):
                got = bundle_whole(texts, dimensions)
                got = np.rint(got / _lengths(got) * UNITS).astype(np.int64)
                names = np.array(batch.column("lang").slice(part.start, len(texts)).to_pylist(), object)
                for name in set(names.tolist()):
                    total[name] += got[names == name].sum(axis=0)
        for name, vector in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions, pa.string()), pa.array(np.arange(dimensions, dtype=np.int32)),
                 pa.array(vector)], names=["lang", "place", "value"])

    sums = rows.mapInArrow(add, "lang string, place int, value long").groupBy("lang", "place").agg(
        F.sum("value").alias("value"))
    lists = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("at"))
    most = MOST_BYTES // (4 * dimensions)
    found = sorted((r.lang, [v.value for v in r["at"]]) for r in lists.limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"more than {most} languages; their prototypes are too large to send to every task")
    return [name for name, _ in found], np.array([v for _, v in found], np.float64).reshape(len(found), dimensions)


def identify_language(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
                      dimensions: int = DIMENSIONS) -> DataFrame:
    """One row per row of ``docs``: the key, ``lang_pred, score, margin``.

    Prototypes are learned from the rows that ``train`` marks and whose language
    is not null. ``score`` is the cosine to the nearest prototype, 0 at least;
    ``margin`` is how much nearer it is than the next. Of equally near ones the
    first by code point is taken. A text that is null or has no letters, or any
    text if nothing could be learned, is ``und`` with score and margin 0.
    Repeated rows are treated alike; other columns are ignored.
    """
    names, prototypes = learn_prototypes(docs, text, lang, train, dimensions)
    prototypes = (prototypes / _lengths(prototypes)).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((names, prototypes))
    rows = docs.select(F.col(key).alias("row"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["row"]

    def predict(batches):
        names, prototypes = shared.value
        for batch in batches:
            for part, texts in _pieces(batch):
                got = bundle_whole(texts, dimensions)
                known = got.any(axis=1) & (len(names) > 0)
                label, score, margin = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
                if names:
                    near = (got / _lengths(got)) @ prototypes.T
                    best = near.argmax(axis=1)
                    top = np.sort(near, axis=1)
                    score = np.where(known, np.clip(top[:, -1], 0, 1), 0.0).astype(np.float64)
                    second = top[:, -2] if len(names) > 1 else np.zeros(len(texts))
                    margin = np.where(known, top[:, -1] - second, 0.0).astype(np.float64)
                    label = [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(part.start, len(texts)), pa.array(label, pa.string()), pa.array(score),
                     pa.array(margin)], names=["row", "lang_pred", "score", "margin"])

    return rows.mapInArrow(predict, f"row {kind}, lang_pred string, score double, margin double").withColumnRenamed(
        "row", key)
