"""Marginal likelihood of texts over all segmentations into the subwords of an existing vocabulary.

The pieces of a word form a lattice; its forward recursion in log space adds up
all segmentations. Piece weights begin as the vocabulary's own scores and are
then set to the counts that are expected of them in the training words, by one
forward-backward pass, with the scores' weights as the prior; the pieces stay as they are.
A text's probability is the product over its words, with one end.

A word is scored once, not once per occurrence. Documents learn the values of
frequent words from a broadcast table of bounded size, and those of all other
words by a join on the word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starrung.llm import words as W
from starrung.operators.joins import lookup
from starrung.workspace import Workspace

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# Words that go to every task, at most; each takes 24 bytes there.
HEAD_WORDS = 1 << 19
# Training words that the scores count as when expected counts are taken over.
PRIOR_WORDS = 1000.0
# Cells of a batch of words that are as long as the longest of them.
CELLS = 1 << 20
MERGE_WORDS = 1 << 19
# Words of more bytes are gone through in windows of positions, so many at a time; others together, up to so many bytes.
LONG_WORD, WINDOW, STRIP_WINDOWS = 4096, 512, 128
GROUP_BYTES = 1 << 20
COUNT_UNITS = 1000
_MARK = "▁".encode()


@dataclass
class Pieces:
    """Pieces as hashes in order, with their lengths in bytes and log weights."""

    order: np.ndarray
    hashes: np.ndarray
    log_weight: np.ndarray
    longest: int
    maybe: np.ndarray

    def with_weights(self, weight: np.ndarray) -> Pieces:
        with np.errstate(divide="ignore"):
            return Pieces(self.order, self.hashes, np.log(weight), self.longest, self.maybe)


def read_pieces(path: str = VOCABULARY) -> Pieces:
    """The pieces that words can consist of, with weights that add up to 1.

    Scores that are log probabilities are taken as such. Whole numbers are
    ranks and weigh 1 / (rank + 3). Byte pieces, which have no score, share the
    weight of the last rank; bytes that the vocabulary lacks are added to them.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).encode()
        if piece and _MARK not in piece[1:] and not set(piece) & set(W.SPACES):
            pieces[piece] = model.get_score(i)
    scores = np.array(list(pieces.values()))
    if np.array_equal(scores, np.rint(scores)):
        weight = 1.0 / (scores.max() - scores + 3.0)
    else:
        weight = np.exp(scores)
    names = list(pieces)
    smallest = weight.min() / 256
    for b in range(256):
        if bytes([b]) not in pieces:
            names.append(bytes([b]))
            weight = np.append(weight, smallest)
    h = W.hash_words(names)
    order = np.argsort(h)
    maybe = np.zeros(1 << 20, bool)
    maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    return Pieces(order, h[order], np.log(weight[order] / weight.sum()), max(map(len, names)), maybe)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all words, the word mark before each, and where each begins."""
    parts = list(W.chunks(column, 1 << 62))
    if not parts:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data, offsets = parts[0].data, parts[0].offsets
    n = len(offsets) - 1
    out = np.empty(len(data) + 3 * n, np.uint8)
    starts = offsets[:-1] + 3 * np.arange(n)
    head = (starts[:, None] + np.arange(3)).ravel()
    body = np.ones(len(out), bool)
    body[head] = False
    out[head] = np.tile(np.frombuffer(_MARK, np.uint8), n)
    out[body] = data
    return out, offsets + 3 * np.arange(n + 1)


def _edges(data: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Number of the piece that covers ``length`` bytes from a position, or -1, by length and position."""
    end = np.repeat(offsets[1:], np.diff(offsets))
    at = np.arange(len(data))
    found = np.full((pieces.longest + 1, len(data)), -1, np.int32)
    for length, hashes in W.growing_hashes(data, pieces.longest):
        inside = np.flatnonzero(at[: len(hashes)] + length <= end[: len(hashes)])
        if not len(inside):
            break
        h = hashes[inside]
        near = np.flatnonzero(pieces.maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(pieces.hashes, h[near]), len(pieces.hashes) - 1)
        same = pieces.hashes[place] == h[near]
        found[length, inside[near[same]]] = place[same]
    return found


def _groups(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of words to look at together: a long word alone, others a megabyte at a time."""
    long = np.flatnonzero(np.diff(offsets) > LONG_WORD)
    first = 0
    while first < len(offsets) - 1:
        following = int(long[np.searchsorted(long, first)]) if len(long) and long[-1] >= first else len(offsets) - 1
        if following == first:
            last = first + 1
        else:
            last = int(np.searchsorted(offsets, offsets[first] + GROUP_BYTES, side="right")) - 1
            last = min(max(last, first + 1), following)
        yield first, last
        first = last


def _batches(offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Words of similar length together."""
    lengths = np.diff(offsets)
    order = np.argsort(lengths, kind="stable")
    first = 0
    while first < len(order):
        last = first + 1
        # Doubling the step keeps this cheap; the batch ends before it holds too many cells.
        step = 1024
        while last < len(order) and step:
            to = min(last + step, len(order))
            if (to - first) * (lengths[order[to - 1]] + 1) <= CELLS:
                last, step = to, step * 2
            else:
                step //= 2
        yield order[first:last]
        first = last


def _forward(edges: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pieces: Pieces) -> np.ndarray:
    longest = int(lengths.max())
    alpha = np.full((longest + 1, len(starts)), -np.inf)
    alpha[0] = 0.0
    for j in range(1, longest + 1):
        some = slice(int(np.searchsorted(lengths, j)), None)
        for length in range(1, min(j, len(edges) - 1) + 1):
            edge = edges[length, starts[some] + (j - length)]
            use = np.flatnonzero(edge >= 0)
            if len(use):
                into = use + some.start
                alpha[j, into] = np.logaddexp(alpha[j, into], alpha[j - length, into] + pieces.log_weight[edge[use]])
    return alpha


def word_log_probs(column: pa.Array, pieces: Pieces, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of each word over all segmentations.

    With counts of the words, also the expected count of each piece.
    """
    data, offsets = _buffers(column)
    out = np.zeros(len(offsets) - 1)
    expected = None if counts is None else np.zeros(len(pieces.hashes))
    for first, last in _groups(offsets):
        part, where = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        some = None if counts is None else counts[first:last]
        if len(part) > LONG_WORD and last == first + 1:
            out[first] = _long_word(part, pieces, expected, 0.0 if some is None else float(some[0]))
        else:
            out[first:last] = _short_words(part, where, pieces, expected, some)
    return out, expected


def _short_words(data: np.ndarray, offsets: np.ndarray, pieces: Pieces, expected: np.ndarray | None,
                 counts: np.ndarray | None) -> np.ndarray:
    """Log probabilities of words, side by side; adds to the expected counts."""
    out = np.zeros(len(offsets) - 1)
    edges = _edges(data, offsets, pieces)
    lengths = np.diff(offsets)
    for batch in _batches(offsets):
        starts, size = offsets[batch], lengths[batch]
        alpha = _forward(edges, starts, size, pieces)
        full = alpha[size, np.arange(len(batch))]
        out[batch] = full
        if counts is None:
            continue
        longest = int(size.max())
        beta = np.full_like(alpha, -np.inf)
        beta[size, np.arange(len(batch))] = 0.0
        for i in range(longest - 1, -1, -1):
            for length in range(1, min(longest - i, len(edges) - 1) + 1):
                some = int(np.searchsorted(size, i + length))
                edge = edges[length, starts[some:] + i]
                use = np.flatnonzero(edge >= 0)
                if not len(use):
                    continue
                into, piece = use + some, edge[use]
                follow = pieces.log_weight[piece] + beta[i + length, into]
                beta[i, into] = np.logaddexp(beta[i, into], follow)
                np.add.at(expected, piece, np.exp(alpha[i, into] + follow - full[into]) * counts[batch[into]])
    return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(x - np.expand_dims(safe, axis)).sum(axis=axis))


def _windows(data: np.ndarray, first: int, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Log weight and number of the piece that ends at each position of some windows, by its length less one.

    The windows begin at position ``first``. Positions behind the word have an
    edge of weight 1 from the one before, so the last window is like the others.
    """
    many = min(STRIP_WINDOWS, -(-(len(data) - first) // WINDOW))
    last = min(first + many * WINDOW, len(data))
    low = max(first - pieces.longest + 1, 0)
    found = _edges(data[low:last], np.array([0, last - low]), pieces)
    numbers = np.full((many * WINDOW, pieces.longest), -1, np.int32)
    for length in range(1, min(pieces.longest, last - low) + 1):
        skip = max(0, length - 1 - (first - low))  # ends before which the piece would begin ahead of ``low``
        start = first + 1 + skip - length - low
        numbers[skip : last - first, length - 1] = found[length, start : start + last - first - skip]
    weights = np.where(numbers >= 0, pieces.log_weight[numbers], -np.inf)
    weights[last - first :, 0] = 0.0
    return weights.reshape(many, WINDOW, -1), numbers.reshape(many, WINDOW, -1)


def _crossings(weights: np.ndarray) -> np.ndarray:
    """How each window takes over the last positions before it to its own last ones, as matrices in log space."""
    many, width, longest = weights.shape
    # Position j of the window is at longest - 1 + j; the row of a matrix begins with all weight on one earlier position.
    alpha = np.full((many, longest, longest + width), -np.inf)
    alpha[:, np.arange(longest), longest - 1 - np.arange(longest)] = 0.0
    some = np.isfinite(weights).any(axis=0)
    for j in range(width):
        used = np.flatnonzero(some[j])  # lengths that a piece of any window has here
        alpha[:, :, longest + j] = _log_sum(alpha[:, :, longest + j - 1 - used] + weights[:, None, j, used], 2)
    return alpha[:, :, : -longest - 1 : -1]


def _long_word(data: np.ndarray, pieces: Pieces, expected: np.ndarray | None, count: float) -> float:
    """Log probability of one long word; adds ``count`` times the expected pieces.

    The forward recursion is linear in its last ``longest`` values, so windows of positions are gone through side by
    side, each as a matrix, and the matrices are then applied one after the other.
    """
    longest = pieces.longest
    before = [np.full(longest, -np.inf)]
    before[0][0] = 0.0
    crossings = []
    for first in range(0, len(data), STRIP_WINDOWS * WINDOW):
        for crossing in _crossings(_windows(data, first, pieces)[0]):
            before.append(_log_sum(before[-1][:, None] + crossing, 0))
            if expected is not None:
                crossings.append(crossing)
    full = float(before[-1][0])
    if expected is None:
        return full
    after = [np.full(longest, -np.inf)]
    after[0][0] = 0.0
    for crossing in reversed(crossings):
        after.append(_log_sum(crossing + after[-1], 1))
    after.reverse()
    done = 0
    for first in range(0, len(data), STRIP_WINDOWS * WINDOW):
        weights, numbers = _windows(data, first, pieces)
        many = len(weights)
        alpha = np.full((many, longest + WINDOW), -np.inf)
        alpha[:, :longest] = np.array(before[done : done + many])[:, ::-1]
        backwards = weights[:, :, ::-1]
        for j in range(WINDOW):
            alpha[:, longest + j] = _log_sum(alpha[:, j : j + longest] + backwards[:, j], 1)
        # What follows a position: pieces inside the window, and for its last positions those that lead out of it.
        follow = np.full((many, WINDOW + longest, longest), -np.inf)
        for length in range(1, longest + 1):
            follow[:, : WINDOW - length, length - 1] = weights[:, length:, length - 1]
        beta = np.full((many, WINDOW + longest), -np.inf)
        leave = np.array(after[done + 1 : done + many + 1])
        for j in range(WINDOW - 1, -1, -1):
            here = _log_sum(beta[:, j + 1 : j + 1 + longest] + follow[:, j], 1)
            out = leave[:, WINDOW - 1 - j] if WINDOW - 1 - j < longest else np.full(many, -np.inf)
            beta[:, j] = np.logaddexp(here, out)
        for length in range(1, longest + 1):
            use = numbers[:, :, length - 1] >= 0
            start = alpha[:, longest - length : longest - length + WINDOW]
            chance = np.exp(start[use] + weights[:, :, length - 1][use] + beta[:, :WINDOW][use] - full)
            np.add.at(expected, numbers[:, :, length - 1][use], chance * count)
        done += many
    return full


def _word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Stretches of bytes as an Arrow column, without a Python object each."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    body = data[np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body))


def _count_words(docs: DataFrame, text: str, train: Column) -> DataFrame:
    """``word, c``: every word of the texts with its count in training texts; the empty word counts ends."""
    rows = docs.select(train.alias("train"), F.col(text).alias("text"))

    def merged(parts):
        h = np.concatenate([p[0] for p in parts])
        _, first, back = np.unique(h, return_index=True, return_inverse=True)
        counts = np.bincount(back, np.concatenate([p[1] for p in parts]), len(first)).astype(np.int64)
        return h[first], counts, pa.concat_arrays([p[2] for p in parts]).take(pa.array(first))

    def count(batches):
        held, kept = [], 0
        ends = 0
        for batch in batches:
            train_ = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            ends += int(train_.sum())
            for chunk in W.chunks(batch.column("text")):
                data = W.LOWER[chunk.data]
                starts, stops, row = W.spans(data, chunk.offsets, W.NOT_SPACE)
                if not len(starts):
                    continue
                h = W.hashes(W.sums(data, starts, stops), starts, stops)
                _, first, back = np.unique(h, return_index=True, return_inverse=True)
                counts = np.bincount(back, train_[chunk.first + row], len(first)).astype(np.int64)
                held.append((h[first], counts, _word_array(data, starts[first], stops[first])))
                kept += len(first)
                if kept > MERGE_WORDS:
                    held = [merged(held)]
                    kept = len(held[0][0])
                    if kept > MERGE_WORDS // 2:
                        yield pa.RecordBatch.from_arrays([held[0][2].cast(pa.string()), pa.array(held[0][1])], names=["word", "c"])
                        held, kept = [], 0
        if held:
            _, counts, names = merged(held)
            yield pa.RecordBatch.from_arrays([names.cast(pa.string()), pa.array(counts)], names=["word", "c"])
        yield pa.RecordBatch.from_arrays([pa.array([""], pa.string()), pa.array([ends], pa.int64())], names=["word", "c"])

    return rows.mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _learned(words: DataFrame, pieces: Pieces) -> tuple[Pieces, float]:
    """Pieces with their expected counts in the training words as weights, and the natural log of the end's."""
    shared = words.sparkSession.sparkContext.broadcast(pieces)

    def expect(batches):
        total = np.zeros(len(shared.value.hashes))
        for batch in batches:
            counts = batch.column("c").to_numpy().astype(np.float64)
            total += word_log_probs(batch.column("word"), shared.value, counts)[1]
        some = np.flatnonzero(total > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(np.rint(total[some] * COUNT_UNITS).astype(np.int64))],
            names=["piece", "n"])

    used = words.where("c > 0 and word <> ''")
    sums = used.mapInArrow(expect, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    count = np.zeros(len(pieces.hashes))
    for row in sums:  # one row per piece of the vocabulary at most
        count[row.piece] = row.n / COUNT_UNITS
    ends = words.where("word = ''").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0] + 1
    weight = (count + PRIOR_WORDS * np.exp(pieces.log_weight)) / (count.sum() + PRIOR_WORDS)
    p_end = ends / (ends + count.sum() + PRIOR_WORDS)
    return pieces.with_weights(weight * (1 - p_end)), math.log(p_end)


def _scored_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word, c, lp`` with the base-10 log probability of each word."""
    shared = words.sparkSession.sparkContext.broadcast(pieces)

    def score(batches):
        for batch in batches:
            lp = word_log_probs(batch.column("word"), shared.value)[0] / math.log(10)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(lp)], names=["word", "c", "lp"])

    return words.where("word <> ''").mapInArrow(score, "word string, c long, lp double")


def _head(words: DataFrame, most: int) -> tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The smallest count above which there are ``most`` words or fewer, and those words' hashes, counts and scores."""
    level = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    sizes = words.where("c > 0").groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c"))
    least, kept = None, 0
    for row in sorted(sizes.collect(), key=lambda r: -r.level):  # eight rows per power of two
        kept += row.n
        if kept > most:
            break
        least = row.c
    if least is None:
        empty = np.zeros(0)
        return 1 << 62, (empty.astype(np.uint64), empty.astype(np.int64), empty)

    def hashed(batches):
        for batch in batches:
            total, offsets = None, None
            for chunk in W.chunks(batch.column("word"), 1 << 62):
                offsets = chunk.offsets
                total = W.sums(chunk.data, offsets[:-1], offsets[1:])
            if total is not None:
                h = W.hashes(total, offsets[:-1], offsets[1:])
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column("c"), batch.column("lp")],
                                                 names=["h", "c", "lp"])

    got = words.where(F.col("c") >= least).mapInArrow(hashed, "h long, c long, lp double").toArrow()
    h = got.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    return least, (h[order], got.column("c").to_numpy()[order], got.column("lp").to_numpy()[order])


_ROW = ("uid long, {key} {kind}, train boolean, n_tokens long, n_known long, base double, lp double, "
        "rare array<struct<word:string,n:int>>")


def _by_document(docs: DataFrame, key: str, text: str, train: Column, head) -> DataFrame:
    """Sums over the head words of each document, and its other words with their counts."""
    rows = docs.select(F.col(key).alias("key"), train.alias("train"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]
    shared = docs.sparkSession.sparkContext.broadcast(head)
    pair = pa.struct([("word", pa.string()), ("n", pa.int32())])

    def score(batches):
        from pyspark import TaskContext

        h_head, c_head, lp_head = shared.value
        log_c = np.log10(c_head + 1.0)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                rows_ = len(chunk)
                data = W.LOWER[chunk.data]
                starts, stops, row = W.spans(data, chunk.offsets, W.NOT_SPACE)
                h = W.hashes(W.sums(data, starts, stops), starts, stops)
                if len(h_head):
                    at = np.minimum(np.searchsorted(h_head, h), len(h_head) - 1)
                    known = h_head[at] == h
                else:
                    at, known = np.zeros(len(h), np.int64), np.zeros(len(h), bool)
                counts = np.bincount(row, minlength=rows_)
                n_known = np.bincount(row[known], minlength=rows_)
                base = np.bincount(row[known], log_c[at[known]], rows_) if known.any() else np.zeros(rows_)
                lp = np.bincount(row[known], lp_head[at[known]], rows_) if known.any() else np.zeros(rows_)
                # The other words, once per document.
                rare = np.flatnonzero(~known)
                by = np.lexsort((h[rare], row[rare]))
                rare = rare[by]
                new = np.ones(len(rare), bool)
                new[1:] = (h[rare][1:] != h[rare][:-1]) | (row[rare][1:] != row[rare][:-1])
                first = np.flatnonzero(new)
                many = np.diff(np.append(first, len(rare))).astype(np.int32)
                names = _word_array(data, starts[rare[first]], stops[rare[first]]).cast(pa.string())
                lists = np.concatenate([[0], np.cumsum(np.bincount(row[rare[first]], minlength=rows_))]).astype(np.int32)
                values = pa.StructArray.from_arrays([names, pa.array(many)], fields=list(pair))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(uid, uid + rows_)), batch.column("key").slice(chunk.first, rows_),
                     batch.column("train").slice(chunk.first, rows_), pa.array(counts + 1), pa.array(n_known.astype(np.int64)),
                     pa.array(base), pa.array(lp), pa.ListArray.from_arrays(pa.array(lists), values)],
                    names=["uid", "key", "train", "n_tokens", "n_known", "base", "lp", "rare"])
                uid += rows_

    return rows.mapInArrow(score, _ROW.format(key="key", kind=kind))


def lattice_likelihood(ws: Workspace, docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text",
                       vocabulary: str = VOCABULARY, head_words: int = HEAD_WORDS) -> DataFrame:
    """One row per row of ``docs``: the key, ``n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words between white space, lower-cased in A-Z, and one end.
    ``score`` is the base-10 log of the text's probability over all
    segmentations. ``base_score`` is the smoothed unigram score of whole words,
    ``n_known`` the tokens that training texts have and ``train_tokens`` all
    tokens there. A null or empty text is an end only. Repeated rows count as
    often as they occur, ``train`` that is null counts as false, without
    training texts the vocabulary's own scores are used. Other columns are ignored.
    """
    train = F.coalesce(train, F.lit(False))
    words = ws.keep(_count_words(docs, text, train), "words", tokens=F.sum("c"), known=F.count_if(F.col("c") > 0))
    n, v = words.totals["tokens"], words.totals["known"]
    pieces, log_end = _learned(words.df, read_pieces(vocabulary))
    scored = ws.keep(_scored_words(words.df, pieces), "scored-words")
    ends = words.df.where("word = ''").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    least, head = _head(scored.df, head_words)
    rows = ws.table(_by_document(docs, key, text, train, head), "documents-by-head")
    tail = rows.select("uid", F.explode("rare").alias("x")).select("uid", F.col("x.word").alias("word"), F.col("x.n").alias("n"))
    rest = replace(scored, df=scored.df.where(F.col("c") < least))
    tail = lookup(tail, rest, ["word"], "inner").groupBy(F.col("uid").alias("u")).agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs"), F.sum(F.col("n") * F.col("lp")).alias("lps"))
    both = rows.drop("rare").join(tail, F.col("uid") == F.col("u"), "left")
    zero = F.lit(0.0)
    return both.select(
        F.col("key").alias(key), F.col("n_tokens").cast("long").alias("n_tokens"),
        (F.col("n_known") + F.coalesce("known", F.lit(0)) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", zero) + F.lit(math.log10(ends + 1))
         - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"),
        (F.col("lp") + F.coalesce("lps", zero) + F.lit(log_end / math.log(10))).alias("score"))
