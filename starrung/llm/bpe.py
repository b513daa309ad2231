"""Byte-level BPE with the ranks of an existing vocabulary: texts to token ids, and ids back to bytes.

A text is split by the vocabulary's expression. The distinct pieces of a batch
go into matrices of pieces of similar length, one row each. Every round finds
each row's leftmost pair of the least rank, puts the pair's token in its place
and closes the gap; a row without a pair that is a token is done. Ranks of pairs come
from a hash table, which holds every way to cut a token in two, since a pair
merges whenever its bytes are a token.

A piece of more than ``LONG`` bytes is a matrix of its own with one row. A round there does at once what
rounds of one merge each would do one after the other, and closes gaps when half of the cells are empty.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starrung.llm import words as W

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
NO_PAIR = np.iinfo(np.int32).max
# Cells of a matrix, widths at which pieces are put together, and the widest of them.
CELLS = 1 << 20
WIDTHS = (2, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256)
LONG = WIDTHS[-1]
# Pieces and their bytes that a task remembers at most; texts of more characters are split bit by bit.
KNOWN_PIECES, KNOWN_BYTES = 1 << 18, 16 << 20
LONG_TEXT, PIECES_AT_ONCE = 1 << 20, 1 << 17
BATCH_BYTES = 1 << 20

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Vocabulary:
    """Tokens by id, ids by bytes, ids of single bytes, and the table of pairs."""

    tokens: list[bytes]
    ids: dict[bytes, int]
    single: np.ndarray
    keys: np.ndarray
    values: np.ndarray
    pattern: str

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _SPREAD) >> np.uint64(64 - len(self.keys).bit_length() + 1)).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair makes, or ``NO_PAIR``; cells below 0 are empty."""
        out = np.full(left.shape, NO_PAIR, np.int32)
        flat = out.reshape(-1)
        left, right = left.reshape(-1), right.reshape(-1)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        key = left[open_].astype(np.int64) * len(self.tokens) + right[open_]
        slot = self._slot(key)
        while len(open_):
            there = self.keys[slot]
            hit = there == key
            flat[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            open_, key, slot = open_[on], key[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out


def make_vocabulary(ranks: dict[bytes, int], pattern: str) -> Vocabulary:
    """A vocabulary from bytes and ranks, which are its ids; every single byte has to be a token."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    keys, values = [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                keys.append(left * len(tokens) + right)
                values.append(rank)
    size = 1 << max(4, (3 * len(keys)).bit_length())
    made = Vocabulary(tokens, ranks, np.array([ranks[bytes([b])] for b in range(256)], np.int32),
                      np.full(size, -1, np.int64), np.zeros(size, np.int32), pattern)
    key, value = np.array(keys, np.int64), np.array(values, np.int32)
    slot = made._slot(key)
    while len(key):
        free = made.keys[slot] < 0
        _, first = np.unique(slot[free], return_index=True)
        put = np.flatnonzero(free)[first]
        made.keys[slot[put]], made.values[slot[put]] = key[put], value[put]
        left = np.ones(len(key), bool)
        left[put] = False
        key, value, slot = key[left], value[left], (slot[left] + 1) & (size - 1)
    return made


@lru_cache(maxsize=4)
def read_vocabulary(path: str | None = None) -> Vocabulary:
    """The vocabulary in a file of base64 tokens and ranks; without a path the public one for many languages."""
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return make_vocabulary(ranks, public_tokenizers.PATTERN)


def split_text(text: str, pattern) -> Iterator[list[str]]:
    """The matches of the pattern in a text, some at a time if it is long."""
    if len(text) <= LONG_TEXT:
        yield pattern.findall(text)
        return
    found = (m.group() for m in pattern.finditer(text))
    while part := list(islice(found, PIECES_AT_ONCE)):
        yield part


def compiled(pattern: str):
    """The pattern for Python; white space is the Unicode property, as in the library whose files these are."""
    import regex

    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(
        r"\S", r"\P{White_Space}"))


def merge_rows(cells: np.ndarray, vocabulary: Vocabulary) -> list[np.ndarray]:
    """Token ids of the pieces in the rows of a matrix of byte tokens, padded with -1 behind each."""
    out: list[np.ndarray] = [cells[:0, 0]] * len(cells)
    row = np.arange(len(cells))
    ranks = vocabulary.pairs(cells[:, :-1], cells[:, 1:])
    while len(row):
        at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(row), np.int64)
        here = np.arange(len(row))
        best = ranks[here, at] if ranks.shape[1] else np.full(len(row), NO_PAIR)
        live = best < NO_PAIR
        for i in np.flatnonzero(~live).tolist():
            out[row[i]] = cells[i][cells[i] >= 0]
        if not live.all():
            row, cells, ranks, at, best = row[live], cells[live], ranks[live], at[live], best[live]
            here = here[: len(row)]
        if not len(row):
            break
        cells[here, at] = best
        column = np.arange(cells.shape[1] - 1)
        cells = np.take_along_axis(cells, column + (column > at[:, None]), axis=1)
        # The pair that was merged and the one behind it become one, and both that touch the new token are looked up.
        column = column[:-1]
        ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), axis=1)
        for side in (at - 1, at):
            some = np.flatnonzero((side >= 0) & (side < ranks.shape[1]))
            ranks[some, side[some]] = vocabulary.pairs(cells[some, side[some]], cells[some, side[some] + 1])
    return out


def merge_long(cells: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Token ids of one long piece.

    Among all pairs of the least rank those that do not overlap are merged from the left, up to
    the first whose token makes a pair of no higher rank with a neighbour: that pair would be next.
    """
    while True:
        n = len(cells)
        follow, before = np.append(np.arange(1, n), -1), np.arange(-1, n - 1)
        ranks = np.append(vocabulary.pairs(cells[:-1], cells[1:]), NO_PAIR).astype(np.int32)
        gone = 0
        while gone <= n // 2:
            least = int(ranks.min())
            if least == NO_PAIR:
                return cells[cells >= 0]
            at = np.flatnonzero(ranks == least)
            at = at[_apart(at, follow)]
            second = follow[at]
            behind = follow[second]
            # Whether the candidate before is the left neighbour, which is the new token by then.
            joined = np.zeros(len(at), bool)
            joined[1:] = before[at[1:]] == second[:-1]
            left = np.where(before[at] >= 0, cells[before[at]], -1)
            left[joined] = least
            token = np.full(len(at), least, np.int32)
            to_left = vocabulary.pairs(left, token)
            to_right = vocabulary.pairs(token, np.where(behind >= 0, cells[behind], -1))
            early = np.flatnonzero((to_left <= least) | (to_right <= least))
            if len(early):
                at = at[: early[0] + 1]
                second, behind, token = second[: len(at)], behind[: len(at)], token[: len(at)]
            cells[at], cells[second] = token, -1
            ranks[second] = NO_PAIR
            follow[at] = behind
            back = behind >= 0
            before[behind[back]] = at[back]
            gone += len(at)
            # Pairs at the new tokens and at the cells before them.
            prior = before[at]
            changed = np.unique(np.concatenate([at, prior[prior >= 0]]))
            right = follow[changed]
            ranks[changed] = vocabulary.pairs(cells[changed], np.where(right >= 0, cells[right], -1))
        cells = cells[cells >= 0]


def _apart(at: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """Every other one, from the left, of candidates that stand next to each other."""
    chained = np.zeros(len(at), bool)
    chained[1:] = follow[at[:-1]] == at[1:]
    first = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
    return (np.arange(len(at)) - first) % 2 == 0


def encode_pieces(pieces: list[bytes], vocabulary: Vocabulary) -> list[np.ndarray]:
    """Token ids of each piece; a piece that is a token is that token."""
    out: list[np.ndarray] = [vocabulary.single[:0]] * len(pieces)
    rest = []
    for i, piece in enumerate(pieces):
        whole = vocabulary.ids.get(piece)
        if whole is not None:
            out[i] = np.array([whole], np.int32)
        elif piece:
            rest.append(i)
    size = np.array([len(pieces[i]) for i in rest], np.int64)
    rest = np.array(rest, np.int64)
    low = 0
    for width in WIDTHS:
        bucket = rest[(size > low) & (size <= width)]
        low = width
        for first in range(0, len(bucket), CELLS // width):
            part = bucket[first : first + CELLS // width].tolist()
            lengths = np.array([len(pieces[i]) for i in part])
            cells = np.full((len(part), int(lengths.max())), -1, np.int32)
            cells[np.arange(cells.shape[1]) < lengths[:, None]] = vocabulary.single[
                np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)]
            for i, ids in zip(part, merge_rows(cells, vocabulary)):
                out[i] = ids
    for i in rest[size > LONG].tolist():
        out[i] = merge_long(vocabulary.single[np.frombuffer(pieces[i], np.uint8)], vocabulary)
    return out


class _Numbers(dict):
    """Numbers of pieces in the order in which they are first asked for; ``new`` has those that came since it was emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = number = len(self)
        return number


class Encoder:
    """Encodes texts and remembers the pieces it has met, up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.pattern = vocabulary, compiled(vocabulary.pattern)
        self._forget()

    def _forget(self) -> None:
        self.number = _Numbers()
        self.ids, self.first, self.many = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bytes = 0

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        numbers = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        raw = [p.encode() for p in self.number.new]
        if raw:
            found = encode_pieces(raw, self.vocabulary)
            many = np.array([len(f) for f in found], np.int64)
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(many) - many])
            self.many = np.concatenate([self.many, many])
            self.ids = np.concatenate([self.ids, *found]).astype(np.int32)
            self.bytes += sum(map(len, raw))
            self.number.new = []
        return numbers

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        parts, counts = [], []
        held, owners = [], []

        def flush():
            numbers = self._numbers(held)
            many = self.many[numbers]
            at = np.repeat(self.first[numbers] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
            parts.append(self.ids[at])
            # A text may be in several parts; its counts are added up.
            per = np.add.reduceat(np.append(many, 0), [a for a, _ in owners]) if owners else []
            for (a, owner), n, b in zip(owners, per, [a for a, _ in owners[1:]] + [len(held)]):
                counts[owner] += int(n) if b > a else 0
            if len(self.number) > KNOWN_PIECES or self.bytes > KNOWN_BYTES:
                self._forget()

        for i, text in enumerate(texts):
            counts.append(0)
            for pieces in split_text(text, self.pattern):
                owners.append((len(held), i))
                held += pieces
                if len(held) >= PIECES_AT_ONCE:
                    flush()
                    held, owners = [], []
        flush()
        return np.concatenate(parts), np.array(counts, np.int64)


def encode_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: the key and ``ids``, the token ids of the whole text as an array.

    Special tokens are ordinary text. Null and empty texts have no ids. Rows
    that repeat are rows of their own, null keys stay null; other columns are
    ignored and an empty table gives an empty result. ``path`` names a file of
    base64 tokens and ranks, read once and sent to the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    rows = docs.select(F.col(key).alias("row"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["row"]

    def encode(batches):
        encoder = Encoder(shared.value)
        for batch in batches:
            for chunk in W.chunks(batch.column("text"), BATCH_BYTES):
                part = batch.slice(chunk.first, len(chunk))
                ids, counts = encoder.encode(pc.fill_null(part.column("text"), "").to_pylist())
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))],
                    names=["row", "ids"])

    return rows.mapInArrow(encode, f"row {kind}, ids array<int>").withColumnRenamed("row", key)


def decode_documents(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None,
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``encoded``: the key, the columns to ``carry`` and ``decoded``, the bytes of its tokens.

    A null or empty array gives no bytes; neither does an id that is null or that the vocabulary lacks.
    """
    vocabulary = read_vocabulary(path)
    size = np.array([len(t) for t in vocabulary.tokens] + [0], np.int64)
    shared = encoded.sparkSession.sparkContext.broadcast(
        (np.frombuffer(b"".join(vocabulary.tokens), np.uint8), np.cumsum(size) - size, size))
    rows = encoded.select(F.col(key).alias("row"), *carry, F.col(ids).cast("array<int>").alias("ids"))
    form = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes[:-1])

    def decode(batches):
        body, first, size = shared.value
        for batch in batches:
            lists = batch.column("ids")
            step = max(1, batch.num_rows * BATCH_BYTES // max(lists.nbytes, 1))
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                got = part.column("ids")
                flat = pc.fill_null(pc.list_flatten(got), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                flat[(flat < 0) | (flat >= len(size) - 1)] = len(size) - 1
                many = pc.fill_null(pc.list_value_length(got), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                lengths = size[flat]
                ends = np.concatenate([[0], np.cumsum(lengths)])
                at = np.repeat(first[flat] - ends[:-1], lengths) + np.arange(int(ends[-1]))
                offsets = ends[np.concatenate([[0], np.cumsum(many)])].astype(np.int32)
                out = pa.Array.from_buffers(pa.binary(), part.num_rows, [
                    None, pa.py_buffer(offsets), pa.py_buffer(body[at].tobytes())])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], out], names=[*part.schema.names[:-1], "decoded"])

    return rows.mapInArrow(decode, f"{form}, decoded binary").withColumnRenamed("row", key)
