"""Words and hashes of whole text columns as numpy arrays, without a Python object per word.

All of it works on the UTF-8 bytes of an Arrow column. A character above U+007F
consists of bytes above 0x7F only, so classes of ASCII characters are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = b"\x09\x0a\x0b\x0c\x0d\x20"
CHUNK_BYTES = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Bytes that are hashed at a time.
_STRETCH = 1 << 18
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def class_of(outside: bytes) -> np.ndarray:
    """Which byte values belong to words, given those that do not."""
    inside = np.ones(256, bool)
    inside[list(outside)] = False
    return inside


NOT_SPACE = class_of(SPACES)


@dataclass
class Texts:
    """Some rows of a text column: the bytes of all, and where each begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column in pieces of about ``limit`` bytes; null counts as empty, a longer text stays whole."""
    column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return
    _, where, body = column.buffers()
    offsets = np.frombuffer(where, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Texts(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every longest run of word bytes; a run ends with its row."""
    w = inside[data]
    begins, ends = w.copy(), w.copy()
    begins[1:] &= ~w[:-1]
    ends[:-1] &= ~w[1:]
    full = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    begins[heads] = w[heads]
    ends[tails] = w[tails]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, side="right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers, one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# A factor for each byte value and one for each place in a word, as if drawn at random: the sum of their products tells
# words apart whatever their letters are, unlike a polynomial, in which long regular words can meet.
_LETTERS = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _GOLDEN) | np.uint64(1)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_places = {"p": np.zeros(0, np.uint64)}


def _factors(n: int) -> np.ndarray:
    """The factors of the first ``n`` places of a word."""
    if len(_places["p"]) < n:
        _places["p"] = mix((np.arange(max(n, 256), dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)) * _GOLDEN)
    return _places["p"]


def _finished(total: np.ndarray, length) -> np.ndarray:
    return mix(total + np.asarray(length).astype(np.uint64) * _LENGTH)


def sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Running sums from which ``hashes`` takes those of the words, and of any beginning of a word.

    Words do not overlap and are in order. Places are counted from the start of each word.
    """
    total = np.zeros(len(data) + 1, np.uint64)
    if not len(starts):
        return total
    longest = int((ends - starts).max())
    factors = _factors(longest)
    start = 0
    for low in range(0, len(data), _STRETCH):
        high = min(low + _STRETCH, len(data))
        place = np.zeros(high - low, np.int64)
        begin = starts[np.searchsorted(starts, low) : np.searchsorted(starts, high)]
        place[begin - low] = begin
        place[0] = max(place[0], start)
        np.maximum.accumulate(place, out=place)
        start = int(place[-1])
        np.subtract(np.arange(low, high), place, out=place)
        # Bytes between words have places beyond the longest; their products cancel out.
        np.minimum(place, longest - 1, out=place)
        np.cumsum(_LETTERS[data[low:high]] * factors[place], out=total[low + 1 : high + 1])
        total[low + 1 : high + 1] += total[low]
    return total


def hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, or of the beginning of a word that ends at ``ends``."""
    return _finished(total[ends] - total[starts], ends - starts)


def stretch_hashes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The same hash for stretches of equal length that may begin anywhere."""
    factors, total = _factors(length), np.zeros(len(starts), np.uint64)
    for j in range(length):
        total += _LETTERS[data[starts + j]] * factors[j]
    return _finished(total, length)


def growing_hashes(data: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For lengths from 1 on, the hash of the stretch of that length at every place where it fits."""
    letters, factors, total = _LETTERS[data], _factors(longest), np.zeros(len(data), np.uint64)
    for length in range(1, min(longest, len(data)) + 1):
        total = total[: len(data) - length + 1] + letters[length - 1 :] * factors[length - 1]
        yield length, _finished(total, length)


def run_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive words, from the words' hashes."""
    out = np.zeros(max(len(h) - length + 1, 0), np.uint64)
    for j, factor in enumerate(_factors(length)[:length]):
        out += h[j : j + len(out)] * factor
    return mix(out)


def hash_words(words: list[bytes]) -> np.ndarray:
    """The same hash for words given one by one."""
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    starts = ends - np.array([len(w) for w in words], np.int64)
    return hashes(sums(data, starts, ends), starts, ends)


_ORDER = np.array([0x8DA6B343, 0xD8163841, 0xCB1AB31F, 0x165667B1, 0x27D4EB2F], np.uint64) * np.uint64(
    0x100000001B3
) | np.uint64(1)


def shingles(h: np.ndarray, row: np.ndarray, rows: int, k: int = 5) -> list[np.ndarray]:
    """The sorted distinct hashes of ``k`` consecutive words of each row.

    A row of fewer words has one, of all its words; a row without words has none.
    """
    counts = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(counts)])
    if len(h) >= k:
        wide = np.zeros(len(h) - k + 1, np.uint64)
        for j in range(k):
            wide += h[j : len(h) - k + 1 + j] * _ORDER[j]
        wide = mix(wide)
    out = []
    for i in range(rows):
        s, n = first[i], counts[i]
        if n >= k:
            got = np.sort(wide[s : s + n - k + 1])
            out.append(got[np.concatenate([[True], got[1:] != got[:-1]])])
        elif n:
            out.append(mix(((h[s : s + n] * _ORDER[:n]).sum(dtype=np.uint64) + np.uint64(n)).reshape(1)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
