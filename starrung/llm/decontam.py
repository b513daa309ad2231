"""Passages of benchmark items in documents, found by backward search in an FM-index of each shard of the documents.

A shard is a few megabytes of whole documents of one partition. Its symbols are
the words of the benchmark; any other word can be part of no phrase and only
separates, and so does a run of benchmark words shorter than every phrase.
Nothing is shuffled: a document is searched and its spans are merged where it
was read. The words of the benchmark are hashed by tasks; what every task gets is
arrays of numbers, with each phrase once however many items have it. A shard's
index is made once and searched for all phrases of up to ``PART_BYTES`` of
benchmark; a larger benchmark means more passes over the documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starrung.llm import words as W
from starrung.llm.fm_index import FMIndex
from starrung.workspace import Workspace

WINDOW = 10
PART_BYTES = 64 << 20
# Words of a piece of a very long item, and phrases that are searched at once.
ITEM_WORDS = 1 << 20
PATTERNS = 1 << 16
# Everything in ASCII that is neither letter nor digit; capitals are lower-cased before.
_INSIDE = W.class_of(bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122)))
_TERMINAL_AND_GAP = 2

FOUND = "n_words long, n_hit long, spans array<struct<first:long,last:long,start:long,end:long>>, items array<string>"


class Phrases:
    """The windows of some benchmark items: words as numbers in one sequence, where each window begins, and its items."""

    def __init__(self, names: list[str], hashes: np.ndarray, counts: np.ndarray, window: int = WINDOW):
        self.names, item = np.unique(np.array(names, object), return_inverse=True) if names else (np.zeros(0, object), [])
        self.words = np.unique(hashes)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.words & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.sequence = (np.searchsorted(self.words, hashes) + _TERMINAL_AND_GAP).astype(np.int32)
        first = np.cumsum(counts) - counts
        self.groups = []
        lengths = np.minimum(counts, window)
        for length in np.unique(lengths[lengths > 0]).tolist():
            of = np.flatnonzero(lengths == length)
            many = counts[of] - length + 1
            start = np.repeat(first[of] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
            owner = np.repeat(np.asarray(item, np.int32)[of], many)
            # Equal windows are one; those of the same item once.
            key = W.run_hashes(hashes, length)[start]
            order = np.lexsort((owner, key))
            key, owner, start = key[order], owner[order], start[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            once = new | np.concatenate([[True], owner[1:] != owner[:-1]])
            begin = np.flatnonzero(new[once])
            self.groups.append((length, start[new], np.append(begin, once.sum()), owner[once]))
        self.shortest = min((g[0] for g in self.groups), default=window)

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Symbol of each word, 0 for words of no phrase."""
        out = np.zeros(len(h), np.int64)
        near = np.flatnonzero(self.maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.words, h[near]), max(len(self.words) - 1, 0))
        same = self.words[at] == h[near] if len(self.words) else np.zeros(0, bool)
        out[near[same]] = at[same] + _TERMINAL_AND_GAP
        return out

    def patterns(self, text: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, numbers and words of the windows all of whose words are in ``text``, some at a time."""
        there = np.zeros(len(self.words) + _TERMINAL_AND_GAP, bool)
        there[text[text >= _TERMINAL_AND_GAP]] = True
        upto = np.concatenate([[0], np.cumsum(there[self.sequence], dtype=np.int32)])
        for length, start, _, _ in self.groups:
            which = np.flatnonzero(upto[start + length] - upto[start] == length)
            for low in range(0, len(which), PATTERNS):
                part = which[low : low + PATTERNS]
                yield length, part, self.sequence[start[part][:, None] + np.arange(length)].astype(np.int64)

    def items_of(self, length: int, which: int) -> list[str]:
        _, _, begin, owner = next(g for g in self.groups if g[0] == length)
        return self.names[owner[begin[which] : begin[which + 1]]].tolist()


def _runs(symbol: np.ndarray, row: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard's sequence without what can't match: symbols with a gap behind each run, and their word positions."""
    known = symbol > 0
    new = known.copy()
    new[1:] &= ~known[:-1] | (row[1:] != row[:-1])
    end = known.copy()
    end[:-1] &= ~known[1:] | (row[1:] != row[:-1])
    starts, ends = np.flatnonzero(new), np.flatnonzero(end) + 1
    long = ends - starts >= least
    starts, lengths = starts[long], (ends - starts)[long]
    total = int(lengths.sum()) + len(lengths)
    place = np.full(total, -1, np.int64)
    if total:
        begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        inside = np.ones(total, bool)
        inside[begin + lengths] = False
        place[inside] = np.repeat(starts - begin, lengths) + np.flatnonzero(inside)
    return np.where(place >= 0, symbol[place], 1), place


def _search(chunk: W.Texts, phrases: Phrases) -> Iterator[tuple[int, int, list, list]]:
    """Words, hit words, spans and items of each document of the shard."""
    data = W.LOWER[chunk.data]
    starts, ends, row = W.spans(data, chunk.offsets, _INSIDE)
    rows = len(chunk)
    counts = np.bincount(row, minlength=rows)
    spans: dict[int, list] = defaultdict(list)
    items: dict[int, set] = defaultdict(set)
    hits = np.zeros(rows, np.int64)
    if len(starts) and len(phrases.words):
        symbol = phrases.numbers(W.hashes(W.sums(data, starts, ends), starts, ends))
        text, place = _runs(symbol, row, phrases.shortest)
        if len(text):
            index = FMIndex(text)
            cover = np.zeros(len(starts) + 1, np.int64)
            for length, which, patterns in phrases.patterns(text):
                low, high = index.search(patterns)
                found = np.flatnonzero(high > low)
                many = (high - low)[found]
                if not len(found):
                    continue
                ranks = np.repeat(low[found] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
                at = place[index.locate(ranks)]
                np.add.at(cover, at, 1)
                np.add.at(cover, at + length, -1)
                pairs = np.unique(np.stack([row[at], np.repeat(which[found], many)]), axis=1)
                for r, p in pairs.T.tolist():
                    items[r].update(phrases.items_of(length, p))
            hit = np.cumsum(cover[:-1]) > 0
            hits = np.bincount(row[hit], minlength=rows)
            first = np.concatenate([[0], np.cumsum(counts)])
            new, last = hit.copy(), hit.copy()
            new[1:] &= ~hit[:-1] | (row[1:] != row[:-1])
            last[:-1] &= ~hit[1:] | (row[1:] != row[:-1])
            if hit.any():
                points = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
                for a, b in zip(np.flatnonzero(new).tolist(), np.flatnonzero(last).tolist()):
                    r = int(row[a])
                    zero = points[chunk.offsets[r]]
                    spans[r].append({"first": a - int(first[r]), "last": b + 1 - int(first[r]),
                                     "start": int(points[starts[a]] - zero), "end": int(points[ends[b]] - zero)})
    for r in range(rows):
        yield int(counts[r]), int(hits[r]), spans.get(r, []), sorted(items.get(r, ()))


def _item_words(items: DataFrame, name: str, text: str, window: int) -> DataFrame:
    """``item, words, bytes``: the hashes of the words of every item; a very long one in pieces that share window - 1 words."""
    rows = items.select(F.coalesce(F.col(name).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))

    def words(batches):
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                data = W.LOWER[chunk.data]
                starts, ends, row = W.spans(data, chunk.offsets, _INSIDE)
                h = W.hashes(W.sums(data, starts, ends), starts, ends).view(np.int64)
                first = np.searchsorted(row, np.arange(len(chunk) + 1))
                names, pieces = [], []
                for r, item in enumerate(batch.column("item").slice(chunk.first, len(chunk)).to_pylist()):
                    many = int(first[r + 1] - first[r])
                    for at in range(0, max(many - window + 1, 1) if many else 0, ITEM_WORDS):
                        names.append(item)
                        pieces.append(h[first[r] + at : min(first[r] + at + ITEM_WORDS + window - 1, first[r + 1])])
                if names:
                    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.string()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(pieces)))],
                        names=["item", "words"])

    return rows.mapInArrow(words, "item string, words array<long>").distinct()


def _parts(ws: Workspace, items: DataFrame, name: str, text: str, window: int, size: int) -> Iterator[Phrases]:
    """The phrases of the benchmark, at most about ``size`` bytes of it at a time, counted as six to a word."""
    every = ws.keep(_item_words(items, name, text, window), "benchmark-words", words=F.sum(F.size("words")))
    parts = max(1, -(-6 * every.totals["words"] // size))
    for part in range(parts):
        mine = every.df if parts == 1 else every.df.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == part)
        got = mine.toArrow()
        words = got.column("words").combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int64()))
        counts = np.diff(words.offsets.to_numpy()).astype(np.int64)
        if len(counts) or parts == 1:
            yield Phrases(got.column("item").to_pylist(), words.values.to_numpy().view(np.uint64), counts, window)


def _pass(docs: DataFrame, key: str, text: str, part: Phrases) -> DataFrame:
    phrases = docs.sparkSession.sparkContext.broadcast(part)
    rows = docs.select(F.col(key).alias("row"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["row"]
    span = pa.list_(pa.struct([(f, pa.int64()) for f in ("first", "last", "start", "end")]))

    def search(batches):
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                found = list(zip(*_search(chunk, phrases.value)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(chunk.first, len(chunk)), pa.array(found[0], pa.int64()),
                     pa.array(found[1], pa.int64()), pa.array(found[2], span), pa.array(found[3], pa.list_(pa.string()))],
                    names=["row", "n_words", "n_hit", "spans", "items"])

    return rows.mapInArrow(search, f"row {kind}, {FOUND}").withColumnRenamed("row", key)


def _together(pdf):
    """One row for the passes over one document: spans merged by word, items united."""
    import pandas as pd

    spans = sorted((s for list_ in pdf["spans"] for s in list_), key=lambda s: s["first"])
    merged: list[dict] = []
    for s in spans:
        if merged and s["first"] <= merged[-1]["last"]:
            if s["last"] > merged[-1]["last"]:
                merged[-1] |= {"last": s["last"], "end": s["end"]}
        else:
            merged.append(dict(s))
    return pd.DataFrame({"row": pdf["row"].iloc[:1], "n_words": pdf["n_words"].iloc[:1],
                         "n_hit": [sum(s["last"] - s["first"] for s in merged)], "spans": [merged],
                         "items": [sorted({i for list_ in pdf["items"] for i in list_})]})


def find_benchmark(ws: Workspace, docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                   item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                   part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per row of ``docs``: the key, ``n_words, n_hit, spans, items``.

    Words are letters, digits and all characters beyond ASCII, lower-cased in
    A-Z. A phrase is ``window`` consecutive words of an item, or all words of a
    shorter one. ``spans`` are the merged words inside occurrences: ``first``
    and ``last`` (exclusive) in words, ``start`` and ``end`` (exclusive) in code
    points. ``items`` are the ids, as sorted strings, of items with an
    occurring phrase; a null id is an empty string, repeated items count once.
    Null and empty texts have no words. An empty benchmark finds nothing.
    Words are told apart by a 64-bit hash. Other columns are ignored.
    With a benchmark of several parts, rows equal in key and text are searched once.
    """
    parts = _parts(ws, items, item, item_text, window, part_bytes)
    first, second = next(parts), next(parts, None)
    if second is None:
        return _pass(docs, key, text, first)
    name = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("a"),
                    F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("b"))
    with_id = docs.select(name.alias("row"), F.col(text).alias("text")).dropDuplicates(["row"])
    passes = [ws.table(_pass(with_id, "row", "text", part), "benchmark-pass") for part in (first, second)]
    passes += [ws.table(_pass(with_id, "row", "text", part), "benchmark-pass") for part in parts]
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    kind = dict(every.dtypes)["row"]
    hit = every.where("n_hit > 0").groupBy("row").applyInPandas(_together, f"row {kind}, {FOUND}")
    clean = passes[0].join(hit.select(F.col("row").alias("r")), F.col("row") == F.col("r"), "left_anti")
    clean = clean.select("row", "n_words", F.lit(0).cast("long").alias("n_hit"), "spans", "items")
    rows = docs.select(name.alias("d")).join(hit.unionByName(clean), F.col("d") == F.col("row"))
    return rows.select(F.col("d.key").alias(key), "n_words", "n_hit", "spans", "items")
