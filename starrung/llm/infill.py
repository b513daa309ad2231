"""Fill-in-the-middle: a text cut in three at drawn places, with its parts marked and put in another order.

A batch goes through pyarrow's functions: units as list arrays, flattened with
the index of their text, ordinals, a filter per role, lists again, and one
string per role. Only a text's own row is needed, so nothing is shuffled. A long
text goes through the same steps stretch by stretch, with its ordinals counted on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starrung.llm import words as W

MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
# The order of the parts in each form.
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
PLAIN_FROM = 90  # of 100 draws, those from this one on leave the text as it is
SPM_BELOW = 20  # of 100
SEED = 1
STRETCH = 1 << 20


def _units(texts: pa.Array) -> pa.ListArray:
    """Each text as the list of its code points; strings are not copied."""
    _, where, body = texts.buffers()
    ends = np.frombuffer(where, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(body, np.uint8)[ends[0] : ends[-1]] if body is not None else np.zeros(0, np.uint8)
    first = np.flatnonzero((data & 0xC0) != 0x80)
    offsets = np.append(first, len(data)).astype(np.int32)
    units = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(first, ends - ends[0]).astype(np.int32)), units)


def _rebuilt(parent: pa.Array, units: pa.Array, rows: int) -> pa.Array:
    """Units with the index of their text, in order, as one string per text."""
    many = np.bincount(parent.to_numpy(), minlength=rows)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32)), units)
    return pc.binary_join(lists, "")


def _parts(texts: pa.Array, start: pa.Array, end: pa.Array, base: int = 0) -> dict[str, pa.Array]:
    """Prefix, middle and suffix of each text; the middle begins at unit ``start`` and ends before ``end``.

    ``base`` is the ordinal of the first unit.
    """
    lists = _units(texts)
    parent = pc.list_parent_indices(lists).cast(pa.int32())
    units = pc.list_flatten(lists)
    begin = pa.array(lists.offsets.to_numpy()[:-1].astype(np.int64) - base)
    ordinal = pc.subtract(pa.array(np.arange(len(units))), pc.take(begin, parent))
    early = pc.less(ordinal, pc.take(start, parent))
    late = pc.greater_equal(ordinal, pc.take(end, parent))
    roles = {"prefix": early, "middle": pc.invert(pc.or_(early, late)), "suffix": late}
    return {role: _rebuilt(parent.filter(mask), units.filter(mask), len(texts)) for role, mask in roles.items()}


def _stretches(text: str) -> Iterator[str]:
    for at in range(0, len(text), STRETCH // 4):
        yield text[at : at + STRETCH // 4]


def _long_parts(text: pa.Array, start: pa.Array, end: pa.Array) -> dict[str, pa.Array]:
    """The same for one long text, from its stretches."""
    found: dict[str, list[str]] = {role: [] for role in MARKS}
    base = 0
    for part in _stretches(text[0].as_py()):
        for role, piece in _parts(pa.array([part]), start, end, base).items():
            found[role].append(piece[0].as_py())
        base += len(part)
    return {role: pc.binary_join(pa.array([pieces], pa.list_(pa.string())), "") for role, pieces in found.items()}


def _modulo(number: pa.Array, divisor) -> pa.Array:
    return pc.subtract(number, pc.multiply(pc.divide(number, divisor), divisor))


def _joined(parts: dict[str, pa.Array], order: tuple[str, ...]) -> pa.Array:
    marked = [piece for role in order for piece in (MARKS[role], parts[role])]
    return pc.binary_join_element_wise(*marked, "")


def transformed(texts: pa.Array, draws: list[pa.Array], plain_from: int = PLAIN_FROM,
                spm_below: int = SPM_BELOW) -> dict[str, pa.Array]:
    """``n, form, prefix_chars, middle_chars, output`` of each text, from four whole numbers drawn for it."""
    n = pc.utf8_length(texts).cast(pa.int64())
    places = [_modulo(d, pc.add(n, 1)) for d in draws[:2]]
    start, end = pc.min_element_wise(*places), pc.max_element_wise(*places)
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_modulo(draws[2], 100), plain_from))
    for mark in MARKS.values():
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    form = pc.if_else(plain, "plain", pc.if_else(pc.less(_modulo(draws[3], 100), spm_below), "spm", "psm"))
    cut = pc.invert(plain)
    some, first, last = texts.filter(cut), start.filter(cut), end.filter(cut)
    output = texts
    if len(some):
        long = len(some) == 1 and some.nbytes > STRETCH
        parts = _long_parts(some, first, last) if long else _parts(some, first, last)
        made = pc.if_else(pc.equal(form.filter(cut), "spm"), _joined(parts, FORMS["spm"]), _joined(parts, FORMS["psm"]))
        output = pc.replace_with_mask(texts, cut, made)
    nothing = pa.scalar(None, pa.int64())
    return {"n": n, "form": form, "prefix_chars": pc.if_else(plain, nothing, start),
            "middle_chars": pc.if_else(plain, nothing, pc.subtract(end, start)), "output": output}


def restored(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts that were cut. A mark is found where it was put, since no text with a mark is cut."""
    texts = output
    for name, order in FORMS.items():
        mask = pc.equal(form, name)
        left = output.filter(mask)
        if not len(left):
            continue
        parts: dict[str, pa.Array] = {}
        left = pc.list_element(pc.split_pattern(left, MARKS[order[0]], max_splits=1), 1)
        for role, following in zip(order, [*order[1:], None]):
            if following is None:
                parts[role] = left
                continue
            both = pc.split_pattern(left, MARKS[following], max_splits=1)
            parts[role], left = pc.list_element(both, 0), pc.list_element(both, 1)
        whole = pc.binary_join_element_wise(parts["prefix"], parts["middle"], parts["suffix"], "")
        texts = pc.replace_with_mask(texts, mask, whole)
    return texts


def _strings(column: pa.Array) -> pa.Array:
    return pc.fill_null(column, "").cast(pa.string())


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED,
                   plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """One row per row of ``docs``: the key, ``n, form, prefix_chars, middle_chars, output``.

    Units are code points. The draws come from the SHA-256 of seed and key, so
    reruns agree and rows that repeat a key are cut by the same numbers; a null
    key counts as an empty one. ``plain`` texts stay as they are and have no
    parts: empty and null ones, those with a mark in them, and those drawn so.
    Other columns are ignored, an empty table gives an empty result.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = docs.select(F.col(key).alias("row"), F.col(text).alias("text"), F.sha2(name.cast("binary"), 256).alias("h"))
    rows = rows.select("row", "text", *[
        F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)])
    kind = dict(rows.dtypes)["row"]
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]

    def cut(batches):
        for batch in batches:
            for chunk in W.chunks(batch.column("text"), STRETCH):
                part = batch.slice(chunk.first, len(chunk))
                made = transformed(_strings(part.column("text")), [part.column(f"h{i}") for i in range(1, 5)],
                                   plain_from, spm_below)
                yield pa.RecordBatch.from_arrays([part.column("row"), *[made[x] for x in names]], names=["row", *names])

    return rows.mapInArrow(
        cut, f"row {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    ).withColumnRenamed("row", key)


def restore_middle(made: DataFrame, key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``made``: the key, the columns to ``carry`` and ``restored``, the text before it was cut.

    An output that is null counts as empty, one of any other form than psm or spm is returned as it is.
    """
    rows = made.select(F.col(key).alias("row"), *carry, F.col("form").alias("__form"), F.col("output").alias("__output"))
    form = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes[:-2])

    def restore(batches):
        for batch in batches:
            for chunk in W.chunks(batch.column("__output"), STRETCH):
                part = batch.slice(chunk.first, len(chunk))
                texts = restored(_strings(part.column("__output")), _strings(part.column("__form")))
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], texts], names=[*part.schema.names[:-2], "restored"])

    return rows.mapInArrow(restore, f"{form}, restored string").withColumnRenamed("row", key)
