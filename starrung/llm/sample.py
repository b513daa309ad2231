"""The bounded, labelled sample that classifiers are fitted on."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starrung.llm import words as W

# A document is taken for a copy of an earlier one if it shares so many of its so many smallest shingle hashes.
SMALLEST, SHARED = 16, 6


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, key: str, text: str,
                    most: dict[int, int], most_bytes: int) -> pa.Table:
    """``text, label`` of up to ``most`` documents per label value, the first in the order of a hash of the key.

    Only rows of ``labels`` for which ``train`` holds are used, keys whose
    labels contradict each other are not, and neither are texts that are null
    or longer than ``most_bytes``. Of rows that repeat a key one is taken.
    """
    marked = labels.where(train & F.col(label).isin(*most)).groupBy(F.col(key).alias("__k")).agg(
        F.min(label).alias("label"), F.max(label).alias("__other")).where(F.col("label") == F.col("__other"))
    size = docs.select(F.col(key).alias("__k"), F.octet_length(text).alias("__n"))
    marked = marked.join(size.where(F.col("__n") <= most_bytes).select("__k").distinct(), "__k", "left_semi")
    order = [F.xxhash64(F.col("__k").cast("string")), F.col("__k")]
    chosen = None
    for value, n in most.items():
        part = marked.where(F.col("label") == value).orderBy(*order).limit(n).select("__k", "label")
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("text"))
    rows = rows.where(F.octet_length("text") <= most_bytes).join(
        F.broadcast(chosen), F.col("__key") == F.col("__k")).dropDuplicates(["__key"])
    return rows.orderBy("__key").select("text", F.col("label").cast("int").alias("label")).toArrow()


def without_copies(sample: pa.Table) -> pa.Table:
    """The sample with one document of each group of copies, so that its words do not count as often as it was copied."""
    kept, seen = [], set()
    for i, text in enumerate(sample.column("text").to_pylist()):
        for chunk in W.chunks(pa.array([text], pa.string())):
            data = W.LOWER[chunk.data]
            starts, ends, row = W.spans(data, chunk.offsets, W.NOT_SPACE)
            got = W.shingles(W.hashes(W.sums(data, starts, ends), starts, ends), row, 1)[0][:SMALLEST].tolist()
        common = sum(h in seen for h in got)
        if not got or common < SHARED * len(got) / SMALLEST:
            kept.append(i)
            seen.update(got)
    return sample.take(pa.array(np.array(kept, np.int64)))
