"""Turning counted rows back into that many equal rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 10_000
TASK_ROWS = 100_000


def expand_copies(df: DataFrame, copies: str, total: int, chunk: int = CHUNK, task_rows: int = TASK_ROWS) -> DataFrame:
    """Each row ``copies`` times, without that column; ``total`` is about the sum of them.

    Copies are cut into chunks, and the chunks are dealt to as many tasks as the
    total asks for. The number is given, so that adaptive execution, which sees
    only the small chunks, does not put them together again.
    """
    n = F.col(copies)
    columns = [c for c in df.columns if c != copies]
    last = F.floor((n - 1) / chunk).cast("bigint")
    chunks = df.where(n > 0).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("__chunk"))
    dealt = chunks.repartition(max(1, ceil(total / task_rows)), *columns, "__chunk")
    here = F.least(F.lit(chunk).cast("bigint"), n - F.col("__chunk") * chunk).cast("bigint")
    return dealt.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), here)).alias("__i")).drop("__i")
