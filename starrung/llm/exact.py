"""Exact duplicates by most-significant-digit radix partitioning; texts are compared as they are, without digests.

Level by level, each group of texts that agree so far is split by its next
digit, some bytes. A group of one text is done, and so is a group whose texts
have ended. Digits grow with the level, so a text of n bytes takes about
log(n) levels, and only texts that still agree with another are carried along.
Digits are counted with map-side aggregation, and rows learn the name of their
group by a lookup that keeps frequent digits out of the shuffle, so the rows of a hot group are
never brought together. Rows go by a number that is written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starrung.llm.tables import SPACE_CLASS
from starrung.operators.joins import lookup
from starrung.workspace import Kept, Workspace

FIRST_BYTES = 8
GROWTH = 8
LONGEST_BYTES = 1 << 20


def normalised(text: Column) -> Column:
    """The bytes of the text with every run of white space as one space; null counts as empty."""
    return F.encode(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS, " "), "UTF-8")


def _digits(rows: DataFrame, width: int) -> DataFrame:
    """Rows with their next ``width`` bytes, and whether there are more behind them."""
    return rows.withColumns({"part": F.substring("rest", 1, width), "more": F.octet_length("rest") > width})


def _split(ws: Workspace, left: DataFrame, keys: list[str], level: int) -> Kept:
    """The groups of more than one row that the digits make, each with a name of its own.

    Keys of rows can't name them: they may be null, or those of several texts.
    """
    groups = left.groupBy(*keys).agg(F.min("row").alias("least"), F.count(F.lit(1)).alias("size"))
    # Written with the table, so all that read it see the same names.
    return ws.keep(groups.where("size > 1").withColumn("name", F.monotonically_increasing_id()), f"radix-{level}")


def _rest(width: int) -> Column:
    """What is left of the texts that go on."""
    return F.when(F.col("size").isNotNull() & F.col("more"), F.substring("rest", width + 1, 2**31 - 1)).alias("rest")


def exact_duplicates(ws: Workspace, docs: DataFrame, key: str = "doc_id", text: str = "text",
                     first: int = FIRST_BYTES, growth: int = GROWTH) -> DataFrame:
    """One row per row of ``docs``: the key, ``keep_id, group_size, kept, text_sha256, repeated``.

    Null and empty texts are equal to each other. Of equal texts the row with
    the smallest key is kept; null keys count as the largest. Rows that repeat
    both key and text are told by ``repeated``, how many of them there are;
    each counts for ``group_size``, and all of them are marked as kept if their
    key is. The digest names the text in the result; nothing is grouped or joined
    by it. Other columns are ignored, and an empty table gives an empty result.
    """
    base = _digits(docs.select(F.col(key).alias("row"), normalised(docs[text]).alias("rest")), first)
    going = F.col("size").isNotNull() & F.col("more")
    split = _split(ws, base, ["part", "more"], 0)
    every = lookup(base.withColumn("digest", F.sha2("rest", 256)), split, ["part", "more"])
    every = ws.keep(every.select(F.monotonically_increasing_id().alias("number"), "row", "digest", "name", "least", "size",
                                 "more", _rest(first)), "radix-rows-0", going=F.count_if(going))
    columns = ["number", "row", "name", "least", "size"]
    ended = [every.df.where(F.col("size").isNotNull() & ~F.col("more")).select(*columns, F.lit(0).alias("level"))]
    current, width, level = every, first, 0
    while current.totals["going"]:
        width, level = min(width * growth, LONGEST_BYTES), level + 1
        left = _digits(current.df.where(going).select("number", "row", F.col("name").alias("group"), "rest"), width)
        split = _split(ws, left, ["group", "part", "more"], level)
        current = lookup(left, split, ["group", "part", "more"], "inner")
        current = ws.keep(current.select(*columns, "more", _rest(width)), f"radix-rows-{level}", going=F.count_if("more"))
        ended.append(current.df.where(~F.col("more")).select(*columns, F.lit(level).alias("level")))
    groups = ended[0]
    for rows in ended[1:]:
        groups = groups.unionByName(rows)
    same = groups.groupBy("level", "name", "row").agg(F.count(F.lit(1)).alias("same"))
    same = ws.keep(same.where("same > 1"), "repeated-rows")
    groups = lookup(groups, same, ["level", "name", "row"])
    found = ws.keep(groups.select("number", "least", "size", F.coalesce("same", F.lit(1)).alias("same")), "exact-groups")
    # Each number is there once.
    return lookup(every.df.select("number", "row", "digest"), found, ["number"], balanced=True).select(
        F.col("row").alias(key), F.coalesce("least", "row").alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("least", "row").eqNullSafe(F.col("row")).alias("kept"), F.col("digest").alias("text_sha256"),
        F.coalesce("same", F.lit(1)).cast("long").alias("repeated"))
