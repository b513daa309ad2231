"""Removal of lines that many sites share, in DataFrame operations only.

Each line hash gets a HyperLogLog sketch of the sites that have the line;
sketches are built before the shuffle and merged after it, so a line of a third
of all rows is one sketch per task. Where the estimate is near the threshold,
distinct sites are counted exactly, so the outcome is that of exact counts.

Lines are looked up one by one, and the places of the shared ones are put
together per text, which is then cut at them. Equal texts are one entry there,
so rows need no names.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starrung.operators.joins import lookup
from starrung.workspace import Workspace

MIN_SITES = 5
# Lines of fewer characters without the white space around them stay; 1 leaves out empty lines only.
MIN_CHARS = 1
LOG_K = 10
# Six standard errors of a sketch with 2^LOG_K buckets, at least one site.
BAND = 0.2


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\x0b\x0c\r"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(value: Column) -> Column:
    """128 bits of a line or text."""
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(1), value).alias("b"))


def shared_lines(ws: Workspace, docs: DataFrame, text: str = "text", site: str = "source",
                 min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS):
    """The measured table ``h`` of hashes of all lines that ``min_sites`` or more sites have.

    Lines are compared without white space around them; those of fewer than
    ``min_chars`` characters are left alone. A null site is a site of its own.
    """
    lines = docs.select(F.coalesce(F.col(site).cast("string"), F.lit("\x00")).alias("site"),
                        F.explode(_lines(F.col(text))).alias("line"))
    lines = lines.where(F.length(_trimmed(F.col("line"))) >= max(min_chars, 1)).select(
        "site", _hash(_trimmed(F.col("line"))).alias("h"))
    spread = lines.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(LOG_K)).alias("sketch"))
    margin = max(1.0, BAND * min_sites)
    spread = spread.select("h", F.hll_sketch_estimate("sketch").alias("sites"))
    spread = ws.keep(spread.where(F.col("sites") >= min_sites - margin), "line-spread")
    near = replace(spread, df=spread.df.where(F.col("sites") <= min_sites + margin).select("h"))
    exact = lookup(lines, near, ["h"], "left_semi", ws=ws).distinct().groupBy("h").agg(F.count(F.lit(1)).alias("sites"))
    sure = spread.df.where(F.col("sites") > min_sites + margin).select("h")
    return ws.keep(sure.unionByName(exact.where(F.col("sites") >= min_sites).select("h")), "shared-lines")


def remove_shared_lines(ws: Workspace, docs: DataFrame, key: str = "doc_id", text: str = "text",
                        site: str = "source", min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per row of ``docs``: the key, ``text`` without the shared lines, ``n_lines, n_removed``.

    All occurrences of a shared line go. Empty lines, also those of white space
    only, are never shared. A null text counts as empty and an empty text has
    one empty line. Repeated rows and null keys are rows like others. Other
    columns are ignored. Lines and texts are told apart by 128-bit hashes.
    """
    shared = shared_lines(ws, docs, text, site, min_sites, min_chars)
    # The hash of a text is a column before its lines are rows, else it would be made for every line.
    lines = docs.select(_hash(F.col(text)).alias("t"), _lines(F.col(text)).alias("lines")).select(
        "t", F.posexplode("lines").alias("place", "line"))
    lines = lines.where(F.length(_trimmed(F.col("line"))) >= max(min_chars, 1)).select(
        "t", "place", _hash(_trimmed(F.col("line"))).alias("h"))
    hit = lookup(lines, shared, ["h"], "left_semi", ws=ws)
    places = ws.keep(hit.groupBy("t").agg(F.array_sort(F.collect_set("place")).alias("places")), "places-of-shared-lines")
    rows = docs.select(F.col(key).alias("row"), F.col(text).alias("body"), _hash(F.col(text)).alias("t"))
    rows = lookup(rows, places, ["t"], ws=ws).select("row", "places", _lines(F.col("body")).alias("lines"))
    # The shared lines cut the others into stretches: from behind one of them, or the beginning, up to the next.
    n = F.size("lines")
    cuts = F.concat(F.array(F.lit(-1)), F.col("places"), F.array(n))
    rows = rows.select("row", "places", "lines", cuts.alias("cuts"))
    stretches = F.transform(F.sequence(F.lit(1), F.size("cuts") - 1), lambda i: F.slice(
        "lines", F.get("cuts", i - 1) + 2, F.get("cuts", i) - F.get("cuts", i - 1) - 1))
    kept = F.when(F.col("places").isNull(), F.col("lines")).otherwise(F.flatten(stretches))
    return rows.select(F.col("row").alias(key), F.array_join(kept, "\n").alias("text"), n.cast("long").alias("n_lines"),
                       F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_removed"))
