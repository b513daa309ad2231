"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

A row's key is an exponential variable divided by its quality weight, drawn
from a hash of its id, so the order of the keys is a weighted sample without
replacement and does not change between runs. A source's rows are taken a whole
number of times first; what is missing to its target is filled in key order.

The order is never made over a whole source. Keys fall into cells of about
``CELL_ROWS`` rows; the words of the cells are added up, and only the cell in
which the target is reached is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starrung.llm.tables import WORD_CLASS, sized
from starrung.workspace import Workspace

# Weights of the sources in their order, repeated.
WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3.0
CELL_ROWS = 4096
_UNITS = 1 << 52


def words_in(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_CLASS)).cast("long")


def text_quality(text: Column) -> Column:
    """Quality weight from 0.1 to 1: the share of characters that are neither digits nor ASCII symbols."""
    odd = F.regexp_count(text, F.lit(r"[0-9#$%&*+/<=>@\[\\\]^_`{|}~!]"))
    return F.when(F.length(text) > 0, F.greatest(F.lit(0.1), 1 - odd / F.length(text))).otherwise(F.lit(0.1))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """``target`` and the other columns of ``sizes``, which has one row per source.

    Sources by code point, null last, take the weights in turn and share the
    sum of all sizes. A target stops at ``most`` times its source's size; what
    it leaves is shared by weight until none is above. That point is found in
    one pass: sources reach their stop in the order of stop to weight, so those
    before the first that stays below are stopped and the others share the rest.
    One row per source goes through the two windows.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    stop = most * F.col("source_size")
    ranked = sizes.withColumn("weight", weight).withColumn("stop", stop)
    order = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))
    left_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    ranked = ranked.withColumn("place", F.row_number().over(order)).withColumn("level", left / left_weight).withColumn(
        "stopped", F.col("stop") <= F.col("level") * F.col("weight"))
    # Beyond the first source that is not stopped, the level does not change any more.
    settled = F.min(F.when(~F.col("stopped"), F.struct("place", "level"))).over(whole)["level"]
    target = F.when(F.col("stopped"), F.col("stop")).otherwise(settled * F.col("weight"))
    return ranked.select(*sizes.columns, target.alias("target"))


def mix(ws: Workspace, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, most: float = MOST_EPOCHS, quality: Column | None = None, seed: int = 1,
        cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per row of ``docs``: the key, ``size, source_size, target, taken, source, weight``.

    ``size`` counts words, null texts have none. ``taken`` is the words the mix
    takes of the row: its size times the whole epochs, and once more if the row
    comes before the target in key order; the row in which it is reached is
    taken if that ends nearer to it. Rows with equal keys are ordered by id and
    size; repeated rows that agree in all three are rows of their own and may
    be ordered either way, which changes no sum. ``quality`` is a weight above
    0 (null or less counts as the smallest, 1e-6). Sources that are null form
    one source. Other columns are ignored; an empty table gives an empty result.
    """
    quality = text_quality(F.col(text)) if quality is None else quality
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    draw = (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(_UNITS))
    weight = F.greatest(F.coalesce(quality.cast("double"), F.lit(0.0)), F.lit(1e-6))
    rows = ws.table(docs.select(
        F.col(key).alias("row"), F.col(source).alias("source"), words_in(F.col(text)).alias("size"),
        weight.alias("weight"), (-F.log(draw) / weight).alias("order_key")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"),
                                      F.avg("weight").alias("mean_weight"))
    targets = source_targets(sizes, weights, most).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    targets = ws.keep(targets.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
                      .withColumn("cells", F.greatest(F.lit(1), F.ceil(F.col("source_rows") / cell_rows))), "mix-targets")
    sources = sized(targets).withColumnRenamed("source", "s")
    # 1 - exp(-key) spreads keys drawn with about the mean weight evenly over the cells, in the order of the keys.
    cell = F.floor((1 - F.exp(-F.col("order_key") * F.col("mean_weight"))) * F.col("cells")).cast("long")
    placed = rows.join(sources, rows["source"].eqNullSafe(sources["s"])).drop("s").withColumn("cell", cell)
    cells = placed.groupBy("source", "cell", "budget").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("cell")
    cells = cells.withColumn("start", F.sum("words").over(upto) - F.col("words"))
    # The cell in which the budget is reached; before it all rows are taken, after it none.
    reached = cells.where((F.col("start") < F.col("budget")) & (F.col("start") + F.col("words") >= F.col("budget")))
    reached = ws.keep(reached.groupBy(F.col("source").alias("s")).agg(
        F.min("cell").alias("last"), F.min("start").alias("start")), "mix-cells")
    marks = sized(reached)
    placed = placed.join(marks, placed["source"].eqNullSafe(marks["s"]), "left").drop("s")
    in_order = Window.partitionBy("source").orderBy("order_key", "row", "size")
    inside = placed.where(F.col("cell") == F.col("last"))
    inside = inside.withColumn("end", F.col("start") + F.sum("size").over(in_order.rowsBetween(
        Window.unboundedPreceding, 0)))
    inside = inside.withColumn("extra", (F.col("end") - F.col("size") / 2 <= F.col("budget")).cast("long"))
    outside = placed.where(~F.col("cell").eqNullSafe(F.col("last")))
    # Without such a cell the budget is 0 (or the source has no words), and nothing is added.
    outside = outside.withColumn("extra", F.coalesce(F.col("cell") < F.col("last"), F.lit(False)).cast("long"))
    columns = ["row", "source", "size", "weight", "source_size", "target", "epochs", "extra"]
    both = inside.select(*columns).unionByName(outside.select(*columns))
    return both.select(F.col("row").alias(key), "size", "source_size", "target",
                       (F.col("size") * (F.col("epochs") + F.col("extra"))).cast("long").alias("taken"),
                       "source", "weight")
