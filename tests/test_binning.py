import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from starrung.operators import binning
from starrung.operators.binning import assign_bins, histogram, quantile_breaks
from starrung.operators.ordering import with_running_total


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize("parts", [4, 10])
@pytest.mark.parametrize("single", [1_000_000, 0])
def test_breaks_equal_linear_quantiles(spark, ws, monkeypatch, parts, single):
    monkeypatch.setattr(binning, "SINGLE_TASK_VALUES", single)
    values = np.random.default_rng(3).normal(size=501).round(3)
    got = quantile_breaks(ws, frame(spark, values.tolist()), F.col("x"), parts)
    assert got == pytest.approx(np.quantile(values, np.linspace(0, 1, parts + 1)).tolist(), abs=1e-12)


@pytest.mark.parametrize("single", [1_000_000, 0])
def test_breaks_with_a_hot_value_and_weights(spark, ws, monkeypatch, single):
    monkeypatch.setattr(binning, "SINGLE_TASK_VALUES", single)
    values = [1.0] * 400 + list(map(float, range(2, 802)))
    weighted = spark.createDataFrame([(1.0, 400), *[(float(v), 1) for v in range(2, 802)]], "x double, w bigint")
    expected = np.quantile(values, [0, 0.5, 1]).tolist()
    plain = quantile_breaks(ws, frame(spark, values), F.col("x"), 2, rows=1200)
    by_weight = quantile_breaks(ws, weighted, F.col("x"), 2, weight=F.col("w"), rows=801)
    assert plain == by_weight == pytest.approx(expected)


def test_repeated_breaks_raise_or_merge(spark, ws):
    df = frame(spark, [1.0, 1.0, 1.0, 2.0])
    with pytest.raises(ValueError):
        quantile_breaks(ws, df, F.col("x"), 10)
    merged = quantile_breaks(ws, df, F.col("x"), 4, dedupe=True)
    assert merged == [1.0, 1.25, 2.0]
    with pytest.raises(ValueError):
        quantile_breaks(ws, df.limit(0), F.col("x"), 4)


def exact_breaks(values, parts):
    """Positions in whole numbers, then one interpolation."""
    values, out = sorted(values), []
    for i in range(parts + 1):
        rank, rest = divmod((len(values) - 1) * i, parts)
        low, high = values[rank], values[min(rank + 1, len(values) - 1)]
        out.append(low + (high - low) * (rest / parts))
    return out


@pytest.mark.parametrize("n", [2, 3, 7, 10, 11, 171, 172, 331, 999, 1000, 1001, 2000])
def test_breaks_do_not_depend_on_the_path(spark, ws, monkeypatch, n):
    df = spark.range(n).select((F.col("id") + 1).cast("double").alias("x"))
    for parts in (4, 10):
        want = exact_breaks([float(i + 1) for i in range(n)], parts)
        found = []
        for single in (0, 1_000_000):
            monkeypatch.setattr(binning, "SINGLE_TASK_VALUES", single)
            found += [quantile_breaks(ws, df, F.col("x"), parts, rows=n), quantile_breaks(ws, df, F.col("x"), parts)]
        assert found == [want] * 4


def test_repeated_breaks_keep_the_numbers_of_the_bins(spark, ws):
    few = frame(spark, [float(max(i, 2)) for i in range(1, 11)])  # the first breaks are equal
    many = frame(spark, [float(i) for i in range(1, 11)])
    breaks = quantile_breaks(ws, few, F.col("x"), 9, repeats=True)
    assert breaks == [2.0, *map(float, range(2, 11))]
    numbers = rows(few.select(assign_bins(F.col("x"), breaks)).distinct())
    own = rows(many.where("x > 2").select(assign_bins(F.col("x"), quantile_breaks(ws, many, F.col("x"), 9))))
    assert [b for b, in numbers] == [1, *[b for b, in own]] == [1, 2, 3, 4, 5, 6, 7, 8, 9]


def test_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 1.5, 2.0, 3.0, -5.0, 9.0, None)], "x double")
    got = df.select(assign_bins(F.col("x"), [0.0, 1.0, 2.0, 3.0])).collect()
    assert [r[0] for r in got] == [1, 1, 2, 2, 3, 1, 3, None]


def test_ties_share_a_bin(spark, ws):
    df = frame(spark, [1.0] * 5 + [2.0, 3.0, 4.0, 5.0, 6.0])
    breaks = quantile_breaks(ws, df, F.col("x"), 2)
    got = df.select("x", assign_bins(F.col("x"), breaks).alias("b")).distinct()
    assert rows(got) == [(1.0, 1), (2.0, 2), (3.0, 2), (4.0, 2), (5.0, 2), (6.0, 2)]


def test_equal_breaks_in_one_value(spark, ws):
    df = frame(spark, [4.0, 4.0])
    breaks = quantile_breaks(ws, df, F.col("x"), 4, dedupe=True)
    assert breaks == [4.0]
    assert rows(df.select(assign_bins(F.col("x"), breaks))) == [(1,), (1,)]


def test_histogram_fills_empty_bins_and_caps_the_top(spark, ws):
    got = rows(histogram(ws, frame(spark, [0.0, 0.1, 10.0, 9.9]), F.col("x"), 5).select("bin", "count"))
    assert got == [(0, 2), (1, 0), (2, 0), (3, 0), (4, 2)]
    assert rows(histogram(ws, frame(spark, [3.0, 3.0]), F.col("x"), 2).select("bin", "count")) == [(0, 2), (1, 0)]


def test_histogram_default_bins(spark, ws):
    assert histogram(ws, frame(spark, [float(i) for i in range(64)]), F.col("x")).count() == 7


def test_running_total_over_many_partitions(spark, ws):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("x"))
    got = with_running_total(ws, df, ["x"], weight=F.col("x"))
    for row in got.collect():
        assert row.before == row.x * (row.x - 1) // 2
