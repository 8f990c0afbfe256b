import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import quantiles
from ledgerloom.functions.quantiles import exact_quantiles, global_row_number, quantile_bin

PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


@pytest.mark.parametrize("size", [1, 2, 3, 6, 7, 101, 5000])
def test_matches_linear_interpolation(spark, size):
    rng = np.random.default_rng(size)
    frame = pd.DataFrame({"a": rng.normal(size=size).round(2), "b": rng.integers(0, 5, size)})
    row = exact_quantiles(spark.createDataFrame(frame), ["a", "b"], PROBS).first()
    for c in ("a", "b"):
        assert np.allclose(row[c], frame[c].quantile(PROBS), rtol=0, atol=1e-9)


def test_exact_with_coarse_sketch_and_hot_value(spark):
    """A third of the rows share one value, and the sketch is far coarser than the data."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id") * 0.01).alias("x")
    )
    expected = df.toPandas()["x"].quantile([0.1, 0.5, 0.9])
    got = exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], accuracy=200).first()["x"]
    assert np.allclose(got, expected, atol=1e-9)


def test_nulls_are_ignored(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]).first()["x"] == [2.0]


def test_bins_are_quantile_edges_not_equal_counts(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 7)], "x int")
    edges = exact_quantiles(df, ["x"], PROBS).select(F.col("x").alias("e"))
    rows = df.crossJoin(edges).select("x", quantile_bin(F.col("x"), F.col("e"), 4).alias("bin")).collect()
    assert [r["bin"] for r in sorted(rows)] == [1, 1, 2, 3, 4, 4]


@pytest.mark.parametrize("size", [5, 13, 59])
def test_bins_equal_pandas_on_ranks(spark, size):
    df = spark.range(1, size + 1).select(F.col("id").alias("x"))
    edges = exact_quantiles(df, ["x"], PROBS).select(F.col("x").alias("e"))
    rows = df.crossJoin(edges).select("x", quantile_bin(F.col("x"), F.col("e"), 4).alias("bin")).collect()
    expected = pd.qcut(pd.Series(range(1, size + 1)), 4, labels=[1, 2, 3, 4]).astype(int).tolist()
    assert [r["bin"] for r in sorted(rows)] == expected


def test_collapsed_edges_give_no_bin(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "x int")
    edges = exact_quantiles(df, ["x"], PROBS).select(F.col("x").alias("e"))
    bins = df.crossJoin(edges).select(quantile_bin(F.col("x"), F.col("e"), 4).alias("b"))
    assert {r["b"] for r in bins.collect()} == {None}


def test_global_row_number(spark):
    df = spark.range(10_000).select((F.col("id") % 7).alias("f"), F.col("id").alias("k"))
    got = global_row_number(df.repartition(16), ["f", "k"]).toPandas().sort_values("row_number")
    expected = df.toPandas().sort_values(["f", "k"])
    assert got["row_number"].tolist() == list(range(1, 10_001))
    assert got["k"].tolist() == expected["k"].tolist()


def test_half_of_the_rows_in_one_bracket(spark, monkeypatch):
    """Half of all rows are distinct values within one bracket: rounds narrow it, no task gets it whole."""
    monkeypatch.setattr(quantiles, "FEW", 50)
    rounds = []
    narrow = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda inner, ranks: (rounds.append(len(ranks)), narrow(inner, ranks)))
    df = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 5 + F.col("id") * 1e-9).otherwise(F.col("id").cast("double")).alias("x")
    )
    probs = [0.01, 0.25, 0.5, 0.99]
    got = exact_quantiles(df, ["x"], probs, accuracy=20).first()["x"]
    assert np.allclose(got, df.toPandas()["x"].quantile(probs), rtol=0, atol=1e-12)
    assert 2 <= len(rounds) <= 4


def test_missed_bracket_is_widened(spark, monkeypatch):
    """A sketch that is far off costs a pass, not the result."""
    sketch, calls = F.percentile_approx, []

    def off(column, around, accuracy):
        calls.append(around)
        return sketch(column, [0.9] * len(around), accuracy) if len(calls) == 1 else sketch(column, around, accuracy)

    monkeypatch.setattr(quantiles.F, "percentile_approx", off)
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    assert exact_quantiles(df, ["x"], [0.25, 0.5]).first()["x"] == [249.75, 499.5]
    assert len(calls) >= 2


def test_no_values(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    row = exact_quantiles(df, ["x", "y"], [0.5]).first()
    assert row["x"] == [] and row["y"] == [1.0]


def test_no_window_over_values(spark):
    import inspect

    assert "Window" not in inspect.getsource(quantiles._select) + inspect.getsource(quantiles._narrow)
