"""Column building blocks against independent Python computations."""

from __future__ import annotations

import math
import statistics

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lossgrid.functions import bins, uniform
from lossgrid.functions.normal import with_normal_cdf, with_normal_quantile
from lossgrid.functions.numeric import clip, least_or_null, nan_to_null

NORMAL = statistics.NormalDist()


def test_normal_quantile_and_cdf(spark):
    ps = [1e-300, 1e-9, 1e-6, 1e-3, 0.02, 0.0749, 0.0751, 0.3, 0.5, 0.7, 0.95, 0.99999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    for row in with_normal_cdf(with_normal_quantile(df, "z", "p"), "c", "z").collect():
        assert row["z"] == pytest.approx(NORMAL.inv_cdf(row["p"]), rel=1e-13, abs=1e-15)
        assert row["c"] == pytest.approx(row["p"], rel=1e-9)


def test_normal_functions_at_the_ends(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double")
    rows = with_normal_cdf(with_normal_quantile(df, "z", "p"), "c", "z").collect()
    assert (rows[0]["z"], rows[0]["c"]) == (-math.inf, 0.0)
    assert (rows[1]["z"], rows[1]["c"]) == (math.inf, 1.0)
    assert (rows[2]["z"], rows[2]["c"]) == (None, None)


def reference_uniform(entity: int, run: int, seed: int) -> float:
    p, k = uniform.PRIME, uniform.ROUND_KEYS
    state = pow(entity % p + (seed * k[1] + k[0]) % p, 5, p)
    state = pow(state + run * k[2] + k[3], 5, p)
    state = pow(state + (entity // p) % p + k[4], 5, p)
    return (state + 0.5) / p


def test_uniform_matches_integer_arithmetic_at_any_partitioning(spark):
    keys = [0, 1, 2, 12345, 2**31 - 1, 2**31, 2**40 + 7, 2**62]
    df = spark.createDataFrame([(k, r) for k in keys for r in (0, 1, 999)], "k bigint, r bigint")
    for parts in (1, 5):
        rows = uniform.with_uniform(df.repartition(parts), "u", "k", "r", 42).collect()
        assert all(row["u"] == reference_uniform(row["k"], row["r"], 42) for row in rows)


def test_uniform_is_uniform_and_uncorrelated(spark):
    n, runs = 2000, 60
    df = spark.range(n).select(F.col("id").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("r"))
    drawn = uniform.with_uniform(df, "u", "k", "r", 7).toPandas().pivot(index="k", columns="r", values="u").to_numpy()
    assert abs(drawn.mean() - 0.5) < 0.005 and abs(drawn.var() * 12 - 1) < 0.02
    between = np.corrcoef(drawn.T)[np.triu_indices(runs, 1)]
    assert abs(between.std() * math.sqrt(n) - 1) < 0.1


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-0.5, 1.5, allow_nan=False), min_size=1, max_size=40))
def test_right_closed_bins(spark, values):
    edges = bins.unit_edges(10)
    values = values + [0.0, 0.1, 0.3, 0.30000000000000004, 0.9, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "x double").withColumn("b", bins.right_closed_bin(F.col("x"), edges))
    for row in df.collect():
        assert row["b"] == min(max(int(np.searchsorted(edges, row["x"], side="left")) - 1, 0), 9)


@pytest.mark.parametrize("closed", ["left", "right"])
def test_equal_width_bins_follow_the_edges(spark, closed):
    lo, hi, n = 0.1, 0.9, 7
    edges = [lo + i * ((hi - lo) / n) for i in range(n)] + [hi]
    values = edges + [0.1234, 0.5, 0.77]
    df = spark.createDataFrame([(v,) for v in values], "x double").withColumn(
        "b", bins.equal_width_bin(F.col("x"), F.lit(lo), F.lit(hi), n, closed)
    )
    side = "right" if closed == "left" else "left"
    for row in df.collect():
        assert row["b"] == min(max(int(np.searchsorted(edges, row["x"], side=side)) - 1, 0), n - 1)


def test_null_arithmetic(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), 2.0), (3.0, 2.0)], "a double, b double")
    rows = nan_to_null(df).select("a", least_or_null(F.col("a"), F.col("b")).alias("m"), clip(F.col("a"), 0, 2).alias("c")).collect()
    assert [tuple(r) for r in rows] == [(1.0, None, 1.0), (None, None, None), (3.0, 2.0, 2.0)]
