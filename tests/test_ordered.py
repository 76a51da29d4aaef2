"""Running totals and quantiles against NumPy, with ties, NULL groups and one group holding most rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid.operators import ordered
from lossgrid.operators.ordered import approx_quantiles, exact_quantiles, running_totals


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(6000):
        group = "hot" if i % 3 else (None if i % 9 == 0 else f"g{i % 5}")
        value = None if i % 101 == 0 else (0.5 if i % 4 == 0 else float(np.round(rng.normal(), 2)))
        rows.append((group, value, int(rng.integers(1, 5))))
    return spark.createDataFrame(rows, "g string, v double, w int"), rows


def test_running_totals_equal_cumulative_sums(spark, skewed):
    df, rows = skewed
    got = {(r["g"], r["v"]): r for r in running_totals(df, "v", {"s": F.col("w")}, ["g"]).collect()}
    groups = {r[0] for r in rows}
    assert {g for g, _ in got} == groups
    for group in groups:
        mine = [(v, w) for g, v, w in rows if g == group and v is not None]
        total = sum(w for _, w in mine)
        upto = 0
        for value in sorted({v for v, _ in mine}):
            upto += sum(w for v, w in mine if v == value)
            row = got[(group, value)]
            assert (row["s_upto"], row["s_total"]) == (upto, total)


@pytest.mark.parametrize("partitions,buckets", [(1, 8), (4, 64), (16, 8)])
def test_totals_do_not_depend_on_layout(spark, skewed, partitions, buckets):
    df, _ = skewed
    def run(d, b):
        return sorted(map(str, running_totals(d, "v", {"n": F.lit(1)}, ["g"], buckets=b).collect()))

    assert run(df.repartition(partitions), buckets) == run(df.coalesce(1), 16)


def test_quantiles_equal_numpy(spark, skewed):
    df, rows = skewed
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    for row in exact_quantiles(df, "v", probs, ["g"]).collect():
        values = [v for g, v, _ in rows if g == row["g"] and v is not None]
        assert row["n"] == len(values)
        np.testing.assert_allclose(row["quantiles"], np.percentile(values, [100 * p for p in probs]), atol=1e-12)


def test_ungrouped_and_single_value(spark):
    one = spark.createDataFrame([(2.5,)] * 7, "v double")
    assert exact_quantiles(one, "v", [0.1, 0.9]).first()["quantiles"] == [2.5, 2.5]
    row = running_totals(one, "v", {"n": F.lit(1)}).first()
    assert (row["n"], row["n_upto"], row["n_total"]) == (7, 7, 7)


@pytest.mark.parametrize("partitions,buckets", [(1, 8), (6, 64)])
def test_bucket_selection_equals_the_full_order(spark, skewed, partitions, buckets):
    df, rows = skewed
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    few = exact_quantiles(df.repartition(partitions), "v", probs, ["g"], few_groups=True, buckets=buckets)
    full = exact_quantiles(df, "v", probs, ["g"], few_groups=False)
    assert sorted(map(str, few.collect())) == sorted(map(str, full.collect()))
    values = [v for _, v, _ in rows if v is not None]
    alone = exact_quantiles(df, "v", probs, buckets=buckets).first()
    np.testing.assert_allclose(alone["quantiles"], np.percentile(values, [100 * p for p in probs]), atol=1e-12)


def test_approximate_quantiles_have_the_same_layout(spark, skewed):
    df, _ = skewed
    exact, rough = exact_quantiles(df, "v", [0.5]).first(), approx_quantiles(df, "v", [0.5]).first()
    assert rough["n"] == exact["n"] and abs(rough["quantiles"][0] - exact["quantiles"][0]) < 0.05


@pytest.mark.parametrize("error", [1e-7, 0.0015, 0.2])
def test_quantiles_whatever_the_sketch_says(spark, monkeypatch, error):
    """Brackets that miss are widened, wide ones merge; ties, infinities, NaN, NULL, small and empty groups stay exact."""
    monkeypatch.setattr(ordered, "SKETCH_ERROR", error)
    monkeypatch.setattr(ordered, "SKETCH_SIZE", 16)
    rng = np.random.default_rng(5)
    values = {"a": rng.normal(size=20_000), "b": np.repeat([3.0, 7.0], [9_000, 1_000]), "c": np.array([1.0, 2.0]), None: np.arange(50.0)}
    values["a"][:3] = [np.inf, -np.inf, 1e300]
    rows = [(k, float(v)) for k, x in values.items() for v in x] + [("a", None), ("d", None), ("e", float("nan")), ("e", 4.0), ("e", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.9, 0.0, 0.001, 0.5, 0.5, 0.25, 0.8999, 0.999]
    found = {r["g"]: r for r in ordered.exact_quantiles(df, "v", probs, ["g"], few_groups=True).collect()}
    assert set(found) == {"a", "b", "c", None, "e"}
    for k, x in values.items():
        x, at = np.sort(x), [p * (len(x) - 1) for p in probs]
        want = [x[int(i)] if i == int(i) else x[int(i)] + (x[int(i) + 1] - x[int(i)]) * (i - int(i)) for i in at]
        assert found[k]["n"] == len(x) and found[k]["quantiles"] == pytest.approx(want, rel=1e-12)
    assert found["e"]["n"] == 3 and found["e"]["quantiles"][3] == 5.0 and math.isnan(found["e"]["quantiles"][-1])
    whole = ordered.exact_quantiles(df.filter("g = 'b'"), "v", [0.5, 0.95]).first()
    assert (whole["n"], whole["quantiles"]) == (10_000, [3.0, 7.0])


def test_quantiles_do_not_repeat_a_shuffle(spark):
    """A table behind a shuffle is written once and read twice; a plain scan is read where it is."""
    scan = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert ordered._cheap_to_read_twice(scan.filter("o_totalprice > 0").select("o_totalprice")).inputFiles() == scan.inputFiles()
    assert ordered._cheap_to_read_twice(scan.groupBy("o_custkey").sum("o_totalprice")).inputFiles() != scan.inputFiles()


def test_quantiles_of_columns_side_by_side(spark):
    """Those of every column for itself; NULL has no rank, a column without values is missing."""
    rng = np.random.default_rng(5)
    data = [(float(rng.normal()), int(rng.integers(0, 9)), None if i % 3 else float(i), None) for i in range(20_000)]
    df = spark.createDataFrame(data, "a double, b int, c double, d double").repartition(5)
    probs = [0.0, 0.1, 0.5, 0.99, 1.0]
    found = {r["feature"]: r for r in ordered.column_quantiles(df, ["a", "b", "c", "d"], probs).collect()}
    assert set(found) == {"a", "b", "c"}
    for i, c in enumerate("abc"):
        values = [r[i] for r in data if r[i] is not None]
        assert found[c]["n"] == len(values) and found[c]["quantiles"] == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)
    assert ordered.column_quantiles(df.limit(0), ["a", "b"], probs).count() == 0
