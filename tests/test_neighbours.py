"""Nearest-neighbour mutual information against brute force."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lossgrid.functions.special import digamma
from lossgrid.operators import selection
from lossgrid.operators.neighbours import neighbour_mutual_info, with_nearest


def _psi(n: int) -> float:
    return sum(1.0 / j for j in range(1, n)) - 0.5772156649015329


def _brute_force(rows: list[tuple], column: int, k: int) -> float:
    """Straight from the definition, all distances of a row sorted."""
    usable = [(r[0], r[column] if r[column] is not None and math.isfinite(r[column]) else 0.0) for r in rows if r[0] is not None]
    sizes = {y: sum(1 for c, _ in usable if c == y) for y, _ in usable}
    kept = [(y, x) for y, x in usable if sizes[y] > 1]
    total = 0.0
    for i, (y, x) in enumerate(kept):
        own = sorted(abs(x - v) for j, (c, v) in enumerate(kept) if c == y and j != i)
        rank = min(k, sizes[y] - 1)
        radius = own[rank - 1]
        if radius == 0:
            rank, m = sum(1 for c, v in kept if c == y and v == x), sum(1 for _, v in kept if v == x)
        else:
            m = sum(1 for _, v in kept if x - radius < v < x + radius)
        total += _psi(rank) - _psi(sizes[y]) - _psi(m)
    return max(0.0, _psi(len(kept)) + total / len(kept))


def _table(n: int, seed: int) -> list[tuple]:
    """Label of three classes and one lone row; a telling column, a noisy one, one of few values, one with gaps."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        y = None if i % 17 == 3 else 9 if i == 5 else 2 if i % 29 == 0 else i % 2
        telling = float(rng.randrange(64 * (y or 0), 64 * (y or 0) + 100)) / 8
        gaps = [None, float("nan"), float("inf")][i % 3] if i % 5 == 0 else float(rng.randrange(4096))
        rows.append((y, telling, float(rng.randrange(10**6)), float(rng.randrange(3)), gaps))
    return rows


SCHEMA = "y int, telling double, noise double, few double, gaps double"


@pytest.mark.parametrize(("n", "k"), [(400, 3), (90, 1), (150, 7)])
def test_equal_to_brute_force(spark, n, k):
    rows = _table(n, seed=n)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = {r["feature"]: r["score"] for r in neighbour_mutual_info(table, label="y", neighbours=k).collect()}
    assert found == {c: pytest.approx(_brute_force(rows, i, k), abs=1e-9) for i, c in enumerate(("telling", "noise", "few", "gaps"), 1)}
    assert max(found, key=found.get) == "telling"


def test_few_rows_empty_tables_and_clashing_names(spark):
    empty = spark.createDataFrame([], "y int, x double")
    assert neighbour_mutual_info(empty, label="y").count() == 0
    assert neighbour_mutual_info(spark.createDataFrame([(0, 1.0), (1, 2.0)], "y int, x double"), label="y").count() == 0
    rows = [(i % 2, float(i % 2) + 0.25 * (i % 3), 1.0) for i in range(40)]
    table = spark.createDataFrame(rows, "n int, value double, feature double")
    found = {r["feature"]: r["score"] for r in neighbour_mutual_info(table, label="n").collect()}
    assert found == {"value": pytest.approx(_brute_force(rows, 1, 3)), "feature": pytest.approx(_brute_force(rows, 2, 3), abs=1e-9)}
    assert found["feature"] == pytest.approx(0.0, abs=1e-9)


def test_neighbours_across_the_borders_of_buckets(spark):
    """One group of nearly all rows, one of a few: many buckets hold fewer than k rows of the second."""
    rows = [("many", float(i), 1) for i in range(500)] + [("few", float(100 * i), 1) for i in range(6)]
    table = spark.createDataFrame(rows, "g string, value double, n int").repartition(7)
    for r in with_nearest(table, "value", "n", ["g"], 4).collect():
        values = sorted(v for g, v, _ in rows if g == r["g"])
        at = values.index(r["value"])
        assert [p["value"] for p in r["_below"]] == values[max(0, at - 4):at]
        assert [p["value"] for p in r["_above"]] == values[at + 1:at + 5]


def test_digamma(spark):
    found = spark.range(0, 2000).select("id", digamma(F.col("id")).alias("psi")).collect()
    assert found[0]["psi"] is None
    assert all(r["psi"] == pytest.approx(_psi(r["id"]), abs=1e-11) for r in found[1:])


def test_no_window_without_partitions(spark):
    from lossgrid.operators import neighbours

    points = spark.createDataFrame(_table(60, 1), SCHEMA)
    plan = neighbours._with_radius(neighbours._points(points, "y", ["telling"]), 3)._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"\bWindow \[.*", plan)
    assert windows and all(re.search(r"\], \[feature#\d+, _class#\d+", w) for w in windows)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_each_order_is_made_once(spark):
    """Intervals take their totals along: no large join, and no window over buckets is computed for two branches."""
    table = spark.createDataFrame(_table(200, 3), SCHEMA)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = neighbour_mutual_info(table, label="y")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "NestedLoop" not in plan
    assert len(re.findall(r"\bWindow \[", plan)) == 2


def test_as_a_selection_method(spark):
    table = spark.createDataFrame([(i % 2, float(i % 7) + 3.0 * (i % 2), "ab"[i % 2]) for i in range(80)], "y int, x double, c string")
    found = selection.select_features(table, label="y", method="neighbours", cols=["x"], cat_cols=["c"], k=5).collect()
    assert {r["column"] for r in found} == {"x", "c"}
