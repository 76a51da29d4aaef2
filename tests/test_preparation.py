"""Cleaning, features, encoding, selection and split on hand-made tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid.operators import categories, cleaning, encoding, features, quality, selection, split
from lossgrid.sources.loan_csv import read_loans_dir


def test_parse_percent_and_month(spark):
    df = spark.createDataFrame(
        [("45.3%", "Dec-2015"), (" 7 %", "Foo-2015"), ("abc", None), (None, "Jan-1999")], "revol_util string, issue_d string"
    )
    rows = cleaning.parse_month(cleaning.parse_percent(df)).collect()
    assert [r["revol_util"] for r in rows] == [pytest.approx(0.453), pytest.approx(0.07), None, None]
    assert [r["issue_d"] for r in rows] == [dt.date(2015, 12, 1), None, None, dt.date(1999, 1, 1)]


def test_cleaning_steps_keep_missing_values(spark):
    df = spark.createDataFrame(
        [(1, 10.0, 8.0, 5.0), (2, None, 8.0, None), (3, 9.0, None, 1500.0), (4, -1.0, -2.0, 999.0), (5, 3.0, 0.0, 1.0)],
        "k int, funded_amnt double, loan_amnt double, dti double",
    )
    capped = {r["k"]: r["funded_amnt"] for r in cleaning.cap_funded_at_requested(df).collect()}
    assert capped == {1: 8.0, 2: None, 3: None, 4: -2.0, 5: 0.0}
    cleared = {r["k"]: (r["funded_amnt"], r["loan_amnt"]) for r in cleaning.negatives_to_null(df).collect()}
    assert cleared[4] == (None, None) and cleared[1] == (10.0, 8.0)
    kept = {r["k"] for r in cleaning.filter_income_dti(df.withColumn("annual_inc", F.col("loan_amnt"))).collect()}
    assert kept == {1, 2}


def test_dedup_treats_null_keys_as_equal_and_keeps_the_first(spark):
    rows = [(1, 1, 5.0), (1, 1, 3.0), (None, None, 9.0), (None, None, 2.0), (1, None, 7.0)]
    df = spark.createDataFrame(rows, "id int, member_id int, x double")
    got = sorted(cleaning.dedup_loans(df, order_by=["x"]).collect(), key=str)
    assert sorted(r["x"] for r in got) == [2.0, 3.0, 7.0]
    assert cleaning.dedup_loans(df.drop("id", "member_id").union(df.select("x"))).count() == 5


def test_target_mapping_drops_open_loans(spark):
    statuses = ["Fully Paid", "Charged Off", "Default", "Current", None,
                "Does not meet the credit policy. Status:Charged Off", "Does not meet the credit policy. Status:Fully Paid"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(statuses)], "k int, loan_status string")
    out = cleaning.map_default_target(df)
    assert {r["k"]: r["default"] for r in out.collect()} == {0: 0, 1: 1, 2: 1, 5: 1}
    assert "loan_status" not in out.columns


def test_prepare_loans_accepts_any_subset_of_columns(spark):
    df = spark.createDataFrame([("1", 100.0, float("nan")), ("2", 50.0, 3.0), ("1", 100.0, float("nan"))], "id string, loan_amnt double, dti double")
    out = cleaning.prepare_loans(df)
    assert out.columns == ["loan_amnt", "dti", "dti_missing"]
    assert sorted((r["loan_amnt"], r["dti"], r["dti_missing"]) for r in out.collect()) == [(50.0, 3.0, 0), (100.0, None, 1)]


def test_features_at_their_edges(spark):
    df = spark.createDataFrame(
        [(580.0, 4, 0, 0.0, 12.0, None, 3), (580.1, 4, 8, 120.0, 1.0, 0, 2), (851.0, 1, 1, 24.0, 1.0, 2, None)],
        "fico_avg double, open_acc int, total_acc int, annual_inc double, loan_amnt double, delinq_2yrs int, inq_last_6mths int",
    )
    rows = features.derived_features(df).collect()
    assert [r["fico_band"] for r in rows] == ["Poor", "Fair", None]
    assert [r["utilization_of_credit_lines"] for r in rows] == [4.0, 0.5, 1.0]
    assert [r["loan_to_income"] for r in rows] == [12.0, pytest.approx(1 / 120), pytest.approx(1 / 24)]
    assert [r["clean_record"] for r in rows] == [1, 1, 0]
    assert [r["high_inquiry_activity"] for r in rows] == [1, 0, 0]
    zero_income = features.payment_to_income(df.withColumn("installment", F.lit(1.0))).collect()
    assert zero_income[0]["pmt_to_inc"] is None


def test_mode_ties_take_the_smallest_and_all_null_stays(spark):
    df = spark.createDataFrame([("b", None, None), ("a", None, 1.0), (None, None, 3.0), ("b", None, None), ("a", None, None)],
                               "c string, empty string, x double")
    rows = encoding.handle_missing_values(df).collect()
    assert rows[2]["c"] == "a" and rows[2]["empty"] is None
    assert [r["x"] for r in rows] == [2.0, 1.0, 3.0, 2.0, 2.0]


def test_one_hot_drops_first_level_and_refuses_too_many(spark):
    df = spark.createDataFrame([("b", 1), ("a", 0), (None, 1), ("c", 0)], "c string, y int")
    out = encoding.one_hot(df, target="y")
    assert out.columns == ["c_b", "c_c", "y"]
    assert sorted(map(tuple, out.collect())) == [(0, 0, 0), (0, 0, 1), (0, 1, 0), (1, 0, 1)]
    with pytest.raises(ValueError):
        encoding.one_hot(df, max_levels=2)


def test_quality_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (0, "x"), (None, "x")], "y int, c string")
    row = quality.quality_report(df, target="y").first()
    assert (row["n_rows"], row["duplicate_rows"], row["missing_values"]) == (5, 2, 4)
    assert row["target_rate"] == 0.75
    assert quality.quality_report(df.filter("y IS NULL"), target="y").first()["target_rate"] is None


def test_clean_table_and_cardinality(spark):
    rows = [(i, None if i > 5 else 1, i % 2 if i % 10 else None) for i in range(100)]
    df = spark.createDataFrame([*rows, *rows[1:6]], "k int, sparse int, y int")
    cleaned = quality.clean_table(df, target="y", missing_threshold=0.5)
    assert cleaned.columns == ["k", "y"] and cleaned.count() == 90
    ids = df.select(F.format_string("CUST_%04d", "k").alias("customer_id"), F.lit("x").alias("const"))
    assert [tuple(r) for r in quality.high_cardinality(ids).collect()] == [("customer_id", 100)]


def test_selection_ranks_the_informative_feature_first(spark):
    df = spark.range(2000).select(
        (F.col("id") % 2).alias("y"), (F.col("id") % 2 * 3.0 + F.col("id") % 7).alias("good"), F.pmod(F.xxhash64("id"), F.lit(97)).alias("noise"),
        F.lit(1.0).alias("constant"),
    )
    for method in ("mutual_info", "anova"):
        found = selection.select_features(df, label="y", method=method, k=2).collect()
        assert [r["feature"] for r in found] == ["good", "noise"]


@pytest.mark.parametrize("partitions", [1, 7])
def test_split_is_exact_per_class_and_stable(spark, partitions):
    df = spark.range(1003).select("id", (F.col("id") % 10 == 0).cast("int").alias("y")).repartition(partitions)
    out = split.stratified_split(df, key="id", label="y")
    sizes = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    for label, n in ((0, 902), (1, 101)):
        assert sizes[(label, "test")] == int(n * 0.3 + 0.5) and sizes[(label, "val")] == int(n * 0.2 + 0.5)
        assert sum(v for (c, _), v in sizes.items() if c == label) == n
    other = split.stratified_split(df.repartition(3), key="id", label="y")
    assert out.select("id", "split").exceptAll(other.select("id", "split")).isEmpty()


@pytest.mark.parametrize("hot", [3, 17, 58])
def test_split_with_a_key_that_holds_a_third(spark, hot):
    """Against ranks of all rows in plain Python; the hot key is one row wherever rows are ordered."""
    keys = [k for k in range(120)] + [hot] * 60
    df = spark.createDataFrame([(k, 1) for k in keys], "id long, y int").repartition(4)
    out = split.stratified_split(df, key="id", label="y")
    found = {}
    for r in out.collect():
        assert found.setdefault(r["id"], r["split"]) == r["split"]
    order = sorted((int(hashlib.md5(f"42|{k}".encode()).hexdigest()[:13], 16), k) for k in keys)
    test = int(len(keys) * 0.3 + 0.5)
    val = test + int(len(keys) * 0.2 + 0.5)
    for place in sorted(set(order)):
        assert found[place[1]] == ("test" if place <= order[test - 1] else "val" if place <= order[val - 1] else "train")
    assert out.count() == len(keys)


def test_csv_tree_needs_an_accepted_file(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        read_loans_dir(spark, str(tmp_path))
    (tmp_path / "a" / "b" / "My_Accepted_2018.csv").write_text(",id,loan_amnt,desc\n0,7,1.5,hello\n1,8,bad,\n")
    (tmp_path / "a" / "rejected.CSV.csv").write_text("x\n1\n")
    tables = read_loans_dir(spark, str(tmp_path), drop_cols=["desc"], accepted_only=False)
    assert tables["accepted"].columns == ["id", "loan_amnt"]
    assert [r["loan_amnt"] for r in tables["accepted"].collect()] == [1.5, None]
    assert tables["rejected"].count() == 1


def test_levels_are_numbered_in_order_without_a_limit(spark):
    df = spark.range(3000).select("id", F.concat(F.lit("k"), F.col("id") % 1500).alias("wide"), F.when(F.col("id") % 3 > 0, "only").alias("one"),
                                  F.lit(None).cast("string").alias("none"), (F.col("id") % 2).alias("x"))
    levels = categories.level_table(df, ["wide", "none", "one"])
    rows = levels.orderBy("feature", "level").collect()
    wide = [r for r in rows if r["feature"] == "wide"]
    assert [r["level"] for r in wide] == sorted({f"k{i}" for i in range(1500)}) and [r["level_id"] for r in wide] == list(range(1500))
    assert [r["slot"] for r in wide] == [None, *range(1499)] and all(r["n"] == 2 for r in wide)
    assert [(r["level"], r["n"], r["slot"]) for r in rows if r["feature"] == "one"] == [("only", 2000, None)]
    sparse = categories.sparse_rows(df, levels, cat_cols=["wide", "none", "one"], num_cols=["x"], keep=["id"])
    got = {r["id"]: [(e["slot"], e["value"]) for e in r["entries"]] for r in sparse.collect()}
    number = {r["level"]: r["slot"] for r in wide}
    for i in range(3000):
        slot = number[f"k{i % 1500}"]
        assert got[i] == [(0, 1.0)] * (i % 2) + ([(slot + 1, 1.0)] if slot is not None else [])
    empty = categories.level_table(df.limit(0), ["wide"])
    assert empty.collect() == [] and categories.sparse_rows(df.limit(0), empty, cat_cols=["wide"]).collect() == []


def test_scores_of_levels_are_those_of_their_indicators(spark):
    df = spark.range(600).select("id", F.concat(F.lit("g"), F.col("id") % 5).alias("g"), F.expr("CAST(id % 5 = 2 OR id % 7 = 0 AS INT)").alias("y"))
    wanted = df.select("y", *[(F.col("g") == f"g{i}").cast("int").alias(f"g_g{i}") for i in range(1, 5)])
    by_f = selection.select_anova_f(wanted, label="y", k=4).collect()
    got = categories.level_scores(df, label="y", cols=["g"], method="anova", k=4).collect()
    assert {f"g_{r['level']}": pytest.approx(r["score"]) for r in got} == {r["feature"]: r["score"] for r in by_f}
    best = categories.level_scores(df, label="y", cols=["g"], k=1).first()
    n = df.groupBy((F.col("g") == "g2").alias("x"), "y").count().collect()
    cell = {(r["x"], r["y"]): r["count"] for r in n}
    info = sum(c / 600 * math.log(c * 600 / (sum(v for (a, _), v in cell.items() if a == x) * sum(v for (_, b), v in cell.items() if b == y))) for (x, y), c in cell.items())
    assert best["level"] == "g2" and best["score"] == pytest.approx(info)
    assert categories.level_scores(df.limit(0), label="y", cols=["g"]).collect() == []


def test_correlations_of_many_columns(spark):
    """150 columns with missing values against numpy, pair by pair; constants and lone rows have no coefficient."""
    r = np.random.default_rng(7)
    n, k = 400, 150
    x = r.normal(0, 1, (n, k)) + r.normal(0, 1, (n, 1))
    x[:, 3] = x[:, 3] * 1e-3 + 1e7
    x[:, 5] = 0.1
    x[r.random((n, k)) < 0.2] = np.nan
    x[:, 7] = np.nan
    x[0, 7] = 2.0
    x[:, 9] = np.where(np.isnan(x[:, 10]), 5.0, -3.25)  # constant wherever column 10 is known
    rows = [tuple(None if np.isnan(v) else float(v) for v in row) for row in x]
    df = spark.createDataFrame(rows, ", ".join(f"`c {i}` double" for i in range(k))).repartition(5)
    found = {(q["feature_a"], q["feature_b"]): q["corr"] for q in selection.correlation_matrix(df).collect()}
    assert len(found) == k * k
    for i in range(0, k, 1):
        for j in (0, 3, 5, 7, 9, 10, i):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            got = found[f"c {i}", f"c {j}"]
            assert got == found[f"c {j}", f"c {i}"]
            if len(a) < 2 or np.ptp(a) == 0 or np.ptp(b) == 0:
                assert got is None
            else:
                assert got == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-8)
    assert not [q for q in selection.correlation_matrix(df.limit(0), cols=["c 0", "c 1"]).collect() if q["corr"] is not None]
    assert selection.correlation_matrix(df.limit(0), cols=["c 0", "c 1"]).count() == 4


def test_correlation_shuffles_one_row_per_pair(spark):
    df = spark.range(1000).select(*[(F.col("id") * i % 7).alias(f"c{i}") for i in range(1, 20)])
    plan = selection.correlation_matrix(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "SortAggregate" not in plan and "Join" not in plan


def test_bounds_and_fillings_are_constants(spark):
    """What reads a capped or filled table again repeats neither its shuffles nor the search for medians and modes."""
    from lossgrid.operators import encoding

    rows = [(i, float(i) if i % 5 else None, "ab"[i % 2] if i % 7 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "id bigint, dti double, kind string").repartition(3)
    capped = cleaning.cap_outliers(df, cols=["dti"])
    filled = encoding.impute_mode(encoding.impute_median(capped, cols=["dti"]), cols=["kind"])
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    assert not any(step in plan for step in ("Repartition", "Aggregate", "subquery"))
    assert filled.filter("dti IS NULL OR kind IS NULL").count() == 0 and filled.count() == 500
    low, high = np.quantile([r[1] for r in rows if r[1] is not None], [0.01, 0.99])
    assert filled.agg(F.min("dti"), F.max("dti")).first() == (pytest.approx(low), pytest.approx(high))
