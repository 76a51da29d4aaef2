"""Model training, calibration and scoring."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lossgrid.operators import boosting, discrimination, models


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(42)
    rows = []
    for i in range(1500):
        x, z = float(rng.normal()), float(rng.normal(5, 3))
        c = ["low", "mid", "it's"][int(rng.integers(0, 3))]
        chance = 1 / (1 + np.exp(-(1.5 * x - 1 + (c == "mid"))))
        rows.append((i, x if i % 17 else None, z, c if i % 23 else None, int(rng.uniform() < chance)))
    return spark.createDataFrame(rows, "id int, x double, z double, c string, y int").repartition(4).cache()


@pytest.fixture(scope="module")
def logistic(table):
    return models.train_logistic(table, label="y", num_cols=["x", "z"], cat_cols=["c"], max_iter=50)


def auc(df, score="pd"):
    return discrimination.auc_ks(df, score=score, label="y").first()["auc_roc"]


def test_logistic_learns_and_survives_saving(spark, table, logistic, tmp_path):
    scored = models.score_pd(logistic, table)
    assert auc(scored) > 0.8
    models.save_model(logistic, str(tmp_path / "m"))
    again = models.score_pd(models.load_model(str(tmp_path / "m")), table, keep=["id"], out="again")
    gap = scored.join(again, "id").agg(F.max(F.abs(F.col("pd") - F.col("again")))).first()[0]
    assert gap < 1e-12
    with pytest.raises(ValueError):
        models.score_pd(None, table)


def test_importance_names_follow_the_vector(table, logistic):
    names = models.feature_names(logistic, table, num_cols=["x", "z"], cat_cols=["c"])
    assert names == ["x", "z", "c_it's", "c_low", "c_mid"]
    found = models.feature_importance(logistic, names, k=2).collect()
    assert found[0]["feature"] == "x" and len(found) == 2 and found[0]["importance"] >= found[1]["importance"]


def test_boosted_trees_rank_defaults(table):
    model = models.train_gbt(table, label="y", num_cols=["x", "z"], cat_cols=["c"], trees=5)
    assert auc(models.score_pd(model, table)) > 0.8


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0)], "x double, k double")
    rows = models.scale_std(df, num_cols=["x", "k"]).collect()
    std = np.std([1.0, 3.0, 2.0])
    assert [r["x"] for r in rows] == [pytest.approx(1 / std), pytest.approx(3 / std), pytest.approx(2 / std)]
    assert rows[0]["k"] == 7.0


@pytest.mark.parametrize("calibrate", [models.calibrate_isotonic, models.calibrate_platt])
def test_calibration_does_not_worsen_the_fit(table, logistic, calibrate):
    scored = models.score_pd(logistic, table).withColumn("raw", F.pow("pd", 0.3))
    out = calibrate(scored, score="raw", label="y")
    row = models.brier_improvement(out, label="y", before="raw", after="calibrated").first()
    assert row["brier_score_improvement"] > 0
    if calibrate is models.calibrate_isotonic:
        ordered = [r["calibrated"] for r in out.orderBy("raw").collect()]
        assert all(b >= a - 1e-12 for a, b in zip(ordered, ordered[1:]))


@pytest.mark.parametrize("method", models.CALIBRATION_METHODS)
def test_scores_become_probabilities(table, method):
    data = table.filter("x IS NOT NULL").select("id", "x", "y")
    row = models.pd_calibration(data, data, score="x", label="y", method=method).agg(F.min("pd"), F.max("pd"), F.avg("pd"), F.avg("y")).first()
    assert 0 <= row[0] < row[1] <= 1 and row[2] == pytest.approx(row[3], abs=0.02)


def test_unknown_calibration_is_an_error(table):
    with pytest.raises(ValueError):
        models.pd_calibration(table, table, score="x", label="y", method="other")


def test_isotonic_fit_is_exact(spark):
    """Scores that differ only in late digits stay apart; the fit equals pooling at once."""
    r = np.random.default_rng(8)
    scores = np.concatenate([r.normal(0, 3, 600), 0.5 + np.arange(40) * 1e-9])
    labels = (r.random(640) < 1 / (1 + np.exp(-scores))).astype(int)
    df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)], "s double, y int").repartition(7)
    order = np.argsort(scores, kind="stable")
    blocks = []
    for s, y in zip(scores[order], labels[order]):
        blocks.append([s, s, 1.0, float(y)])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            b = blocks.pop()
            blocks[-1] = [blocks[-1][0], b[1], blocks[-1][2] + b[2], blocks[-1][3] + b[3]]
    found = sorted(tuple(x) for x in models.isotonic_blocks(df, "s", "y").collect())
    assert found == [tuple(b) for b in blocks]


def test_many_levels_and_levels_of_unlabelled_rows(spark):
    """No limit on levels, and names come from the fitted model, not from the table at hand."""
    rows = [(i, float(i % 7), f"l{i % 300}", None if i % 300 == 299 else i % 2) for i in range(900)]
    df = spark.createDataFrame(rows, "id bigint, x double, c string, y int")
    model = models.train_logistic(df, label="y", num_cols=["x"], cat_cols=["c"])
    names = models.feature_names(model, df, num_cols=["x"], cat_cols=["c"])
    assert len(names) == 300 and "c_l299" not in names
    assert models.feature_importance(model, names, k=5).count() == 5


def _mllib(table, trees):
    from pyspark.ml.classification import GBTClassifier

    labelled = table.filter("y IN (0, 1)")
    pos, neg = labelled.filter("y = 1").count(), labelled.filter("y = 0").count()
    weighted = labelled.withColumn("_weight", F.when(F.col("y") == 1, neg / pos).otherwise(1.0))
    estimator = GBTClassifier(labelCol="y", weightCol="_weight", maxIter=trees, maxDepth=5, stepSize=0.1, seed=models.SEED)
    return models.fit_pipeline(weighted, estimator, num_cols=["x", "z"], cat_cols=["c"], scale=False)


def test_boosted_trees_are_those_of_mllib(table, tmp_path):
    ours, theirs = models.train_gbt(table, label="y", num_cols=["x", "z"], cat_cols=["c"], trees=4), _mllib(table, 4)
    models.save_model(ours, str(tmp_path / "trees"))
    both = models.score_pd(theirs, models.score_pd(models.load_model(str(tmp_path / "trees")), table), out="theirs")
    assert both.agg(F.max(F.abs(F.col("pd") - F.col("theirs")))).first()[0] < 1e-9
    last = ours.stages[-1]
    assert list(last.treeWeights) == [1.0, 0.1, 0.1, 0.1]
    assert last.featureImportances.toArray() == pytest.approx(theirs.stages[-1].featureImportances.toArray(), abs=1e-6)


def test_trees_grow_on_the_whole_cluster_whatever_the_files(spark, monkeypatch):
    """A table in one partition is summed up by as many tasks as the cluster has places, and every row is in the sums."""
    parts, rows, total = [], [], boosting._total

    def seen(sums, size):
        parts.append(sums.getNumPartitions())
        found = total(sums, size)
        rows.append(found[: (len(found) - 2) // 2].sum() if size == len(found) else 0)
        return found

    monkeypatch.setattr(boosting, "_total", seen)
    monkeypatch.setattr(boosting, "LEAST_ROWS", 100)
    table = spark.range(5000).selectExpr("id * 7919 % 1009 * 1e0 AS x", "CAST(id * 7919 % 1009 > id * 31 % 1500 AS INT) AS y").coalesce(1)
    models.train_gbt(table, label="y", num_cols=["x"], trees=2, depth=2)
    assert set(parts) == {spark.sparkContext.defaultParallelism} and rows[0] == 5000


def test_one_class_or_no_split(spark):
    """Nothing to split on gives trees of one leaf."""
    same = spark.createDataFrame([(1.0, i % 2) for i in range(40)], "x double, y int")
    assert models.score_pd(models.train_gbt(same, label="y", num_cols=["x"], trees=3), same).select("pd").distinct().count() == 1


def _grown_with(monkeypatch, table, rest_rows):
    summed, places = [], boosting._level_sums
    monkeypatch.setattr(boosting, "REST_ROWS", rest_rows)
    monkeypatch.setattr(boosting, "_total", lambda sums, size: (summed.append(size), np.sum(sums.collect(), axis=0))[1])
    model = models.train_gbt(table, label="y", num_cols=["x", "z"], cat_cols=["c"], trees=3)
    assert boosting._level_sums is places
    return model, sum(summed)


def test_the_larger_child_is_the_rest_of_its_parent(table, monkeypatch):
    """Adding up one child of two gives the scores that adding up both gives, from fewer sums."""
    (whole, many), (rest, few) = _grown_with(monkeypatch, table, 1 << 40), _grown_with(monkeypatch, table, 0)
    both = models.score_pd(rest, models.score_pd(whole, table), out="rest")
    assert few < 0.7 * many
    assert both.agg(F.max(F.abs(F.col("pd") - F.col("rest")))).first()[0] < 1e-9


def test_scores_in_batches_are_those_of_mllib(table):
    """Trees grown here are evaluated for whole columns, also for rows of levels and values that no fit has seen."""
    model = models.train_gbt(table, label="y", num_cols=["x", "z"], cat_cols=["c"], trees=30)
    edges = [float(c) for cuts in model.stages[-1].grown.cuts.values() for c in cuts][:20]
    rows = [(9000 + i, v, w, c, 0) for i, v in enumerate([*edges, -1e300, float("inf"), None]) for w in (0.0, 5.0, None) for c in ("mid", "new", None)]
    every = table.unionByName(table.sparkSession.createDataFrame(rows, table.schema))
    ours = models.score_pd(model, every)
    assert "ArrowEvalPython" in ours._jdf.queryExecution().executedPlan().toString()
    theirs = model.transform(ours).select("pd", F.get(vector_to_array("probability"), F.lit(1)).alias("theirs"))
    n, gap = theirs.agg(F.count("pd"), F.max(F.abs(F.col("pd") - F.col("theirs")))).first()
    assert n == 1500 + len(rows) and gap < 1e-14


def test_deep_trees_are_scored_in_batches(spark):
    """More than 255 places in a tree."""
    table = spark.range(3000).selectExpr("id * 7919 % 1009 * 1e0 AS x", "id % 97 * 1e0 AS z", "CAST(id * 31 % 53 > id % 41 AS INT) AS y")
    model = models.train_gbt(table, label="y", num_cols=["x", "z"], trees=4, depth=8)
    ours = models.score_pd(model, table)
    theirs = model.transform(ours).select("pd", F.get(vector_to_array("probability"), F.lit(1)).alias("theirs"))
    assert theirs.agg(F.max(F.abs(F.col("pd") - F.col("theirs")))).first()[0] < 1e-14
