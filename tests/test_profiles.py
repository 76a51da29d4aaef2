"""Reference profiles: same drift as from both samples, without reading the reference."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lossgrid.operators import drift, profiles
from lossgrid.session import scratch_dir

SCHEMA = "is_ref int, g string, y int, score double, x double, few double, same double"


def _rows(n: int, seed: int = 1) -> list[tuple]:
    rng, rows = random.Random(seed), []
    for i in range(n):
        ref = int(rng.random() < 0.6)
        x = None if i % 13 == 0 else round(rng.gauss(0.0 if ref else 0.4, 1.0), 2)
        rows.append((ref, [None, "a", "b"][i % 3], int(rng.random() < 0.2 + 0.1 * (1 - ref)), rng.random() ** (1 + ref), x, float(rng.randrange(3 + ref)), 7.0))
    return rows


@pytest.fixture(scope="module")
def both(spark):
    """Both samples, the reference in a folder of its own."""
    rows = spark.createDataFrame(_rows(1500), SCHEMA)
    path = scratch_dir(spark, "reference")
    rows.filter("is_ref = 1").write.parquet(path)
    return rows, spark.read.parquet(path), rows.filter("is_ref = 0"), path


def _by_key(df, keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_same_drift_as_from_both_samples(spark, both, by):
    rows, reference, current, _ = both
    names = ["x", "few", "same"]
    profile = profiles.build_profile(profiles.value_counts(reference, features=names, by=by), by=by)
    path = scratch_dir(spark, "saved")
    profile.save(path)
    found = _by_key(profiles.drift_from_profile(current, profiles.Profile.load(spark, path), features=names), [*by, "feature"])
    wanted = _by_key(drift.feature_drift(rows, features=names, is_ref="is_ref", by=by), [*by, "feature"])
    assert found.keys() == wanted.keys() and len(wanted) == 3 * (3 if by else 1)
    for key, row in wanted.items():
        assert found[key] == {k: pytest.approx(v, abs=1e-12) if isinstance(v, float) else v for k, v in row.items()}


def test_same_verdict_and_no_reading_of_the_reference(spark, both):
    rows, reference, current, path = both
    counts, saved = scratch_dir(spark, "counts"), scratch_dir(spark, "saved")
    part = profiles.value_counts(reference, features=["x"], score="score", label="y")
    for name in ("01", "02", "01"):  # two halves by label, the first of them written again
        mine = reference.filter(F.col("y") == (0 if name == "01" else 1))
        profiles.write_counts(profiles.value_counts(mine, features=["x"], score="score", label="y"), counts, part=name)
    read = profiles.read_counts(spark, counts)
    assert {r["part"] for r in read.select("part").distinct().collect()} == {"01", "02"}
    assert read.agg(F.sum("rows")).first()[0] == part.agg(F.sum("rows")).first()[0]
    profiles.build_profile(read).save(saved)
    found = profiles.verdict_from_profile(current, profiles.Profile.load(spark, saved), score="score", label="y", features=["x"])
    wanted = drift.drift_verdict(rows, score="score", label="y", is_ref="is_ref", features=["x"]).first().asDict()
    assert found.first().asDict() == {k: pytest.approx(v) if isinstance(v, float) else v for k, v in wanted.items()}
    files = found.inputFiles()
    assert any(saved in f for f in files) and not any(path in f or counts in f for f in files)


def test_thinned_steps_keep_the_error_and_high_steps(spark):
    rng = random.Random(5)
    ref = [0.5 if rng.random() < 0.4 else rng.random() for _ in range(4000)]
    cur = [rng.random() ** 1.3 for _ in range(1500)]
    rows = spark.createDataFrame([(1, v) for v in ref] + [(0, v) for v in cur], "is_ref int, x double")
    counts = profiles.value_counts(rows.filter("is_ref = 1"), features=["x"])
    exact, current = profiles.build_profile(counts), rows.filter("is_ref = 0")
    whole = profiles.drift_from_profile(current, exact, features=["x"]).first()
    for error in (0.1, 0.01):
        thin = profiles.build_profile(counts, max_error=error)
        assert thin.steps.count() <= 2 / error + 1 and thin.steps.agg(F.sum("rows")).first()[0] == 4000
        assert thin.steps.filter("value = 0.5").first()["rows"] >= sum(v == 0.5 for v in ref)
        heights, height = {r["value"]: r["rows"] for r in thin.steps.collect()}, 0
        for value in sorted(set(ref)):
            height += heights.get(value, 0)
            assert 0 <= sum(v <= value for v in ref) / 4000 - height / 4000 < error
        row = profiles.drift_from_profile(current, thin, features=["x"]).first()
        assert row["psi"] == pytest.approx(whole["psi"]) and abs(row["ks_statistic"] - whole["ks_statistic"]) < error


def test_empty_samples_and_bad_names(spark, both):
    _, reference, current, _ = both
    profile = profiles.build_profile(profiles.value_counts(reference, features=["x"]))
    none = profiles.drift_from_profile(current.limit(0), profile, features=["x"]).first()
    assert none["ks_statistic"] is None and none["psi"] is not None
    assert profiles.drift_from_profile(current, profile, features=["few"]).count() == 0
    empty = profiles.build_profile(profiles.value_counts(reference.limit(0), features=["x"]))
    path = scratch_dir(spark, "empty")
    empty.save(path)
    assert profiles.drift_from_profile(current, profiles.Profile.load(spark, path), features=["x"]).count() == 0
    with pytest.raises(ValueError, match="part names"):
        profiles.write_counts(reference, "/nowhere", part="a/b")
