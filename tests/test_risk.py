"""Loss, capital, simulation, concentration and impairment operators."""

from __future__ import annotations

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid.operators import capital, components, concentration, impairment, simulation
from tests.test_functions import reference_uniform

N = statistics.NormalDist()
PARTS = {"pd": "pd", "ead": "ead", "lgd": "lgd"}


def loans(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id bigint, pd double, ead double, lgd double")


@pytest.fixture(scope="module")
def portfolio(spark):
    rng = np.random.default_rng(42)
    rows = [(float(rng.uniform(0.01, 0.2)), float(rng.lognormal(10, 1)), float(rng.beta(2, 3))) for _ in range(300)]
    return loans(spark, rows), rows


def test_expected_loss_and_empty_exposure(spark, portfolio):
    df, rows = portfolio
    row = components.expected_loss(df, **PARTS).first()
    assert row["total_el"] == pytest.approx(sum(p * e * l for p, e, l in rows))
    assert row["el_rate"] == pytest.approx(row["total_el"] / sum(e for _, e, _ in rows))
    none = components.expected_loss(loans(spark, [(0.1, 0.0, 0.4)]), pd="pd", ead="ead").first()
    assert none["el_rate"] == 0.0


def test_expected_loss_totals_survive_null_segments(portfolio):
    df, _ = portfolio
    tagged = df.withColumn("seg", F.when(F.col("id") % 3 != 0, F.concat(F.lit("s"), F.col("id") % 3)))
    rows = components.expected_loss(tagged, **PARTS, by=["seg"]).collect()
    grand = [r["total_el"] for r in rows if r["level"] == 1]
    assert len(rows) == 4 and len(grand) == 1
    assert grand[0] == pytest.approx(sum(r["total_el"] for r in rows if r["level"] == 0))


def test_retail_capital_formula(portfolio):
    df, rows = portfolio
    q, total = N.inv_cdf(0.999), 0.0
    for p, e, l in rows:
        r = 0.03 + 0.13 * math.exp(-35 * p)
        total += e * l * (N.cdf((N.inv_cdf(p) + math.sqrt(r) * q) / math.sqrt(1 - r)) - p)
    row = capital.regulatory_capital(df, **PARTS).first()
    assert row["unexpected_loss"] == pytest.approx(total, rel=1e-10)
    assert row["capital_requirement"] == pytest.approx(0.08 * row["total_rwa"])


def test_certain_pds_need_no_economic_capital(spark):
    df = loans(spark, [(0.0, 100.0, 1.0), (1.0, 100.0, 1.0), (1e-7, 100.0, 1.0), (0.5, 100.0, None)])
    row = capital.economic_capital(df, **PARTS).first()
    q = N.inv_cdf(0.999)
    small = 100 * (N.cdf((N.inv_cdf(1e-7) + math.sqrt(0.15) * q) / math.sqrt(0.85)) - 1e-7)
    assert row["economic_capital"] == pytest.approx(small, rel=1e-6)
    assert row["worst_case_loss"] - row["expected_loss"] == row["economic_capital"]
    retail = capital.with_retail_capital(df, **PARTS).collect()
    assert retail[0]["capital"] > 0 and retail[3]["capital"] is None


def test_stress_is_ordered_and_bounded(portfolio):
    df, rows = portfolio
    found = {r["scenario"]: r for r in capital.stress_pd(df, pd="pd", scenarios={"mild": 1.5, "severe": 3.0, "max": 99.0}).collect()}
    assert found["mild"]["portfolio_pd"] < found["severe"]["portfolio_pd"] < found["max"]["portfolio_pd"] == pytest.approx(1.0)
    assert found["mild"]["pd_increase"] == pytest.approx(0.5 * np.mean([p for p, _, _ in rows]))
    assert capital.with_stressed_pd(df, pd="pd", scenarios={"a": 1.0, "b": 2.0}).count() == 600


def test_portfolio_pd_methods(portfolio):
    df, rows = portfolio
    values = {m: capital.portfolio_pd(df, pd="pd", method=m).first()[0] for m in ("average", "weighted", "vasicek")}
    assert values["average"] == pytest.approx(np.mean([p for p, _, _ in rows])) == pytest.approx(values["weighted"])
    assert values["average"] < values["vasicek"] <= 1
    with pytest.raises(ValueError):
        capital.portfolio_pd(df, pd="pd", method="other")


def test_raroc(spark):
    df = spark.createDataFrame([(1e6, 5e6, 2e5), (1e6, 0.0, 2e5), (1e6, -1.0, 0.0)], "i double, c double, l double")
    assert [r["raroc"] for r in components.raroc(df, income="i", capital="c", loss="l").collect()] == [pytest.approx(16.0), 0.0, 0.0]


def test_lgd_and_ead(spark):
    rng = np.random.default_rng(5)
    rec = rng.beta(3, 2, 200)
    df = spark.createDataFrame([(float(r), "secured" if i % 2 else None) for i, r in enumerate(rec)], "r double, f string")
    row = components.lgd_distribution(df, recovery="r").first()
    np.testing.assert_allclose([row["p10"], row["median_lgd"], row["p90"]], np.percentile(1 - rec, [10, 50, 90]), atol=1e-12)
    assert row["std_lgd"] == pytest.approx(rec.std())
    assert components.lgd_distribution(df, recovery="r", by=["f"]).filter("f IS NULL").first()["n_observations"] == 100
    limits = spark.createDataFrame([(100.0, 40.0), (50.0, 60.0), (None, 5.0)], "c double, o double")
    assert [r["ead"] for r in components.ead_conversion(limits, committed="c", outstanding="o").collect()] == [70.0, 60.0, None]


def test_returns_var_and_shortfall(spark):
    rng = np.random.default_rng(42)
    ret = rng.normal(-0.01, 0.05, 1000)
    df = spark.createDataFrame([(float(r),) for r in ret], "r double")
    found = {c: capital.return_var_es(df, ret="r", confidence=c).first() for c in (0.90, 0.95)}
    cut = np.percentile(ret, 5)
    assert found[0.95]["value_at_risk"] == pytest.approx(-cut)
    assert found[0.95]["expected_shortfall"] == pytest.approx(-ret[ret <= cut].mean())
    assert found[0.95]["value_at_risk"] >= found[0.90]["value_at_risk"]
    parametric = capital.return_var_es(df, ret="r", method="parametric").first()["value_at_risk"]
    assert parametric == pytest.approx(-(ret.mean() + ret.std() * N.inv_cdf(0.05)))
    gains = spark.createDataFrame([(0.1,), (0.2,)], "r double")
    assert tuple(capital.return_var_es(gains, ret="r").first()) == (2, 0.0, 0.0)
    with pytest.raises(ValueError):
        capital.return_var_es(df, ret="r", method="other")


def test_simulation_against_brute_force(spark):
    rows = [(0.05, 100.0, 0.5), (0.0, 50.0, 1.0), (1.0, 7.0, 1.0), (0.4, 30.0, 0.2)]
    df, runs, seed, rho = loans(spark, rows), 50, 11, 0.1
    got = {r["sim"]: r["loss"] for r in simulation.simulate_losses(df, key="id", **PARTS, n_sims=runs, seed=seed).collect()}
    assert sorted(got) == list(range(runs))
    for sim in range(runs):
        z = N.inv_cdf(reference_uniform(sim, 0, seed + simulation.SYSTEMATIC_SEED_OFFSET))
        loss = 0.0
        for i, (p, e, l) in enumerate(rows):
            limit = p if p in (0.0, 1.0) else N.cdf((N.inv_cdf(p) - math.sqrt(rho) * z) / math.sqrt(1 - rho))
            loss += e * l * (reference_uniform(i, sim, seed) < limit)
        assert got[sim] == pytest.approx(loss)


def test_simulation_does_not_depend_on_partitions(portfolio):
    df, rows = portfolio

    def run(parts, tasks):
        losses = simulation.simulate_losses(df.repartition(parts), key="id", **PARTS, n_sims=200, tasks=tasks)
        return [round(r["loss"], 4) for r in losses.orderBy("sim").collect()]

    base = run(1, 1)
    assert base == run(7, 5)
    assert np.mean(base) == pytest.approx(sum(p * e * l for p, e, l in rows), rel=0.2)


def test_loss_measures(spark, portfolio):
    rng = np.random.default_rng(9)
    losses = rng.lognormal(3, 1, 1000)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(losses)], "sim bigint, loss double")
    row = simulation.loss_var_es(df).first()
    var = np.percentile(losses, 99.9)
    assert row["credit_var"] == pytest.approx(var)
    assert row["expected_shortfall"] == pytest.approx(losses[losses >= var].mean())
    assert row["var_95"] <= row["var_99"] <= row["credit_var"] <= row["expected_shortfall"]
    density, edges = np.histogram(losses, bins=50, density=True)
    bars = simulation.loss_histogram(df).orderBy("bin").collect()
    np.testing.assert_allclose([b["density"] for b in bars], density, rtol=1e-9)
    empty = simulation.simulate_losses(portfolio[0].limit(0), key="id", **PARTS, n_sims=5)
    assert [r["loss"] for r in empty.collect()] == [0.0] * 5
    with pytest.raises(ValueError):
        simulation.economic_capital_by_method(portfolio[0], method="other", key="id", **PARTS)


def test_diversification(spark):
    rows = [("a", s, float(s % 10)) for s in range(100)] + [("b", s, float((s + 5) % 10)) for s in range(100)]
    df = spark.createDataFrame(rows, "unit string, sim int, loss double")
    ratio = capital.diversification_ratio(df, unit="unit", run="sim", loss="loss").first()["diversification_ratio"]
    assert 0 < ratio < 1
    zero = capital.diversification_ratio(df.withColumn("loss", F.lit(0.0)), unit="unit", run="sim", loss="loss").first()
    assert zero["diversification_ratio"] == 0.0


def test_concentration(spark):
    values = [float(v) for v in (5, 1, 1, 9, 3, 3, 3)]
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, e double")
    top = {r["label"]: r["exposure"] for r in concentration.concentration_topn(df, exposure="e", key="id", n=2).collect()}
    assert top == {"3": 9.0, "0": 5.0, "Others": 11.0}
    row = concentration.concentration_indices(df, exposure="e").first()
    shares = np.array(values) / sum(values)
    assert row["hhi"] == pytest.approx((shares**2).sum()) and row["top_1_concentration"] == pytest.approx(9 / 25)
    assert row["top_10_concentration"] == pytest.approx(1.0)
    points = concentration.lorenz_curve(df, exposure="e").orderBy("exposure").collect()
    assert [round(p["share_of_loans"] * 7) for p in points] == [2, 5, 6, 7] and points[-1]["share_of_exposure"] == pytest.approx(1.0)
    assert concentration.concentration_topn(df, exposure="e", key="id", n=7).count() == 7


def test_stage_rules(spark):
    rows = [
        (0.1, 0.1, 0, 1), (0.2, 0.1, 0, 1), (0.2001, 0.15, 0, 2), (0.05, 0.02, 0, 2), (0.99, 0.9, 0, 3), (0.1, 0.1, 30, 1),
        (0.1, 0.1, 31, 2), (0.1, 0.1, 90, 2), (0.1, 0.1, 91, 3), (0.1, 0.1, None, 1), (None, 0.1, 0, 1), (None, None, 95, 3),
        (0.05, None, 0, 1), (0.3, None, None, 2),
    ]
    df = spark.createDataFrame(rows, "pd double, orig double, dpd int, expected int")
    for row in impairment.with_stage(df, pd="pd", original_pd="orig", dpd="dpd").collect():
        assert row["stage"] == row["expected"], row
    assert impairment.with_stage(df, pd="pd", original_pd="orig").filter("stage = 3").count() == 1


def test_ecl_by_stage_keeps_empty_stages(spark):
    df = spark.createDataFrame([(100, 0.1, 0.1, 0.5, 3, 0), (200, 0.3, 0.1, 0.5, 2, 0)],
                               "ead int, pd double, orig double, lgd double, t int, dpd int")
    out = impairment.with_ecl(df, exposure="ead", pd="pd", original_pd="orig", lgd="lgd", term_years="t", dpd="dpd")
    rows = {r["stage"]: (r["loans"], r["ecl"]) for r in impairment.ecl_by_stage(out).collect()}
    assert rows[1] == (1, pytest.approx(5.0)) and rows[2] == (1, pytest.approx(200 * 0.51 * 0.5)) and rows[3] == (0, 0.0)
    assert rows[0] == (2, pytest.approx(5.0 + 51.0))


def test_macro_weighted_pd_is_bounded_per_scenario(spark):
    df = spark.createDataFrame([(0.1,), (0.9,), (None,)], "pd double")
    weighted = impairment.macro_weighted_pd(F.col("pd"), {"base": 1.0, "down": 1.5, "unweighted": 9.0}, {"base": 0.6, "down": 0.2})
    assert [r[0] for r in df.select(weighted).collect()] == [pytest.approx(0.09), pytest.approx(0.74), None]


def test_a_repeated_snapshot_replaces_all_of_the_first(spark, tmp_path):
    from lossgrid.sources.sinks import write_results

    path = str(tmp_path / "ecl")
    rows = spark.createDataFrame([(1, 1), (2, 3)], "id int, stage int")
    write_results(rows, path, as_of="2024-01-31", partition_by=["stage"])
    write_results(rows, path, as_of="2024-02-29", partition_by=["stage"])
    write_results(rows.filter("stage = 1"), path, as_of="2024-01-31", partition_by=["stage"])
    back = spark.read.parquet(path)
    assert back.filter("as_of = date'2024-01-31'").count() == 1 and back.count() == 3


def test_nan_pd_stays_in_stage_1(spark):
    from lossgrid.operators import impairment

    df = spark.createDataFrame([(float("nan"), 0.1), (0.5, float("nan")), (0.995, 0.1), (None, None)], "pd double, pd0 double")
    found = impairment.with_stage(df, pd="pd", original_pd="pd0").collect()
    assert [r["stage"] for r in found] == [1, 2, 3, 1]
