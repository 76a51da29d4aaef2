"""The whole chain as one job: prepare, select, split, train, calibrate, score, stage, write, monitor."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossgrid.functions.numeric import numeric_columns
from lossgrid.operators import (
    alerts, capital, categories, cleaning, components, discrimination, drift, encoding, features, impairment, models, selection, simulation, split,
)
from lossgrid.session import materialise
from lossgrid.sources.sinks import write_results

KEY = "loan_key"
LABEL = "default"
TERMS = "contract_terms"


def training_table(
    loans: DataFrame, *, key: str, k: int, terms: Sequence[str] = (), method: str = "mutual_info"
) -> tuple[DataFrame, list[str]]:
    """(key, label, split, k best features, terms), written to shared storage, and the feature names.

    The key, and the terms of the contract in one column, are carried under names of their own through cleaning,
    which drops identifiers and duplicates: a loan keeps the terms of the row that stays. They are no features.
    """
    carried = loans.withColumns({KEY: F.col(key), TERMS: F.struct(*terms)}) if terms else loans.withColumn(KEY, F.col(key))
    prepared = features.derived_features(cleaning.prepare_loans(carried))
    kept = [c for c, kind in prepared.dtypes if kind not in ("date", "timestamp", "timestamp_ntz")]
    prepared = materialise(prepared.select(*kept), "prepared")
    keyed = [KEY, LABEL, TERMS] if terms else [KEY, LABEL]
    numbers = numeric_columns(prepared, exclude=keyed)
    texts = [c for c, kind in prepared.dtypes if kind == "string" and c not in keyed]
    filled = encoding.impute_mode(encoding.impute_median(prepared, cols=numbers), cols=texts)
    # Categories may have any number of levels: only those among the k best become columns.
    best = selection.select_features(filled, label=LABEL, method=method, cols=numbers, cat_cols=texts, k=k).collect()
    chosen = [(r["column"], r["level"]) for r in best if r["level"] is not None]
    names = [r["column"] if r["level"] is None else categories.indicator_name(r["column"], r["level"]) for r in best]
    taken = [F.col(f"`{r['column']}`") for r in best if r["level"] is None] + categories.indicators(chosen)
    table = split.stratified_split(filled.select(*keyed, *taken), key=KEY, label=LABEL)
    # Every fit and the scoring read it with all cores; the files of a small result may be few.
    return materialise(table.repartition(loans.sparkSession.sparkContext.defaultParallelism), "training"), names


# Multipliers of the PD by scenario, and the scenarios' weights.
MACRO_SCENARIOS = {"base": 1.0, "optimistic": 0.8, "downturn": 1.5}
MACRO_WEIGHTS = {"base": 0.6, "optimistic": 0.2, "downturn": 0.2}
STRESS_SCENARIOS = {"base_case": 1.0, "mild_recession": 2.0, "severe_recession": 4.0, "financial_crisis": 6.0}


def long_rows(name: str, df: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(table, group, metric, value): one row per numeric or boolean column of a small result table."""
    kept = [f.name for f in df.schema.fields if f.name not in groups and isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("double").alias("value")) for c in kept])
    group = F.concat_ws("|", *[F.coalesce(F.col(g).cast("string"), F.lit("all")) for g in groups])
    return df.select(F.lit(name).alias("table"), group.alias("group"), F.inline(pairs))


def run_portfolio_job(
    loans: DataFrame,
    *,
    key: str,
    exposure: str,
    lgd: str,
    original_pd: str,
    term_years: str,
    path: str,
    as_of: str,
    dpd: str | None = None,
    income_rate: str | None = None,
    by: Sequence[str] = (),
    k: int = 20,
    trees: int = 200,
    n_sims: int = 1000,
) -> dict[str, DataFrame]:
    """Score the test loans, write their PD, stage and ECL as one snapshot and its alerts, and return the small
    result tables.

    ``trees`` > 0 trains boosted trees, otherwise the logistic model. The ECL uses the macro-weighted PD. The alert
    table below ``path`` holds one batch per day, which a repeated run replaces, and the report reads it. ``income_rate`` (percent of the exposure a year)
    adds the return on risk-adjusted capital.
    """
    terms = list(dict.fromkeys(c for c in (exposure, lgd, original_pd, term_years, dpd, income_rate, *by) if c))
    table, names = training_table(loans, key=key, k=k, terms=terms)

    def part(name: str) -> DataFrame:
        return table.filter(F.col("split") == name)

    if trees:
        model = models.train_gbt(part("train"), label=LABEL, num_cols=names, trees=trees)
    else:
        model = models.train_logistic(part("train"), label=LABEL, num_cols=names)
    scored = models.score_pd(model, table, keep=[KEY, LABEL, "split", TERMS, *names], out="raw_pd")
    scored = materialise(scored, "scores")
    calibration = models.fit_isotonic(scored.filter(F.col("split") == "val"), score="raw_pd", label=LABEL)
    scored = models.apply_isotonic(calibration, scored, score="raw_pd", out="pd")

    book = scored.filter(F.col("split") == "test").select(KEY, LABEL, "pd", f"{TERMS}.*")
    weighted = impairment.macro_weighted_pd(F.col("pd"), MACRO_SCENARIOS, MACRO_WEIGHTS)
    book = impairment.with_ecl(
        book.withColumn("macro_pd", weighted), exposure=exposure, pd="macro_pd", original_pd=original_pd, lgd=lgd,
        term_years=term_years, dpd=dpd,
    )
    write_results(book, f"{path}/ecl", as_of=as_of, partition_by=["stage"])
    spark = table.sparkSession
    written = spark.read.parquet(f"{path}/ecl").filter(F.col("as_of") == as_of)

    periods = scored.filter(F.col("split").isin("train", "test")).withColumn(
        "is_ref", (F.col("split") == "train").cast("int")
    )
    verdict = materialise(drift.drift_verdict(periods, score="pd", label=LABEL, is_ref="is_ref", features=names), "verdict")
    calibrated = discrimination.calibration_summary(written, score="pd", label=LABEL)
    day = F.lit(as_of).cast("timestamp_ntz")
    metrics = verdict.select(
        F.inline(F.array(
            F.struct(F.lit("psi").alias("metric"), F.col("score_psi").alias("value")),
            F.struct(F.lit("ks_statistic").alias("metric"), F.col("score_ks").alias("value")),
        ))
    ).unionByName(calibrated.select(F.lit("expected_calibration_error").alias("metric"), F.col("expected_calibration_error").alias("value")))
    raised = alerts.metric_alerts(metrics.withColumn("ts", day)).unionByName(alerts.drift_alerts(verdict, ts=day))
    alerts.write_alerts(raised, f"{path}/alerts", report_date=dt.date.fromisoformat(as_of), run="portfolio")
    history = alerts.read_alerts(spark, f"{path}/alerts")

    parts = {"pd": "pd", "ead": exposure, "lgd": lgd}
    losses = simulation.simulate_losses(written, key=KEY, **parts, n_sims=n_sims)
    economic = capital.economic_capital(written, **parts, by=by)
    results = {
        "ecl_by_stage": impairment.ecl_by_stage(written, by=by),
        "expected_loss": components.expected_loss(written, **parts, by=by),
        "economic_capital": economic,
        "regulatory_capital": capital.regulatory_capital(written, **parts, by=by),
        "stress": capital.stress_pd(written, pd="pd", scenarios=STRESS_SCENARIOS, by=by),
        "loss_distribution": simulation.loss_var_es(losses),
        "performance": discrimination.performance_report(written, score="pd", label=LABEL),
        "calibration": calibrated,
        "feature_drift": drift.feature_drift(periods, features=names, is_ref="is_ref"),
        "drift": verdict,
        "report": alerts.monitoring_report(history, model_name="portfolio", report_date=dt.date.fromisoformat(as_of)),
    }
    if income_rate:
        income = written.groupBy(*by).agg(F.sum(F.col(exposure) * F.col(income_rate) / 100.0).alias("income"))
        both = income.join(economic, list(by)) if by else income.join(F.broadcast(economic))  # one row each
        results["raroc"] = components.raroc(both, income="income", capital="economic_capital", loss="expected_loss")
    return results


def all_rows(results: dict[str, DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """Every result table in one long table."""
    groups = {"ecl_by_stage": [*by, "stage"], "stress": [*by, "scenario"], "feature_drift": ["feature"], "report": ["model_name"]}
    found = None
    for name, df in results.items():
        rows = long_rows(name, df, groups.get(name, [c for c in by if c in df.columns]))
        found = rows if found is None else found.unionByName(rows)
    return found
