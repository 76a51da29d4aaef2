"""Impairment staging and expected credit loss."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.functions.numeric import clip
from lossgrid.operators.components import amount

# Fixed values of the staging rules.
SICR_THRESHOLD = 2.0
PD_OFFSET = 1e-6
PD_STAGE_2 = 0.20
PD_STAGE_3 = 0.99
DPD_STAGE_2 = 30
DPD_STAGE_3 = 90
STAGES = (1, 2, 3)


def stage_of(
    pd: Column, original_pd: Column, dpd: Column | None = None, sicr_threshold: float = SICR_THRESHOLD
) -> Column:
    """Stage 1, 2 or 3. Stage-3 rules win; a comparison with a missing value (NULL or NaN) does not hold."""
    pd, original_pd = (F.when(~F.isnan(x), x) for x in (pd, original_pd))
    impaired = pd >= PD_STAGE_3
    raised = (pd / (original_pd + PD_OFFSET) > sicr_threshold) | (pd > PD_STAGE_2)
    if dpd is not None:
        impaired = impaired | (dpd > DPD_STAGE_3)
        raised = raised | (dpd > DPD_STAGE_2)
    return F.when(impaired, 3).when(raised, 2).otherwise(1)


def with_stage(
    df: DataFrame,
    *,
    pd: str,
    original_pd: str,
    dpd: str | None = None,
    sicr_threshold: float = SICR_THRESHOLD,
    out: str = "stage",
) -> DataFrame:
    days = F.col(dpd) if dpd else None
    return df.withColumn(out, stage_of(F.col(pd), F.col(original_pd), days, sicr_threshold))


def lifetime_pd(pd: Column, years: Column) -> Column:
    """1 - (1 - PD)^years."""
    return F.lit(1.0) - F.pow(F.lit(1.0) - pd, years)


def macro_weighted_pd(pd: Column, scenarios: Mapping[str, float], weights: Mapping[str, float]) -> Column:
    """Weighted sum of scenario PDs, each bounded to [0, 1]; a scenario without weight counts 0."""
    parts = [clip(pd * float(m), 0.0, 1.0) * float(weights.get(s, 0.0)) for s, m in scenarios.items()]
    return reduce(lambda a, b: a + b, parts, F.lit(0.0))


def with_ecl(
    df: DataFrame,
    *,
    exposure: str,
    pd: str,
    original_pd: str,
    lgd: str | float,
    term_years: str,
    dpd: str | None = None,
    sicr_threshold: float = SICR_THRESHOLD,
) -> DataFrame:
    """Add stage, lifetime PD and ECL: 12-month loss in stage 1, lifetime loss in stages 2 and 3."""
    staged = with_stage(df, pd=pd, original_pd=original_pd, dpd=dpd, sicr_threshold=sicr_threshold)
    staged = staged.withColumn("pd_lifetime", lifetime_pd(F.col(pd), F.col(term_years)))
    used = F.when(F.col("stage") == 1, F.col(pd)).otherwise(F.col("pd_lifetime"))
    return staged.withColumn("ecl", F.col(exposure).cast("double") * used * amount(lgd))


def ecl_by_stage(staged: DataFrame, *, stage: str = "stage", ecl: str = "ecl", by: Sequence[str] = ()) -> DataFrame:
    """Loans and ECL per stage, empty stages included, plus the total as stage 0.

    One aggregate column per stage: the shuffle carries one row per task (and group), whatever share of the
    loans a stage holds.
    """
    aggregates = [F.count(stage).alias("_n0"), F.coalesce(F.sum(ecl), F.lit(0.0)).alias("_e0")]
    for s in STAGES:
        here = F.col(stage) == s
        aggregates.append(F.count_if(here).alias(f"_n{s}"))
        aggregates.append(F.coalesce(F.sum(F.when(here, F.col(ecl))), F.lit(0.0)).alias(f"_e{s}"))
    rows = F.array(
        *[
            F.struct(F.lit(s).alias("stage"), F.col(f"_n{s}").alias("loans"), F.col(f"_e{s}").alias("ecl"))
            for s in (*STAGES, 0)
        ]
    )
    return staged.groupBy(*by).agg(*aggregates).select(*by, F.inline(rows))
