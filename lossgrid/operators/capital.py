"""One-factor capital, stressed PDs, portfolio PD, risk-weighted assets, diversification, return VaR."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.functions.normal import normal_quantile_of, with_normal_cdf, with_normal_quantile
from lossgrid.functions.numeric import clip
from lossgrid.operators.components import DEFAULT_LGD, amount
from lossgrid.operators.ordered import running_totals

DEFAULT_CONFIDENCE = 0.999
PD_FLOOR = 1e-6
ECONOMIC_CORRELATION = 0.15
RWA_FACTOR = 12.5


def with_conditional_pd(df: DataFrame, *, out: str, pd: str, correlation: Column, confidence: float) -> DataFrame:
    """Add Φ((Φ⁻¹(pd) + √R·q) / √(1−R)), the PD in the systematic bad case."""
    df = with_normal_quantile(df, "_cp_z", pd).withColumn("_cp_r", correlation)
    shifted = F.col("_cp_z") + F.sqrt("_cp_r") * F.lit(normal_quantile_of(confidence))
    df = df.withColumn("_cp_x", shifted / F.sqrt(F.lit(1.0) - F.col("_cp_r")))
    return with_normal_cdf(df, out, "_cp_x").drop("_cp_z", "_cp_r", "_cp_x")


def with_retail_capital(
    df: DataFrame,
    *,
    pd: str,
    ead: str,
    lgd: str | float = DEFAULT_LGD,
    confidence: float = DEFAULT_CONFIDENCE,
    out: str = "capital",
) -> DataFrame:
    """Loan-level regulatory retail capital: PD kept off 0 and 1, correlation falling with PD."""
    df = df.withColumn("_rc_pd", clip(F.col(pd), PD_FLOOR, 1.0 - PD_FLOOR))
    correlation = F.lit(0.03) + F.lit(0.13) * F.exp(F.lit(-35.0) * F.col("_rc_pd"))
    df = with_conditional_pd(df, out="_rc_cond", pd="_rc_pd", correlation=correlation, confidence=confidence)
    value = F.col(ead) * amount(lgd) * (F.col("_rc_cond") - F.col("_rc_pd"))
    return df.withColumn(out, value).drop("_rc_pd", "_rc_cond")


def regulatory_capital(
    df: DataFrame,
    *,
    pd: str,
    ead: str,
    lgd: str | float = DEFAULT_LGD,
    confidence: float = DEFAULT_CONFIDENCE,
    by: Sequence[str] = (),
) -> DataFrame:
    """Unexpected loss, risk-weighted assets (12.5 times) and the 8 % requirement, per group."""
    loans = with_retail_capital(df, pd=pd, ead=ead, lgd=lgd, confidence=confidence, out="_k")
    sums = loans.groupBy(*by).agg(F.coalesce(F.sum("_k"), F.lit(0.0)).alias("unexpected_loss"))
    return sums.withColumn("total_rwa", F.col("unexpected_loss") * RWA_FACTOR).withColumn(
        "capital_requirement", F.col("total_rwa") * 0.08
    )


def vasicek_capital_retail(
    df: DataFrame,
    *,
    pd: str,
    ead: str,
    lgd: str | float = DEFAULT_LGD,
    confidence: float = DEFAULT_CONFIDENCE,
    by: Sequence[str] = (),
) -> DataFrame:
    """Portfolio VaR over expected loss: the summed retail capital per group."""
    capital = regulatory_capital(df, pd=pd, ead=ead, lgd=lgd, confidence=confidence, by=by)
    return capital.select(*by, F.col("unexpected_loss").alias("portfolio_var"))


def economic_capital(
    df: DataFrame,
    *,
    pd: str,
    ead: str,
    lgd: str | float = DEFAULT_LGD,
    confidence: float = DEFAULT_CONFIDENCE,
    correlation: float = ECONOMIC_CORRELATION,
    by: Sequence[str] = (),
) -> DataFrame:
    """Worst-case loss, expected loss and their difference at one fixed correlation.

    A PD of exactly 0 or 1 (a calibrated PD can be) is certain and needs no capital.
    """
    df = with_conditional_pd(df, out="_ec_cond", pd=pd, correlation=F.lit(correlation), confidence=confidence)
    severity = F.col(ead) * amount(lgd)
    sums = df.groupBy(*by).agg(
        F.coalesce(F.sum(severity * F.col("_ec_cond")), F.lit(0.0)).alias("worst_case_loss"),
        F.coalesce(F.sum(severity * F.col(pd)), F.lit(0.0)).alias("expected_loss"),
    )
    return sums.withColumns(
        {
            "economic_capital": F.col("worst_case_loss") - F.col("expected_loss"),
            "confidence_level": F.lit(confidence),
        }
    )


def _scenario_rows(scenarios: Mapping[str, float]) -> Column:
    """Scenario table as a literal array: exploding it multiplies rows in place, without a join."""
    return F.array(*[F.struct(F.lit(s).alias("scenario"), F.lit(float(m)).alias("multiplier")) for s, m in scenarios.items()])


def with_stressed_pd(df: DataFrame, *, pd: str, scenarios: Mapping[str, float], out: str = "stressed_pd") -> DataFrame:
    """One row per (loan, scenario) with the stressed PD, bounded to [0, 1]."""
    wide = df.select("*", F.inline(_scenario_rows(scenarios)))
    return wide.withColumn(out, clip(F.col(pd) * F.col("multiplier"), 0.0, 1.0))


def stress_pd(
    df: DataFrame, *, pd: str, scenarios: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Mean stressed PD per scenario and its increase over the base mean.

    One aggregate column per scenario in a single scan; the few result rows are turned long afterwards.
    """
    names = list(scenarios)
    sums = df.groupBy(*by).agg(
        F.avg(pd).alias("_base"),
        *[F.avg(clip(F.col(pd) * F.lit(float(scenarios[s])), 0.0, 1.0)).alias(f"_s{i}") for i, s in enumerate(names)],
    )
    rows = F.array(*[F.struct(F.lit(s).alias("scenario"), F.col(f"_s{i}").alias("portfolio_pd"))
                     for i, s in enumerate(names)])
    return sums.select(*by, "_base", F.inline(rows)).select(
        *by, "scenario", "portfolio_pd", (F.col("portfolio_pd") - F.col("_base")).alias("pd_increase")
    )


def portfolio_pd(
    df: DataFrame,
    *,
    pd: str,
    method: str = "average",
    weight: str | None = None,
    confidence: float = DEFAULT_CONFIDENCE,
    correlation: float = ECONOMIC_CORRELATION,
    by: Sequence[str] = (),
) -> DataFrame:
    """One PD per portfolio: plain mean, weighted mean, or mean PD in the systematic bad case."""
    if method == "average":
        value = F.avg(pd)
    elif method == "weighted":
        w = F.col(weight) if weight else F.lit(1.0)
        value = F.try_divide(F.sum(w * F.col(pd)), F.sum(F.when(F.col(pd).isNotNull(), w)))
    elif method == "vasicek":
        df = with_conditional_pd(df, out="_pp", pd=pd, correlation=F.lit(correlation), confidence=confidence)
        value = F.avg("_pp")
    else:
        raise ValueError(f"unknown portfolio PD method: {method}")
    return df.groupBy(*by).agg(value.alias("portfolio_pd"))


def diversification_ratio(
    losses: DataFrame, *, unit: str, run: str, loss: str, confidence: float = DEFAULT_CONFIDENCE
) -> DataFrame:
    """1 - portfolio VaR / sum of the units' stand-alone VaRs, in [0, 1]; 0 if the portfolio VaR is 0.

    Input rows are (unit, run, loss) of a simulated loss distribution; a percentile state holds at most one
    value per run.
    """
    alone = losses.groupBy(unit).agg(F.percentile(loss, confidence).alias("var")).agg(F.sum("var")).scalar()
    whole = losses.groupBy(run).agg(F.sum(loss).alias("_l")).agg(F.percentile("_l", confidence).alias("portfolio_var"))
    both = whole.withColumn("sum_of_vars", alone)
    ratio = clip(F.lit(1.0) - F.try_divide("portfolio_var", "sum_of_vars"), 0.0, 1.0)
    return both.withColumn("diversification_ratio", F.when(F.col("portfolio_var") == 0, 0.0).otherwise(ratio))


def return_var_es(
    df: DataFrame, *, ret: str, confidence: float = 0.95, method: str = "historical", by: Sequence[str] = ()
) -> DataFrame:
    """Value at risk of returns (historical or parametric) and the historical expected shortfall.

    Rank, quantile and tail mean all come from the running counts of distinct returns, so the returns are
    not joined back with their quantile.
    """
    if method not in ("historical", "parametric"):
        raise ValueError(f"unknown VaR method: {method}")
    group = F.struct(*by, F.lit(0).alias("_pad")).alias("_group")
    returns = df.select(group, F.col(ret).cast("double").alias("_r"))
    totals = running_totals(returns, "_r", {"_n": F.lit(1)}, ["_group"])
    before, upto, r = F.col("_n_upto") - F.col("_n"), F.col("_n_upto"), F.col("_r")
    at = F.lit(1.0 - confidence) * (F.col("_n_total") - 1)
    low = F.floor(at)
    high = F.least(low + 1, F.col("_n_total") - 1)
    tail = (before <= low) & (r <= 0)  # the returns at or below the quantile, and no gains
    found = totals.groupBy("_group").agg(
        F.max("_n_total").alias("n"),
        F.max(at - low).alias("_part"),
        F.max(F.when((before <= low) & (low < upto), r)).alias("_low"),
        F.max(F.when((before <= high) & (high < upto), r)).alias("_high"),
        F.try_divide(F.sum(F.when(tail, r * F.col("_n"))), F.sum(F.when(tail, F.col("_n")))).alias("_tail"),
    )
    zero = F.lit(0.0)
    value = historical = F.greatest(-(F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")), zero)
    if method == "parametric":
        moments = returns.groupBy("_group").agg(F.avg("_r").alias("_mean"), F.stddev_pop("_r").alias("_std"))
        found = found.join(moments, "_group", "left")
        value = F.greatest(-(F.col("_mean") + F.col("_std") * normal_quantile_of(1.0 - confidence)), zero)
    return found.select(
        *[F.col("_group").getField(k).alias(k) for k in by],
        "n",
        value.alias("value_at_risk"),
        F.greatest(F.coalesce(-F.col("_tail"), zero), historical).alias("expected_shortfall"),
    )
