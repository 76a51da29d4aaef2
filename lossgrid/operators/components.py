"""PD, LGD and EAD components, expected loss, return on risk-adjusted capital, component validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.operators.ordered import exact_quantiles

DEFAULT_LGD = 0.45
DEFAULT_CCF = 0.5
LGD_PROBS = {"p10": 0.10, "p25": 0.25, "median_lgd": 0.50, "p75": 0.75, "p90": 0.90}


def amount(value: str | float) -> Column:
    """A column by name, or a constant for every loan."""
    return F.col(value) if isinstance(value, str) else F.lit(float(value))


def pd_summary(df: DataFrame, *, pd: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean and population deviation of the PDs."""
    return df.groupBy(*by).agg(
        F.count(pd).alias("n_scores"), F.avg(pd).alias("mean_pd"), F.stddev_pop(pd).alias("std_pd")
    )


def lgd_summary(df: DataFrame, *, recovery: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean and population deviation of LGD = 1 - recovery."""
    return df.groupBy(*by).agg(
        F.count(recovery).alias("n_observations"),
        (F.lit(1.0) - F.avg(recovery)).alias("mean_lgd"),
        F.stddev_pop(recovery).alias("std_lgd"),
    )


def lgd_distribution(df: DataFrame, *, recovery: str, by: Sequence[str] = ()) -> DataFrame:
    """Moments, extremes and exact percentiles of LGD, per facility type if ``by`` names it."""
    losses = df.select(*by, (F.lit(1.0) - F.col(recovery)).alias("_lgd"))
    moments = losses.groupBy(*by).agg(
        F.count("_lgd").alias("n_observations"),
        F.avg("_lgd").alias("mean_lgd"),
        F.stddev_pop("_lgd").alias("std_lgd"),
        F.min("_lgd").alias("min_lgd"),
        F.max("_lgd").alias("max_lgd"),
    )
    ranks = exact_quantiles(losses, "_lgd", list(LGD_PROBS.values()), by)
    names = [F.get("q", F.lit(i)).alias(name) for i, name in enumerate(LGD_PROBS)]
    stats = ("n_observations", "mean_lgd", "std_lgd", "min_lgd", "max_lgd")
    if not by:
        return moments.withColumn("q", ranks.select("quantiles").scalar()).select(*stats, *names)
    group = F.struct(*by).alias("_group")
    joined = moments.withColumn("_group", group).join(
        ranks.select(group, F.col("quantiles").alias("q")), "_group", "left"
    )
    return joined.select(*by, *stats, *names)


def ead_conversion(
    df: DataFrame, *, committed: str, outstanding: str, ccf: str | float = DEFAULT_CCF, out: str = "ead"
) -> DataFrame:
    """Loan-level EAD = outstanding + CCF * undrawn, with the CCF and utilisation columns."""
    c, o = F.col(committed), F.col(outstanding)
    undrawn = F.when(c.isNotNull() & o.isNotNull(), F.greatest(c - o, F.lit(0.0)))
    return df.withColumns(
        {out: o + amount(ccf) * undrawn, "ccf": amount(ccf), "utilization": F.try_divide(o, c)}
    )


def ead_summary(
    df: DataFrame, *, committed: str, outstanding: str, ccf: str | float = DEFAULT_CCF, by: Sequence[str] = ()
) -> DataFrame:
    """Mean CCF, total EAD and utilisation statistics."""
    loans = ead_conversion(df, committed=committed, outstanding=outstanding, ccf=ccf, out="_ead")
    return loans.groupBy(*by).agg(
        F.avg("ccf").alias("mean_ccf"),
        F.sum("_ead").alias("total_ead"),
        F.avg("utilization").alias("mean_utilization"),
        F.stddev_pop("utilization").alias("std_utilization"),
        F.min("utilization").alias("min_utilization"),
        F.max("utilization").alias("max_utilization"),
    )


def with_expected_loss(
    df: DataFrame, *, pd: str, ead: str, lgd: str | float = DEFAULT_LGD, out: str = "el"
) -> DataFrame:
    """Loan-level EL = PD * LGD * EAD."""
    return df.withColumn(out, F.col(pd) * amount(lgd) * F.col(ead))


def expected_loss(
    df: DataFrame, *, pd: str, ead: str, lgd: str | float = DEFAULT_LGD, by: Sequence[str] = ()
) -> DataFrame:
    """Total EL, exposure and EL rate (0 without exposure); with ``by``, also the grand total (NULL keys)."""
    loans = with_expected_loss(df, pd=pd, ead=ead, lgd=lgd, out="_el")
    grouped = loans.rollup(*by) if by else loans.groupBy()
    level = [F.grouping_id().alias("level")] if by else []
    sums = grouped.agg(
        *level,
        F.coalesce(F.sum("_el"), F.lit(0.0)).alias("total_el"),
        F.coalesce(F.sum(ead), F.lit(0.0)).alias("total_exposure"),
        F.avg(pd).alias("mean_pd"),
    )
    rate = F.when(F.col("total_exposure") > 0, F.col("total_el") / F.col("total_exposure")).otherwise(F.lit(0.0))
    return sums.withColumn("el_rate", rate)


def raroc(df: DataFrame, *, income: str, capital: str, loss: str) -> DataFrame:
    """Add RAROC in percent to rows of income, capital and expected loss; 0 without positive capital."""
    value = (F.col(income) - F.col(loss)) / F.col(capital) * 100.0
    return df.withColumn("raroc", F.when(F.col(capital) > 0, value).otherwise(F.lit(0.0)))


def component_validation(
    df: DataFrame, *, pd: str, defaulted: str, lgd: str, realised_lgd: str, by: Sequence[str] = ()
) -> DataFrame:
    """Mean absolute and root mean squared error of PD against defaults and LGD against realised LGD."""

    def errors(name: str, estimate: str, actual: str) -> list[Column]:
        gap = F.col(estimate) - F.col(actual)
        return [F.avg(F.abs(gap)).alias(f"{name}_mae"), F.sqrt(F.avg(gap * gap)).alias(f"{name}_rmse")]

    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sample_size"), *errors("pd", pd, defaulted), *errors("lgd", lgd, realised_lgd)
    )
