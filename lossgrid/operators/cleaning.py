"""Cleaning of accepted-loan tables. Each step applies only to the columns that are present."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossgrid.functions.numeric import clip, least_or_null, melt, nan_to_null, numeric_columns
from lossgrid.operators import features
from lossgrid.operators.ordered import approx_quantiles, cheap_to_read_twice, column_quantiles

# Columns without predictive content, columns known only after the outcome, pricing columns.
USELESS_COLUMNS = ("id", "member_id", "url", "desc", "title", "zip_code", "emp_title", "policy_code")
LEAKAGE_COLUMNS = (
    "out_prncp", "out_prncp_inv", "total_pymnt", "total_pymnt_inv",
    "total_rec_prncp", "total_rec_int", "total_rec_late_fee",
    "recoveries", "collection_recovery_fee",
    "last_pymnt_d", "last_pymnt_amnt", "next_pymnt_d",
    "hardship_flag", "hardship_type", "hardship_reason", "hardship_status",
    "hardship_amount", "hardship_start_date", "hardship_end_date",
    "payment_plan_start_date", "hardship_length", "hardship_dpd",
    "hardship_loan_status", "orig_projected_additional_accrued_interest",
    "hardship_payoff_balance_amount", "hardship_last_payment_amount",
    "debt_settlement_flag", "debt_settlement_flag_date", "settlement_status",
    "settlement_date", "settlement_amount", "settlement_percentage", "settlement_term",
    "last_credit_pull_d",
)
PRICING_COLUMNS = ("int_rate", "grade", "sub_grade")
LEAKY_EXTRAS = ("last_fico_range_high", "last_fico_range_low", "last_pymnt_amnt", "total_pymnt")
MONTH_COLUMNS = ("issue_d", "earliest_cr_line", "last_pymnt_d")
CAPPED_COLUMNS = ("annual_inc", "revol_bal", "dti")
FLAG_AND_FILL_COLUMNS = ("mths_since_last_delinq", "mths_since_last_record", "mths_since_last_major_derog")
FLAG_ONLY_COLUMNS = ("revol_util", "dti", "annual_inc")
# Final loan statuses; every other status has no known outcome.
GOOD_STATUSES = ("Fully Paid",)
BAD_STATUSES = ("Charged Off", "Default", "Does not meet the credit policy. Status:Charged Off")


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def dedup_loans(
    df: DataFrame, *, keys: Sequence[str] | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """One row per key (those of id, member_id that exist; else whole rows), the first in ``order_by``.

    The row kept is the minimum of (order_by, whole row): deterministic, and an aggregate that shrinks
    map-side, so one key (or the NULL key) holding a large part of the table does not land in one task.
    """
    keys = list(keys) if keys is not None else _present(df, ("id", "member_id"))
    if not keys:
        return df.distinct()
    rest = [c for c in df.columns if c not in keys]
    rank = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)]
    first = df.groupBy(*keys).agg(F.min(F.struct(*rank, *rest, F.lit(0).alias("_pad"))).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def drop_columns(df: DataFrame, *, include_pricing: bool = False) -> DataFrame:
    """Remove useless, leaking and (unless asked to keep them) pricing columns; prunes the scan."""
    names = USELESS_COLUMNS + LEAKAGE_COLUMNS + (() if include_pricing else PRICING_COLUMNS)
    return df.drop(*names)


def drop_leaky_extras(df: DataFrame) -> DataFrame:
    """Remove the outcome columns that ``drop_columns`` leaves in."""
    return df.drop(*LEAKY_EXTRAS)


def parse_percent(df: DataFrame, *, col: str = "revol_util") -> DataFrame:
    """'45.3%' to 0.453; text that is no number becomes NULL."""
    if col not in df.columns:
        return df
    text = F.trim(F.replace(F.col(col).cast("string"), F.lit("%"), F.lit("")))
    return df.withColumn(col, text.try_cast("double") / 100.0)


def parse_month(df: DataFrame, *, cols: Sequence[str] = MONTH_COLUMNS) -> DataFrame:
    """'Dec-2015' to the first of that month; bad text becomes NULL. Dates and timestamps pass through."""
    parsed = {}
    for c in _present(df, cols):
        if isinstance(df.schema[c].dataType, T.StringType):
            parsed[c] = F.try_to_timestamp(F.col(c), F.lit("MMM-yyyy")).cast("date")
    return df.withColumns(parsed) if parsed else df


def cap_funded_at_requested(df: DataFrame, *, funded: str = "funded_amnt", requested: str = "loan_amnt") -> DataFrame:
    """Funded amount at most the requested amount; NULL if either is missing."""
    if not {funded, requested} <= set(df.columns):
        return df
    return df.withColumn(funded, least_or_null(F.col(funded), F.col(requested)))


def negatives_to_null(df: DataFrame, *, cols: Sequence[str] | None = None) -> DataFrame:
    """Negative values of numeric columns become NULL, all in one projection."""
    names = list(cols) if cols is not None else numeric_columns(df)
    return df.withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in names}) if names else df


def filter_income_dti(df: DataFrame, *, income: str = "annual_inc", dti: str = "dti", max_dti: float = 999) -> DataFrame:
    """Keep rows whose income is missing or positive and whose debt ratio is missing or plausible."""
    if income in df.columns:
        df = df.filter(F.col(income).isNull() | (F.col(income) > 0))
    if dti in df.columns:
        df = df.filter(F.col(dti).isNull() | (F.col(dti) <= max_dti))
    return df


def cap_outliers(
    df: DataFrame,
    *,
    cols: Sequence[str] | None = None,
    lower_q: float = 0.01,
    upper_q: float = 0.99,
    exact: bool = True,
) -> DataFrame:
    """Winsorise numeric columns at their quantiles.

    All columns share one quantile job; the bounds are two numbers per column, so the table itself is neither shuffled
    nor joined. What lies behind a shuffle is written once, for the quantiles and for the result. ``exact=False`` uses a one-pass
    sketch, whose bounds come back as a scalar subquery.
    """
    numeric = set(numeric_columns(df))
    names = [c for c in (_present(df, CAPPED_COLUMNS) if cols is None else cols) if c in numeric]
    if not names:
        return df
    probs = [lower_q, upper_q]
    if exact:
        df = cheap_to_read_twice(df, "cleaned")
        limits = {r["feature"]: r["quantiles"] for r in column_quantiles(df, names, probs).collect()}
        return df.withColumns({c: clip(F.col(c), *[F.lit(q).cast("double") for q in limits.get(c, (None, None))]) for c in names})
    bounds = approx_quantiles(melt(df, names), "value", probs, ["feature"])
    row = bounds.agg(F.map_from_entries(F.collect_list(F.struct("feature", "quantiles"))).alias("b")).scalar()
    capped = {}
    for c in names:
        pair = F.try_element_at(F.col("_bounds"), F.lit(c))
        capped[c] = clip(F.col(c), F.get(pair, F.lit(0)), F.get(pair, F.lit(1)))
    return df.withColumn("_bounds", row).withColumns(capped).drop("_bounds")


def missing_flags_fill0(df: DataFrame, *, cols: Sequence[str] = FLAG_AND_FILL_COLUMNS) -> DataFrame:
    """Add <c>_missing (0/1) and replace NULL by 0: never having had the event is not a missing value."""
    names = _present(df, cols)
    flagged = df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in names}) if names else df
    return flagged.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in names}) if names else df


def missing_flags_only(df: DataFrame, *, cols: Sequence[str] = FLAG_ONLY_COLUMNS) -> DataFrame:
    """Add <c>_missing (0/1), keep the NULLs."""
    names = _present(df, cols)
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in names}) if names else df


def map_default_target(df: DataFrame, *, status: str = "loan_status", target: str = "default") -> DataFrame:
    """Loan status to 0/1; loans without a final status are dropped, and so is the status column."""
    if status not in df.columns:
        return df
    mapped = F.when(F.col(status).isin(*GOOD_STATUSES), 0).when(F.col(status).isin(*BAD_STATUSES), 1)
    # The filter names the statuses so that it reaches the scan.
    return (
        df.filter(F.col(status).isin(*GOOD_STATUSES, *BAD_STATUSES)).withColumn(target, mapped).drop(status)
    )


def clean_accepted(df: DataFrame, *, include_pricing: bool = False) -> DataFrame:
    """Raw cleaning: drop columns, dedup, parse text, repair amounts, filter implausible rows.

    Columns that are dropped anyway never enter the dedup; the identifiers stay until it is done.
    """
    df = nan_to_null(df)
    left = drop_columns(df, include_pricing=include_pricing)
    df = df.select(*[c for c in df.columns if c in left.columns or c in ("id", "member_id")])
    df = drop_columns(dedup_loans(df), include_pricing=include_pricing)
    df = parse_month(parse_percent(df))
    df = negatives_to_null(cap_funded_at_requested(df))
    return filter_income_dti(df)


def prepare_loans(df: DataFrame, *, include_pricing: bool = False, exact: bool = True) -> DataFrame:
    """The whole preparation: clean, cap, flag, target, base features. One lazy plan."""
    df = clean_accepted(df, include_pricing=include_pricing)
    df = cap_outliers(df, exact=exact)
    df = missing_flags_only(missing_flags_fill0(df))
    df = map_default_target(df)
    return features.base_features(df, include_pricing=include_pricing)
