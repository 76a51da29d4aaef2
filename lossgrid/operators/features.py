"""Derived loan features. All are projections; a feature is added only if its inputs are present."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper edges (inclusive) and names of the score bands; the lowest band starts above 0.
FICO_BANDS = ((580, "Poor"), (670, "Fair"), (740, "Good"), (800, "Very Good"), (850, "Exceptional"))
DAYS_PER_MONTH = 30.44


def _has(df: DataFrame, *cols: str) -> bool:
    return set(cols) <= set(df.columns)


def fico_avg(df: DataFrame) -> DataFrame:
    if not _has(df, "fico_range_low", "fico_range_high"):
        return df
    return df.withColumn("fico_avg", (F.col("fico_range_low") + F.col("fico_range_high")) / 2.0)


def credit_history_months(df: DataFrame, *, issued: str = "issue_d", opened: str = "earliest_cr_line") -> DataFrame:
    if not _has(df, issued, opened):
        return df
    return df.withColumn("credit_history_len_months", F.datediff(issued, opened) / DAYS_PER_MONTH)


def payment_to_income(df: DataFrame) -> DataFrame:
    """Instalment over monthly income; NULL at zero income."""
    if not _has(df, "installment", "annual_inc"):
        return df
    return df.withColumn("pmt_to_inc", F.try_divide(F.col("installment"), F.col("annual_inc") / 12.0))


def log_income(df: DataFrame) -> DataFrame:
    return df.withColumn("log_annual_inc", F.log1p("annual_inc")) if _has(df, "annual_inc") else df


def grade_number(df: DataFrame) -> DataFrame:
    """A..G to 1..7, anything else to NULL."""
    if not _has(df, "grade"):
        return df
    known = F.col("grade").rlike("^[A-G]$")
    return df.withColumn("grade_num", F.when(known, F.ascii("grade") - F.ascii(F.lit("A")) + 1))


def base_features(df: DataFrame, *, include_pricing: bool = False) -> DataFrame:
    """Features of the preparation step."""
    df = log_income(payment_to_income(credit_history_months(fico_avg(df))))
    return grade_number(df) if include_pricing else df


def line_utilization(df: DataFrame) -> DataFrame:
    if not _has(df, "open_acc", "total_acc"):
        return df
    total = F.when(F.col("total_acc") == 0, 1).otherwise(F.col("total_acc"))
    return df.withColumn("utilization_of_credit_lines", F.col("open_acc") / total)


def loan_to_income(df: DataFrame) -> DataFrame:
    if not _has(df, "loan_amnt", "annual_inc"):
        return df
    income = F.when(F.col("annual_inc") == 0, 1.0).otherwise(F.col("annual_inc"))
    return df.withColumn("loan_to_income", F.col("loan_amnt") / income)


def residual_income(df: DataFrame) -> DataFrame:
    if not _has(df, "annual_inc", "installment"):
        return df
    return df.withColumn("monthly_residual_income", F.col("annual_inc") / 12.0 - F.col("installment"))


def fico_band(df: DataFrame) -> DataFrame:
    """Score band by right-closed bins, with its rank for ordering; NULL outside (0, 850]."""
    if not _has(df, "fico_avg"):
        return df
    name = order = F.when(F.col("fico_avg") <= 0, None)
    for rank, (upper, label) in enumerate(FICO_BANDS, start=1):
        name = name.when(F.col("fico_avg") <= upper, label)
        order = order.when(F.col("fico_avg") <= upper, rank)
    return df.withColumns({"fico_band": name, "fico_band_order": order.cast("int")})


def risk_features(df: DataFrame) -> DataFrame:
    return fico_band(residual_income(loan_to_income(line_utilization(df))))


def interaction_features(df: DataFrame) -> DataFrame:
    """Debt ratio times utilisation, and amount times rate."""
    if _has(df, "dti", "revol_util"):
        df = df.withColumn("dti_x_util", F.col("dti") * F.col("revol_util"))
    if _has(df, "loan_amnt", "int_rate"):
        df = df.withColumn("cost_of_credit", F.col("loan_amnt") * F.col("int_rate"))
    return df


def behavioral_features(df: DataFrame) -> DataFrame:
    """Clean-record flag (missing counts as zero) and recent-inquiry flag (missing counts as no)."""
    records = [c for c in ("delinq_2yrs", "pub_rec", "tax_liens") if c in df.columns]
    if records:
        total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in records])
        df = df.withColumn("clean_record", (total == 0).cast("int"))
    if _has(df, "inq_last_6mths"):
        active = F.coalesce(F.col("inq_last_6mths") > 2, F.lit(False))
        df = df.withColumn("high_inquiry_activity", active.cast("int"))
    return df


def derived_features(df: DataFrame) -> DataFrame:
    """Risk, interaction and behaviour features in one projection."""
    return behavioral_features(interaction_features(risk_features(df)))
