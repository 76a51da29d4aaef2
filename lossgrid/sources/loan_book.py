"""The loan book: one keyed loan table derived from the order, customer and line tables.

Only the joins that the requested columns need are planned. Orders are the fact side of left joins whose
other sides are unique per key, so leaving a join out never changes the rows. Integer arithmetic on the order
key stands in for loan attributes the tables lack.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.functions.numeric import nan_to_null


# Column -> (SQL expression, table it needs besides the orders).
BOOK = {
    "id": ("o_orderkey", None),
    "member_id": ("o_custkey", None),
    "segment": ("c_mktsegment", "customer"),
    "loan_amnt": ("o_totalprice", None),
    "funded_amnt": ("round(ext, 2)", "lines"),
    "installment": ("o_totalprice / 36e0", None),
    "annual_inc": ("c_acctbal * 12e0", "customer"),
    "revol_util": ("CAST(CAST(qty AS BIGINT) AS STRING) || '%'", "lines"),
    "revol_bal": ("c_acctbal + o_totalprice / 10e0", "customer"),
    "dti": ("((o_orderkey * 37) % 1200) / 1e0", None),
    "int_rate": ("5e0 + ((o_orderkey * 23) % 200) / 10e0", None),
    "issue_ts": ("o_orderdate", None),
    "issue_d": ("date_format(o_orderdate, 'MMM-yyyy')", None),
    "earliest_ts": ("first_dt", "first_order"),
    "earliest_cr_line": ("date_format(first_dt, 'MMM-yyyy')", "first_order"),
    "loan_status": (
        "CASE o_orderstatus WHEN 'F' THEN 'Fully Paid' WHEN 'P' THEN 'Charged Off' ELSE 'Current' END", None),
    "grade": ("substr('ABCDEFG', CAST(substr(o_orderpriority, 1, 1) AS INT), 1)", None),
    "fico_range_low": ("(560 + (o_orderkey * 7919) % 300) / 1e0", None),
    "fico_range_high": ("(564 + (o_orderkey * 7919) % 300) / 1e0", None),
    "open_acc": ("n_lines", "lines"),
    "total_acc": ("max_line", "lines"),
    "delinq_2yrs": ("n_returned", "lines"),
    "pub_rec": ("CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 2 AS INT) END", None),
    "inq_last_6mths": ("CAST((o_orderkey * 13) % 5 AS INT)", None),
    "mths_since_last_delinq": ("CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 60 AS INT) END", None),
    "exposure": ("o_totalprice", None),
    "outstanding": ("o_totalprice * (20 + (o_orderkey * 11) % 61) / 100e0", None),
    "recovery": ("0.8e0 - ((o_orderkey * 31) % 50) / 100e0", None),
    "pd_12m": ("((o_orderkey * 7919) % 1000 + 0.5e0) / 2500e0", None),
    "original_pd": ("((o_orderkey * 104729) % 1000 + 0.5e0) / 5000e0", None),
    "lgd": ("0.2e0 + ((o_orderkey * 31) % 50) / 100e0", None),
    "term_years": ("1 + o_orderkey % 5", None),
    "dpd": ("(o_orderkey * 17) % 120", None),
    "y": ("CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END", None),
    "is_ref": ("CASE WHEN o_orderdate < TIMESTAMP_NTZ '1998-01-01 00:00:00' THEN 1 ELSE 0 END", None),
}
BOOK_COLUMNS = tuple(BOOK)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the schema; NaN becomes NULL here, as in every reader."""
    return nan_to_null(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def loan_book(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Requested loan columns (all by default), one row per order."""
    wanted = list(columns or BOOK_COLUMNS)
    unknown = [c for c in wanted if c not in BOOK]
    if unknown:
        raise ValueError(f"unknown loan book columns: {unknown}")
    parts = {BOOK[c][1] for c in wanted}
    orders = read_table(spark, sf_dir, "orders")
    loans = orders
    # The two customer-keyed joins come first and share one partitioning of the orders.
    if "customer" in parts:
        customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
        loans = loans.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    if "first_order" in parts:
        first = orders.groupBy(F.col("o_custkey").alias("first_ck")).agg(F.min("o_orderdate").alias("first_dt"))
        loans = loans.join(first, F.col("o_custkey") == F.col("first_ck"), "left")
    if "lines" in parts:
        lines = (
            read_table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.sum("l_quantity").alias("qty"),
                F.sum("l_extendedprice").alias("ext"),
                F.count(F.lit(1)).alias("n_lines"),
                F.max("l_linenumber").alias("max_line"),
                F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_returned"),
            )
        )
        loans = loans.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return loans.selectExpr(*[f"{BOOK[c][0]} AS {c}" for c in wanted])
