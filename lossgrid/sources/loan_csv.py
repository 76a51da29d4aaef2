"""Loan CSV readers: a tree of accepted / rejected files, and the single delinquency file."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossgrid.functions.numeric import nan_to_null
from lossgrid.operators.quality import feature_summary

DELINQUENCY_TARGET = "SeriousDlqin2yrs"
# Columns of accepted-loan files that hold numbers. Columns not named here stay text.
NUMERIC_COLUMNS = (
    "loan_amnt funded_amnt funded_amnt_inv installment int_rate annual_inc dti revol_bal open_acc total_acc "
    "delinq_2yrs pub_rec tax_liens inq_last_6mths fico_range_low fico_range_high last_fico_range_low "
    "last_fico_range_high mths_since_last_delinq mths_since_last_record mths_since_last_major_derog out_prncp "
    "total_pymnt total_rec_prncp total_rec_int recoveries last_pymnt_amnt policy_code"
).split()


def _any_case(word: str) -> str:
    """Glob that matches a word in any letter case."""
    return "".join(f"[{ch.lower()}{ch.upper()}]" for ch in word)


def _files(spark: SparkSession, root: str, word: str) -> list[str]:
    """Whether files exist: at most one path is fetched, file contents are not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{_any_case(word)}*.csv")
    )
    try:
        return [r["path"] for r in listing.load(root).select("path").limit(1).collect()]
    except AnalysisException as error:
        raise FileNotFoundError(f"cannot list {root}") from error


def _read(spark: SparkSession, root: str, word: str, schema: T.StructType | None, drop_cols: Sequence[str]) -> DataFrame:
    reader = (
        spark.read.option("header", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{_any_case(word)}*.csv")
    )
    df = (reader.schema(schema) if schema else reader).csv(root)
    # A header cell left empty (a saved row index) is named _c<i> by Spark and unnamed* by other writers.
    unnamed = [c for c in df.columns if re.match(r"(?i)unnamed|_c\d+$", c)]
    df = df.drop(*unnamed, *drop_cols)
    if schema:
        return nan_to_null(df)
    # Without a schema only the header is read up front (everything is text); known numbers are then cast,
    # which saves the extra pass over all files that type inference takes.
    casts = {c: F.col(c).try_cast("double") for c in df.columns if c in NUMERIC_COLUMNS}
    return nan_to_null(df.withColumns(casts)) if casts else df


def read_loans_dir(
    spark: SparkSession,
    root: str,
    *,
    drop_cols: Sequence[str] = (),
    accepted_only: bool = True,
    schemas: Mapping[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """{'accepted': ...} and, if asked for and present, {'rejected': ...} from all matching CSV files below root."""
    schemas = schemas or {}
    if not _files(spark, root, "accepted"):
        raise FileNotFoundError(f"no accepted CSV below {root}")
    tables = {"accepted": _read(spark, root, "accepted", schemas.get("accepted"), drop_cols)}
    if not accepted_only and _files(spark, root, "rejected"):
        tables["rejected"] = _read(spark, root, "rejected", schemas.get("rejected"), drop_cols)
    return tables


def read_delinquency_csv(spark: SparkSession, path: str, *, schema: T.StructType | None = None) -> DataFrame:
    """One delinquency CSV without its saved row index; all other columns are numbers."""
    reader = spark.read.option("header", "true").option("nullValue", "NA")
    df = (reader.schema(schema) if schema else reader).csv(path)
    df = df.drop("Unnamed: 0", "_c0")
    if schema:
        return nan_to_null(df)
    return nan_to_null(df.select(*[F.col(f"`{c}`").try_cast("double").alias(c) for c in df.columns]))


def dataset_metadata(df: DataFrame, *, path: str, target: str | None = None) -> DataFrame:
    """One row: path, target, feature names, size, missing cells."""
    features = [c for c in df.columns if c != target]
    return feature_summary(df).select(
        F.lit(path).alias("path"),
        F.lit(target).cast("string").alias("target"),
        F.lit(features).alias("features"),
        "n_rows",
        "n_cols",
        "missing_values",
    )
