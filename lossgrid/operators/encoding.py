"""Imputation and one-hot encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.functions.numeric import melt, numeric_columns, other_columns
from lossgrid.operators.ordered import approx_quantiles, column_quantiles


def columns_with_nulls(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Which columns need filling: one aggregate, one boolean per column on the driver."""
    if not cols:
        return []
    found = df.agg(*[F.bool_or(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if found[i]]


def medians(df: DataFrame, cols: Sequence[str], *, exact: bool = True) -> DataFrame:
    """feature, quantiles[0] = median of the non-null values, for all columns in one job."""
    if exact:
        return column_quantiles(df, list(cols), [0.5])
    return approx_quantiles(melt(df, list(cols)), "value", [0.5], ["feature"])


def impute_median(df: DataFrame, *, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """NULLs of numeric columns to the column median; a column without any value stays NULL.

    Only columns that have NULLs enter the quantile job. The named columns come out as doubles.
    """
    names = list(cols) if cols is not None else numeric_columns(df)
    filled = {c: F.col(c).cast("double") for c in names}
    gaps = columns_with_nulls(df, names)
    if not gaps:
        return df.withColumns(filled) if filled else df
    # One number per column, as a constant: whatever reads the result again does not ask for it again.
    found = medians(df, gaps, exact=exact).select("feature", F.get("quantiles", F.lit(0)).alias("median")).collect()
    middle = {r["feature"]: r["median"] for r in found}
    for c in gaps:
        filled[c] = F.coalesce(F.col(c).cast("double"), F.lit(middle.get(c)).cast("double"))
    return df.withColumns(filled)


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """feature, mode (as text): the most frequent value, the smallest on ties.

    Counts per (column, value) and then one small maximum, both aggregated map-side; no task holds a
    column's value set.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in cols])
    return (
        df.select(F.inline(pairs))
        .filter(F.col("level").isNotNull())
        .groupBy("feature", "level")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("feature")
        .agg(F.min(F.struct((-F.col("n")).alias("_rank"), F.col("level"))).alias("best"))
        .select("feature", F.col("best.level").alias("mode"))
    )


def impute_mode(df: DataFrame, *, cols: Sequence[str] | None = None) -> DataFrame:
    """NULLs of non-numeric columns (text, bands, dates, booleans) to the column mode."""
    names = list(cols) if cols is not None else other_columns(df)
    gaps = columns_with_nulls(df, names)
    if not gaps:
        return df
    most = {r["feature"]: r["mode"] for r in modes(df, gaps).collect()}  # one value per column, as a constant
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(most.get(c)).cast("string").cast(df.schema[c].dataType)) for c in gaps})


def handle_missing_values(df: DataFrame, *, exact: bool = True) -> DataFrame:
    """Median for numeric columns, mode for all others."""
    return impute_mode(impute_median(df, exact=exact))


def category_levels(df: DataFrame, cols: Sequence[str], *, max_levels: int = 200) -> dict[str, list[str]]:
    """Sorted levels per column. They become column names, so their number is checked, never cut."""
    if not cols:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in cols])
    found = df.select(F.inline(pairs)).filter(F.col("level").isNotNull()).distinct()
    # If more rows than this exist, some column exceeds the limit, which the check below reports.
    rows = found.limit(max_levels * len(cols) + 1).collect()
    levels = {c: sorted(r["level"] for r in rows if r["feature"] == c) for c in cols}
    wide = [c for c, found_levels in levels.items() if len(found_levels) > max_levels]
    if wide:
        raise ValueError(f"more than {max_levels} levels in {wide}: use the vector encoding of the model pipeline")
    return levels


def one_hot(
    df: DataFrame, *, cols: Sequence[str] | None = None, target: str | None = None, max_levels: int = 200
) -> DataFrame:
    """Text columns to 0/1 columns <col>_<level>, the first sorted level left out; NULL gives all zeros."""
    texts = [name for name, kind in df.dtypes if kind == "string" and name != target]
    names = list(cols) if cols is not None else texts
    levels = category_levels(df, names, max_levels=max_levels)
    out: list[Column] = []
    for c in df.columns:
        if c not in levels:
            out.append(F.col(c))
            continue
        for level in levels[c][1:]:
            hit = F.coalesce(F.col(c).cast("string") == F.lit(level), F.lit(False))
            out.append(hit.cast("int").alias(f"{c}_{level}"))
    return df.select(*out)
