"""Feature selection scores and correlations."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossgrid.functions.bins import edge_array_bin
from lossgrid.functions.numeric import melt, numeric_columns
from lossgrid.operators.categories import level_scores
from lossgrid.operators.neighbours import neighbour_mutual_info
from lossgrid.operators.ordered import cheap_to_read_twice, column_quantiles


def _filled(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Features as rows, missing values as 0, which is how the selection scores treat them."""
    filled = df.select(F.col(label).cast("int").alias("_y"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                                              for c in cols])
    return melt(filled, list(cols), keep=["_y"])


def _chosen(df: DataFrame, label: str, cols: Sequence[str] | None) -> list[str]:
    return list(cols) if cols is not None else numeric_columns(df, exclude=[label])


def select_mutual_info(
    df: DataFrame, *, label: str, cols: Sequence[str] | None = None, k: int = 20, n_bins: int = 10
) -> DataFrame:
    """Top-k features by plug-in mutual information with a 0/1 label, on quantile bins of the whole table.

    Only values around the bin edges are shuffled for the exact quantiles; every row is then binned where it
    lies, and the shuffled counts have at most n_bins * 2 rows per feature and task.
    """
    df, names = cheap_to_read_twice(df), _chosen(df, label, cols)
    long = _filled(df, names, label)
    probs = [i / n_bins for i in range(n_bins + 1)]
    wide = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names])
    edges = column_quantiles(wide, names, probs).select("feature", F.array_distinct("quantiles").alias("edges"))
    counts = (
        long.join(F.broadcast(edges), "feature")  # one row per feature column
        .withColumn("bin", F.coalesce(edge_array_bin(F.col("value"), F.col("edges"), n_bins + 1), F.lit(0)))
        .groupBy("feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_y") == 1).alias("n1"))
    )
    cells = counts.select(
        "feature", "n", F.explode(F.array(F.struct(F.lit(0).alias("y"), (F.col("n") - F.col("n1")).alias("c")),
                                          F.struct(F.lit(1).alias("y"), F.col("n1").alias("c")))).alias("cell")
    ).select("feature", "n", "cell.y", "cell.c")
    total = F.sum("c").over(Window.partitionBy("feature"))
    of_class = F.sum("c").over(Window.partitionBy("feature", "y"))
    scored = cells.withColumns({"total": total, "of_class": of_class}).filter(F.col("c") > 0)
    joint = F.col("c") / F.col("total")
    term = joint * F.log(F.col("c") * F.col("total") / (F.col("n").cast("double") * F.col("of_class")))
    return scored.groupBy("feature").agg(F.sum(term).alias("score")).orderBy(F.desc("score"), "feature").limit(k)


def select_anova_f(df: DataFrame, *, label: str, cols: Sequence[str] | None = None, k: int = 20) -> DataFrame:
    """Top-k features by the one-way ANOVA F statistic: moments per (feature, class), aggregated map-side."""
    long = _filled(df, _chosen(df, label, cols), label)
    moments = long.groupBy("feature", "_y").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("var")
    )
    per_feature = Window.partitionBy("feature")  # as many rows as classes
    centre = F.sum(F.col("n") * F.col("mean")).over(per_feature) / F.sum("n").over(per_feature)
    parts = moments.withColumn("gap", F.col("mean") - centre)
    sums = parts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("classes"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("gap") * F.col("gap")).alias("between"),
        F.sum(F.col("n") * F.col("var")).alias("within"),
    )
    score = F.try_divide(
        F.col("between") / (F.col("classes") - 1), F.col("within") / (F.col("n") - F.col("classes"))
    )
    ranked = sums.filter(F.col("classes") > 1).select("feature", score.alias("score"))
    return ranked.orderBy(F.desc_nulls_last("score"), "feature").limit(k)


def select_features(
    df: DataFrame,
    *,
    label: str,
    method: str = "mutual_info",
    cols: Sequence[str] | None = None,
    cat_cols: Sequence[str] = (),
    k: int = 20,
) -> DataFrame:
    """Score table of the k best features: method mutual_info, neighbours (nearest-neighbour information), else ANOVA F.

    With ``cat_cols`` the levels of these columns, however many, compete as 0/1 features: feature, score, and the
    ``column`` and ``level`` (NULL for a number) that a feature stands for. Levels have two values, so beside
    neighbours they are scored by their plug-in information.
    """
    score = {"mutual_info": select_mutual_info, "neighbours": neighbour_mutual_info}.get(method, select_anova_f)
    if not cat_cols:
        return score(df, label=label, cols=cols, k=k)
    levels = level_scores(df, label=label, cols=cat_cols, method="mutual_info" if method == "neighbours" else method, k=k)
    found = levels.select(F.concat_ws("_", "column", "level").alias("feature"), "score", "column", "level")
    numbers = _chosen(df, label, cols)
    if numbers:
        own = score(df, label=label, cols=numbers, k=k)
        found = found.unionByName(own.select("feature", "score", F.col("feature").alias("column"), F.lit(None).cast("string").alias("level")))
    return found.orderBy(F.desc_nulls_last("score"), "feature").limit(k)


def _pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """All coefficients in one scan and one map-side aggregate; each pair skips its own NULLs."""
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_r{i}")
                   for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"_r{i}").alias("corr"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return one.select(F.inline(rows))


def target_correlation_topk(
    df: DataFrame, *, label: str, cols: Sequence[str] | None = None, k: int = 10
) -> DataFrame:
    """Numeric features by absolute Pearson correlation with the label."""
    pairs = [(c, label) for c in _chosen(df, label, cols)]
    long = _pair_correlations(df, pairs).select(F.col("feature_a").alias("feature"), "corr")
    return long.orderBy(F.desc_nulls_last(F.abs("corr")), "feature").limit(k)


PAIR_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
#: A variance below this share of the mean square is rounding: the column counts as constant.
FLAT = 1e-12


def _pair_sums(columns: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task: for each pair of columns the sums over the rows that have both, by matrix products of the batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(PAIR_SUMS), columns, columns))
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            known = np.isfinite(x)
            x[~known] = 0.0
            there = known.astype(float)
            first, square = x.T @ there, (x * x).T @ there
            sums += np.stack([there.T @ there, first, first.T, square, square.T, x.T @ x])
        if rows:
            a, b = np.triu_indices(columns)
            parts = {name: pa.array(sums[k][a, b]) for k, name in enumerate(PAIR_SUMS)}
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), **parts})

    return run


def correlation_matrix(df: DataFrame, *, cols: Sequence[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson matrix as rows (feature_a, feature_b, corr), both triangles and diagonal.

    For any number of columns: a task adds up the sums of all pairs of its rows and sends one narrow row per pair, so
    neither the plan nor the shuffle grows with the rows. Values are centred on the column means first. NULL, NaN and
    infinite values are missing; a pair without common rows or with a constant side has no coefficient.
    """
    names = list(cols) if cols is not None else numeric_columns(df)
    values = [F.col(f"`{c}`").cast("double") for c in names]
    finite = [F.when(F.abs(v) < float("inf"), v) for v in values]
    means = df.agg(F.array(*[F.avg(v) for v in finite]).alias("means")).scalar()
    centred = df.select(*[(v - F.get(means, F.lit(i))).alias(f"c{i}") for i, v in enumerate(values)])
    sums = centred.mapInArrow(_pair_sums(len(names)), "a int, b int, " + ", ".join(f"{c} double" for c in PAIR_SUMS))
    # Every pair has a row, of an empty table too.
    last = F.lit(len(names) - 1)
    pairs = df.limit(0).agg(F.count(F.lit(1))).select(F.explode(F.sequence(F.lit(0), last)).alias("a"))
    none = pairs.select("a", F.explode(F.sequence("a", last)).alias("b"), *[F.lit(0.0).alias(c) for c in PAIR_SUMS])
    total = sums.unionByName(none).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in PAIR_SUMS])

    def spread(square: str, first: str) -> Column:
        v = F.col("n") * F.col(square) - F.col(first) * F.col(first)
        return F.when(v > F.lit(FLAT) * F.col("n") * F.col(square), v)

    shared = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    corr = shared / (F.sqrt(spread("sxx", "sx")) * F.sqrt(spread("syy", "sy")))
    corr = F.when((F.col("a") == F.col("b")) & corr.isNotNull(), F.lit(1.0)).otherwise(corr)
    bounded = F.when(corr.isNotNull(), F.greatest(F.least(corr, F.lit(1.0)), F.lit(-1.0)))
    name = F.array(*[F.lit(c) for c in names])
    upper = total.select(F.get(name, "a").alias("x"), F.get(name, "b").alias("y"), (F.col("a") < F.col("b")).alias("two"), bounded.alias("corr"))
    ways = F.when(F.col("two"), F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    both = upper.select(F.explode(F.coalesce(ways, F.array(F.struct("x", "y")))).alias("pair"), "corr")
    return both.select(F.col("pair.x").alias("feature_a"), F.col("pair.y").alias("feature_b"), "corr")
