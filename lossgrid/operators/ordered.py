"""Distributed running totals and exact quantiles.

A window ordered without partitions moves every row into one task. Here the input is first aggregated to
one row per (group, value), which also collapses ties and hot values map-side. Split points taken from
those distinct values cut the order into even buckets, a window runs inside each bucket, and the bucket
totals (one small row per bucket) are summed ahead and joined back as offsets. A group holding most of the
rows is cut into many buckets like any other stretch of the order.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossgrid.functions.numeric import melt
from lossgrid.session import materialise

MAX_BUCKETS = 16384


def _bucket_count(df: DataFrame) -> int:
    """Power of two, at least four times the shuffle parallelism, so hashing the buckets spreads them evenly."""
    wanted = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_BUCKETS, 1 << max(3, (wanted - 1).bit_length()))


def _split_points(df: DataFrame, value: str, by: Sequence[str], buckets: int) -> Column:
    """At most ``buckets - 1`` sorted (group, value) pairs, as a scalar subquery.

    The pairs with the smallest hashes are taken (the smallest of each hash class first, which bounds what
    is shuffled): a pure function of the set of distinct values, so recomputed tasks and repeated references
    cut at the same places. The aggregate keeps only primitive state, hence stays a map-side hash aggregate.
    """
    pair = F.struct(*by, F.col(value))
    hashed = df.select(*by, value).withColumn("_h", F.xxhash64(*by, value))
    picked = (
        hashed.withColumn("_class", F.pmod("_h", F.lit(buckets - 1)))
        .groupBy(*by, "_class")
        .agg(F.min_by(value, "_h").alias(value), F.min("_h").alias("_h"))
        .select("_h", pair.alias("pair"))
        .orderBy("_h", "pair")
        .limit(buckets - 1)
    )
    return picked.agg(F.sort_array(F.collect_list("pair")).alias("splits")).scalar()


def _with_bucket(df: DataFrame, splits: Column, value: str, group: Sequence[str], buckets: int) -> DataFrame:
    """Add ``_bucket``, the number of split points below the (group, value) pair.

    A branch-free binary search, one projection per halving, all inside generated code.
    """
    pair = F.struct(*group, F.col(value))
    columns = df.columns
    df = df.withColumn("_splits", splits).withColumn("_bucket", F.lit(0))
    at = F.col("_bucket")
    for i in range(1, buckets.bit_length()):
        step = buckets >> i
        df = df.withColumn("_bucket", F.when(F.get("_splits", at + (step - 1)) < pair, at + step).otherwise(at))
    return df.select(*columns, "_bucket")


def bucketed(df: DataFrame, value: str, out: str, by: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """Add ``out``, the number of the range of the (group, value) order a row is in, and the number of ranges.

    Split points are drawn from the distinct values, so ranges hold about equally many of them.
    """
    buckets = _bucket_count(df)
    placed = _with_bucket(df, _split_points(df, value, by, buckets), value, by, buckets)
    return placed.withColumnRenamed("_bucket", out), buckets


def running_totals(
    df: DataFrame,
    value: str,
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """One row per (group, value) with, for each named sum s: ``s``, ``s_upto`` (inclusive), ``s_total``.

    Rows whose value is NULL are left out; ``by`` columns may be NULL.
    """
    names = list(sums)
    buckets = buckets or _bucket_count(df)
    # The group keys travel as one struct: NULL members compare equal under a plain equi-join, so the
    # window and the join with the offsets share one hash partitioning.
    by_struct = [F.struct(*by).alias("_group")] if by else []
    group = ["_group"] if by else []
    present = df.filter(F.col(value).isNotNull()).select(
        *by_struct, value, *[c.alias(s) for s, c in sums.items()]
    )
    distinct = present.groupBy(*group, value).agg(*[F.sum(s).alias(s) for s in names])

    placed = _with_bucket(distinct, _split_points(present, value, group, buckets), value, group, buckets)
    placed = placed.repartition(*group, "_bucket")

    ahead = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # The last value of a bucket is carried along so that both sides read the columns, and thereby the
    # output, of one shuffle.
    offsets = (
        placed.groupBy(*group, "_bucket")
        .agg(F.max(value).alias("_last"), *[F.sum(s).alias(s) for s in names])
        .select(
            *[F.col(c).alias(f"_of{c}") for c in (*group, "_bucket")],
            "_last",
            *[F.coalesce(F.sum(s).over(ahead), F.lit(0)).alias(f"_ahead_{s}") for s in names],
            *[F.sum(s).over(Window.partitionBy(*group)).alias(f"{s}_total") for s in names],
        )
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({f"{s}_upto": F.sum(s).over(inside) for s in names})
    if not by:
        offsets = F.broadcast(offsets)  # at most `buckets` rows
    match = F.col(value) <= F.col("_last")
    for c in (*group, "_bucket"):
        match = match & (F.col(c) == F.col(f"_of{c}"))
    # A left join: every bucket has its offset, and no not-null filter is derived on the search expression.
    return local.join(offsets, match, "left").select(
        *[F.col("_group").getField(k).alias(k) for k in by],
        value,
        *names,
        *[(F.col(f"{s}_upto") + F.col(f"_ahead_{s}")).alias(f"{s}_upto") for s in names],
        *[F.col(f"{s}_total") for s in names],
    )


def quantiles_of_totals(
    totals: DataFrame,
    value: str,
    count: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    also: Sequence[Column] = (),
) -> DataFrame:
    """Linear-interpolated quantiles from ``running_totals``: by, n, ``quantiles`` array (in ``probs`` order).

    Ranks are weighted by the count column; rows with count 0 hold no rank. ``also`` names further
    aggregates of the same pass.
    """
    n, upto = f"`{count}_total`", f"`{count}_upto`"
    inside = f"{upto} - `{count}` <= {{rank}} AND {{rank}} < {upto}"  # the row holds that (0-based) rank
    aggregates, values = [], []
    for i, q in enumerate(probs):
        at = f"({float(q)!r}D * ({{n}} - 1))"
        for name, rank in (("low", f"floor({at})"), ("high", f"least(floor({at}) + 1, {{n}} - 1)")):
            held = inside.format(rank=rank.format(n=n))
            aggregates.append(F.expr(f"max(CASE WHEN {held} THEN `{value}` END) AS _{name}{i}"))
        at = at.format(n="n")
        values.append(f"_low{i} + (_high{i} - _low{i}) * ({at} - floor({at}))")
    grouped = totals.groupBy(*by).agg(F.max(f"{count}_total").alias("n"), *aggregates, *also)
    kept = [c for c in grouped.columns if c not in by and c != "n" and not c.startswith(("_low", "_high"))]
    return grouped.select(*by, "n", F.expr(f"array({', '.join(values)}) AS quantiles"), *kept)


#: Size of the sketches that bracket the ranks, and the share of all rows by which their ranks may be off: twice the
#: error that one estimate in a hundred exceeds. A bracket that misses its rank is widened, so this is no matter of results.
SKETCH_SIZE, SKETCH_ERROR = 8192, 0.0015
#: Columns whose sketches are kept side by side in one pass.
SKETCHES = 64
#: Equal parts of a bracket whose rows are counted before any value is ordered.
PARTS = 256


def _ranks(probs: Sequence[float], n: int) -> list[tuple[float, int, int]]:
    """Per probability its place among n ordered values, and the ranks (from 0) on both sides of it."""
    return [(q * (n - 1), math.floor(q * (n - 1)), min(math.floor(q * (n - 1)) + 1, n - 1)) for q in map(float, probs)]


def _brackets(row: Row, probs: Sequence[float], error: float) -> list[tuple[float, float]]:
    """Disjoint ranges of values that should hold the ranks of a group; all its values where it has few."""
    if row["_n"] * error < 4 or error >= 0.25:
        return [(row["_min"], row["_max"])]
    merged: list[tuple[float, float]] = []
    for i in sorted(range(len(probs)), key=lambda i: probs[i]):
        low = row["_min"] if probs[i] <= error else row["_at"][2 * i]
        high = row["_max"] if probs[i] >= 1 - error else row["_at"][2 * i + 1]
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], high))
        else:
            merged.append((low, high))
    return merged


def _sketched(present: DataFrame, value: str, probs: Sequence[float], by: Sequence[str], error: float) -> list[Row]:
    """One row per group: n, smallest, largest, NaN rows, and the estimated values on both sides of each probability."""
    aside = 1.75 * error
    at = F.array(*[F.lit(min(1.0, max(0.0, q + d))) for q in probs for d in (-aside, aside)])
    usable = F.when(~F.isnan(value), F.col(value))
    sketch = present.groupBy(*by).agg(
        F.count(usable).alias("_n"), F.min(usable).alias("_min"), F.max(usable).alias("_max"), F.count_if(F.isnan(value)).alias("_nan"),
        F.kll_sketch_agg_double(usable, F.lit(SKETCH_SIZE)).alias("_sketch"),
    )
    estimate = F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double("_sketch", at))
    return sketch.select(*by, "_n", "_min", "_max", "_nan", estimate.alias("_at")).collect()


def _cells(present: DataFrame, value: str, by: Sequence[str], brackets: list[tuple]) -> DataFrame:
    """by, _gap, _part, value, _rows: rows in brackets counted by value, all others by the gap before a bracket they are in."""
    spark = present.sparkSession
    depth = max(len(b[-1]) for b in brackets).bit_length()
    width = (1 << depth) - 1
    rows = [(*b[:-1], [lo for lo, _ in b[-1]], [hi for _, hi in b[-1]] + [float("inf")] * (width - len(b[-1]))) for b in brackets]
    keys = ", ".join(f"_key{i} {present.schema[c].dataType.simpleString()}" for i, c in enumerate(by))
    table = spark.createDataFrame(rows, f"{keys + ', ' if keys else ''}_lows array<double>, _highs array<double>")
    numbers = present.filter(~F.isnan(value))
    if by:  # one row per group
        same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(by)]
        placed = numbers.join(F.broadcast(table), same)
    else:
        placed = numbers.withColumns({c: F.lit(rows[0][i]).cast("array<double>") for i, c in enumerate(("_lows", "_highs"))})
    placed = placed.withColumn("_gap", F.lit(0))
    gap = F.col("_gap")
    for i in range(depth - 1, -1, -1):  # how many brackets end below the value
        placed = placed.withColumn("_gap", F.when(F.get("_highs", gap + ((1 << i) - 1)) < F.col(value), gap + (1 << i)).otherwise(gap))
    low, high = F.get("_lows", gap), F.get("_highs", gap)
    inside = F.coalesce(F.col(value) >= low, F.lit(False)) & (gap < F.size("_lows"))
    span = high - low
    part = F.when(inside & (span > 0) & (span < float("inf")), F.floor((F.col(value) - low) / span * (PARTS - 1)).cast("int"))
    cells = placed.select(*by, "_gap", F.when(inside, F.coalesce(part, F.lit(0))).alias("_part"), F.when(inside, F.col(value)).alias(value))
    return cells.groupBy(*by, "_gap", "_part", value).agg(F.count(F.lit(1)).alias("_rows"))


def cheap_to_read_twice(df: DataFrame, purpose: str = "quantile-values") -> DataFrame:
    """``df`` if it is a scan with steps in place, else its rows written once: what lies behind a shuffle is not done twice."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return materialise(df, purpose) if re.search(r"\b(Join|Aggregate|Window|Sort|Repartition\w*)\b", plan) else df


_cheap_to_read_twice = cheap_to_read_twice


def _two_pass_quantiles(
    present: DataFrame, value: str, probs: Sequence[float], by: Sequence[str], groups: list[Row] | None = None
) -> list[tuple]:
    """(by, n, quantiles) of every group, on the driver: the table is read twice, by a sketch and by a count.

    The sketch brackets each rank between two values. The count tells how many rows lie below each bracket and how they
    spread over its parts; only the values of the parts that hold a rank are ordered. Counts are exact, so a rank that is
    not where the sketch said is noticed and its bracket widened. ``groups`` are sketches that are there already.
    """
    present = cheap_to_read_twice(present)
    spark, error = present.sparkSession, SKETCH_ERROR
    groups = _sketched(present, value, probs, by, error) if groups is None else groups
    found: dict[tuple, dict[int, float]] = {}
    sizes = {tuple(r[c] for c in by): (r["_n"], r["_n"] + r["_nan"]) for r in groups}
    open_groups = [r for r in groups if r["_n"]]
    while open_groups:
        named = [(tuple(r[c] for c in by), _brackets(r, probs, error)) for r in open_groups]
        cells = materialise(_cells(present, value, by, [(*k, b) for k, b in named]), "quantile-cells")
        counted: dict[tuple, list] = {}
        for r in cells.groupBy(*by, "_gap", "_part").agg(F.sum("_rows").alias("_rows")).collect():  # PARTS a bracket at most
            counted.setdefault(tuple(r[c] for c in by), []).append((r["_gap"], -1 if r["_part"] is None else r["_part"], r["_rows"]))
        wanted, missed = [], []
        for row, (key, _) in zip(open_groups, named, strict=True):
            usable, n = sizes[key]
            ranks = sorted({r for _, a, b in _ranks(probs, n) for r in (a, b) if r < usable})
            ahead, held = 0, []
            for gap, part, rows in sorted(counted[key]):
                inside = [r for r in ranks if ahead <= r < ahead + rows]
                if inside:
                    held.append((*key, gap, part, ahead, inside))
                ahead += rows
            if any(h[len(by) + 1] < 0 for h in held):
                missed.append(row)
            else:
                wanted += held
        if wanted:
            keys = "".join(f"_key{i} {present.schema[c].dataType.simpleString()}, " for i, c in enumerate(by))
            table = spark.createDataFrame(wanted, f"{keys}_g int, _p int, _ahead bigint, _ranks array<bigint>")
            same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(by)]
            inside = Window.partitionBy(*by, "_gap", "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
            near = cells.join(F.broadcast(table), [*same, F.col("_gap") == F.col("_g"), F.col("_part") == F.col("_p")])
            near = near.withColumn("_upto", F.col("_ahead") + F.sum("_rows").over(inside))
            here = F.filter("_ranks", lambda r: (r >= F.col("_upto") - F.col("_rows")) & (r < F.col("_upto")))
            for r in near.select(*by, value, F.explode(here).alias("_rank")).collect():  # one row per rank
                found.setdefault(tuple(r[c] for c in by), {})[r["_rank"]] = r[value]
        open_groups, error = missed, error * 8
        if missed:
            groups = _sketched(present, value, probs, by, error)
            names = {tuple(r[c] for c in by) for r in missed}
            open_groups = [r for r in groups if tuple(r[c] for c in by) in names]
    out = []
    for key, (_, n) in sizes.items():
        held = found.get(key, {})
        values = []
        for at, a, b in _ranks(probs, n) if n else []:
            low, high = held.get(a, float("nan")), held.get(b, float("nan"))
            values.append(low if at == a else low + (high - low) * (at - a))
        out.append((*key, n, values) if n else (*key, None, [None] * len(probs)))
    return out


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    few_groups: bool | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Exact quantiles per group: by, n, ``quantiles`` array (in ``probs`` order), interpolated between neighbours.

    With few groups (at most as many as the table has columns; the default without ``by``) the table is read twice, at
    once: a sketch brackets the wanted ranks, and a count gathers the brackets; the result is a small local table. With many
    groups the running totals of all values, in ``buckets`` ranges, are used. NULLs have no rank, NaN is above all numbers; without values a
    group is missing, and without ``by`` the row is NULL.
    """
    by = list(by)
    few_groups = not by if few_groups is None else few_groups
    typed = df.select(*by, F.col(value).cast("double").alias(value))
    if not few_groups:
        return quantiles_of_totals(running_totals(typed, value, {"_count": F.lit(1)}, by, buckets), value, "_count", probs, by)
    rows = _two_pass_quantiles(typed.filter(F.col(value).isNotNull()), value, [float(q) for q in probs], by)
    schema = T.StructType([*[typed.schema[c] for c in by], T.StructField("n", T.LongType()), T.StructField("quantiles", T.ArrayType(T.DoubleType()))])
    return df.sparkSession.createDataFrame(rows, schema)


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of many columns of one table: feature, n, ``quantiles``, a small local table as of ``exact_quantiles``.

    The sketches are those of the columns side by side, so rows become (feature, value) rows for the count alone. Columns
    without a value are missing.
    """
    probs = [float(q) for q in probs]
    schema = "feature string, n bigint, quantiles array<double>"
    if not cols:
        return df.sparkSession.createDataFrame([], schema)
    table = cheap_to_read_twice(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    aside = 1.75 * SKETCH_ERROR
    at = F.array(*[F.lit(min(1.0, max(0.0, q + d))) for q in probs for d in (-aside, aside)])
    found = []
    for start in range(0, len(cols), SKETCHES):
        aggregates = []
        for i, c in enumerate(cols[start : start + SKETCHES]):
            usable = F.when(~F.isnan(c), F.col(c))
            aggregates += [
                F.count(usable).alias(f"_n{i}"), F.min(usable).alias(f"_min{i}"), F.max(usable).alias(f"_max{i}"),
                F.count_if(F.isnan(c)).alias(f"_nan{i}"), F.kll_sketch_agg_double(usable, F.lit(SKETCH_SIZE)).alias(f"_sketch{i}"),
            ]
        one = table.agg(*aggregates)
        many = range(len(cols[start : start + SKETCHES]))
        estimates = [F.when(F.col(f"_n{i}") > 0, F.kll_sketch_get_quantile_double(f"_sketch{i}", at)).alias(f"_at{i}") for i in many]
        row = one.select(*[f"_{k}{i}" for i in many for k in ("n", "min", "max", "nan")], *estimates).first()
        parts = [{k: row[f"{k}{i}"] for k in ("_n", "_min", "_max", "_nan", "_at")} for i in many]
        found += [Row(feature=cols[start + i], **part) for i, part in enumerate(parts) if part["_n"] + part["_nan"]]
    if not found:
        return df.sparkSession.createDataFrame([], schema)
    long = melt(table, list(cols)).filter(F.col("value").isNotNull())
    rows = _two_pass_quantiles(long, "value", probs, ["feature"], found)
    return df.sparkSession.createDataFrame(rows, schema)


def approx_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), accuracy: int = 10000
) -> DataFrame:
    """Same layout from a mergeable sketch, for tables where one pass matters more than exactness."""
    sketch = F.percentile_approx(F.col(value).cast("double"), F.lit([float(q) for q in probs]), F.lit(accuracy))
    return df.groupBy(*by).agg(F.count(value).alias("n"), sketch.alias("quantiles"))
