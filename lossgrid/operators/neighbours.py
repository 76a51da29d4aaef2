"""Mutual information of numbers with a class label by nearest neighbours.

In one dimension the k nearest neighbours of a value are among the k values before and the k after it. The values are
cut into ordered buckets; windows see k rows to both sides inside a bucket, and the first and last k rows of each bucket,
which are few, see over its borders. How many rows of all classes lie nearer than the k-th neighbour is the difference of
two running totals, taken where the borders of the interval lie in the order of all values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossgrid.functions.numeric import melt, numeric_columns
from lossgrid.functions.special import digamma
from lossgrid.operators.ordered import bucketed
from lossgrid.session import materialise

NEIGHBOURS = 3


def _points(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """feature, _class, value, rows of them (``n``) and of the class (``n_class``); classes of one row have no neighbours."""
    def usable(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(F.abs(x) < float("inf"), x).otherwise(0.0).alias(c)

    known = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("_class"), *[usable(c) for c in cols])
    counts = melt(known, list(cols), keep=["_class"]).groupBy("feature", "_class", "value").agg(F.count(F.lit(1)).alias("n"))
    sizes = known.groupBy("_class").agg(F.count(F.lit(1)).alias("n_class")).filter(F.col("n_class") > 1)
    return counts.join(sizes, "_class")


def with_nearest(df: DataFrame, value: str, count: str, group: Sequence[str], k: int) -> DataFrame:
    """Add ``_below`` and ``_above``: (value, count) of up to k rows before and after a row in the order of its group.

    Values are distinct within a group. No task orders more than a bucket, or k rows from both ends of every bucket. The
    order within the buckets is written once, as the rows at the borders are looked at again.
    """
    group, columns = list(group), df.columns
    placed = bucketed(df, value, "_bucket", group)[0].repartition(*group, "_bucket")
    pair = F.struct(F.col(value).alias("value"), F.col(count).alias("n"))

    def both_sides(keys: Sequence[str]) -> tuple[Column, Column]:
        order = Window.partitionBy(*keys).orderBy(value)
        below, above = [F.lag(pair, i).over(order) for i in range(k, 0, -1)], [F.lead(pair, i).over(order) for i in range(1, k + 1)]
        return tuple(F.filter(F.array(*side), lambda p: p.isNotNull()) for side in (below, above))

    inside = Window.partitionBy(*group, "_bucket").orderBy(value)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below, above = both_sides([*group, "_bucket"])
    local = placed.select(*columns, below.alias("_below"), above.alias("_above"), F.row_number().over(inside).alias("_rank"),
                          F.count(F.lit(1)).over(whole).alias("_rows"))
    local = materialise(local, "neighbour-buckets")
    starts, ends = F.col("_rank") <= k, F.col("_rows") - F.col("_rank") < k
    # The k rows before the first ones of a bucket are among the last k of the buckets before it, and the like after it.
    below, above = both_sides(group)
    edges = local.filter(starts | ends).withColumns({"_before": below, "_after": above})
    edges = edges.select(*columns, F.when(starts, F.col("_before")).otherwise(F.col("_below")).alias("_below"),
                         F.when(ends, F.col("_after")).otherwise(F.col("_above")).alias("_above"))
    return local.filter(~(starts | ends)).select(*columns, "_below", "_above").unionAll(edges)


def _with_radius(points: DataFrame, k: int) -> DataFrame:
    """Add the distance to the k-th neighbour in the class (``radius``) and the rank it has (``k``)."""
    def distances(side: str, sign: int) -> Column:
        return F.flatten(F.transform(side, lambda p: F.array_repeat((F.col("value") - p["value"]) * sign, F.least(p["n"], F.lit(k)).cast("int"))))

    near = with_nearest(points, "value", "n", ["feature", "_class"], k)
    same = F.array_repeat(F.lit(0.0), F.least(F.col("n") - 1, F.lit(k)).cast("int"))
    rank = F.least(F.lit(k), F.col("n_class") - 1).cast("int")
    radius = F.element_at(F.sort_array(F.concat(same, distances("_below", 1), distances("_above", -1))), rank)
    near = near.select(*points.columns, radius.alias("radius"), rank.alias("rank"))
    # Where the k-th neighbour has the same value, all rows of that value are neighbours.
    return near.select(*points.columns, "radius", F.when(F.col("radius") > 0, F.col("rank")).otherwise(F.col("n")).alias("k"))


def _with_nearer(reach: DataFrame) -> DataFrame:
    """feature, _class, value, n, n_class, k, and ``m``: the rows of all classes nearer than the radius, or of the value if that is 0.

    Values and the ends of their intervals go through one order; an end is placed before or after the values equal to it, and
    takes the running number of rows there along, so nothing is joined to its totals afterwards.
    """
    tied, nothing = F.col("radius") == 0, F.lit(0).cast("bigint")

    def mark(at: Column, sign: int, place: Column, rows: Column) -> Column:
        return F.struct(at.alias("_at"), F.lit(sign).alias("_sign"), place.alias("_place"), rows.alias("_rows"))

    # The value of an end is inside at the upper end of a tie and at the lower end of an interval, which it is subtracted from.
    after = F.when(tied, 1).otherwise(-1)
    marks = F.array(mark(F.col("value"), 0, F.lit(0), F.col("n")), mark(F.col("value") + F.col("radius"), 1, after, nothing),
                    mark(F.col("value") - F.col("radius"), -1, -after, nothing))
    marks = bucketed(reach.select("feature", "_class", "value", "n", "n_class", "k", F.inline(marks)), "_at", "_bucket", ["feature"])[0]
    ahead = Window.partitionBy("feature").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = marks.groupBy("feature", "_bucket").agg(F.sum("_rows").alias("_all"))  # fewer rows than buckets and features
    totals = totals.select("feature", "_bucket", F.coalesce(F.sum("_all").over(ahead), nothing).alias("_ahead"))
    order = Window.partitionBy("feature", "_bucket").orderBy("_at", "_place").rowsBetween(Window.unboundedPreceding, 0)
    ends = marks.repartition("feature", "_bucket").withColumn("_upto", F.sum("_rows").over(order)).filter(F.col("_sign") != 0)
    reached = ends.join(F.broadcast(totals), ["feature", "_bucket"])
    return reached.groupBy("feature", "_class", "value", "n", "n_class", "k").agg(
        F.sum(F.col("_sign") * (F.col("_upto") + F.col("_ahead"))).alias("m")
    )


def neighbour_mutual_info(df: DataFrame, *, label: str, cols: Sequence[str] | None = None, k: int = 20, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Top-k numeric features (feature, score) by nearest-neighbour mutual information with a class label, in nats.

    Per row: the distance to its k-th neighbour of the same class, and the number m of rows of all classes that are nearer,
    itself included; the score is psi(N) + mean(psi(k) - psi(class size) - psi(m)), at least 0. No jitter is added: where
    the k-th neighbour has the same value, k and m are the numbers of rows with it, so columns of few values come
    close to the plug-in estimate. Intervals are value - radius to value + radius in doubles, ends left out.

    Missing and non-finite values count as 0; rows without a label and classes of one row are left out; equal scores go
    by name; an empty table gives no rows. Only one row per feature, class and distinct value is shuffled.
    """
    names = list(cols) if cols is not None else numeric_columns(df, exclude=[label])
    points = materialise(_points(df, label, names), "neighbour-points")
    reach = materialise(_with_radius(points, neighbours), "neighbour-reach")
    term = F.col("n") * (digamma(F.col("k")) - digamma(F.col("n_class")) - digamma(F.col("m")))
    scored = _with_nearer(reach).groupBy("feature").agg(F.sum("n").alias("rows"), F.sum(term).alias("terms"))
    score = F.greatest(F.lit(0.0), digamma(F.col("rows")) + F.col("terms") / F.col("rows"))
    return scored.select("feature", score.alias("score")).orderBy(F.desc("score"), "feature").limit(k)
