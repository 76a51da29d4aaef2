"""Exact stratified train / validation / test split without sorting the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS = 52
BUCKET_BITS = 16


def _hash52(seed: int, key: str) -> Column:
    text = F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def _as_map(df: DataFrame, key: str, cols: list[str]) -> Column:
    """Small per-class table as a map in a scalar subquery: the big side is not shuffled by class."""
    return df.agg(F.map_from_entries(F.collect_list(F.struct(key, F.struct(*cols)))).alias("m")).scalar()


def stratified_split(
    df: DataFrame, *, key: str, label: str, test_size: float = 0.3, val_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split`` in {test, val, train}: exact shares per class, decided by a seeded hash of the key.

    Rows rank by hash inside their class and the first ``test_size`` share is the test set. Only the two
    cut-off hashes per class are needed: counts per hash prefix find the prefix each cut falls in, and just
    the keys under those prefixes are ranked, by running counts of their rows, so that a key with a large part
    of the table is one row there. The table itself gets a column and is never shuffled. Rows with one key go
    to the same set, which a cut inside such a key makes larger.
    """
    hashed = df.withColumn("_h", _hash52(seed, key)).withColumn(
        "_prefix", F.shiftright("_h", HASH_BITS - BUCKET_BITS).cast("int")
    )
    labelled = hashed.filter(F.col(label).isNotNull())
    per_prefix = labelled.groupBy(label, "_prefix").agg(F.count(F.lit(1)).alias("n"))
    of_class = Window.partitionBy(label)  # at most 2^BUCKET_BITS rows per class
    upto = F.sum("n").over(of_class.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0))
    ranked = per_prefix.withColumns({"upto": upto, "total": F.sum("n").over(of_class)})
    test = F.floor(F.col("total") * test_size + 0.5)
    cuts = {"test": test, "val": test + F.floor(F.col("total") * val_size + 0.5)}
    before = F.col("upto") - F.col("n")
    aggregates = []
    for name, cut in cuts.items():
        inside = (before < cut) & (cut <= F.col("upto"))
        aggregates.append(F.max(F.when(inside, F.col("_prefix"))).alias(f"{name}_prefix"))
        aggregates.append(F.max(F.when(inside, cut - before)).alias(f"{name}_rank"))
    located = ranked.groupBy(label).agg(*aggregates)

    bound = F.try_element_at(F.col("_cuts"), F.col(label))
    tagged = F.array(
        *[
            F.struct(F.lit(n).alias("cut"), bound[f"{n}_prefix"].alias("at"), bound[f"{n}_rank"].alias("rank"))
            for n in cuts
        ]
    )
    fields = [f"{n}_{part}" for n in cuts for part in ("prefix", "rank")]
    near = (
        labelled.select(key, label, "_h", "_prefix")
        .withColumn("_cuts", _as_map(located, label, fields))
        .filter((F.col("_prefix") == bound["test_prefix"]) | (F.col("_prefix") == bound["val_prefix"]))
        .select(key, label, "_h", "_prefix", F.inline(tagged))
        .filter(F.col("_prefix") == F.col("at"))
    )
    keys = near.groupBy(label, "cut", "rank", "_h", key).agg(F.count(F.lit(1)).alias("n"))
    reached = F.sum("n").over(Window.partitionBy(label, "cut").orderBy("_h", key))
    edge = F.struct("_h", key)
    thresholds = (
        keys.withColumn("reached", reached)
        .filter(F.col("reached") >= F.col("rank"))
        .groupBy(label)
        .agg(*[F.min(F.when(F.col("cut") == n, edge)).alias(n) for n in cuts])
    )
    limit = F.try_element_at(F.col("_limits"), F.col(label))
    split = (
        F.when(F.col(label).isNull(), None)
        .when(F.coalesce(edge <= limit["test"], F.lit(False)), "test")
        .when(F.coalesce(edge <= limit["val"], F.lit(False)), "val")
        .otherwise("train")
    )
    return (
        hashed.withColumn("_limits", _as_map(thresholds, label, list(cuts)))
        .withColumn("split", split)
        .drop("_h", "_prefix", "_limits")
    )
