"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Targets: every source gets its weight's share of all words; a source whose share exceeds ``max_epochs`` times its
size is clamped there, and what is left is shared anew among the others by weight, until no share exceeds its cap.
The water level (words per unit of weight) only rises, so each round clamps at least one more source or ends; a
round reads one row of totals.

Sampling: a source's target over its size is a number of repetitions: each document gets the whole ones, and the
rest is filled in the order of a seeded hash until the target is met; the document at the edge gives a part of
itself. The order is a function of (seed, id, text), so reruns agree whatever the partitions. Running totals do not
gather a source in one task: words are summed per (source, leading digits of the hash) first, in two steps of 256
sums each, and only rows of the single slice that holds the edge are ordered. All other rows are decided where they are,
from one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossgrid.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the hash that name a slice, and those that name its stretch: 16 ** 4 slices per source.
SLICE_DIGITS, STRETCH_DIGITS = 4, 2


def n_words(text: Column) -> Column:
    """Number of words, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def water_fill(sources: DataFrame, *, max_epochs: float = 3.0) -> DataFrame:
    """Add ``target`` to (source, source_size, weight) rows, one per source.

    Targets are proportional to weights, none exceeds ``max_epochs`` * source_size, and they sum up to all words
    (to the sum of the caps where that is less). Sources of size 0 get 0; no rows give no rows.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    level = None
    clamped = -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(over, cap).otherwise(F.lit(0.0))).alias("fixed"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("weights"),
            F.count_if(over).alias("clamped"),
        ).first()
        if not row["weights"] or row["clamped"] == clamped:
            break
        clamped = row["clamped"]
        level = (row["all"] - row["fixed"]) / row["weights"]
    if level is None:
        level = 0.0
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), cap))


def cyclic_weights(sources: DataFrame, weights: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Add ``weight``: the sources by code point, NULL last, weigh ``weights`` over and over.

    One row per source is ordered; documents are not.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), place % len(weights)))


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    *,
    seed: int = 42,
    max_epochs: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    ``taken`` counts words, repeats included; the words taken from a source add up to its target rounded down, and
    no document gives more than ``max_epochs`` (rounded up) times its size. ``weights`` has (source, weight);
    sources it lacks weigh 0; without it they weigh 1, 2, 3 in turn. A NULL source is a source; NULL and blank
    texts have size 0 and give 0. Rows alike in id and size are interchangeable.
    """
    sized = materialise(_sized(docs, seed, id_col, text_col, source_col), "mix-sizes")
    return _with_taken(sized, _plan(sized, weights, max_epochs)).select("doc_id", "source", "size", "source_size", "target", "taken")


def _sized(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    """(doc_id, source, size, place, slice) and ``more`` of every row; the place is a hash of seed, id and text."""
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text.cast("string"), F.lit(""))))
    placed = docs.select(
        doc_id.alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), n_words(text).alias("size"), F.md5(key).alias("place"), *more
    )
    return placed.withColumn("slice", F.substring("place", 1, SLICE_DIGITS))


def _plan(sized: DataFrame, weights: DataFrame | None, max_epochs: float) -> DataFrame:
    """One row per source: its target, whole repetitions, and the slice in which the words taken once more end."""
    slices = materialise(sized.groupBy("source", "slice").agg(F.sum("size").alias("words")), "mix-slices")
    sources = slices.groupBy("source").agg(F.sum("words").alias("source_size"))
    if weights is None:
        weighted = cyclic_weights(sources)
    else:
        given = weights.select(F.col("source").alias("_source"), F.col("weight"))
        weighted = sources.join(given, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            "source", "source_size", F.coalesce("weight", F.lit(0)).alias("weight")
        )
    weighted = materialise(weighted, "mix-weights")
    plan = water_fill(weighted, max_epochs=max_epochs)
    ratio = F.col("target") / F.col("source_size")
    plan = plan.select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(F.lit(0)).cast("bigint").alias("whole"),
    ).withColumn("extra", (F.floor("target") - F.col("whole") * F.col("source_size")).cast("bigint"))

    # Words ahead of each slice: those of the stretches before, and of the slices before in its stretch.
    stretch = F.substring("slice", 1, STRETCH_DIGITS).alias("stretch")
    stretches = slices.groupBy(F.col("source").alias("_s"), stretch.alias("_t")).agg(F.sum("words").alias("words"))
    before = Window.partitionBy("_s").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select("_s", "_t", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("source", "stretch").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = slices.withColumn("stretch", stretch).withColumn("ahead", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    placed = placed.join(stretches, F.col("source").eqNullSafe(F.col("_s")) & (F.col("stretch") == F.col("_t")))
    placed = placed.withColumn("ahead", F.col("ahead") + F.col("_before")).drop("_s", "_t", "_before")
    # Where a slice ends before the extra words do, all of it is taken once more.
    placed = placed.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    edge = placed.filter("ahead < extra AND extra < ahead + words").select(
        F.col("source").alias("_s"), F.col("slice").alias("edge_slice"), F.col("ahead").alias("edge_ahead")
    )
    plan = plan.join(edge, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
    # Where no slice is cut, the first slice not taken is the first that begins at the end of the extra words.
    full = placed.filter("ahead + words <= extra").groupBy(F.col("source").alias("_s")).agg(F.max("slice").alias("last_full"))
    return materialise(plan.join(full, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s"), "mix-plan")


def _with_taken(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows with ``source_size``, ``target`` and ``taken``: in place, but for those of the slices at an edge."""
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    at_edge = F.coalesce(F.col("slice") == F.col("edge_slice"), F.lit(False))
    once_more = F.when(F.coalesce(F.col("slice") <= F.col("last_full"), F.lit(False)), F.col("size")).otherwise(F.lit(0))
    outside = joined.filter(~at_edge).withColumn("more", once_more)
    inside = joined.filter(at_edge)
    so_far = Window.partitionBy("source", "slice").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("extra") - F.col("edge_ahead") - F.coalesce(F.sum("size").over(so_far), F.lit(0))
    inside = inside.withColumn("more", F.least(F.greatest(left, F.lit(0)), F.col("size")))
    both = outside.unionByName(inside).withColumn("taken", (F.col("whole") * F.col("size") + F.col("more")).cast("bigint"))
    return both.select(*sized.columns, "source_size", "target", "taken")


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words joined by a space."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), n.cast("int")), " ")


def draw(docs: DataFrame, weights: DataFrame | None = None, *, seed: int = 42, max_epochs: float = 3.0) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: each document as often as it is taken.

    Whole repetitions are equal rows; the part taken from a document at the edge of a source is a row with its
    first words. Documents of which nothing is taken, those without words among them, are not in the mix. Rows are decided one by
    one: they may repeat an id or have none, and rows alike in id and text are interchangeable. A NULL source is a source; no
    documents give no rows. Rows do not move, but for those of the slices at an edge, one in 65,536 of a source.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # no name can clash
    plan = _plan(materialise(_sized(docs, seed, "doc_id", "text", "source"), "mix-sizes"), weights, max_epochs)
    shares = _with_taken(_sized(docs, seed, "doc_id", "text", "source", row).drop("doc_id"), plan).filter("taken > 0")
    whole, part = F.floor(F.col("taken") / F.col("size")).cast("int"), F.col("taken") % F.col("size")
    takes = F.concat(F.array_repeat(F.col("size"), whole), F.array_repeat(part, F.when(part > 0, 1).otherwise(0)))
    each = shares.select("row", "size", F.explode(takes).alias("take"))
    text = F.col("row.text")
    text = F.when(F.col("take") < F.col("size"), first_words(text, F.col("take"))).otherwise(text)
    return each.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
