"""Categories of any width: levels are rows of a table with ordered numbers, not columns.

A column with millions of levels costs a grouped count and a distributed numbering; rows refer to levels by number, as
sparse (slot, value) entries, and scores of levels come from counts. Only levels that were chosen become columns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.operators.ordered import running_totals
from lossgrid.session import materialise


def _levels_of(df: DataFrame, cols: Sequence[str], *more: Column) -> DataFrame:
    """(feature, level, more) rows, one per row and column that has a value; a map-side generate."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("level")) for c in cols])
    return df.select(*more, F.inline(pairs)).filter(F.col("level").isNotNull())


def level_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """feature, level, n, level_id, slot: the levels of each column by code point, numbered from 0.

    ``slot`` numbers all levels of all columns, in the order of ``cols``, without the first level of each, which is NULL.
    NULL is no level; a column without values has none. The numbers come from prefix counts over ranges of the
    levels, so no task holds the levels of a column. Counts per column, a row each, come to the driver.
    """
    counts = _levels_of(df, cols).groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, "level-counts")
    placed = running_totals(counts, "level", {"n": F.col("n"), "one": F.lit(1)}, by=["feature"])
    width = {r["feature"]: r["width"] for r in counts.groupBy("feature").agg(F.count(F.lit(1)).alias("width")).collect()}
    first, offsets = 0, []
    for c in cols:
        if c in width:
            offsets += [F.lit(c), F.lit(first).cast("bigint")]
            first += width[c] - 1
    offset = F.try_element_at(F.create_map(*offsets), F.col("feature")) if offsets else F.lit(None).cast("bigint")
    level_id = F.col("one_upto") - 1
    slot = F.when(level_id > 0, offset + level_id - 1)
    return placed.select("feature", "level", "n", level_id.alias("level_id"), slot.alias("slot"))


def sparse_rows(
    df: DataFrame, levels: DataFrame, *, cat_cols: Sequence[str], num_cols: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """keep, entries: per row its non-zero (slot, value) pairs by slot, numbers first, then one for each category.

    Numeric column i has slot i; level slots follow. Missing numbers, zeros, missing categories, first levels and levels that
    the table lacks have no entry. Each column is joined with its levels; Spark broadcasts those that are small.
    """
    first = len(num_cols)
    out = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys((*keep, *num_cols, *cat_cols))])
    slots = []
    for i, c in enumerate(cat_cols):
        own = levels.filter((F.col("feature") == c) & F.col("slot").isNotNull())
        own = own.select(F.col("level").alias(f"_level{i}"), (F.col("slot") + first).alias(f"_slot{i}"))
        out = out.join(own, F.col(f"`{c}`").cast("string") == F.col(f"_level{i}"), "left")
        slots.append(F.col(f"_slot{i}"))
    number = [(F.lit(i).cast("bigint"), F.col(f"`{c}`").cast("double")) for i, c in enumerate(num_cols)]
    entry = [F.when(x != 0, F.struct(i.alias("slot"), x.alias("value"))) for i, x in number]
    entry += [F.when(s.isNotNull(), F.struct(s.alias("slot"), F.lit(1.0).alias("value"))) for s in slots]
    empty = F.array().cast("array<struct<slot:bigint,value:double>>")
    entries = F.array_sort(F.array_compact(F.array(*entry))) if entry else empty
    return out.select(*[F.col(f"`{c}`") for c in keep], entries.alias("entries"))


def level_scores(df: DataFrame, *, label: str, cols: Sequence[str], method: str = "mutual_info", k: int = 20) -> DataFrame:
    """The k levels whose 0/1 indicators tell most about a 0/1 label: column, level, level_id, score.

    From one grouped count of rows and positives per level; no indicator is formed. The score is the plug-in mutual
    information of the two, for any other method the F statistic of the indicator by class. The first level of a
    column, which the encoding leaves out, is not scored.
    """
    rows = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label).cast("int") == 1).alias("hits")).first()
    total, ones = float(rows["rows"]), float(rows["hits"])
    counts = _levels_of(df, cols, F.col(label).cast("int").alias("_y")).groupBy("feature", "level").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_y") == 1).alias("n1")
    )
    counts = materialise(counts, "level-scores")
    least = counts.groupBy(F.col("feature").alias("_feature")).agg(F.min("level").alias("_first"))
    scored = counts.join(F.broadcast(least), F.col("feature") == F.col("_feature")).filter("level <> _first")  # one row per column
    n, n1 = F.col("n").cast("double"), F.col("n1").cast("double")
    if method == "mutual_info":
        cells = [(n1, n, ones), (n - n1, n, total - ones), (ones - n1, total - n, ones), (total - ones - n + n1, total - n, total - ones)]
        score = F.lit(0.0)
        for cell, side, of_class in cells:
            score = score + F.when(cell > 0, cell / total * F.log(cell * total / (side * of_class))).otherwise(0.0)
    else:
        squares = (n1 * n1 / F.lit(ones) if ones else F.lit(0.0)) + ((n - n1) * (n - n1) / F.lit(total - ones) if total > ones else F.lit(0.0))
        between, within = squares - n * n / total, (n - squares) / (total - 2)
        score = F.try_divide(between, within) if 0 < ones < total and total > 2 else F.lit(None).cast("double")
    best = scored.select("feature", "level", score.alias("score")).orderBy(F.desc_nulls_last("score"), "feature", "level").limit(k)
    return best.select(F.col("feature").alias("column"), "level", "score")


def indicator_name(column: str, level: str) -> str:
    """Column name of a level; characters that could not stand in a name are written as their code points."""
    return f"{column}_" + re.sub(r"[^\w \-+/%:()]", lambda m: f"u{ord(m[0]):x}", level)


def indicators(chosen: Sequence[tuple[str, str]]) -> list[Column]:
    """0/1 columns of some (column, level) pairs; NULL gives 0."""
    return [
        F.coalesce(F.col(f"`{c}`").cast("string") == F.lit(level), F.lit(False)).cast("int").alias(indicator_name(c, level))
        for c, level in chosen
    ]
