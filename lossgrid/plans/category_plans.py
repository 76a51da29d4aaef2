"""Queries on categories of any width: level numbers, sparse rows, scores of levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.operators import categories, selection
from lossgrid.plans.oracle import on_loans
from lossgrid.plans.registry import Query
from lossgrid.sources.loan_book import loan_book

CATEGORIES = ("segment", "member", "grade")
NUMBERS = ("dti", "open_acc", "pub_rec")


def wide_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans with a category of one level per borrower, some of them unknown, beside two narrow ones."""
    loans = loan_book(spark, sf_dir, "id", "y", "segment", "member_id", "grade", *NUMBERS)
    member = F.when(F.col("id") % 9 != 0, F.concat(F.lit("m"), F.col("member_id").cast("string")))
    segment = F.when(F.col("id") % 11 != 0, F.col("segment"))
    return loans.withColumns({"member": member, "segment": segment}).drop("member_id")


WIDE_CTE = (
    "wide AS (SELECT id, y, CASE WHEN id % 11 <> 0 THEN segment END AS segment, CASE WHEN id % 9 <> 0 THEN 'm' || member_id::VARCHAR END "
    "AS member, grade, " + ", ".join(NUMBERS) + " FROM loan)"
)
LEVELS_CTE = (
    "long AS (" + " UNION ALL ".join(f"SELECT id, y, {i} AS place, '{c}' AS feature, {c} AS level FROM wide" for i, c in enumerate(CATEGORIES)) + "), "
    "counts AS (SELECT place, feature, level, count(*) AS n, count_if(y = 1) AS n1 FROM long WHERE level IS NOT NULL GROUP BY ALL), "
    "numbered AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY level) - 1 AS level_id FROM counts), "
    "levels AS (SELECT *, CASE WHEN level_id > 0 THEN count_if(level_id > 0) OVER (ORDER BY place, level_id) - 1 END AS slot FROM numbered)"
)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = wide_loans(spark, sf_dir)
    levels = categories.level_table(loans, CATEGORIES)
    rows = categories.sparse_rows(loans, levels, cat_cols=CATEGORIES, num_cols=NUMBERS, keep=["id"])
    value = F.aggregate("entries", F.lit(0.0), lambda total, e: total + e["value"])
    return rows.select("id", F.size("entries").alias("n_entries"), F.array_join("entries.slot", ",").alias("slots"), value.alias("total"))


def _scores(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    # Borrowers have a handful of loans each, many with equal counts; the order among them is by name.
    return categories.level_scores(wide_loans(spark, sf_dir), label="y", cols=CATEGORIES, method=method, k=15).withColumnRenamed("column", "feature")


_MI_CELLS = (("n1", "n", "o"), ("n - n1", "n", "t - o"), ("o - n1", "t - n", "o"), ("t - o - n + n1", "t - n", "t - o"))
_MI = " + ".join(f"CASE WHEN {c} > 0 THEN ({c}) / t * ln(({c}) * t / (({s}) * ({k}))) ELSE 0e0 END" for c, s, k in _MI_CELLS)
_SQUARES = "(n1 * n1 / o + (n - n1) * (n - n1) / (t - o))"
_F = f"({_SQUARES} - n * n / t) / ((n - {_SQUARES}) / (t - 2))"


def _scores_sql(score: str) -> str:
    return on_loans(
        f"SELECT feature, level, {score} AS score FROM (SELECT feature, level, level_id, n::DOUBLE AS n, n1::DOUBLE AS n1, "
        "(SELECT count(*) FROM wide)::DOUBLE AS t, (SELECT count_if(y = 1) FROM wide)::DOUBLE AS o FROM levels) WHERE level_id > 0 "
        "ORDER BY score DESC NULLS LAST, feature, level LIMIT 15",
        WIDE_CTE, LEVELS_CTE,
    )


_ENTRY_SQL = " UNION ALL ".join(
    [f"SELECT id, {i} AS slot, {c}::DOUBLE AS value FROM wide WHERE {c} <> 0" for i, c in enumerate(NUMBERS)]
    + [f"SELECT id, {len(NUMBERS)} + slot, 1e0 FROM wide JOIN levels ON feature = '{c}' AND level = {c} WHERE slot IS NOT NULL" for c in CATEGORIES]
)
QUERIES = {
    "category_levels": Query(
        lambda s, d: categories.level_table(wide_loans(s, d), CATEGORIES),
        "feature:s level:s n:i level_id:i slot:i",
        on_loans("SELECT feature, level, n, level_id, slot FROM levels", WIDE_CTE, LEVELS_CTE),
    ),
    "sparse_rows": Query(
        _rows,
        "id:i n_entries:i slots:s total:6",
        on_loans(
            "SELECT w.id, count(slot) AS n_entries, coalesce(string_agg(slot::VARCHAR, ',' ORDER BY slot), '') AS slots, "
            "coalesce(sum(value), 0e0) AS total FROM wide w LEFT JOIN entries e ON e.id = w.id GROUP BY w.id",
            WIDE_CTE, LEVELS_CTE, f"entries AS ({_ENTRY_SQL})",
        ),
    ),
    "level_mutual_info": Query(lambda s, d: _scores(s, d, "mutual_info"), "feature:s level:s score:10", _scores_sql(_MI)),
    "level_anova_f": Query(lambda s, d: _scores(s, d, "anova"), "feature:s level:s score:7", _scores_sql(_F)),
    "select_with_levels": Query(
        lambda s, d: selection.select_features(wide_loans(s, d), label="y", method="anova", cols=NUMBERS, cat_cols=["segment", "grade"], k=8).select("feature", "level", "score"),
        "feature:s level:s score:7",
        on_loans(
            "SELECT feature, level, score FROM (SELECT feature || '_' || level AS feature, level, " + _F + " AS score FROM (SELECT feature, level, "
            "level_id, n::DOUBLE AS n, n1::DOUBLE AS n1, (SELECT count(*) FROM wide)::DOUBLE AS t, (SELECT count_if(y = 1) FROM wide)::DOUBLE AS o "
            "FROM levels) WHERE level_id > 0 AND feature <> 'member' UNION ALL SELECT feature, NULL, sum(n * (m - g) * (m - g)) / (sum(n * v) / "
            "(sum(n) - 2)) FROM (SELECT *, sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS g FROM (SELECT feature, y, "
            "count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM ("
            + " UNION ALL ".join(f"SELECT y, '{c}' AS feature, coalesce({c}::DOUBLE, 0e0) AS value FROM wide" for c in NUMBERS)
            + ") GROUP BY feature, y)) GROUP BY feature) ORDER BY score DESC NULLS LAST, feature LIMIT 8",
            WIDE_CTE, LEVELS_CTE,
        ),
    ),
}
