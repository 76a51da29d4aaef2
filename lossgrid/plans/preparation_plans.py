"""Profiling, cleaning, feature, encoding, selection and split queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.operators import cleaning, encoding, features, neighbours, quality, selection, split
from lossgrid.plans.oracle import edge_bin, edge_list, long_form, on_loans, quantile_ctes
from lossgrid.plans.registry import Build, Query
from lossgrid.sources.loan_book import loan_book, read_table

PROFILE_COLUMNS = (
    "id", "segment", "loan_amnt", "funded_amnt", "annual_inc", "revol_util", "open_acc", "total_acc", "delinq_2yrs",
    "pub_rec", "mths_since_last_delinq", "grade", "loan_status",
)


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels: a table with repeated rows and a target that is often missing."""
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id", "left").select("doc_id", "lang", "source", "quality", "toxic")


DOCUMENTS_CTE = (
    "WITH docs AS (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d "
    "LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)


# --- profiling ---------------------------------------------------------------------------------------


def _quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(labelled_documents(spark, sf_dir).drop("doc_id"), target="quality")


def _missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_profile(loan_book(spark, sf_dir, *PROFILE_COLUMNS))


def _target_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.target_distribution(labelled_documents(spark, sf_dir), target="quality")


def _feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.feature_summary(loan_book(spark, sf_dir, *PROFILE_COLUMNS))


def _clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = labelled_documents(spark, sf_dir).drop("doc_id")
    table = table.withColumn("sparse", F.when(F.col("toxic") == 1, 1))
    return quality.clean_table(table, target="quality", missing_threshold=0.7)


def _high_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.high_cardinality(loan_book(spark, sf_dir, "id", "issue_d", "segment", "grade", "revol_util", "dti"))


_MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, "
    f"(count(*) - count({c})) * 100e0 / count(*) AS missing_pct FROM loan"
    for c in PROFILE_COLUMNS
)
_CELLS = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in PROFILE_COLUMNS)

PROFILE_QUERIES = {
    "quality_report": Query(
        _quality_report,
        "n_rows:i n_cols:i missing_values:i duplicate_rows:i target_rate:10",
        f"{DOCUMENTS_CTE}, u AS (SELECT DISTINCT lang, source, quality, toxic FROM docs) "
        "SELECT count(*) AS n_rows, 4 AS n_cols, count(*) * 4 - count(lang) - count(source) - count(quality) "
        "- count(toxic) AS missing_values, count(*) - (SELECT count(*) FROM u) AS duplicate_rows, "
        "avg(CASE WHEN quality IN (0, 1) THEN quality::DOUBLE END) AS target_rate FROM docs",
    ),
    "missing_profile": Query(
        _missing_profile,
        "column_name:s missing:i missing_pct:8",
        on_loans(f"SELECT * FROM ({_MISSING_SQL}) ORDER BY missing DESC, column_name LIMIT 10"),
    ),
    "target_distribution": Query(
        _target_distribution, "quality:i n:i", f"{DOCUMENTS_CTE} SELECT quality, count(*) AS n FROM docs GROUP BY quality"
    ),
    "feature_summary": Query(
        _feature_summary,
        "n_rows:i n_cols:i n_numeric:i n_categorical:i missing_values:i",
        on_loans(
            f"SELECT count(*) AS n_rows, {len(PROFILE_COLUMNS)} AS n_cols, 9 AS n_numeric, 4 AS n_categorical, "
            f"sum({_CELLS}) AS missing_values FROM loan"
        ),
    ),
    "clean_table": Query(
        _clean_table,
        "lang:s source:s quality:i toxic:i",
        f"{DOCUMENTS_CTE} SELECT DISTINCT lang, source, quality, toxic FROM docs WHERE quality IS NOT NULL",
    ),
    "high_cardinality": Query(
        _high_cardinality,
        "column_name:s n_distinct:i",
        on_loans(
            "SELECT * FROM (SELECT 'issue_d' AS column_name, count(DISTINCT issue_d) AS n_distinct FROM loan UNION ALL "
            "SELECT 'segment', count(DISTINCT segment) FROM loan UNION ALL SELECT 'grade', count(DISTINCT grade) "
            "FROM loan UNION ALL SELECT 'revol_util', count(DISTINCT revol_util) FROM loan) WHERE n_distinct > 50"
        ),
    ),
}

# --- cleaning ----------------------------------------------------------------------------------------


def _dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = loan_book(spark, sf_dir, "id", "member_id", "loan_amnt", "loan_status")
    again = loans.filter(F.col("id") % 10 == 0).withColumn("loan_amnt", F.col("loan_amnt") + 1.0)
    # Loans without a key: one of them remains.
    unkeyed = loans.filter(F.col("id") % 4 == 0).withColumns(
        {"id": F.lit(None).cast("bigint"), "member_id": F.lit(None).cast("bigint")}
    )
    return cleaning.dedup_loans(loans.unionByName(again).unionByName(unkeyed), order_by=["loan_amnt"])


def _drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = loan_book(spark, sf_dir, "id", "member_id", "int_rate", "grade", "loan_amnt", "dti", "outstanding", "issue_d")
    loans = loans.withColumnsRenamed({"outstanding": "out_prncp", "issue_d": "last_credit_pull_d"})
    kept = cleaning.drop_columns(loans)
    assert kept.columns == ["loan_amnt", "dti"], kept.columns
    return kept


def _drop_leaky(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = loan_book(spark, sf_dir, "id", "loan_amnt", "fico_range_low", "fico_range_high", "outstanding")
    renamed = {
        "fico_range_low": "last_fico_range_low", "fico_range_high": "last_fico_range_high", "outstanding": "total_pymnt",
    }
    kept = cleaning.drop_leaky_extras(loans.withColumnsRenamed(renamed))
    assert kept.columns == ["id", "loan_amnt"], kept.columns
    return kept


def _negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.negatives_to_null(loan_book(spark, sf_dir, "id", "annual_inc", "revol_bal", "dti"))


def _cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cap_outliers(loan_book(spark, sf_dir, "id", "annual_inc", "revol_bal", "dti"))


def _prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = (
        "id member_id loan_amnt funded_amnt installment annual_inc revol_util revol_bal dti issue_d earliest_cr_line "
        "loan_status int_rate grade fico_range_low fico_range_high open_acc total_acc mths_since_last_delinq outstanding"
    ).split()
    loans = loan_book(spark, sf_dir, *columns).withColumnRenamed("outstanding", "out_prncp")
    return cleaning.prepare_loans(loans)


PREPARE_SQL = on_loans(
    "SELECT loan_amnt, funded_amnt, installment, a AS annual_inc, revol_util, b AS revol_bal, d AS dti, issue_d, "
    "earliest_cr_line, fico_range_low, fico_range_high, open_acc, total_acc, "
    "coalesce(mths_since_last_delinq, 0) AS mths_since_last_delinq, "
    "CASE WHEN mths_since_last_delinq IS NULL THEN 1 ELSE 0 END AS mths_since_last_delinq_missing, "
    "CASE WHEN revol_util IS NULL THEN 1 ELSE 0 END AS revol_util_missing, "
    "CASE WHEN dti IS NULL THEN 1 ELSE 0 END AS dti_missing, "
    "CASE WHEN annual_inc IS NULL THEN 1 ELSE 0 END AS annual_inc_missing, "
    '"default", (fico_range_low + fico_range_high) / 2e0 AS fico_avg, '
    "date_diff('day', earliest_cr_line, issue_d) / 30.44e0 AS credit_history_len_months, "
    "installment / (a / 12e0) AS pmt_to_inc, ln(1e0 + a) AS log_annual_inc FROM ("
    "SELECT f.*, least(greatest(annual_inc, qa.q0), qa.q1) * CASE WHEN annual_inc IS NOT NULL THEN 1 END AS a, "
    "least(greatest(revol_bal, qb.q0), qb.q1) * CASE WHEN revol_bal IS NOT NULL THEN 1 END AS b, "
    "least(greatest(dti, qd.q0), qd.q1) AS d, "
    "CASE loan_status WHEN 'Fully Paid' THEN 0 WHEN 'Charged Off' THEN 1 END AS \"default\" "
    "FROM filtered f, (SELECT * FROM q WHERE feature = 'annual_inc') qa, "
    "(SELECT * FROM q WHERE feature = 'revol_bal') qb, (SELECT * FROM q WHERE feature = 'dti') qd) "
    'WHERE "default" IS NOT NULL',
    "cleaned AS (SELECT loan_amnt, CASE WHEN funded_amnt IS NOT NULL THEN least(funded_amnt, loan_amnt) END AS funded_amnt, "
    "installment, CASE WHEN annual_inc >= 0 THEN annual_inc END AS annual_inc, "
    "CAST(replace(revol_util, '%', '') AS DOUBLE) / 100e0 AS revol_util, "
    "CASE WHEN revol_bal >= 0 THEN revol_bal END AS revol_bal, dti, date_trunc('month', issue_ts)::DATE AS issue_d, "
    "date_trunc('month', earliest_ts)::DATE AS earliest_cr_line, loan_status, fico_range_low, fico_range_high, "
    "open_acc, total_acc, mths_since_last_delinq FROM loan), "
    "filtered AS (SELECT * FROM cleaned WHERE (annual_inc IS NULL OR annual_inc > 0) AND (dti IS NULL OR dti <= 999))",
    quantile_ctes(long_form(["annual_inc", "revol_bal", "dti"], source="filtered"), [0.01, 0.99], "q"),
)
PREPARE_SPEC = (
    "loan_amnt:2 funded_amnt:2 installment:6 annual_inc:5 revol_util:6 revol_bal:5 dti:6 issue_d:d earliest_cr_line:d "
    "fico_range_low:2 fico_range_high:2 open_acc:i total_acc:i mths_since_last_delinq:i mths_since_last_delinq_missing:i "
    "revol_util_missing:i dti_missing:i annual_inc_missing:i default:i fico_avg:4 credit_history_len_months:8 "
    "pmt_to_inc:6 log_annual_inc:8"
)


def _on(columns: str, operator) -> Build:
    """The operator on the named loan columns."""
    return lambda spark, sf_dir: operator(loan_book(spark, sf_dir, *columns.split()))


CLEANING_QUERIES = {
    "dedup_loans": Query(
        _dedup,
        "id:i member_id:i loan_amnt:2 loan_status:s",
        on_loans(
            "SELECT id, member_id, loan_amnt, loan_status FROM (SELECT *, row_number() OVER (PARTITION BY id, member_id "
            "ORDER BY loan_amnt, loan_status) AS rn FROM (SELECT id, member_id, loan_amnt, loan_status FROM loan "
            "UNION ALL SELECT id, member_id, loan_amnt + 1e0, loan_status FROM loan WHERE id % 10 = 0 UNION ALL "
            "SELECT NULL, NULL, loan_amnt, loan_status FROM loan WHERE id % 4 = 0)) WHERE rn = 1"
        ),
    ),
    "drop_columns": Query(_drop_columns, "loan_amnt:2 dti:2", on_loans("SELECT loan_amnt, dti FROM loan")),
    "drop_leaky_extras": Query(_drop_leaky, "id:i loan_amnt:2", on_loans("SELECT id, loan_amnt FROM loan")),
    "parse_percent": Query(
        _on("id revol_util", cleaning.parse_percent),
        "id:i revol_util:6",
        on_loans("SELECT id, try_cast(trim(replace(revol_util, '%', '')) AS DOUBLE) / 100e0 AS revol_util FROM loan"),
    ),
    "parse_month": Query(
        _on("id issue_d earliest_cr_line", cleaning.parse_month),
        "id:i issue_d:d earliest_cr_line:d",
        on_loans(
            "SELECT id, try_strptime(issue_d, '%b-%Y')::DATE AS issue_d, "
            "try_strptime(earliest_cr_line, '%b-%Y')::DATE AS earliest_cr_line FROM loan"
        ),
    ),
    "cap_funded_at_requested": Query(
        _on("id loan_amnt funded_amnt", cleaning.cap_funded_at_requested),
        "id:i funded_amnt:2",
        on_loans("SELECT id, CASE WHEN funded_amnt IS NOT NULL THEN least(funded_amnt, loan_amnt) END AS funded_amnt FROM loan"),
    ),
    "negatives_to_null": Query(
        _negatives,
        "id:i annual_inc:4 revol_bal:4 dti:4",
        on_loans(
            "SELECT id, CASE WHEN annual_inc >= 0 THEN annual_inc END AS annual_inc, "
            "CASE WHEN revol_bal >= 0 THEN revol_bal END AS revol_bal, dti FROM loan"
        ),
    ),
    "filter_income_dti": Query(
        _on("id annual_inc dti", cleaning.filter_income_dti),
        "id:i annual_inc:4 dti:4",
        on_loans(
            "SELECT id, annual_inc, dti FROM loan WHERE (annual_inc IS NULL OR annual_inc > 0) AND (dti IS NULL OR dti <= 999)"
        ),
    ),
    "cap_outliers": Query(
        _cap,
        "id:i annual_inc:5 revol_bal:5 dti:5",
        on_loans(
            "SELECT id, least(greatest(annual_inc, qa.q0), qa.q1) AS annual_inc, "
            "least(greatest(revol_bal, qb.q0), qb.q1) AS revol_bal, least(greatest(dti, qd.q0), qd.q1) AS dti "
            "FROM loan, (SELECT * FROM q WHERE feature = 'annual_inc') qa, "
            "(SELECT * FROM q WHERE feature = 'revol_bal') qb, (SELECT * FROM q WHERE feature = 'dti') qd",
            quantile_ctes(long_form(["annual_inc", "revol_bal", "dti"]), [0.01, 0.99], "q"),
        ),
    ),
    "missing_flags_fill0": Query(
        _on("id mths_since_last_delinq", cleaning.missing_flags_fill0),
        "id:i mths_since_last_delinq:i mths_since_last_delinq_missing:i",
        on_loans(
            "SELECT id, coalesce(mths_since_last_delinq, 0) AS mths_since_last_delinq, "
            "CASE WHEN mths_since_last_delinq IS NULL THEN 1 ELSE 0 END AS mths_since_last_delinq_missing FROM loan"
        ),
    ),
    "missing_flags_only": Query(
        _on("id revol_util dti annual_inc", cleaning.missing_flags_only),
        "id:i revol_util:s revol_util_missing:i dti_missing:i annual_inc_missing:i",
        on_loans(
            "SELECT id, revol_util, CASE WHEN revol_util IS NULL THEN 1 ELSE 0 END AS revol_util_missing, "
            "CASE WHEN dti IS NULL THEN 1 ELSE 0 END AS dti_missing, "
            "CASE WHEN annual_inc IS NULL THEN 1 ELSE 0 END AS annual_inc_missing FROM loan"
        ),
    ),
    "map_default_target": Query(
        _on("id loan_status", cleaning.map_default_target),
        "id:i default:i",
        on_loans(
            "SELECT id, CASE loan_status WHEN 'Fully Paid' THEN 0 ELSE 1 END AS \"default\" FROM loan "
            "WHERE loan_status IN ('Fully Paid', 'Charged Off')"
        ),
    ),
    "prepare_loans": Query(_prepare, PREPARE_SPEC, PREPARE_SQL),
}

# --- derived features --------------------------------------------------------------------------------


def _feature(columns: str, operator, spec: str, sql: str) -> Query:
    """One feature per loan."""
    return Query(_on(f"id {columns}", operator), f"id:i {spec}", on_loans(f"SELECT id, {sql} FROM loan"))


def _banded(df: DataFrame) -> DataFrame:
    return features.fico_band(features.fico_avg(df))


def _with_util(df: DataFrame) -> DataFrame:
    return features.interaction_features(cleaning.parse_percent(df))


FICO = "(fico_range_low + fico_range_high) / 2e0"
FEATURE_QUERIES = {
    "feat_fico_avg": _feature("fico_range_low fico_range_high", features.fico_avg, "fico_avg:4", f"{FICO} AS fico_avg"),
    "feat_credit_history_months": _feature(
        "issue_ts earliest_ts",
        lambda df: features.credit_history_months(df, issued="issue_ts", opened="earliest_ts"),
        "credit_history_len_months:8",
        "date_diff('day', earliest_ts, issue_ts) / 30.44e0 AS credit_history_len_months",
    ),
    "feat_pmt_to_inc": _feature(
        "installment annual_inc", features.payment_to_income, "pmt_to_inc:6",
        "CASE WHEN annual_inc <> 0 THEN installment / (annual_inc / 12e0) END AS pmt_to_inc",
    ),
    "feat_log_income": _feature(
        "annual_inc", lambda df: features.log_income(cleaning.negatives_to_null(df)), "log_annual_inc:8",
        "CASE WHEN annual_inc >= 0 THEN ln(1e0 + annual_inc) END AS log_annual_inc",
    ),
    "feat_grade_num": _feature(
        "grade", features.grade_number, "grade_num:i", "nullif(instr('ABCDEFG', grade), 0) AS grade_num"
    ),
    "feat_line_utilization": _feature(
        "open_acc total_acc", features.line_utilization, "utilization_of_credit_lines:10",
        "open_acc / CASE WHEN total_acc = 0 THEN 1e0 ELSE total_acc END AS utilization_of_credit_lines",
    ),
    "feat_loan_to_income": _feature(
        "loan_amnt annual_inc", features.loan_to_income, "loan_to_income:6",
        "loan_amnt / CASE WHEN annual_inc = 0 THEN 1e0 ELSE annual_inc END AS loan_to_income",
    ),
    "feat_residual_income": _feature(
        "annual_inc installment", features.residual_income, "monthly_residual_income:6",
        "annual_inc / 12e0 - installment AS monthly_residual_income",
    ),
    "feat_fico_band": _feature(
        "fico_range_low fico_range_high", _banded, "fico_band:s fico_band_order:i",
        f"CASE WHEN {FICO} <= 0 THEN NULL WHEN {FICO} <= 580 THEN 'Poor' WHEN {FICO} <= 670 THEN 'Fair' WHEN {FICO} <= 740 "
        f"THEN 'Good' WHEN {FICO} <= 800 THEN 'Very Good' WHEN {FICO} <= 850 THEN 'Exceptional' END AS fico_band, "
        f"CASE WHEN {FICO} <= 0 OR {FICO} > 850 THEN NULL ELSE 1 + ({FICO} > 580)::INT + ({FICO} > 670)::INT "
        f"+ ({FICO} > 740)::INT + ({FICO} > 800)::INT END AS fico_band_order",
    ),
    "feat_dti_x_util": _feature(
        "dti revol_util", _with_util, "dti_x_util:6",
        "dti * (CAST(replace(revol_util, '%', '') AS DOUBLE) / 100e0) AS dti_x_util",
    ),
    "feat_cost_of_credit": _feature(
        "loan_amnt int_rate", features.interaction_features, "cost_of_credit:4", "loan_amnt * int_rate AS cost_of_credit"
    ),
    "feat_clean_record": _feature(
        "delinq_2yrs pub_rec", features.behavioral_features, "clean_record:i",
        "CASE WHEN coalesce(delinq_2yrs, 0) + coalesce(pub_rec, 0) = 0 THEN 1 ELSE 0 END AS clean_record",
    ),
    "feat_high_inquiry": _feature(
        "inq_last_6mths", features.behavioral_features, "high_inquiry_activity:i",
        "CASE WHEN inq_last_6mths > 2 THEN 1 ELSE 0 END AS high_inquiry_activity",
    ),
}

# --- imputation, encoding, selection, split ----------------------------------------------------------

IMPUTED = ("mths_since_last_delinq", "open_acc", "delinq_2yrs", "pub_rec", "dti")
SCORED = (
    "dti", "fico_range_low", "exposure", "annual_inc", "inq_last_6mths", "mths_since_last_delinq", "open_acc", "pd_12m",
    "original_pd", "dpd",
)
CORRELATED = ("loan_amnt", "funded_amnt", "annual_inc", "revol_bal", "open_acc", "mths_since_last_delinq")
BINS = 10


def _impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.impute_median(loan_book(spark, sf_dir, "id", *IMPUTED), cols=IMPUTED)


def _gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = loan_book(spark, sf_dir, "id", "segment", "grade", "revol_util", "issue_ts")
    return loans.withColumn("segment", F.when(F.col("id") % 11 != 0, F.col("segment"))).withColumn(
        "issued", F.when(F.col("id") % 5 != 0, F.col("issue_ts").cast("date"))
    ).drop("issue_ts")


def _impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.impute_mode(_gapped(spark, sf_dir))


def _one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.one_hot(_gapped(spark, sf_dir).select("id", "segment", "grade"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_book(spark, sf_dir, "y", *SCORED)


def _mode_sql(col: str, source: str = "gapped") -> str:
    return (
        f"(SELECT {col} FROM {source} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)"
    )


GAPPED_CTE = (
    "gapped AS (SELECT id, CASE WHEN id % 11 <> 0 THEN segment END AS segment, grade, revol_util, "
    "CASE WHEN id % 5 <> 0 THEN issue_ts::DATE END AS issued FROM loan)"
)
SEGMENTS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
GRADES = ("B", "C", "D", "E")
FILLED_CTE = (
    "filled AS (SELECT y, " + ", ".join(f"coalesce({c}::DOUBLE, 0e0) AS {c}" for c in SCORED) + " FROM loan)"
)
ANOVA_SQL = on_loans(
    "SELECT feature, (sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS score FROM "
    "(SELECT *, sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS g FROM "
    "(SELECT feature, y, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM long GROUP BY feature, y)) "
    "GROUP BY feature ORDER BY score DESC, feature LIMIT 5",
    FILLED_CTE,
    f"long AS ({long_form(SCORED, ['y'], 'filled')})",
)
MI_SQL = on_loans(
    "SELECT feature, sum(c / t * ln(c * t / (nb * ny))) AS score FROM (SELECT feature, bin, y, count(*)::DOUBLE AS c, "
    "sum(count(*)) OVER (PARTITION BY feature, bin)::DOUBLE AS nb, sum(count(*)) OVER (PARTITION BY feature, y)::DOUBLE "
    "AS ny, sum(count(*)) OVER (PARTITION BY feature)::DOUBLE AS t FROM "
    f"(SELECT l.feature, l.y, coalesce({edge_bin('l.value')}, 0) AS bin FROM long l JOIN edges e USING (feature)) "
    "GROUP BY feature, bin, y) GROUP BY feature ORDER BY score DESC, feature LIMIT 8",
    FILLED_CTE,
    f"long AS ({long_form(SCORED, ['y'], 'filled')})",
    quantile_ctes("SELECT feature, value FROM long", [i / BINS for i in range(BINS + 1)], "q"),
    f"edges AS (SELECT feature, {edge_list(BINS)} AS edges FROM q)",
)
_NEAR = ", ".join(f"value - lag(value, {i}) OVER w, lead(value, {i}) OVER w - value" for i in range(1, 4))
NEIGHBOUR_SQL = on_loans(
    "SELECT feature, greatest(0e0, (SELECT psi FROM digammas WHERE i = any_value(big)) + avg(pk.psi - pc.psi - pm.psi)) AS score FROM ranked "
    "JOIN digammas pk ON pk.i = k JOIN digammas pc ON pc.i = n_class JOIN digammas pm ON pm.i = m "
    "GROUP BY feature ORDER BY score DESC, feature LIMIT 8",
    FILLED_CTE,
    f"long AS ({long_form(SCORED, ['y'], 'filled')})",
    "near AS (SELECT *, list_sort(list_filter(gaps, lambda g: g IS NOT NULL))[least(3, n_class - 1)] AS r FROM (SELECT *, "
    f"[{_NEAR}] AS gaps, count(*) OVER (PARTITION BY feature, y) AS n_class, count(*) OVER (PARTITION BY feature, y, value) AS twins, "
    "count(*) OVER (PARTITION BY feature, value) AS equals, count(*) OVER (PARTITION BY feature) AS big FROM long "
    "WINDOW w AS (PARTITION BY feature, y ORDER BY value)))",
    "upto AS (SELECT feature, value AS v, sum(count(*)) OVER (PARTITION BY feature ORDER BY value) AS rows FROM long GROUP BY feature, value)",
    "below AS (SELECT near.*, value + r AS high, coalesce(u.rows, 0) AS lost FROM near ASOF LEFT JOIN upto u "
    "ON near.feature = u.feature AND near.value - r >= u.v)",
    "ranked AS (SELECT below.feature, big, n_class, CASE WHEN r > 0 THEN least(3, n_class - 1) ELSE twins END AS k, "
    "CASE WHEN r > 0 THEN u.rows - lost ELSE equals END AS m FROM below ASOF LEFT JOIN upto u ON below.feature = u.feature AND below.high > u.v)",
    "digammas AS (SELECT i, sum(CASE WHEN i > 1 THEN 1e0 / (i - 1) ELSE 0e0 END) OVER (ORDER BY i) - 0.5772156649015329e0 AS psi "
    "FROM range(1, (SELECT count(*) + 1 FROM loan)) t(i))",
)
_CORR_PAIRS = [(a, b) for a in CORRELATED for b in CORRELATED]
SPLIT_HASH = "('0x' || substr(md5('42|' || id::VARCHAR), 1, 13))::BIGINT"

MODEL_INPUT_QUERIES = {
    "impute_median": Query(
        _impute_median,
        "id:i " + " ".join(f"{c}:4" for c in IMPUTED),
        on_loans(
            "SELECT id, " + ", ".join(
                f"coalesce({c}::DOUBLE, (SELECT q0 FROM q WHERE feature = '{c}')) AS {c}" for c in IMPUTED
            ) + " FROM loan",
            quantile_ctes(long_form(IMPUTED), [0.5], "q"),
        ),
    ),
    "impute_mode": Query(
        _impute_mode,
        "id:i segment:s grade:s revol_util:s issued:d",
        on_loans(
            "SELECT id, " + ", ".join(
                f"coalesce({c}, {_mode_sql(c)}) AS {c}" for c in ("segment", "grade", "revol_util", "issued")
            ) + " FROM gapped",
            GAPPED_CTE,
        ),
    ),
    "one_hot": Query(
        _one_hot,
        "id:i " + " ".join(f"segment_{s}:i" for s in SEGMENTS) + " " + " ".join(f"grade_{g}:i" for g in GRADES),
        on_loans(
            "SELECT id, " + ", ".join(f"coalesce((segment = '{s}')::INT, 0) AS \"segment_{s}\"" for s in SEGMENTS) + ", "
            + ", ".join(f"coalesce((grade = '{g}')::INT, 0) AS \"grade_{g}\"" for g in GRADES) + " FROM gapped",
            GAPPED_CTE,
        ),
    ),
    "select_mutual_info": Query(
        lambda spark, sf_dir: selection.select_mutual_info(_scored(spark, sf_dir), label="y", k=8),
        "feature:s score:10", MI_SQL,
    ),
    "select_neighbour_info": Query(
        lambda spark, sf_dir: neighbours.neighbour_mutual_info(_scored(spark, sf_dir), label="y", k=8),
        "feature:s score:8", NEIGHBOUR_SQL,
    ),
    "select_anova_f": Query(
        lambda spark, sf_dir: selection.select_anova_f(_scored(spark, sf_dir), label="y", k=5),
        "feature:s score:7", ANOVA_SQL,
    ),
    "target_correlation_topk": Query(
        lambda spark, sf_dir: selection.target_correlation_topk(_scored(spark, sf_dir), label="y", k=5),
        "feature:s corr:10",
        on_loans(
            "SELECT * FROM (" + " UNION ALL ".join(
                f"SELECT '{c}' AS feature, corr({c}::DOUBLE, y::DOUBLE) AS corr FROM loan" for c in SCORED
            ) + ") ORDER BY abs(corr) DESC, feature LIMIT 5"
        ),
    ),
    "correlation_matrix": Query(
        lambda spark, sf_dir: selection.correlation_matrix(loan_book(spark, sf_dir, *CORRELATED)),
        "feature_a:s feature_b:s corr:9",
        on_loans(
            " UNION ALL ".join(
                f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}::DOUBLE, {b}::DOUBLE) AS corr FROM loan"
                for a, b in _CORR_PAIRS
            )
        ),
    ),
    "stratified_split": Query(
        lambda spark, sf_dir: split.stratified_split(loan_book(spark, sf_dir, "id", "y"), key="id", label="y"),
        "id:i y:i split:s",
        on_loans(
            "SELECT id, y, CASE WHEN rk <= floor(n * 0.3e0 + 0.5e0) THEN 'test' WHEN rk <= floor(n * 0.3e0 + 0.5e0) "
            "+ floor(n * 0.2e0 + 0.5e0) THEN 'val' ELSE 'train' END AS split FROM (SELECT id, y, "
            f"row_number() OVER (PARTITION BY y ORDER BY {SPLIT_HASH}, id) AS rk, count(*) OVER (PARTITION BY y) AS n FROM loan)"
        ),
    ),
}

QUERIES = {**PROFILE_QUERIES, **CLEANING_QUERIES, **FEATURE_QUERIES, **MODEL_INPUT_QUERIES}
