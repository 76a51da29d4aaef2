"""Model training, calibration and scoring queries, and the source and sink round trips."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lossgrid.operators import discrimination, impairment, models, quality, split
from lossgrid.plans.impairment_plans import STAGED_CTE, loans_with_ecl
from lossgrid.plans.oracle import long_form, on_loans, quantile_ctes
from lossgrid.plans.portfolio_job import all_rows, run_portfolio_job
from lossgrid.plans.preparation_plans import SPLIT_HASH
from lossgrid.plans.registry import Query
from lossgrid.session import materialise, scratch_dir
from lossgrid.sources.loan_book import loan_book, read_table
from lossgrid.sources.loan_csv import DELINQUENCY_TARGET, dataset_metadata, read_delinquency_csv, read_loans_dir
from lossgrid.sources.sinks import write_results

NUMERIC = ["exposure", "pd_12m", "dti", "mths_since_last_delinq", "annual_inc"]
CATEGORIES = ["segment", "grade"]
SCALED = ("exposure", "mths_since_last_delinq", "annual_inc")


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans with a learnable default label (arrears and PD drive it, a hash of the key adds noise)."""
    loans = loan_book(spark, sf_dir, "id", "dpd", *NUMERIC, *CATEGORIES)
    noise = (F.col("id") * 48271 % 1009) / 1009.0
    chance = F.col("pd_12m") + F.when(F.col("grade").isin("D", "E"), 0.15).otherwise(0.0)
    return loans.withColumn("default", (noise < chance).cast("int"))


def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once, since every fit reads it many times."""
    return materialise(split.stratified_split(model_table(spark, sf_dir), key="id", label="default"), "split")


def _part(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("split") == name)


def _scored(model, df: DataFrame, *keep: str) -> DataFrame:
    return models.score_pd(model, df, keep=["id", "default", *keep])


def _logistic(spark: SparkSession, sf_dir: str):
    data = split_table(spark, sf_dir)
    return models.train_logistic(_part(data, "train"), label="default", num_cols=NUMERIC, cat_cols=CATEGORIES), data


def _conditions_hold(model, df: DataFrame, weight: Column, penalty: float, tolerance: float = 5e-3) -> Column:
    """Whether the first-order conditions of a logistic fit hold on the table it was fitted on, as a scalar.

    Per slot of the feature vector: mean of weight * (probability - label) * feature, plus penalty * coefficient.
    """
    last = model.stages[-1]
    residual = weight * (vector_to_array("probability")[1] - F.col("default"))
    slots = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))  # the last one is the intercept
    shares = F.array(*[F.lit(float(penalty * c)) for c in [*last.coefficients, 0.0]])
    rows = model.transform(df).select(residual.alias("r"), F.posexplode(slots).alias("slot", "x"))
    sums = rows.groupBy("slot").agg(F.avg(F.col("r") * F.col("x")).alias("mean"))
    off = F.abs(F.col("mean") + F.get(shares, F.col("slot")))
    return sums.agg((F.max(off) < tolerance).alias("ok")).scalar()


def _fit_summary(scored: DataFrame) -> DataFrame:
    """Counts of the test part; whether PDs lie in [0, 1] and rank better than the best single column; labels at 0.5."""
    single = discrimination.auc_ks(scored, score="pd_12m", label="default").select("auc_roc").scalar()
    model = discrimination.auc_ks(scored, score="pd", label="default").select("auc_roc").scalar()
    labelled = discrimination.predicted_label(scored, score="pd")
    test = F.col("split") == "test"
    return labelled.agg(
        F.count_if(test).alias("n_test"),
        F.sum(F.when(test, F.col("default"))).alias("positives"),
        F.bool_and(F.col("pd").between(0, 1)).alias("pd_in_range"),
        F.bool_and((F.col("pd") >= 0.5) == (F.col("prediction") == 1)).alias("labels_at_half"),
    ).withColumn("ranks_better_than_one_column", model > single)


def _train_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, data = _logistic(spark, sf_dir)
    train = _part(data, "train")
    pos, neg = train.agg(F.count_if(F.col("default") == 1), F.count_if(F.col("default") == 0)).first()
    weight = F.when(F.col("default") == 1, (pos + neg) / (2.0 * max(pos, 1))).otherwise((pos + neg) / (2.0 * max(neg, 1)))
    found = _fit_summary(_scored(model, data, "split", "pd_12m"))
    return found.withColumn("conditions_hold", _conditions_hold(model, train, weight, 1.0 / max(pos + neg, 1)))


def _train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = split_table(spark, sf_dir)
    model = models.train_gbt(_part(data, "train"), label="default", num_cols=NUMERIC, cat_cols=CATEGORIES)
    # Hundreds of trees are walked once per loan, by all cores: the table's files may be few.
    spread = data.repartition(spark.sparkContext.defaultParallelism)
    return _fit_summary(materialise(_scored(model, spread, "split", "pd_12m"), "scores"))


def _score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test loans scored by the model and by its saved and loaded copy."""
    model, data = _logistic(spark, sf_dir)
    path = scratch_dir(spark, "model")
    models.save_model(model, path)
    test = _part(data, "test")
    both = models.score_pd(models.load_model(path), _scored(model, test, *NUMERIC, *CATEGORIES), out="again")
    return both.select(
        "id", "default", F.col("pd").between(0, 1).alias("pd_in_range"), (F.abs(F.col("pd") - F.col("again")) < 1e-12).alias("survives_saving")
    )


def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features by name; tests look at their order."""
    model, data = _logistic(spark, sf_dir)
    names = models.feature_names(model, data, num_cols=NUMERIC, cat_cols=CATEGORIES)
    found = models.feature_importance(model, names, k=len(names))
    return found.select("feature", F.col("importance").between(0, 1e6).alias("in_range"))


def _driven_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two strongest features, in order, of a label that exposure drives and debt to income drives less."""
    loans = model_table(spark, sf_dir)

    def spread(c: str) -> Column:
        centre, width = (loans.agg(f(c).alias("v")).select("v").scalar() for f in (F.avg, F.stddev))
        return F.coalesce(F.tanh((F.col(c) - centre) / width), F.lit(0.0))

    noise = (F.col("id") * 48271 % 1009) / 1009.0
    chance = F.lit(0.5) + spread("exposure") * 0.35 + spread("dti") * 0.15
    data = materialise(loans.withColumn("driven", (noise < chance).cast("int")), "driven")
    model = models.train_logistic(data, label="driven", num_cols=NUMERIC, cat_cols=CATEGORIES)
    names = models.feature_names(model, data, num_cols=NUMERIC, cat_cols=CATEGORIES)
    found = models.feature_importance(model, names, k=2)
    return found.withColumn("place", F.row_number().over(Window.orderBy(F.desc("importance"), "feature")))


def raw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncalibrated scores: three times too high at the low end."""
    table = model_table(spark, sf_dir)
    return table.select("id", "default", F.sqrt(F.col("pd_12m") / 0.4).alias("score"), (F.col("id") % 2).alias("half"))


def _calibrated(method) -> object:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = method(raw_scores(spark, sf_dir), score="score", label="default")
        return models.brier_improvement(out, label="default", before="score", after="calibrated")

    return build


def _pd_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three methods learnt on one half of the loans and applied to the other."""
    table = materialise(raw_scores(spark, sf_dir), "scores")
    known, new = table.filter("half = 0"), table.filter("half = 1").select("id", "default", "score")
    for method in models.CALIBRATION_METHODS:
        new = models.pd_calibration(new, known, score="score", label="default", method=method, out=f"pd_{method}")
    return new.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("default").alias("default_rate"),
        *[F.avg(f"pd_{m}").alias(f"mean_{m}") for m in models.CALIBRATION_METHODS],
        *[F.min(f"pd_{m}").alias(f"min_{m}") for m in models.CALIBRATION_METHODS],
        *[F.max(f"pd_{m}").alias(f"max_{m}") for m in models.CALIBRATION_METHODS],
    )


def _fit_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.classification import LogisticRegression

    data = materialise(model_table(spark, sf_dir), "features")
    estimator = LogisticRegression(labelCol="default")
    model = models.fit_pipeline(data, estimator, num_cols=NUMERIC, cat_cols=CATEGORIES)
    found = models.score_pd(model, data, keep=["id", "default"]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("default").alias("positives"), F.avg("pd").alias("mean_pd")
    )
    return found.withColumn("conditions_hold", _conditions_hold(model, data, F.lit(1.0), 0.0))


def _portfolio_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain from raw loans to written ECL, all result tables as one; open loans drop out by their status."""
    columns = (
        "id member_id loan_amnt funded_amnt installment annual_inc revol_util revol_bal dti issue_d earliest_cr_line "
        "loan_status grade fico_range_low fico_range_high open_acc total_acc delinq_2yrs pub_rec inq_last_6mths "
        "mths_since_last_delinq segment exposure lgd original_pd term_years dpd int_rate"
    ).split()
    results = run_portfolio_job(
        loan_book(spark, sf_dir, *columns), key="id", exposure="exposure", lgd="lgd", original_pd="original_pd",
        term_years="term_years", dpd="dpd", income_rate="int_rate", path=scratch_dir(spark, "portfolio"), as_of="2024-01-31",
    )
    return all_rows(results)


# --- sources and sinks -------------------------------------------------------------------------------


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan book as a tree of CSV files, read back by name."""
    root = scratch_dir(spark, "loans")
    loans = loan_book(spark, sf_dir, "id", "loan_amnt", "annual_inc", "revol_util", "grade", "mths_since_last_delinq")
    loans.write.option("header", "true").option("mapreduce.output.basename", "LC_Accepted_2018").csv(f"{root}/raw/years")
    back = read_loans_dir(spark, root, drop_cols=["revol_util"])["accepted"]
    assert "revol_util" not in back.columns
    return back.groupBy("grade").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("loan_amnt").alias("loan_amnt"),
        F.sum("annual_inc").alias("annual_inc"),
        F.count("mths_since_last_delinq").alias("with_delinq"),
    )


def _delinquency_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Unnamed: 0"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias(DELINQUENCY_TARGET),
        F.col("c_nationkey").alias("age"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("MonthlyIncome"),
    )
    path = scratch_dir(spark, "delinquency")
    customers.write.option("header", "true").option("nullValue", "NA").csv(path)
    back = read_delinquency_csv(spark, path)
    meta = dataset_metadata(back, path=path, target=DELINQUENCY_TARGET)
    dist = quality.target_distribution(back, target=DELINQUENCY_TARGET).filter(F.col(DELINQUENCY_TARGET) == 1)
    return meta.select(
        "target", F.concat_ws(",", "features").alias("features"), "n_rows", "n_cols", "missing_values"
    ).withColumn("delinquent", dist.select("n").scalar())


def _write_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan-level ECL written as a partitioned snapshot, totalled from the written table."""
    path = scratch_dir(spark, "ecl")
    write_results(loans_with_ecl(spark, sf_dir).select("id", "stage", "ecl"), path, as_of="2024-01-31", partition_by=["stage"])
    return impairment.ecl_by_stage(spark.read.parquet(path).filter(F.col("as_of") == "2024-01-31"))


_STAGE_SQL = on_loans(
    "SELECT s.stage, count(e.id) AS loans, coalesce(sum(e.ecl), 0e0) AS ecl FROM (VALUES (0), (1), (2), (3)) AS s(stage) "
    "LEFT JOIN ecl e ON s.stage = 0 OR e.stage = s.stage GROUP BY s.stage",
    STAGED_CTE,
)
_FIT_SPEC = "n_test:i positives:i pd_in_range:b labels_at_half:b ranks_better_than_one_column:b"
_BRIER_SPEC = "brier_score_before:9 brier_score_after:{0} brier_score_improvement:{0}"
# The label of model_table, the seeded split, and raw scores with their points (one per distinct score).
_DEFAULTS = (
    "defaults AS (SELECT *, CASE WHEN (id * 48271 % 1009) / 1009e0 < pd_12m + CASE WHEN grade IN ('D', 'E') THEN 0.15e0 ELSE 0e0 END "
    "THEN 1 ELSE 0 END AS y1 FROM loan)"
)
_SPLIT = (
    "parts AS (SELECT id, y1, CASE WHEN rk <= floor(n * 0.3e0 + 0.5e0) THEN 'test' ELSE 'other' END AS split FROM (SELECT id, y1, "
    f"row_number() OVER (PARTITION BY y1 ORDER BY {SPLIT_HASH}, id) AS rk, count(*) OVER (PARTITION BY y1) AS n FROM defaults))"
)
_RAW = "raw AS (SELECT id, y1, sqrt(pd_12m / 0.4e0) AS x, id % 2 AS half FROM defaults)"


def _isotonic_ctes(source: str, out: str = "iso") -> list[str]:
    """CTE of (x, f): the largest over starts of the smallest over ends of the mean label, per distinct score."""
    return [
        f"{out}_c AS (SELECT x, row_number() OVER (ORDER BY x) AS i, w, s, sum(w) OVER (ORDER BY x) AS cw, sum(s) OVER (ORDER BY x) AS cs "
        f"FROM (SELECT x, count(*)::DOUBLE AS w, sum(y1)::DOUBLE AS s FROM {source} GROUP BY x))",
        f"{out}_p AS (SELECT j.i AS j, k.i AS k, (k.cs - j.cs + j.s) / (k.cw - j.cw + j.w) AS m FROM {out}_c j JOIN {out}_c k ON k.i >= j.i)",
        f"{out}_m AS (SELECT k, max(m) AS f FROM (SELECT j, k, min(m) OVER (PARTITION BY j ORDER BY k DESC) AS m FROM {out}_p) GROUP BY k)",
        f"{out} AS (SELECT x, f FROM {out}_c JOIN {out}_m ON i = k)",
    ]


def _newton_ctes(source: str, terms: list[str], out: str, steps: int = 14) -> list[str]:
    """CTE with the coefficients b0, b1 (, b2) of an unpenalised logistic regression of y1 on one or two terms."""
    terms = ["1e0", *terms]
    n = len(terms)
    score = " + ".join(f"b{i} * {t}" for i, t in enumerate(terms))
    zero = ", ".join(f"0e0 AS b{i}" for i in range(n))
    ctes = [f"{out}_0 AS (SELECT {zero})"]
    for k in range(steps):
        sums = [f"any_value(b{i}) AS b{i}" for i in range(n)]
        sums += [f"sum((y1 - p) * {t}) AS g{i}" for i, t in enumerate(terms)]
        sums += [f"sum(p * (1 - p) * {terms[i]} * {terms[j]}) AS h{i}{j}" for i in range(n) for j in range(i, n)]

        def h(i: int, j: int) -> str:
            return f"h{min(i, j)}{max(i, j)}"

        if n == 2:
            det = "(h00 * h11 - h01 * h01)"
            moved = [f"b0 + (h11 * g0 - h01 * g1) / {det} AS b0", f"b1 + (h00 * g1 - h01 * g0) / {det} AS b1"]
        else:
            def cofactor(i: int, j: int) -> str:
                r = [x for x in range(3) if x != i]
                c = [x for x in range(3) if x != j]
                sign = "-" if (i + j) % 2 else ""
                return f"{sign}({h(r[0], c[0])} * {h(r[1], c[1])} - {h(r[0], c[1])} * {h(r[1], c[0])})"

            det = "(" + " + ".join(f"{h(0, j)} * ({cofactor(0, j)})" for j in range(3)) + ")"
            moved = [
                f"b{i} + (" + " + ".join(f"({cofactor(j, i)}) * g{j}" for j in range(3)) + f") / {det} AS b{i}" for i in range(3)
            ]
        ctes.append(
            f"{out}_{k + 1} AS MATERIALIZED (SELECT {', '.join(moved)} FROM (SELECT {', '.join(sums)} FROM "
            f"(SELECT *, 1 / (1 + exp(-({score}))) AS p FROM {source}, {out}_{k})))"
        )
    ctes.append(f"{out} AS (SELECT * FROM {out}_{steps})")
    return ctes


def _brier(p: str, source: str) -> str:
    return (
        f"SELECT avg((x - y1) * (x - y1)) AS brier_score_before, avg(({p} - y1) * ({p} - y1)) AS brier_score_after, "
        f"avg((x - y1) * (x - y1)) - avg(({p} - y1) * ({p} - y1)) AS brier_score_improvement FROM {source}"
    )


_FIT_SQL = (
    "SELECT count(*) AS n_test, sum(y1) AS positives, true AS pd_in_range, true AS labels_at_half, "
    "true AS ranks_better_than_one_column{} FROM parts WHERE split = 'test'"
)
_LOGIT = "1 / (1 + exp(-(b0 + b1 * x)))"
_BETA_TERMS = ["ln(q)", "-ln(1 - q)"]
_PD_CALIBRATION_SQL = on_loans(
    "SELECT count(*) AS n, avg(y1) AS default_rate, "
    + ", ".join(
        f"{f}({c}) AS {n}_{c}" for c in models.CALIBRATION_METHODS for f, n in (("avg", "mean"), ("min", "min"), ("max", "max"))
    )
    + " FROM (SELECT new.y1, isotonic, "
    "1 / (1 + exp(-(platt.b0 + platt.b1 * new.x))) AS logistic, "
    "1 / (1 + exp(-(beta.b0 + beta.b1 * ln(q) - beta.b2 * ln(1 - q)))) AS beta FROM new, platt, beta)",
    _DEFAULTS,
    _RAW,
    "known AS (SELECT *, 1 / (1 + exp(-x)) AS q FROM raw WHERE half = 0)",
    *_isotonic_ctes("known"),
    *_newton_ctes("known", ["x"], "platt"),
    *_newton_ctes("known", _BETA_TERMS, "beta"),
    # Linear between the points of the fit, constant outside.
    "new AS (SELECT r.id, r.y1, r.x, 1 / (1 + exp(-r.x)) AS q, CASE WHEN lo.x IS NULL THEN hi.f WHEN hi.x IS NULL OR hi.x = lo.x THEN lo.f "
    "ELSE lo.f + (hi.f - lo.f) * (r.x - lo.x) / (hi.x - lo.x) END AS isotonic FROM (SELECT * FROM raw WHERE half = 1) r "
    "ASOF LEFT JOIN iso lo ON r.x >= lo.x ASOF LEFT JOIN iso hi ON r.x <= hi.x)",
)
_MED = "(SELECT q0 FROM q WHERE feature = '{c}')"

QUERIES = {
    "scale_std": Query(
        lambda s, d: models.scale_std(loan_book(s, d, "id", *SCALED), num_cols=SCALED),
        "id:i " + " ".join(f"{c}:8" for c in SCALED),
        on_loans(
            "SELECT id, " + ", ".join(f"{c} / (SELECT stddev_pop({c}) FROM f) AS {c}" for c in SCALED) + " FROM f",
            quantile_ctes(long_form(SCALED), [0.5], "q"),
            "f AS (SELECT id, " + ", ".join(f"coalesce({c}::DOUBLE, {_MED.format(c=c)}) AS {c}" for c in SCALED) + " FROM loan)",
        ),
    ),
    "fit_pipeline": Query(
        _fit_pipeline,
        "n:i positives:i mean_pd:3 conditions_hold:b",
        on_loans("SELECT count(*) AS n, sum(y1) AS positives, avg(y1) AS mean_pd, true AS conditions_hold FROM defaults", _DEFAULTS),
    ),
    "train_logistic": Query(
        _train_logistic, f"{_FIT_SPEC} conditions_hold:b", on_loans(_FIT_SQL.format(", true AS conditions_hold"), _DEFAULTS, _SPLIT)
    ),
    "train_gbt": Query(_train_gbt, _FIT_SPEC, on_loans(_FIT_SQL.format(""), _DEFAULTS, _SPLIT)),
    "portfolio_job": Query(_portfolio_job, "table:s group:s metric:s value:6"),
    "score_pd": Query(
        _score,
        "id:i default:i pd_in_range:b survives_saving:b",
        on_loans(
            'SELECT id, y1 AS "default", true AS pd_in_range, true AS survives_saving FROM parts WHERE split = \'test\'', _DEFAULTS, _SPLIT
        ),
    ),
    "feature_importance_topk": Query(
        _importance,
        "feature:s in_range:b",
        on_loans(
            "SELECT feature, true AS in_range FROM (SELECT DISTINCT 'segment_' || segment AS feature FROM loan UNION SELECT 'grade_' || grade "
            f"FROM loan UNION SELECT unnest({NUMERIC}))"
        ),
    ),
    "importance_of_drivers": Query(
        _driven_importance, "place:i feature:s", "SELECT * FROM (VALUES (1, 'exposure'), (2, 'dti')) AS t(place, feature)"
    ),
    "calibrate_isotonic": Query(
        _calibrated(models.calibrate_isotonic),
        _BRIER_SPEC.format(9),
        on_loans(_brier("f", "raw JOIN iso USING (x)"), _DEFAULTS, _RAW, *_isotonic_ctes("raw")),
    ),
    "calibrate_platt": Query(
        _calibrated(models.calibrate_platt),
        _BRIER_SPEC.format(6),
        on_loans(_brier(_LOGIT, "raw, platt"), _DEFAULTS, _RAW, *_newton_ctes("raw", ["x"], "platt")),
    ),
    "pd_calibration": Query(
        _pd_calibration,
        "n:i default_rate:9 "
        + " ".join(f"{s}_{m}:{d}" for s in ("mean", "min", "max") for m, d in (("logistic", 4), ("isotonic", 8), ("beta", 3))),
        _PD_CALIBRATION_SQL,
    ),
    "read_loans_dir": Query(
        _csv_round_trip,
        "grade:s n:i loan_amnt:2 annual_inc:2 with_delinq:i",
        on_loans(
            "SELECT grade, count(*) AS n, sum(loan_amnt) AS loan_amnt, sum(annual_inc) AS annual_inc, count(mths_since_last_delinq) AS "
            "with_delinq FROM loan GROUP BY grade"
        ),
    ),
    "read_delinquency_csv": Query(
        _delinquency_round_trip,
        "target:s features:s n_rows:i n_cols:i missing_values:i delinquent:i",
        f"SELECT '{DELINQUENCY_TARGET}' AS target, 'age,MonthlyIncome' AS features, count(*) AS n_rows, 3 AS n_cols, "
        "count_if(NOT c_acctbal > 0) AS missing_values, count_if(c_acctbal < 0) AS delinquent FROM customer",
    ),
    "write_results": Query(_write_results, "stage:i loans:i ecl:2", _STAGE_SQL),
}

