"""Default-probability models on MLlib: preprocessing, training, calibration, scoring, importance.

Fitted preprocessing is a ``SQLTransformer`` whose constants (medians, levels, deviations) are few numbers
per column, so a whole model is one ``PipelineModel`` that MLlib saves and loads.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.operators import boosting
from lossgrid.operators.encoding import medians, modes
from lossgrid.operators.ordered import bucketed
from lossgrid.session import materialise

SEED = 42
#: Neighbouring ranges pooled by one task in a round of the isotonic fit.
FAN = 16
CALIBRATION_METHODS = ("logistic", "isotonic", "beta")


def _name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _numeric_constants(df: DataFrame, cols: Sequence[str], moments: bool = True) -> dict[str, tuple[float, float | None, float | None]]:
    """Median and, if asked for, mean and population deviation (after median imputation) per column: three numbers each."""
    if not cols:
        return {}
    middle = {r["feature"]: r["m"] for r in medians(df, cols).select("feature", F.get("quantiles", F.lit(0)).alias("m")).collect()}
    if not moments:
        return {c: (middle.get(c), None, None) for c in cols}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(middle.get(c))) for c in cols}
    found = df.agg(
        *[F.avg(x).alias(f"_a{i}") for i, x in enumerate(filled.values())],
        *[F.stddev_pop(x).alias(f"_s{i}") for i, x in enumerate(filled.values())],
    ).first()
    return {c: (middle.get(c), found[f"_a{i}"], found[f"_s{i}"]) for i, c in enumerate(cols)}


def preprocess_stages(
    df: DataFrame,
    *,
    num_cols: Sequence[str],
    cat_cols: Sequence[str] = (),
    center: bool = False,
    scale: bool = True,
    out: str = "features",
) -> list[Transformer | Estimator]:
    """Stages: median imputation and scaling of numbers, mode imputation and one-hot encoding of text.

    Scaling divides by the population deviation (by 1 for a constant column). A level unseen in fitting
    encodes as all zeros.
    """
    constants = _numeric_constants(df, num_cols, moments=center or scale)
    exprs = []
    for i, c in enumerate(num_cols):
        median, mean, std = constants[c]
        if median is None:
            raise ValueError(f"column without any value: {c}")
        value = f"coalesce(CAST({_name(c)} AS DOUBLE), {_number(median)})"
        if center:
            value = f"({value} - {_number(mean)})"
        if scale:
            value = f"({value} / {_number(std if std else 1.0)})"
        exprs.append(f"{value} AS `_num{i}`")
    most = {r["feature"]: r["mode"] for r in modes(df, cat_cols).collect()} if cat_cols else {}
    stages: list[Transformer | Estimator] = []
    inputs = [f"_num{i}" for i in range(len(num_cols))]
    filled = []
    for j, c in enumerate(cat_cols):
        exprs.append(f"coalesce(CAST({_name(c)} AS STRING), {_text(most.get(c, ''))}) AS `_cat{j}`")
        filled.append(f"_cat{j}")
    stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__"))
    if filled:
        # Sparse slots, one per level however many there are; the level indices stay on executors.
        index, vectors = [f"{c}_idx" for c in filled], [f"{c}_vec" for c in filled]
        stages.append(StringIndexer(inputCols=filled, outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=index, outputCols=vectors, dropLast=True))  # the last index: unseen levels
        inputs += vectors
    stages.append(VectorAssembler(inputCols=inputs, outputCol=out))
    return stages


def feature_names(model: PipelineModel, df: DataFrame, *, num_cols: Sequence[str], cat_cols: Sequence[str] = ()) -> list[str]:
    """Names of the vector slots of a fitted model, read from the slots' own metadata.

    Only the schema of ``df`` is used; it needs the model's input columns.
    """
    groups = model.transform(df.limit(0)).schema["features"].metadata["ml_attr"]["attrs"].values()
    slots = sorted((slot["idx"], slot["name"]) for group in groups for slot in group)
    names = {f"_num{i}": c for i, c in enumerate(num_cols)}
    for j, c in enumerate(cat_cols):
        head = f"_cat{j}_vec_"
        names |= {slot: f"{c}_{slot.removeprefix(head)}" for _, slot in slots if slot.startswith(head)}
    return [names[slot] for _, slot in slots]


def scale_std(df: DataFrame, *, num_cols: Sequence[str]) -> DataFrame:
    """Median imputation and division by the population deviation, without centring."""
    constants = _numeric_constants(df, num_cols)
    scaled = {}
    for c in num_cols:
        median, _, std = constants[c]
        scaled[c] = F.coalesce(F.col(c).cast("double"), F.lit(median)) / F.lit(std if std else 1.0)
    return df.withColumns(scaled)


def fit_pipeline(
    df: DataFrame,
    estimator: Estimator,
    *,
    num_cols: Sequence[str],
    cat_cols: Sequence[str] = (),
    center: bool = False,
    scale: bool = True,
) -> PipelineModel:
    """Preprocessing and estimator fitted as one model."""
    stages = preprocess_stages(df, num_cols=num_cols, cat_cols=cat_cols, center=center, scale=scale)
    return Pipeline(stages=[*stages, estimator]).fit(df)


def _class_counts(df: DataFrame, label: str) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).first()
    return row["pos"], row["neg"]


def train_logistic(
    df: DataFrame, *, label: str, num_cols: Sequence[str], cat_cols: Sequence[str] = (), max_iter: int = 1000
) -> PipelineModel:
    """L2 logistic regression on standardised features with balanced class weights n / (2 n_k).

    A unit inverse penalty on summed losses is 1 / n on MLlib's weighted mean loss.
    """
    labelled = df.filter(F.col(label).isin(0, 1))
    pos, neg = _class_counts(labelled, label)
    n = pos + neg
    weight = F.when(F.col(label) == 1, n / (2.0 * max(pos, 1))).otherwise(n / (2.0 * max(neg, 1)))
    estimator = LogisticRegression(
        featuresCol="features",
        labelCol=label,
        weightCol="_weight",
        maxIter=max_iter,
        regParam=1.0 / max(n, 1),
        elasticNetParam=0.0,
        standardization=False,
        tol=1e-6,
    )
    return fit_pipeline(labelled.withColumn("_weight", weight), estimator, num_cols=num_cols, cat_cols=cat_cols, center=True)


def train_gbt(
    df: DataFrame,
    *,
    label: str,
    num_cols: Sequence[str],
    cat_cols: Sequence[str] = (),
    trees: int = 200,
    depth: int = 5,
    rate: float = 0.1,
    seed: int = SEED,
) -> PipelineModel:
    """Boosted trees; positives weigh n_neg / n_pos. NULLs are imputed, trees need no scaling.

    The trees are grown by ``boosting``, evenly over the cluster whatever files the table is in.
    """
    labelled = df.filter(F.col(label).isin(0, 1))
    pos, neg = _class_counts(labelled, label)
    ratio = neg / pos if pos else 1.0
    estimator = GBTClassifier(
        featuresCol="features", labelCol=label, weightCol="_weight", maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed
    )
    prepare = Pipeline(stages=preprocess_stages(labelled, num_cols=num_cols, cat_cols=cat_cols, scale=False)).fit(labelled)
    counts = [len(levels) for stage in prepare.stages if isinstance(stage, StringIndexerModel) for levels in stage.labelsArray]
    numbers = [f"_num{i}" for i in range(len(num_cols))]
    grown = boosting.fit_trees(
        prepare.transform(labelled), label=label, numbers=numbers, categories=[(f"_cat{j}_idx", n) for j, n in enumerate(counts)],
        rows=pos + neg, ratio=ratio, trees=trees, depth=depth, rate=rate, seed=seed,
    )
    model = boosting.as_model(df.sparkSession, estimator, grown, numbers=len(numbers), slots=len(numbers) + sum(counts))
    return PipelineModel(stages=[*prepare.stages, model])


def score_pd(model: PipelineModel, df: DataFrame, *, out: str = "pd", keep: Sequence[str] | None = None) -> DataFrame:
    """Probability of default per loan; only the named columns and the PD are kept.

    Boosted trees that were grown in this session are evaluated in batches, loaded ones by MLlib; the PDs are the same.
    """
    if model is None:
        raise ValueError("no model to score with")
    names = list(keep) if keep is not None else df.columns
    batches = boosting.probability(model.stages[-1])
    if batches is not None:
        prepared = PipelineModel(stages=model.stages[:-1]).transform(df)
        return prepared.select(*names, batches(vector_to_array(model.stages[-1].getFeaturesCol())).alias(out))
    scored = model.transform(df)
    return scored.select(*names, vector_to_array("probability")[1].alias(out))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importance(model: PipelineModel, names: Sequence[str], *, k: int = 10) -> DataFrame:
    """(feature, importance) of the k strongest features: tree importances or absolute coefficients."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        values = abs(last.coefficients.toArray())
    else:
        raise ValueError("model has neither importances nor coefficients")
    rows = [(str(n), float(v)) for n, v in zip(names, values, strict=True)]
    table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


# --- calibration -------------------------------------------------------------------------------------


def _pool(points: np.ndarray) -> list[tuple[float, float, float, float]]:
    """Pool adjacent violators of (low, high, weight, weighted sum) rows in score order."""
    blocks: list[tuple[float, float, float, float]] = []
    for low, high, weight, total in points.tolist():
        while blocks and blocks[-1][3] * weight >= total * blocks[-1][2]:
            before = blocks.pop()
            low, weight, total = before[0], weight + before[2], total + before[3]
        blocks.append((low, high, weight, total))
    return blocks


def isotonic_blocks(df: DataFrame, score: str, label: str) -> DataFrame:
    """The blocks of the isotonic fit: low and high score, weight and sum of the labels; exact, nothing is rounded.

    Labels are summed per distinct score first. Every range of the score order is pooled by a task of its own, and
    what is left of neighbouring ranges is pooled again in rounds of FAN ranges, each of which sees only blocks.
    Pooling in parts and pooling the results gives the same blocks as pooling at once.
    """
    present = df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull())
    points = present.groupBy(F.col(score).cast("double").alias("low")).agg(
        F.count(F.lit(1)).cast("double").alias("weight"), F.sum(F.col(label).cast("double")).alias("total")
    )
    points, ranges = bucketed(points, "low", "part")
    schema = "part int, low double, high double, weight double, total double"

    def pool(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values("low")[["low", "high", "weight", "total"]].to_numpy(float)
        return pd.DataFrame(_pool(ordered), columns=["low", "high", "weight", "total"]).assign(part=int(key[0]))[
            ["part", "low", "high", "weight", "total"]
        ]

    blocks = points.withColumn("high", F.col("low")).groupBy("part").applyInPandas(pool, schema)
    while ranges > 1:
        ranges = -(-ranges // FAN)
        blocks = blocks.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("part").applyInPandas(pool, schema)
    return blocks.select("low", "high", "weight", "total")


def _inside(p: Column) -> Column:
    """Keep a probability off 0 and 1 before taking logarithms."""
    return F.least(F.greatest(p, F.lit(1e-12)), F.lit(1.0 - 1e-12))


def _fit_logistic(df: DataFrame, label: str, inputs: Sequence[str]) -> PipelineModel:
    stages = [
        VectorAssembler(inputCols=list(inputs), outputCol="_cal_features"),
        LogisticRegression(
            featuresCol="_cal_features", labelCol=label, probabilityCol="_cal_prob",
            rawPredictionCol="_cal_raw", predictionCol="_cal_pred", maxIter=200, tol=1e-9,
        ),
    ]
    return Pipeline(stages=stages).fit(df.filter(F.col(label).isNotNull()))


def fit_isotonic(df: DataFrame, *, score: str, label: str) -> Transformer:
    """Monotone map of score to default rate, linear between blocks.

    The blocks are pooled on executors; the model gets their two ends, of which a fit has few.
    """
    rate = F.col("total") / F.col("weight")
    blocks = materialise(isotonic_blocks(df, score, label), "isotonic")
    ends = F.when(F.col("low") < F.col("high"), F.array("low", "high")).otherwise(F.array("low"))
    points = blocks.select(F.explode(ends).alias("_x"), rate.alias("_rate"), F.col("weight").alias("_w"))
    return IsotonicRegression(
        featuresCol="_x", labelCol="_rate", weightCol="_w", predictionCol="_iso", isotonic=True
    ).fit(points)


def apply_isotonic(model: Transformer, df: DataFrame, *, score: str, out: str) -> DataFrame:
    fed = df.withColumn("_x", F.col(score))
    return model.transform(fed).withColumn(out, F.least(F.greatest(F.col("_iso"), F.lit(0.0)), F.lit(1.0))).drop("_x", "_iso")


def calibrate_isotonic(df: DataFrame, *, score: str, label: str, out: str = "calibrated") -> DataFrame:
    """Isotonic calibration fitted on, and applied to, the given (validation) table."""
    return apply_isotonic(fit_isotonic(df, score=score, label=label), df, score=score, out=out)


def calibrate_platt(df: DataFrame, *, score: str, label: str, out: str = "calibrated") -> DataFrame:
    """Sigmoid calibration: an unpenalised logistic regression on the score."""
    model = _fit_logistic(df, label, [score])
    return _logistic_output(model, df, out)


def _logistic_output(model: PipelineModel, df: DataFrame, out: str) -> DataFrame:
    return model.transform(df).withColumn(out, vector_to_array("_cal_prob")[1]).drop(
        "_cal_features", "_cal_prob", "_cal_raw", "_cal_pred"
    )


def brier_improvement(df: DataFrame, *, label: str, before: str, after: str) -> DataFrame:
    """Brier score of both columns and the improvement."""

    def brier(c: str) -> Column:
        gap = F.col(c) - F.col(label)
        return F.avg(gap * gap)

    return df.agg(brier(before).alias("brier_score_before"), brier(after).alias("brier_score_after")).withColumn(
        "brier_score_improvement", F.col("brier_score_before") - F.col("brier_score_after")
    )


def pd_calibration(
    scores: DataFrame, calibration: DataFrame, *, score: str, label: str, method: str = "logistic", out: str = "pd"
) -> DataFrame:
    """Raw scores to PDs in [0, 1], learnt from (score, default) pairs of a second table.

    ``beta`` is a logistic regression on ln s and -ln(1 - s); scores are squashed into (0, 1) first.
    """
    if method not in CALIBRATION_METHODS:
        raise ValueError(f"unknown calibration method: {method}")
    if method == "isotonic":
        model = fit_isotonic(calibration, score=score, label=label)
        return apply_isotonic(model, scores, score=score, out=out)
    if method == "logistic":
        model = _fit_logistic(calibration, label, [score])
        return _logistic_output(model, scores, out)

    def with_logs(df: DataFrame) -> DataFrame:
        p = _inside(F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col(score))))
        return df.withColumn("_ls", F.log(p)).withColumn("_l1s", -F.log(F.lit(1.0) - p))

    model = _fit_logistic(with_logs(calibration), label, ["_ls", "_l1s"])
    return _logistic_output(model, with_logs(scores), out).drop("_ls", "_l1s")
