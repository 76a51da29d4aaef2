"""Simulated portfolio losses of the one-factor default model, their VaR and shape.

Loans are spread once as narrow rows and expanded by the runs inside the task (blocks of systematic draws), each
task keeps one running sum per run, and only those sums are shuffled. Draws are functions of (seed, loan, run):
partitioning, retries and lost executors do not change a result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.functions.bins import equal_width_bin
from lossgrid.functions.normal import with_normal_cdf, with_normal_quantile
from lossgrid.functions.uniform import with_entity_state, with_run_uniform, with_uniform

DEFAULT_CORRELATION = 0.1
SYSTEMATIC_SEED_OFFSET = 1
RUNS_PER_ROW = 250


def systematic_draws(spark: SparkSession, *, n_sims: int, seed: int) -> DataFrame:
    """(sim, z): one standard normal draw of the common factor per run."""
    runs = spark.range(n_sims).select(F.col("id").alias("sim"), F.lit(0).alias("_zero"))
    drawn = with_uniform(runs, "_u", "sim", "_zero", seed + SYSTEMATIC_SEED_OFFSET)
    return with_normal_quantile(drawn, "z", "_u").select("sim", "z")


def simulate_losses(
    df: DataFrame,
    *,
    key: str,
    pd: str,
    ead: str,
    lgd: str,
    n_sims: int = 1000,
    seed: int = 42,
    correlation: float = DEFAULT_CORRELATION,
    by: Sequence[str] = (),
    tasks: int | None = None,
) -> DataFrame:
    """(by, sim, loss): a loan defaults if √ρ·z + √(1−ρ)·ε < Φ⁻¹(pd), that is if its uniform draw lies
    below Φ((Φ⁻¹(pd) − √ρ·z) / √(1−ρ)); a defaulted loan loses EAD * LGD. Runs without default have loss 0.

    The narrow loans are spread evenly over ``tasks`` tasks (the shuffle partitions by default), once each whatever
    the number of runs; a task then joins its loans with the blocks of RUNS_PER_ROW draws. The draws take 16 bytes a
    run, a size the caller chooses; it does not grow with the loans.
    """
    if n_sims < 1:
        raise ValueError("n_sims must be positive")
    spark = df.sparkSession
    draws = systematic_draws(spark, n_sims=n_sims, seed=seed)
    block = F.floor(F.col("sim") / F.lit(RUNS_PER_ROW)).alias("block")
    per_block = draws.groupBy(block).agg(F.sort_array(F.collect_list(F.struct("sim", "z"))).alias("draws"))
    n_blocks = -(-n_sims // RUNS_PER_ROW)

    loans = df.filter(F.col(pd).isNotNull()).select(
        *by, F.col(key).alias("_key"), F.col(pd).alias("_pd"), (F.col(ead) * F.col(lgd)).alias("_severity")
    )
    loans = with_normal_quantile(loans, "_threshold", "_pd")
    loans = with_entity_state(loans, "_state", "_key", seed)
    loans = loans.select(
        *by, "_key", "_state", "_severity", (F.col("_threshold") / F.lit((1 - correlation) ** 0.5)).alias("_threshold"),
    )
    loans = loans.repartition(tasks or int(spark.conf.get("spark.sql.shuffle.partitions")), "_key")
    expanded = loans.withColumn("_block", F.explode(F.expr(f"sequence(0L, {n_blocks - 1}L)")))
    cells = expanded.join(F.broadcast(per_block), F.col("_block") == F.col("block")).select(*loans.columns, F.inline("draws"))
    slope = (correlation / (1 - correlation)) ** 0.5
    cells = cells.withColumn("_x", F.col("_threshold") - F.lit(slope) * F.col("z"))
    cells = with_normal_cdf(cells, "_limit", "_x")
    cells = with_run_uniform(cells, "_u", "_state", "_key", "sim")
    # Summed by condition, not filtered: a filter would be pushed through the projections and have their
    # whole chain written into it once per use.
    lost = F.when(F.col("_u") < F.col("_limit"), F.col("_severity")).otherwise(F.lit(0.0))
    losses = cells.select(*by, "sim", lost.alias("loss")).groupBy(*by, "sim").agg(F.sum("loss").alias("loss"))
    if by:
        return losses
    runs = spark.range(n_sims).select(F.col("id").alias("sim"))  # an empty portfolio loses 0 in every run
    return runs.join(losses, "sim", "left").select("sim", F.coalesce("loss", F.lit(0.0)).alias("loss"))


def loss_var_es(losses: DataFrame, *, confidence: float = 0.999, by: Sequence[str] = ()) -> DataFrame:
    """Expected and unexpected loss, VaR (interpolated percentile) and the mean loss at or beyond VaR.

    The percentile state holds one value per run.
    """
    gathered = losses.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_simulations"),
        F.avg("loss").alias("expected_loss"),
        F.stddev_pop("loss").alias("std_loss"),
        F.percentile("loss", [0.95, 0.99, confidence]).alias("_q"),
        F.sort_array(F.collect_list("loss"), asc=False).alias("_losses"),
    )
    var = F.get("_q", F.lit(2))
    tail = F.filter("_losses", lambda x: x >= var)
    mean_tail = F.aggregate(tail, F.lit(0.0), lambda acc, x: acc + x) / F.size(tail)
    return gathered.select(
        *by,
        "n_simulations",
        "expected_loss",
        "std_loss",
        F.get("_q", F.lit(0)).alias("var_95"),
        F.get("_q", F.lit(1)).alias("var_99"),
        var.alias("credit_var"),
        (var - F.col("expected_loss")).alias("unexpected_loss"),
        mean_tail.alias("expected_shortfall"),
    )


def loss_histogram(losses: DataFrame, *, bins: int = 50) -> DataFrame:
    """Density histogram of the losses and their mean; empty bins stay."""
    limits = losses.agg(F.min("loss").alias("lo"), F.max("loss").alias("hi"), F.avg("loss").alias("mean"),
                        F.count("loss").alias("total"))
    # A single value gets a range of one unit around it.
    pad = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    limits = limits.select((F.col("lo") - pad).alias("lo"), (F.col("hi") + pad).alias("hi"), "mean", "total")
    counted = (
        losses.withColumn("_r", limits.select(F.struct("lo", "hi")).scalar())
        .withColumn("bin", equal_width_bin(F.col("loss"), F.col("_r.lo"), F.col("_r.hi"), bins, "left"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    grid = limits.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi", "mean", "total")
    n = F.coalesce("n", F.lit(0))
    return grid.join(F.broadcast(counted), "bin", "left").select(  # at most `bins` rows
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lower"),
        n.alias("n"),
        (n / (F.col("total") * width)).alias("density"),
        F.col("mean").alias("mean_loss"),
    )


def economic_capital_simulated(losses: DataFrame, *, confidence: float = 0.999, by: Sequence[str] = ()) -> DataFrame:
    """Economic capital as simulated VaR over mean loss, with the VaR ladder."""
    found = loss_var_es(losses, confidence=confidence, by=by)
    return found.select(
        *by,
        F.col("unexpected_loss").alias("economic_capital"),
        F.col("expected_loss").alias("mean_loss"),
        "std_loss",
        "var_95",
        "var_99",
        F.col("credit_var").alias("var_999"),
    )


def economic_capital_by_method(
    df: DataFrame, *, method: str, key: str, pd: str, ead: str, lgd: str, confidence: float = 0.999, **simulation: int
) -> DataFrame:
    """Economic capital by the closed formula ('vasicek') or by simulation ('monte_carlo')."""
    from lossgrid.operators.capital import economic_capital

    if method == "vasicek":
        return economic_capital(df, pd=pd, ead=ead, lgd=lgd, confidence=confidence)
    if method == "monte_carlo":
        losses = simulate_losses(df, key=key, pd=pd, ead=ead, lgd=lgd, **simulation)
        return economic_capital_simulated(losses, confidence=confidence)
    raise ValueError(f"unknown economic capital method: {method}")
