"""Standard normal distribution function and quantile as native expressions.

Both are DataFrame steps rather than one nested Column: the shared sub-term (the exponential, the tail
root) becomes a named column of its own projection, so it is computed once per row and the generated
method stays small enough to be compiled.
"""

from __future__ import annotations

import statistics
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rational approximation of the normal quantile, algorithm AS 241 (Wichura, 1988).
QUANTILE_CENTRE_NUM = (
    3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
    4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3,
)
QUANTILE_CENTRE_DEN = (
    1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
    2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3,
)
QUANTILE_NEAR_NUM = (
    1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
    1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4,
)
QUANTILE_NEAR_DEN = (
    1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
    1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9,
)
QUANTILE_FAR_NUM = (
    6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
    2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7,
)
QUANTILE_FAR_DEN = (
    1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
    7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15,
)
# Double-precision normal distribution function (Hart, 1968; West, 2005).
CDF_NUM = (
    220.206867912376, 221.213596169931, 112.079291497871, 33.912866078383,
    6.37396220353165, 0.700383064443688, 3.52624965998911e-2,
)
CDF_DEN = (
    440.413735824752, 793.826512519948, 637.333633378831, 296.564248779674,
    86.7807322029461, 16.064177579207, 1.75566716318264, 8.83883476483184e-2,
)
CDF_SPLIT = 7.07106781186547
ROOT_TWO_PI = 2.506628274631


def _horner(x: str, coefficients: Sequence[float]) -> str:
    text = f"{coefficients[-1]!r}D"
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c!r}D)"
    return text


def _fraction(x: str, num: Sequence[float], den: Sequence[float]) -> str:
    return f"{_horner(x, num)} / {_horner(x, den)}"


def with_normal_quantile(df: DataFrame, out: str, p: str) -> DataFrame:
    """Add ``out`` = Φ⁻¹(p); p <= 0 gives -inf, p >= 1 gives +inf, NULL stays NULL."""
    centre = _fraction("(0.180625D - _nq_q * _nq_q)", QUANTILE_CENTRE_NUM, QUANTILE_CENTRE_DEN)
    near = _fraction("(_nq_tail - 1.6D)", QUANTILE_NEAR_NUM, QUANTILE_NEAR_DEN)
    far = _fraction("(_nq_tail - 5D)", QUANTILE_FAR_NUM, QUANTILE_FAR_DEN)
    in_tail = f"`{p}` > 0 AND `{p}` < 1 AND abs(_nq_q) > 0.425D"
    return (
        df.withColumn("_nq_q", F.col(p) - F.lit(0.5))
        .withColumn(
            "_nq_tail", F.expr(f"CASE WHEN {in_tail} THEN sqrt(-ln(CASE WHEN _nq_q < 0 THEN `{p}` ELSE 1D - `{p}` END)) END")
        )
        .withColumn(
            out,
            F.expr(
                f"CASE WHEN `{p}` <= 0 THEN -DOUBLE('Infinity') WHEN `{p}` >= 1 THEN DOUBLE('Infinity') "
                f"WHEN abs(_nq_q) <= 0.425D THEN _nq_q * {centre} "
                f"WHEN _nq_tail <= 5D THEN signum(_nq_q) * ({near}) "
                f"WHEN _nq_tail > 5D THEN signum(_nq_q) * ({far}) END"
            ),
        )
        .drop("_nq_q", "_nq_tail")
    )


def with_normal_cdf(df: DataFrame, out: str, x: str) -> DataFrame:
    """Add ``out`` = Φ(x); ±inf give 0 and 1, NULL stays NULL."""
    tail = "(_nc_abs + 0.65D)"
    for k in ("4D", "3D", "2D", "1D"):
        tail = f"(_nc_abs + {k} / {tail})"
    lower = (
        f"CASE WHEN _nc_abs > 37D THEN 0D "
        f"WHEN _nc_abs < {CDF_SPLIT!r}D THEN _nc_exp * {_fraction('_nc_abs', CDF_NUM, CDF_DEN)} "
        f"WHEN _nc_abs IS NOT NULL THEN _nc_exp / {tail} / {ROOT_TWO_PI!r}D END"
    )
    return (
        df.withColumn("_nc_abs", F.abs(F.col(x)))
        .withColumn("_nc_exp", F.expr("exp(-(_nc_abs * _nc_abs) / 2D)"))
        .withColumn("_nc_low", F.expr(lower))
        .withColumn(out, F.expr(f"CASE WHEN `{x}` > 0 THEN 1D - _nc_low ELSE _nc_low END"))
        .drop("_nc_abs", "_nc_exp", "_nc_low")
    )


def normal_quantile_of(level: float) -> float:
    """Φ⁻¹ of a plan-time constant such as a confidence level."""
    return statistics.NormalDist().inv_cdf(level)
