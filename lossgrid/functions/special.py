"""Special functions as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Divisors of the asymptotic series of the digamma function, 2k / B(2k) for k = 1 to 5.
DIGAMMA_DIVISORS = (12.0, -120.0, 252.0, -240.0, 132.0)
DIGAMMA_SHIFT = 6


def digamma(x: Column) -> Column:
    """Logarithmic derivative of the gamma function for x >= 1, to about 1e-12; NULL stays NULL, smaller x give NULL."""
    x = x.cast("double")
    z = x + float(DIGAMMA_SHIFT)
    value = F.log(z) - F.lit(0.5) / z
    power = F.lit(1.0)
    for divisor in DIGAMMA_DIVISORS:
        power = power / (z * z)
        value = value - power / divisor
    for step in range(DIGAMMA_SHIFT):
        value = value - F.lit(1.0) / (x + float(step))
    return F.when(x >= 1, value)
