"""Special functions Spark lacks, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the rational-exponent fit to erfc with relative
# error below 1.2e-7 (Press et al., Numerical Recipes, section 6.2).
ERFC = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]


def log_gamma(x: Column) -> Column:
    """Stirling series with three terms; good to 1e-9 for x >= 5."""
    return (
        (x - 0.5) * F.log(x)
        - x
        + F.lit(0.5 * math.log(2 * math.pi))
        + 1.0 / (x * 12.0)
        - 1.0 / (x * x * x * 360.0)
        + 1.0 / (x * x * x * x * x * 1260.0)
    )


def erfc(x: Column) -> Column:
    """Complementary error function by the fit above; nested products, one polynomial."""
    z = F.abs(x)
    t = 1.0 / (1.0 + 0.5 * z)
    poly = F.lit(ERFC[-1])
    for c in reversed(ERFC[:-1]):
        poly = F.lit(c) + t * poly
    val = t * F.exp(-z * z + poly)
    return F.when(x >= 0, val).otherwise(2.0 - val)


def normal_cdf(z: Column) -> Column:
    return 0.5 * erfc(-z / F.lit(math.sqrt(2.0)))
