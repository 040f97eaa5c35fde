"""Time scales and light-travel time as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth orbit at J2000 and physical constants.
SEMI_MAJOR_AU = 1.000001018
ECCENTRICITY = 0.0167086
MEAN_ANOMALY_J2000_DEG = 357.51716
PERIHELION_ARG_DEG = 102.9373
SIDEREAL_YEAR_DAYS = 365.256363004
J2000_MJD = 51544.5
OBLIQUITY_DEG = 23.4392911
AU_LIGHT_DAYS = 499.004783836 / 86400.0


def timestamp_to_mjd(ts) -> Column:
    """MJD of a zone-free timestamp; independent of the session time zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c.cast("timestamp_ntz"))
    return micros / F.lit(86400e6) + F.lit(40587.0)


def jd_to_mjd(jd) -> Column:
    return (F.col(jd) if isinstance(jd, str) else jd) - F.lit(2400000.5)


def phase(t: Column, period: Column, t_ref: Column | float = 0.0) -> Column:
    """Folded phase in [0, 1)."""
    ref = F.lit(t_ref) if isinstance(t_ref, (int, float)) else t_ref
    return F.pmod(t - ref, period) / period


def _kepler_steps(mean: Column, steps: int = 5) -> Column:
    """Eccentric anomaly after Newton steps.

    The steps run inside ``aggregate`` so the expression stays of fixed size
    instead of doubling with each step.
    """
    e = F.lit(ECCENTRICITY)

    def newton(acc, _):
        return acc - (acc - e * F.sin(acc) - mean) / (1.0 - e * F.cos(acc))

    return F.aggregate(F.array(*[F.lit(i) for i in range(steps)]), mean, newton)


def heliocentric_mjd(df, mjd: str, ra: str, dec: str, name: str = "helioMjd"):
    """Add the arrival time at the Sun: t + (earth position . line of sight) / c.

    Intermediate values are named columns, so each is computed once.
    """
    out = df.withColumn("__E", _kepler_steps(F.lit(math.radians(MEAN_ANOMALY_J2000_DEG)) + F.lit(2 * math.pi / SIDEREAL_YEAR_DAYS) * (F.col(mjd) - F.lit(J2000_MJD))))
    e = ECCENTRICITY
    out = out.withColumn(
        "__nu",
        2.0 * F.atan2(math.sqrt(1 + e) * F.sin(F.col("__E") / 2), math.sqrt(1 - e) * F.cos(F.col("__E") / 2)) + F.lit(math.radians(PERIHELION_ARG_DEG)),
    ).withColumn("__r", F.lit(SEMI_MAJOR_AU) * (1.0 - e * F.cos("__E")))
    eps = math.radians(OBLIQUITY_DEG)
    x = F.col("__r") * F.cos("__nu")
    y = F.col("__r") * F.sin("__nu")
    a, d = F.radians(ra), F.radians(dec)
    along = x * F.cos(d) * F.cos(a) + y * (math.cos(eps) * F.cos(d) * F.sin(a) + math.sin(eps) * F.sin(d))
    return out.withColumn(name, F.col(mjd) + along * F.lit(AU_LIGHT_DAYS)).drop("__E", "__nu", "__r")
