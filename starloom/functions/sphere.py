"""Geometry on the sphere as Column expressions (degrees in, arcseconds out)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# km/s in au per Julian year, and arcsec per radian.
AU_PER_YEAR_KMS = 4.740470463533348
ARCSEC_PER_RADIAN = 206264.80624709636


def _c(x) -> Column:
    if isinstance(x, (int, float)):
        return F.lit(float(x))
    return F.col(x) if isinstance(x, str) else x


def separation_arcsec(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle distance by the haversine form."""
    a1, d1, a2, d2 = map(_c, (ra1, dec1, ra2, dec2))
    sd = F.sin(F.radians(d2 - d1) / 2)
    sa = F.sin(F.radians(a2 - a1) / 2)
    h = sd * sd + F.cos(F.radians(d1)) * F.cos(F.radians(d2)) * sa * sa
    return F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(h)))) * 3600.0


def unit_vector(ra, dec) -> tuple[Column, Column, Column]:
    a, d = F.radians(_c(ra)), F.radians(_c(dec))
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def propagate(df, ra: str, dec: str, pmra: str, pmdec: str, parallax: str, rv: str, years: float, names=("ra_corr", "dec_corr")):
    """Positions after ``years`` of straight-line motion through space.

    pmra (with cos dec), pmdec in mas/yr, parallax in mas, rv in km/s.  The
    input position columns are kept.  In units of the distance, the velocity is
    the proper motion plus rv / distance along the line of sight.
    """
    to_rad = 1.0 / 1000.0 / ARCSEC_PER_RADIAN
    a, d = F.radians(_c(ra)), F.radians(_c(dec))
    mu_a, mu_d = _c(pmra) * to_rad, _c(pmdec) * to_rad
    # rv [km/s] -> au/yr, times 1 / distance [au] = parallax [rad]
    mu_r = _c(rv) / AU_PER_YEAR_KMS * _c(parallax) * to_rad
    cols = {"__sa": F.sin(a), "__ca": F.cos(a), "__sd": F.sin(d), "__cd": F.cos(d), "__mr": 1.0 + mu_r * years}
    out = df.withColumns(cols)
    sa, ca, sd, cd, mr = (F.col(c) for c in cols)
    x = cd * ca * mr + (-sa * mu_a - sd * ca * mu_d) * years
    y = cd * sa * mr + (ca * mu_a - sd * sa * mu_d) * years
    z = sd * mr + cd * mu_d * years
    out = out.withColumns({"__x": x, "__y": y, "__z": z})
    rho = F.sqrt(F.col("__x") * F.col("__x") + F.col("__y") * F.col("__y"))
    out = out.withColumns({names[0]: F.pmod(F.degrees(F.atan2("__y", "__x")), F.lit(360.0)), names[1]: F.degrees(F.atan2(F.col("__z"), rho))})
    return out.drop(*cols, "__x", "__y", "__z")


def max_proper_motion(margin_arcsec: float, start: float, end: float) -> float:
    """Largest proper motion (mas/yr) that stays inside the margin between two epochs."""
    return 1000.0 * margin_arcsec / abs(end - start)


def inside_convex(ra, dec, vertices: list[tuple[float, float]]) -> Column:
    """Half-space test against each edge of a convex polygon of either winding."""
    pts = []
    for r, d in vertices:
        r, d = math.radians(r), math.radians(d)
        pts.append((math.cos(d) * math.cos(r), math.cos(d) * math.sin(r), math.sin(d)))
    center = [sum(p[i] for p in pts) for i in range(3)]
    x, y, z = unit_vector(ra, dec)
    cond = None
    for p, q in zip(pts, pts[1:] + pts[:1]):
        n = (p[1] * q[2] - p[2] * q[1], p[2] * q[0] - p[0] * q[2], p[0] * q[1] - p[1] * q[0])
        if sum(a * b for a, b in zip(n, center)) < 0:
            n = tuple(-v for v in n)
        test = (x * n[0] + y * n[1] + z * n[2]) >= 0
        cond = test if cond is None else cond & test
    return cond
