"""Brightness conversions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# AB zero point for nanojansky fluxes, rounded and from its definition.
AB_ZERO_POINT = 31.4
AB_ZERO_POINT_DEFINED = 8.9 + 2.5 * 9

# Per-band zero points of the simulated-truth fluxes.
TRUTH_ZERO_POINTS = {
    "u": 12.652350670009373,
    "g": 14.689449213373276,
    "r": 14.559501946792281,
    "i": 14.378976834902065,
    "z": 13.993052964496345,
    "y": 13.017367314857484,
}

# Vega-to-AB shifts of the three broad bands (AB zero point, Vega zero point).
VEGA_TO_AB = {"g": 25.8010 - 25.6874, "bp": 25.1040 - 24.7479, "rp": 25.3540 - 25.3385}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flux_to_mag(flux, zero_point: float = AB_ZERO_POINT) -> Column:
    """AB magnitude; null where the flux is not positive."""
    f = _c(flux)
    return F.when(f > 0, F.lit(zero_point) - F.lit(2.5) * F.log10(f))


def mag_to_flux(mag, zero_point: float = AB_ZERO_POINT) -> Column:
    return F.pow(F.lit(10.0), F.lit(-0.4) * (_c(mag) - F.lit(zero_point)))


def mag_error(flux, err, zero_point: float = AB_ZERO_POINT) -> Column:
    """Half the magnitude difference between flux - err and flux + err; all three must be positive."""
    f, e = _c(flux), _c(err)
    ok = (f > 0) & (f + e > 0) & (f - e > 0)
    up = F.lit(zero_point) - F.lit(2.5) * F.log10(f + e)
    down = F.lit(zero_point) - F.lit(2.5) * F.log10(f - e)
    return F.when(ok, -(up - down) / 2)


def mag_error_linear(flux, err) -> Column:
    """First-order magnitude error 2.5 / ln 10 * err / flux."""
    f = _c(flux)
    return F.when(f > 0, F.lit(2.5) / F.log(F.lit(10.0)) * _c(err) / f)


def by_band(band, values: dict[str, float]) -> Column:
    """Constant looked up by band; null for unknown bands."""
    b = _c(band)
    out = None
    for name, v in values.items():
        out = F.when(b == name, F.lit(v)) if out is None else out.when(b == name, F.lit(v))
    return out


def band_magnitude(flux, band, zero_points: dict[str, float] = TRUTH_ZERO_POINTS) -> Column:
    f = _c(flux)
    return F.when(f != 0, by_band(band, zero_points) - F.lit(2.5) * F.log10(F.when(f > 0, f)))


def color(flux_a, flux_b) -> Column:
    """Magnitude difference a - b; null unless both fluxes are positive."""
    return flux_to_mag(flux_a) - flux_to_mag(flux_b)


def snr(flux, err) -> Column:
    return _c(flux) / F.nullif(_c(err), F.lit(0.0))


def weight(err) -> Column:
    e = F.nullif(_c(err), F.lit(0.0))
    return F.lit(1.0) / (e * e)


def weighted_mean(x, err) -> Column:
    """Inverse-variance mean as an aggregate expression."""
    w = weight(err)
    return F.sum(_c(x) * w) / F.sum(w)
