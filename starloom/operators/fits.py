"""Transient template fits on a parameter grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.scan import Bazin, scan_best


def bazin_grid_fit(df: DataFrame, keys: list[str], time="mjd", flux="psfFlux", err="psfFluxErr", min_points: int = 8, model: Bazin = Bazin(), **kw) -> DataFrame:
    """Best (t0, rise, fall) of a pulse and its reduced chi2 beside a constant's.

    The answer is the best grid point, not an iterative optimum.  t0 runs over
    the object's time span in ``model.n_t0`` equal steps.
    """
    span = F.col("__t1") - F.col("__t0")
    shapes = len(model.rises) * len(model.falls)
    grid = {"f0": F.col("__t0"), "step": span / (model.n_t0 - 1), "nf": F.lit(model.n_t0 * shapes)}
    b = scan_best(df, keys, model, grid, time, flux, err, min_points=min_points, **kw)
    i = F.floor(F.col("k") / shapes)
    j = F.col("k") % shapes
    total = F.col("wyy") - F.col("wy") * F.col("wy") / F.col("w")
    vgg = F.col("a1") - F.col("a0") * F.col("a0") / F.col("w")
    vyg = F.col("a2") - F.col("a0") * F.col("wy") / F.col("w")
    pick = lambda values, idx: F.element_at(F.array(*[F.lit(float(v)) for v in values]), (idx + 1).cast("int"))
    out = b.withColumn("amplitude", vyg / F.nullif(vgg, F.lit(0.0)))
    return out.select(
        *keys, "n",
        (F.col("f0") + i * F.col("step")).alias("t0"),
        pick(model.rises, F.floor(j / len(model.falls))).alias("rise"),
        pick(model.falls, j % len(model.falls)).alias("fall"),
        "amplitude",
        ((F.col("wy") - F.col("amplitude") * F.col("a0")) / F.col("w")).alias("baseline"),
        (total / F.nullif(F.col("n") - 1, F.lit(0))).alias("chi2_const"),
        (total * (1.0 - F.col("score")) / F.nullif(F.col("n") - 5, F.lit(0))).alias("chi2_bazin"),
    )
