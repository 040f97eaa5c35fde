"""Schema-driven column work."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def any_flag(df: DataFrame, part: str = "flag") -> Column:
    """True where any boolean column whose name holds ``part`` is true."""
    names = [f.name for f in df.schema.fields if part in f.name.lower() and isinstance(f.dataType, T.BooleanType)]
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(n), F.lit(False)) for n in names], F.lit(False))


def cast_narrow(df: DataFrame, keep: list[str]) -> DataFrame:
    """All double columns to float except positions and times in ``keep``."""
    return df.withColumns({f.name: F.col(f.name).cast("float") for f in df.schema.fields if isinstance(f.dataType, T.DoubleType) and f.name not in keep})


def numeric_columns(df: DataFrame, skip_suffix: tuple[str, ...] = ("Id",), skip_part: str = "Mag") -> list[str]:
    """Numeric columns that are neither ids nor magnitudes."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and not f.name.endswith(skip_suffix) and skip_part not in f.name]


def shape_ellipse(df: DataFrame, xx: str, yy: str, xy: str, names=("a", "b", "theta")) -> DataFrame:
    """Semi-axes and angle of the ellipse of second moments; null if a moment is null.

    Eigenvalues of the 2x2 matrix in closed form.
    """
    out = df.withColumns({
        "__mid": (F.col(xx) + F.col(yy)) / 2,
        "__half": F.sqrt((F.col(xx) - F.col(yy)) * (F.col(xx) - F.col(yy)) / 4 + F.col(xy) * F.col(xy)),
    })
    return out.withColumns({
        names[0]: F.sqrt(F.col("__mid") + F.col("__half")),
        names[1]: F.when(F.col("__mid") >= F.col("__half"), F.sqrt(F.col("__mid") - F.col("__half"))),
        names[2]: 0.5 * F.atan2(2 * F.col(xy), F.col(xx) - F.col(yy)),
    }).drop("__mid", "__half")
