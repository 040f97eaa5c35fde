"""Truth comparison and declarative look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def match_quality(matches: DataFrame, truth: DataFrame, keys: list[str]) -> DataFrame:
    """Completeness and purity of matches against true pairs."""
    m = matches.select(*keys).distinct().withColumn("in_match", F.lit(1))
    r = truth.select(*keys).distinct().withColumn("in_truth", F.lit(1))
    s = m.join(r, keys, "full_outer").agg(
        F.count("in_match").alias("matched"), F.count_if(F.col("in_match").isNotNull() & F.col("in_truth").isNotNull()).alias("correct"), F.count("in_truth").alias("truth")
    )
    return s.withColumns({
        "completeness": F.col("correct") / F.nullif(F.col("truth"), F.lit(0)),
        "purity": F.col("correct") / F.nullif(F.col("matched"), F.lit(0)),
    })


CONE_SQL = """
SELECT f.objectId, f.mjd, f.psfFlux AS flux, f.psfFluxErr AS flux_err, f.band
FROM {detections} AS f
JOIN {objects} AS o ON f.objectId = o.objectId
WHERE o.dec BETWEEN :dec - :radius / 3600 AND :dec + :radius / 3600
  AND degrees(2 * asin(least(1, sqrt(
        pow(sin(radians(o.dec - :dec) / 2), 2)
        + cos(radians(o.dec)) * cos(radians(:dec)) * pow(sin(radians(o.ra - :ra) / 2), 2))))) * 3600 <= :radius
  AND array_contains(:bands, f.band)
  AND f.psfFlux IS NOT NULL AND f.psfFluxErr > 0
ORDER BY f.mjd
"""


def sql_cone(spark: SparkSession, detections: DataFrame, objects: DataFrame, ra: float, dec: float, radius_arcsec: float, bands: list[str]) -> DataFrame:
    """Light curves of the objects in a cone, as one SQL statement with parameters."""
    args = {"ra": ra, "dec": dec, "radius": radius_arcsec, "bands": F.array(*[F.lit(b) for b in bands])}
    return spark.sql(CONE_SQL, args=args, detections=detections, objects=objects)
