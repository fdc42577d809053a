"""Statistics of raster cells over areas, from a table of coverage (geoid, year, value, frac)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.functions.cleaning import finite


def coverage(cells: DataFrame, parts: DataFrame) -> DataFrame:
    """Cell values (cell, year, value) with the part of each area they cover (cell, geoid, frac)."""
    return cells.join(parts, "cell")


def class_fraction(cells: DataFrame, classes: list[int]) -> DataFrame:
    """Percent of each area's covered part in one of the classes; cells without data don't count."""
    here = cells.where(finite("value").isNotNull())
    share = F.sum(F.when(F.col("value").isin(classes), F.col("frac")).otherwise(0.0)) / F.nullif(F.sum("frac"), F.lit(0.0))
    return here.groupBy("geoid", "year").agg(F.round(100 * share, 4).alias("value"))


def weighted_mean(cells: DataFrame) -> DataFrame:
    """Mean of the cell values by covered part."""
    v = finite("value")
    w = F.when(v.isNotNull(), F.col("frac"))
    return cells.groupBy("geoid", "year").agg(F.round(F.sum(v * w) / F.nullif(F.sum(w), F.lit(0.0)), 4).alias("value"))
