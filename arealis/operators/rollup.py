"""From small areas to counties and the region.

Both levels come from one pass with grouping sets; a level's label is the
county or ``REGION``. Sums that only counties and years key are small, so each
of these is one partial aggregation and one small shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.cleaning import county, finite, ratio

REGION = "REGION"


def by_county_and_region(df: DataFrame, aggregates: list[Column], county_column: str = "county") -> DataFrame:
    """Aggregates for each (county, year) and (region, year), the label in ``geoid``."""
    rows = df.groupingSets([[county_column, "year"], ["year"]], county_column, "year").agg(F.grouping(county_column).alias("_whole"), *aggregates)
    label = F.when(F.col("_whole") == 1, REGION).otherwise(F.col(county_column))
    return rows.select(label.alias("geoid"), "year", *[c for c in rows.columns if c not in (county_column, "year", "_whole")])


def sum_blocks(blocks: DataFrame, counties: list[str], columns: list[str], block_column: str = "w_geocode") -> DataFrame:
    """Sums of job counts for the tracts of these counties."""
    block = F.lpad(F.col(block_column).cast("string"), 15, "0")
    here = [c for c in columns if c in blocks.columns]
    keep = blocks.withColumn("geoid", F.substring(block, 1, 11)).where(county("geoid").isin(counties))
    return keep.groupBy("geoid", *[c for c in ("year",) if c in blocks.columns]).agg(*(F.sum(c).alias(c) for c in here))


def pooled(df: DataFrame, estimates: list[str], moes: list[str]) -> DataFrame:
    """The region's raw variables for each year: estimates add up, margins in quadrature."""
    squares = [F.sqrt(F.sum(finite(c) * finite(c))).alias(c) for c in moes]
    return df.groupBy("year").agg(*(F.sum(finite(c)).alias(c) for c in estimates), *squares)


def _weighted(value: Column, moe: Column, weight: Column) -> list[Column]:
    has = value.isNotNull() & (weight > 0)
    w = F.when(has, weight)
    total = F.sum(w)
    return [(F.sum(w * value) / total).alias("value"), (F.sqrt(F.sum(w * moe * w * moe)) / total).alias("moe"), total.alias("weight")]


def population_weighted(df: DataFrame, weights: DataFrame) -> DataFrame:
    """The region's mean of areas by population (weights: geoid, year, pop); years without weight go."""
    joined = df.join(weights, ["geoid", "year"])
    out = joined.groupBy("year").agg(*_weighted(finite("value"), finite("moe"), finite("pop")))
    return out.where("weight > 0").drop("weight")


def zonal(df: DataFrame, areas: DataFrame, counties: DataFrame) -> DataFrame:
    """County and region means by land area (areas: geoid, area); each county has a row, NULL without data. No margin."""
    joined = df.join(areas, "geoid", "left").withColumn("county", county("geoid"))
    found = by_county_and_region(joined, _weighted(finite("value"), F.lit(None).cast("double"), finite("area")))
    years = df.select("year").distinct()
    labels = counties.select(F.col("county").alias("geoid")).unionByName(df.sparkSession.createDataFrame([(REGION,)], "geoid string"))
    every = labels.crossJoin(years)  # counties times years, both small
    return every.join(found, ["geoid", "year"], "left").select("geoid", "year", F.round("value", 4).alias("value"), F.lit(None).cast("double").alias("moe"))


def nearest_year(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """For each wanted year the nearest of all available years; ties go to the later one."""
    pairs = wanted.select("year").distinct().crossJoin(have.select(F.col("year").alias("have")).distinct())  # years only
    order = F.struct(-F.abs(F.col("have") - F.col("year")), F.col("have"))
    return pairs.groupBy("year").agg(F.max_by("have", order).alias("nearest"))


def population_near(wanted: DataFrame, population: DataFrame) -> DataFrame:
    """Population (geoid, year, pop) of the year nearest to each wanted one."""
    near = nearest_year(wanted, population)
    return near.join(population.withColumnRenamed("year", "nearest"), "nearest").select("geoid", "year", "pop")


def derived(df: DataFrame, expected: DataFrame, kind: str, weights: DataFrame | None = None) -> DataFrame:
    """County and region values from small areas alone (expected: geoid).

    Counts add up and are published only if every expected area has a value;
    others are means by population. A county without a usable area has a NULL.
    """
    years = df.select("year").distinct()
    grid = expected.select("geoid").distinct().crossJoin(years).join(df, ["geoid", "year"], "left").withColumn("county", county("geoid"))
    v, m = finite("value"), finite("moe")
    if kind == "count":
        complete = F.count(v) == F.count(F.lit(1))
        aggregates = [F.when(complete, F.sum(v)).alias("value"), F.when(complete, F.sqrt(F.sum(m * m))).alias("moe")]
    else:
        if weights is None:
            raise ValueError("a mean needs weights")
        grid = grid.join(weights, ["geoid", "year"], "left")
        aggregates = _weighted(v, m, finite("pop"))[:2]
    return by_county_and_region(grid, aggregates)


def county_areas(areas: DataFrame) -> DataFrame:
    return areas.groupBy(county("geoid").alias("county")).agg(F.sum("area").alias("area"))


def per_area(df: DataFrame, areas: DataFrame) -> DataFrame:
    """Value and margin over land area; NULL without a positive area."""
    out = df.join(areas, "geoid", "left").withColumns({"value": F.round(ratio("value", "area"), 4), "moe": F.round(ratio("moe", "area"), 4)})
    return out.drop("area")
