"""Job measures of areas from counts by industry and wage class."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.cleaning import county, ratio
from arealis.operators.rollup import by_county_and_region

# Two-digit industry columns of each group, total and high-wage columns.
INDUSTRIES = {
    "office": ("CNS09", "CNS10", "CNS11", "CNS12", "CNS13", "CNS14", "CNS20"),
    "industrial": ("CNS03", "CNS04", "CNS05", "CNS06", "CNS08"),
    "retail": ("CNS07", "CNS17", "CNS18"),
    "health_ed": ("CNS15", "CNS16"),
}
TOTAL, HIGH_WAGE = "C000", "CE03"


def measure_columns(columns: list[str]) -> dict[str, Column]:
    """The twelve measures over a row of counts with ``area`` and ``households``; absent counts are zero."""
    count = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in columns else F.lit(0.0)
    total = count(TOTAL)
    out = {"total_jobs": total, "job_density": ratio(total, "area"), "jobs_housing_balance": ratio(total, "households")}
    for name, parts in INDUSTRIES.items():
        jobs = reduce(lambda a, b: a + b, (count(c) for c in parts))
        out |= {f"{name}_share": ratio(100 * jobs, total), f"{name}_density": ratio(jobs, "area")}
    return out | {"high_wage_share": ratio(100 * count(HIGH_WAGE), total)}


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    wide = df.select("geoid", "year", *(F.round(c, 4).alias(n) for n, c in measure_columns(columns).items()))
    return wide.unpivot(["geoid", "year"], list(measure_columns(columns)), "measure", "value")


def job_measures(counts: DataFrame, areas: DataFrame, households: DataFrame) -> DataFrame:
    """Long rows (geoid, year, measure, value); areas: geoid, area; households: geoid, year, households."""
    return _long(counts.join(areas, "geoid", "left").join(households, ["geoid", "year"], "left"), counts.columns)


def job_rollup(counts: DataFrame, areas: DataFrame, households: DataFrame) -> DataFrame:
    """The measures of counties and the region, from their own sums rather than from the areas' measures."""
    names = [c for c in counts.columns if c not in ("geoid", "year")]
    sums = by_county_and_region(counts.withColumn("county", county("geoid")), [F.sum(c).alias(c) for c in names])
    homes = by_county_and_region(households.withColumn("county", county("geoid")), [F.sum("households").alias("households")])
    by_county = areas.groupBy(county("geoid").alias("geoid")).agg(F.sum("area").alias("area"))
    land = by_county.unionByName(areas.agg(F.lit("REGION").alias("geoid"), F.sum("area").alias("area")))
    return _long(sums.join(land, "geoid", "left").join(homes, ["geoid", "year"], "left"), counts.columns)
