"""One adapter for each kind of source: (spark, indicator, landing) to (geoid, year, ...) rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from arealis.operators import jobs, zonal
from arealis.sources import readers
from arealis.sources.config import ConfigError, Indicator


@dataclass
class Landing:
    """What has been landed for a region: tables by name, its counties, and old-vintage years."""

    tables: dict[str, DataFrame]
    counties: list[str]
    old_years: tuple[int, ...] = ()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise ConfigError(f"no table {name!r} has been landed")
        return self.tables[name]


Adapter = Callable[[SparkSession, Indicator, Landing], DataFrame]
ADAPTERS: dict[str, Adapter] = {}


def adapter(name: str) -> Callable[[Adapter], Adapter]:
    """Registers a source; further ones can be added by users."""

    def add(f: Adapter) -> Adapter:
        ADAPTERS[name] = f
        return f

    return add


def fetch(spark: SparkSession, indicator: Indicator, landing: Landing) -> DataFrame:
    if indicator.source not in ADAPTERS:
        raise ConfigError(f"unknown source {indicator.source!r}")
    return ADAPTERS[indicator.source](spark, indicator, landing)


@adapter("acs")
def survey(spark, indicator, landing):
    if "survey_rows" in landing.tables:  # from the services, geoid and numbers already
        return landing["survey_rows"]
    return readers.survey_rows(landing["acs"], indicator.table.estimates(), indicator.table.margins())


@adapter("cdc_places")
def health(spark, indicator, landing):
    rows = landing["cdc_places"].where((landing["cdc_places"]["measureid"] == indicator.block["measure_id"]) & landing["cdc_places"]["data_value_type"].isin(indicator.block.get("data_value_type", "Crude prevalence")))
    by_release = {r["release"]: r["vintage"] for r in rows.select("release", "vintage").distinct().collect()}  # a row for each release
    return readers.health_releases({n: (rows.where(rows["release"] == n), v) for n, v in by_release.items()})


@adapter("lodes")
def job_counts(spark, indicator, landing):
    long = jobs.job_measures(landing["lodes"], landing["area"], landing["households"])
    return long.where(long["measure"] == indicator.block["measure"]).selectExpr("geoid", "year", "value", "CAST(NULL AS DOUBLE) AS moe")


@adapter("raster")
def land_cover(spark, indicator, landing):
    cells = landing[indicator.block["product"]]
    found = zonal.class_fraction(cells, indicator.block["classes"]) if indicator.block.get("stat", "classfrac") == "classfrac" else zonal.weighted_mean(cells)
    return found.selectExpr("geoid", "year", "value", "CAST(NULL AS DOUBLE) AS moe")


@adapter("viirs")
def night_lights(spark, indicator, landing):
    return zonal.weighted_mean(landing["viirs"]).selectExpr("geoid", "year", "value", "CAST(NULL AS DOUBLE) AS moe")


@adapter("tract_csv")
def user_file(spark, indicator, landing):
    return readers.csv_indicator(spark, indicator.csv, landing.counties, landing["edges"], indicator.slug)
