"""What a build needs, landed from the services: survey tables, health estimates, job files and populations.

The services' addresses are parts of the region's definition, so that recorded
answers can stand in for them. Rows go through Spark data sources; only release
lists, file lists and tallies of failed requests are looked at on the driver.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions.cleaning import estimate
from arealis.operators.rollup import sum_blocks
from arealis.scratch import shared_dir, stored
from arealis.sources import readers, services
from arealis.sources.config import ConfigError, Indicator
from arealis.sources.registry import Landing

#: The variable of the total population.
POPULATION = "B01003_001E"


@dataclass
class Services:
    """The services of a region: ``region`` has counties (fips) and blocks acs, cdc_places and lodes with addresses."""

    spark: SparkSession
    region: Mapping
    folder: Path
    environment: Mapping = field(default_factory=lambda: os.environ)

    def __post_init__(self) -> None:
        for source in (services.TableService, services.PagedService):
            self.spark.dataSource.register(source)
        self.counties = [c["fips"] for c in self.region["counties"]]

    # --- Survey -----------------------------------------------------------

    def survey(self, variables: list[str], years: list[int], level: str = "tract") -> DataFrame:
        """Wide raw variables (geoid, year, ...) of the region's tracts or counties, by the chosen provider."""
        acs = self.region["acs"]
        key = self.environment.get("CENSUS_API_KEY")
        chosen = services.provider(self.environment.get("ACS_PROVIDER"), acs.get("provider", "auto"), bool(key))
        estimates, margins = ([v for v in variables if v.endswith(end)] for end in "EM")
        if chosen == "api":
            if not key:
                raise ConfigError("the provider api needs CENSUS_API_KEY")
            rows = self._tables(services.table_pages(acs["api_base"], years, self.counties, variables, level, key), variables, level)
            found = readers.survey_rows(rows, estimates, margins)
        else:
            found = self._latest(acs["latest_url"], variables, max(years), level)
        here = self.spark.createDataFrame([(c,) for c in self.counties], "county string")
        return found.join(F.broadcast(here), F.substring("geoid", 1, 5) == F.col("county"), "left_semi")  # at most a nation's counties

    def _tables(self, pages: list[tuple[int, str]], variables: list[str], level: str) -> DataFrame:
        names = ["state", "county", *(["tract"] if level == "tract" else []), "year", *variables, services.FAILURE]
        read = self.spark.read.format("table_service").schema(", ".join(f"{n} string" for n in names)).option("pages", json.dumps(pages))
        read = read.option("pause", str(self.region["acs"].get("pause", 1.5)))
        rows = stored(read.load(), "survey")
        failed = {int(r["year"]): r["n"] for r in rows.where(F.col(services.FAILURE).isNotNull()).groupBy("year").agg(F.count("*").alias("n")).collect()}
        kept = services.whole_years(pages, failed)
        return rows.where(F.col(services.FAILURE).isNull() & F.col("year").isin([str(y) for y in kept])).drop(services.FAILURE)

    def _latest(self, template: str, variables: list[str], last_year: int, level: str) -> DataFrame:
        """The keyless provider's one document, of its latest release only."""
        places = ",".join(f"140|05000US{c}" if level == "tract" else f"05000US{c}" for c in self.counties)
        url = template.format(tables=",".join(sorted({v.split("_")[0] for v in variables})), places=places)
        text = services.retried(lambda: services.fetch(url), tries=3, pause=2.0)
        name = f"{shared_dir(self.spark)}/survey-{abs(hash(url))}"
        self.spark.createDataFrame([(text,)], "value string").write.mode("overwrite").text(name)
        digits = 11 if level == "tract" else 5
        return readers.survey_release(self.spark, name, variables, last_year).where(F.length("geoid") == digits)

    def population(self, years: list[int]) -> DataFrame:
        """geoid, year and pop of the counties, by which medians and rates of the region are weighted."""
        return self.survey([POPULATION], years, "county").select("geoid", "year", estimate(POPULATION).alias("pop"))

    # --- Health estimates -------------------------------------------------

    def health(self, measure: str, value_type: str, level: str = "tract") -> DataFrame:
        """Service rows of all releases with a dataset at this level, with release and vintage; only matching rows are sent."""
        block = self.region["cdc_places"]
        releases = [r for r in block["releases"] if r.get(level)]
        area = "countyfips" if level == "tract" else "locationid"
        where = f"{area} in ({', '.join(repr(c) for c in self.counties)}) and measureid='{measure}' and data_value_type='{value_type}'"
        queries = [(r["year"], services.paged_query(block["base"].format(dataset=r[level]), where, readers.HEALTH_COLUMNS)) for r in releases]
        names = [*readers.HEALTH_COLUMNS, services.TAG]
        read = self.spark.read.format("paged_service").schema(", ".join(f"{n} string" for n in names)).option("queries", json.dumps(queries))
        vintages = self.spark.createDataFrame([(str(r["year"]), r["vintage"]) for r in releases], "_release string, vintage int")
        rows = stored(read.option("size", str(block.get("page", services.PAGE))).load(), "health")  # asked once
        rows = rows.join(F.broadcast(vintages), rows[services.TAG] == F.col("_release"))  # a row for each release
        return rows.select(*readers.HEALTH_COLUMNS, F.col(services.TAG).cast("int").alias("release"), "vintage", F.lit(measure).alias("measureid"), F.lit(value_type).alias("data_value_type"))

    # --- Jobs -------------------------------------------------------------

    def jobs(self, years: list[int]) -> DataFrame:
        """Job counts of the region's tracts from the states' files, which are downloaded once; absent years are left out."""
        block = self.region["lodes"]
        paths: dict[int, list[str]] = {}
        for year in years:
            for state in block["states"]:
                path = services.downloaded(block["url_template"].format(st=state, year=year), self.folder / "jobs" / f"{state}-{year}.csv.gz")
                if path:
                    paths.setdefault(year, []).append(str(path))
        return sum_blocks(readers.job_blocks(self.spark, paths), self.counties, readers.JOB_COLUMNS)

    # --- All that an indicator needs --------------------------------------

    def land(self, indicator: Indicator, years: list[int], landing: Landing) -> Landing:
        """The landing with the tables of the indicator's source and of its county roll-up added."""
        tables, source = dict(landing.tables), indicator.source
        if source == "acs":
            variables = [*indicator.table.estimates(), *indicator.table.margins()]
            tables |= {"survey_rows": self.survey(variables, years), "acs_county": self.survey(variables, years, "county"), "population_county": self.population(years)}
        elif source == "cdc_places":
            value_type = indicator.block.get("data_value_type", "Crude prevalence")
            by_level = {level: self.health(indicator.block["measure_id"], value_type, level) for level in ("tract", "county")}
            releases = {r["year"]: (by_level["county"].where(F.col("release") == r["year"]), r["vintage"]) for r in self.region["cdc_places"]["releases"] if r.get("county")}
            tables |= {"cdc_places": by_level["tract"], "cdc_places_county": readers.health_releases(releases), "population_county": self.population(years)}
        elif source == "lodes":
            tables["lodes"] = self.jobs(years)
        return Landing(tables, self.counties, landing.old_years)
