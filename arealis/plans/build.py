"""The build of an indicator, from landed rows to stored facts and documents.

Everything up to the check is one lazy plan; the actions are the check, the two
writes, and the documents, which read what has been written.
"""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions.uncertainty import compute_indicator, with_reliability
from arealis.operators import crosswalk, quality, rollup, stitch
from arealis.operators.jobs import job_rollup
from arealis.plans import contract
from arealis.plans.warehouse import Warehouse, facts
from arealis.sources.config import ConfigError, Indicator
from arealis.sources.registry import Landing, fetch


@dataclass
class Build:
    spark: SparkSession
    landing: Landing
    warehouse: Warehouse
    folder: Path
    created: str
    caution: float = 15.0
    unreliable: float = 30.0
    permutations: int = 9999

    def tidy(self, indicator: Indicator, raw: DataFrame) -> DataFrame:
        """Source rows on current areas, as value, margin, cv and reliability, for the published areas."""
        land = self.landing
        if indicator.table:
            spec = indicator.table
            current = crosswalk.harmonize(raw, land["edges"], list(land.old_years), spec.estimates(), spec.margins(), spec.kind == "median")
            rows = compute_indicator(current, spec, self.caution, self.unreliable)
            rows = rollup.per_area(rows, land["area"]) if spec.per_land_area else rows
        elif indicator.source == "cdc_places":
            old = raw.where("vintage = 2010")
            rows = with_reliability(stitch.first_wins([raw.where("vintage = 2020").select("geoid", "year", "value", "moe", "pop"), crosswalk.allocate_rates(old, land["edges"])]).drop("pop"), self.caution, self.unreliable)
        else:
            rows = with_reliability(raw.select("geoid", "year", "value", "moe"), self.caution, self.unreliable)
        return rows.join(land["publish"].select("geoid"), "geoid", "left_semi").select("geoid", "year", "value", "moe", "cv", "reliability")

    def county_rows(self, indicator: Indicator, tidy: DataFrame) -> DataFrame:
        """County and region values by the rule of the source."""
        land, source = self.landing, indicator.source
        weights = lambda: rollup.population_near(tidy, land["population"])
        if source in ("raster", "viirs"):
            rows = rollup.zonal(tidy, land["area"], self.spark.createDataFrame([(c,) for c in land.counties], "county string"))
        elif source == "lodes":
            long = job_rollup(land["lodes"], land["area"], land["households"])
            rows = long.where(F.col("measure") == indicator.block["measure"]).select("geoid", "year", "value", F.lit(None).cast("double").alias("moe"))
        elif source == "tract_csv":
            kind = indicator.csv.kind
            rows = rollup.derived(tidy, land["publish"], kind, None if kind == "count" else weights())
        elif source == "acs":
            spec = indicator.table
            published = compute_indicator(land["acs_county"], spec, self.caution, self.unreliable)
            if spec.kind == "median":
                region = rollup.population_weighted(published, rollup.population_near(published, land["population_county"]))
                region = with_reliability(region, self.caution, self.unreliable)
            else:
                pooled = rollup.pooled(land["acs_county"], spec.estimates(), spec.margins()).withColumn("geoid", F.lit(rollup.REGION))
                region = compute_indicator(pooled, spec, self.caution, self.unreliable)
            rows = published.unionByName(region.withColumn("geoid", F.lit(rollup.REGION)))
            if spec.per_land_area:
                by_county = rollup.county_areas(land["area"]).withColumnRenamed("county", "geoid")
                whole = land["area"].agg(F.lit(rollup.REGION).alias("geoid"), F.sum("area").alias("area"))
                rows = rollup.per_area(rows, by_county.unionByName(whole))
            # The numbers are rounded by now; cv and reliability are those of the unrounded ones.
            return rows.select("geoid", "year", "value", "moe", "cv", "reliability").withColumn("indicator_id", F.lit(indicator.id))
        elif source == "cdc_places":
            published = land["cdc_places_county"].select("geoid", "year", "value", "moe")
            region = rollup.population_weighted(published, rollup.population_near(published, land["population_county"]))
            rows = published.unionByName(region.withColumn("geoid", F.lit(rollup.REGION)).select("geoid", "year", "value", "moe"))
        else:
            raise ConfigError(f"no roll-up for source {source!r}")
        return with_reliability(rows, self.caution, self.unreliable).withColumn("indicator_id", F.lit(indicator.id))

    def run(self, indicator: Indicator, app: Path | None = None, reexport: bool = False, refetch: bool = False, reharmonize: bool = False) -> DataFrame | None:
        """Build and store an indicator; returns the tally of significant change.

        Stored years are kept and only missing ones fetched, unless all
        (``refetch``) or the old vintage's (``reharmonize``) are wanted anew.
        """
        stored = self.warehouse.read(indicator.id)
        if reexport:
            if stored is None:
                raise ConfigError(f"{indicator.slug}: nothing is stored to export")
        else:
            raw = fetch(self.spark, indicator, self.landing)
            if stored is not None and not refetch:
                again = list(self.landing.old_years) if reharmonize else []
                kept = stored.where(~F.col("year").isin(again)) if again else stored
                raw = raw.join(stitch.missing_years(kept, raw), "year", "left_semi")
                tidy = stitch.first_wins([self.tidy(indicator, raw), kept])
            else:
                tidy = self.tidy(indicator, raw)
            tidy = tidy.persist()
            quality.check_and_record(indicator, tidy, self.landing["publish"], self.folder / "qa", self.created)
            # What is read from the table must be complete before the table is replaced; the check has read all of it.
            self.warehouse.write(facts(tidy, indicator, self.created))
            tidy.unpersist()
            stored = self.warehouse.read(indicator.id)
        if not reexport or self.warehouse.read_rollup(indicator.id) is None:
            self.warehouse.write_rollup(self.county_rows(indicator, stored))
        self.export(indicator, stored, app)
        return stitch.change_tally(stitch.comparable_pairs(stored))

    def export(self, indicator: Indicator, tidy: DataFrame, app: Path | None = None) -> None:
        years = sorted(r["year"] for r in tidy.select("year").distinct().collect())
        values = contract.value_document(indicator, tidy, years)
        z, lisa = contract.analytic_documents(indicator, tidy, years, self.landing["points"], permutations=self.permutations)
        contract.write_documents(indicator, values, z, lisa, self.folder / "export")
        if app:
            aggregates = contract.aggregate_document(self.warehouse.read_rollup(indicator.id), years)
            contract.merge_into(app, indicator, values, z, lisa, aggregates)
            import json

            contract.write_atomic(app / "provenance.json", json.dumps(contract.provenance(self.spark.version, self.created)))
