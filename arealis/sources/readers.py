"""Scans of landed files and decoders of published record formats."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions.cleaning import area_id, county, estimate, number, strict_year
from arealis.functions.uncertainty import moe_of_interval
from arealis.operators import crosswalk
from arealis.operators.stitch import newest_release, union_all
from arealis.sources.config import ConfigError, CsvSpec

#: Share of areas that may be unknown in the declared vintage.
VINTAGE_TOLERANCE = 0.05

#: Job-count columns that a file may have.
JOB_COLUMNS = ["C000", *(f"CA{i:02d}" for i in (1, 2, 3)), *(f"CE{i:02d}" for i in (1, 2, 3)), *(f"CNS{i:02d}" for i in range(1, 21)),
               *(f"CR{i:02d}" for i in (1, 2, 3, 4, 5, 7)), "CT01", "CT02", *(f"CD{i:02d}" for i in range(1, 5))]


def text_csv(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """A CSV file with a header, all columns as text: inferred types would cut leading zeros."""
    return spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)


def relationship_shares(spark: SparkSession, path: str, counties: list[str]) -> DataFrame:
    """Edges by land area from a pipe-separated file of tract pieces, for 2020 tracts of these counties."""
    rows = text_csv(spark, path, "|").select(F.col("GEOID_TRACT_10").alias("t10"), F.col("GEOID_TRACT_20").alias("t20"), number("AREALAND_PART").alias("area"))
    return crosswalk.area_shares(rows.where(county("t20").isin(counties)))


def land_areas(spark: SparkSession, path: str) -> DataFrame:
    """geoid and area in square miles from a stored table (geoid, aland_sqmi)."""
    return text_csv(spark, path).select("geoid", number("aland_sqmi").alias("area"))


def edge_table(spark: SparkSession, *paths: str) -> DataFrame:
    """Stored edges (t10, t20, afact) of the first path that exists: by population first, by area as the fallback."""
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return text_csv(spark, path).select("t10", "t20", number("afact").alias("afact"))
    raise ConfigError(f"there is no edge table at {' or '.join(paths)}")


def block_pieces(spark: SparkSession, path: str, counties: list[str]) -> DataFrame:
    """Land area shared by 2020 blocks of these counties and 2010 tracts, for ``crosswalk.population_shares``."""
    part = lambda state, cty, tract, block="": F.concat(F.lpad(state, 2, "0"), F.lpad(cty, 3, "0"), F.lpad(tract, 6, "0"), *([F.lpad(block, 4, "0")] if block else []))
    rows = text_csv(spark, path, "|").select(
        part("STATE_2020", "COUNTY_2020", "TRACT_2020", "BLK_2020").alias("b20"), part("STATE_2010", "COUNTY_2010", "TRACT_2010").alias("t10"), number("AREALAND_INT").alias("area")
    )
    return rows.where(county("b20").isin(counties) & (F.col("area") > 0)).groupBy("b20", "t10").agg(F.sum("area").alias("area"))


def block_population(rows: DataFrame) -> DataFrame:
    """b20, t20 and pop from census rows (state, county, tract, block, P1_001N); what is no number counts as none."""
    block = F.concat("state", "county", "tract", "block")
    return rows.select(block.alias("b20"), F.substring(block, 1, 11).alias("t20"), F.coalesce(number("P1_001N"), F.lit(0.0)).alias("pop"))


# --- Survey tables ---------------------------------------------------------

def survey_rows(rows: DataFrame, estimates: list[str], margins: list[str]) -> DataFrame:
    """Wide raw variables from rows with state, county, tract (or county alone) and year; codes for missing are NULL."""
    parts = [F.col(c) for c in ("state", "county", "tract") if c in rows.columns]
    return rows.select(F.concat(*parts).alias("geoid"), F.col("year").cast("int").alias("year"), *(estimate(c).alias(c) for c in [*estimates, *margins]))


def survey_release(spark: SparkSession, path: str, variables: list[str], last_year: int) -> DataFrame:
    """The keyless service's document: data by area, table and column, for its latest release only.

    A variable such as B01003_001E is table B01003, column 001, estimate; M is the error.
    """
    column = T.MapType(T.StringType(), T.DoubleType())
    schema = T.StructType([
        T.StructField("release", T.StructType([T.StructField("id", T.StringType())])),
        T.StructField("data", T.MapType(T.StringType(), T.MapType(T.StringType(), T.StructType([T.StructField("estimate", column), T.StructField("error", column)])))),
    ])
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    year = F.coalesce(F.substring("release.id", 4, 4).try_cast("int"), F.lit(last_year))
    rows = doc.select(year.alias("year"), F.explode("data").alias("key", "tables")).where(F.col("key").startswith("14000US") | F.col("key").startswith("05000US"))

    def value(name: str):
        table, rest = name.split("_")
        side = "error" if rest.endswith("M") else "estimate"
        return estimate(F.try_element_at(F.try_element_at("tables", F.lit(table))[side], F.lit(table + rest[:-1]))).alias(name)

    return rows.select(F.substring_index("key", "US", -1).alias("geoid"), "year", *(value(v) for v in variables))


# --- Health estimates ------------------------------------------------------

#: Columns of the service that are asked for.
HEALTH_COLUMNS = ["year", "locationid", "data_value", "low_confidence_limit", "high_confidence_limit", "totalpopulation"]


def health_rows(rows: DataFrame) -> DataFrame:
    """geoid, year, value, moe, pop from service rows, whose numbers are text; rows without an area go."""
    return rows.where(F.col("locationid").isNotNull()).select(
        F.col("locationid").alias("geoid"), strict_year("year").alias("year"), number("data_value").alias("value"),
        moe_of_interval(number("low_confidence_limit"), number("high_confidence_limit")).alias("moe"), number("totalpopulation").alias("pop"),
    )


def health_releases(releases: dict[int, tuple[DataFrame, int]]) -> DataFrame:
    """The newest release's row of each area and year; releases: number to (service rows, vintage of its tracts)."""
    tagged = [health_rows(rows).withColumns({"release": F.lit(n), "vintage": F.lit(vintage)}) for n, (rows, vintage) in sorted(releases.items())]
    return newest_release(union_all(tagged))


def health_measures(rows: DataFrame) -> DataFrame:
    return rows.select("measureid", "measure", "category", "data_value_type").distinct()


# --- Jobs ------------------------------------------------------------------

def job_blocks(spark: SparkSession, paths: dict[int, list[str]]) -> DataFrame:
    """Job counts by block from (gzipped) CSV files by year; of the known columns those that a file has."""
    if not paths:
        raise ConfigError("there are no job files for any year")
    frames = []
    for year, files in sorted(paths.items()):
        rows = text_csv(spark, files)
        frames.append(rows.select(F.lpad("w_geocode", 15, "0").alias("w_geocode"), F.lit(year).alias("year"), *(number(c).alias(c) for c in JOB_COLUMNS if c in rows.columns)))
    return union_all(frames)


# --- User files ------------------------------------------------------------

def repeated_keys(rows: DataFrame, keys: tuple[str, ...] = ("geoid", "year")) -> DataFrame:
    """One row: how many keys there are, and how many occur more than once."""
    return rows.groupBy(*keys).count().agg(F.count("*").alias("n_keys"), F.count_if(F.col("count") > 1).alias("n_repeated"))


def csv_values(spark: SparkSession, spec: CsvSpec, counties: list[str], slug: str = "?") -> DataFrame:
    """geoid, year, value, moe[, pop] of a user's file, for areas of these counties."""
    rows = text_csv(spark, spec.path)
    absent = [c for c in (spec.geoid_col, spec.value_col, spec.moe_col, spec.year_col, spec.pop_col) if c and c not in rows.columns]
    if absent:
        raise ConfigError(f"{slug}: the file has no column {', '.join(absent)}; it has {', '.join(rows.columns[:12])}")
    year = strict_year(spec.year_col) if spec.year_col else F.lit(spec.year)
    moe = number(spec.moe_col) if spec.moe_col else F.lit(None).cast("double")
    pop = [number(spec.pop_col).alias("pop")] if spec.pop_col else []
    out = rows.select(area_id(spec.geoid_col).alias("geoid"), year.cast("int").alias("year"), number(spec.value_col).alias("value"), moe.alias("moe"), *pop)
    out = out.where(county("geoid").isin(counties))
    found = repeated_keys(out).first()
    if not found["n_keys"]:
        raise ConfigError(f"{slug}: no row is in the region; does {spec.geoid_col} hold area codes of 11 digits?")
    if found["n_repeated"]:
        raise ConfigError(f"{slug}: {found['n_repeated']} pairs of area and year occur more than once")
    return out


def vintage_gaps(values: DataFrame, vintage: int, edges: DataFrame) -> DataFrame:
    """One row: areas (n_areas), those that are not in the vintage (n_missing), and of these the ones in the other (n_other)."""
    side = {2010: "t10", 2020: "t20"}
    known = [edges.select(F.col(side[v]).alias("geoid")).distinct().withColumn(name, F.lit(True)) for v, name in ((vintage, "_own"), (4030 - vintage, "_other"))]
    ids = values.select("geoid").distinct().join(known[0], "geoid", "left").join(known[1], "geoid", "left")
    missing = F.col("_own").isNull()
    return ids.agg(F.count("*").alias("n_areas"), F.count_if(missing).alias("n_missing"), F.count_if(missing & F.col("_other").isNotNull()).alias("n_other"))


def check_vintage(values: DataFrame, vintage: int, edges: DataFrame, slug: str = "?") -> None:
    """Refuses areas of another vintage: many codes are in both, so a wrong file would half fit."""
    total, absent, others = vintage_gaps(values, vintage, edges).first()
    if absent <= VINTAGE_TOLERANCE * total:
        return
    other = 4030 - vintage
    hint = f"; most of them are {other} areas, so set tract_vintage: {other}" if others > absent / 2 else ""
    raise ConfigError(f"{slug}: {absent} of {total} areas are not in the {vintage} vintage{hint}")


def csv_indicator(spark: SparkSession, spec: CsvSpec, counties: list[str], edges: DataFrame, slug: str = "?") -> DataFrame:
    """geoid, year, value, moe on 2020 areas."""
    values = csv_values(spark, spec, counties, slug)
    check_vintage(values, spec.tract_vintage, edges, slug)
    if spec.tract_vintage == 2010:
        values = crosswalk.allocate_values(values, edges, spec.kind)
    return values.select("geoid", "year", "value", "moe")


# --- Shapes ----------------------------------------------------------------

def _inside(rings: list) -> tuple[float, float]:
    """A point inside a polygon: the middle of the widest stretch of its middle line."""
    ys = [y for _, y in rings[0]]
    best = (-1.0, rings[0][0][0], rings[0][0][1])
    for part in (0.5, 0.25, 0.75, 0.375, 0.625):
        level = min(ys) + (max(ys) - min(ys)) * part
        cuts = sorted(a[0] + (level - a[1]) / (b[1] - a[1]) * (b[0] - a[0]) for r in rings for a, b in zip(r, r[1:] + r[:1]) if (a[1] > level) != (b[1] > level))
        best = max([best, *((right - left, (left + right) / 2, level) for left, right in zip(cuts[::2], cuts[1::2]))])
    return best[1], best[2]


def inner_points(spark: SparkSession, path: str, id_property: str = "GEOID") -> DataFrame:
    """id, x, y inside each (multi)polygon of a GeoJSON file."""
    schema = "features array<struct<properties: map<string,string>, geometry: struct<type: string, coordinates: string>>>"
    features = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        area = lambda r: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1])))
        for batch in batches:
            found = []
            for kind, coordinates in zip(batch["kind"], batch["coordinates"]):
                shapes = json.loads(coordinates) if kind == "MultiPolygon" else [json.loads(coordinates)]
                found.append(_inside(max(shapes, key=lambda s: area(s[0]))))
            yield pd.DataFrame({"id": batch["id"], "x": [x for x, _ in found], "y": [y for _, y in found]})

    rows = features.select(F.element_at("f.properties", id_property).alias("id"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"))
    return rows.mapInPandas(inside, "id string, x double, y double")
