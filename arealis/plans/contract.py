"""The exported documents of an indicator.

Rows are made by Spark, an array of years for each area; a document is as large
as its areas times its years, so it is written on the driver, area by area.
"""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.operators import spatial
from arealis.operators.rollup import REGION
from arealis.operators.stats import aligned_series, summaries, summary, zscores

SCHEMA_VERSION = 1
ENDS = ("min", "max", "p1", "p99")


def _rounded(numbers, places: int = 4):
    return [None if x is None else round(x, places) for x in numbers]


def value_document(indicator, tidy: DataFrame, years: list[int], classes: int = 5) -> dict:
    """Values, margins, cv and reliability by area, with class breaks over all years and by year."""
    years = sorted(years)
    columns = ["value", "moe", "cv", "reliability"]
    doc: dict = {"schemaVersion": SCHEMA_VERSION, "indicatorId": indicator.id, "geoLevel": "tract", "years": years, **{c: {} for c in ("values", *columns[1:])}}
    for row in aligned_series(tidy, years, columns).orderBy("geoid").toLocalIterator():
        for name, c in zip(("values", *columns[1:]), columns):
            doc[name][row["geoid"]] = list(row[c])
    found = {r["year"]: r for r in summaries(tidy.where(F.col("year").isin(years)), classes=classes).collect()}  # a row for each year and one for all
    empty = {**dict.fromkeys(ENDS, 0.0), "breaks": []}
    get = lambda y: found[y].asDict() if y in found else empty
    doc["breaks"] = _rounded(get(None)["breaks"])
    doc["domain"] = {k: round(get(None)[k], 4) for k in ENDS}
    doc["stats"] = {str(y): {k: round(get(y)[k], 4) for k in ENDS} | {"breaks": _rounded(get(y)["breaks"])} for y in years}
    return doc


def analytic_documents(indicator, tidy: DataFrame, years: list[int], points: DataFrame, neighbours: int = 8, permutations: int = 9999) -> tuple[dict, dict]:
    """Scores by year (3 places) and local clusters by year; areas without a point are in no cluster."""
    years = sorted(years)
    rows = tidy.where(F.col("year").isin(years)).select("geoid", "year", "value")
    edges = spatial.knn_weights(points, neighbours)
    clusters = spatial.local_moran(rows, edges, ["year"], permutations).select("geoid", "year", "quadrant")
    both = zscores(rows, ["year"]).select("geoid", "year", F.round("z", 3).alias("z")).join(clusters, ["geoid", "year"])
    z, lisa = {}, {}
    for row in aligned_series(both, years, ["z", "quadrant"], None).orderBy("geoid").toLocalIterator():
        z[row["geoid"]] = list(row["z"])
        lisa[row["geoid"]] = [q or 0 for q in row["quadrant"]]
    return {"indicatorId": indicator.id, "years": years, "z": z}, {"indicatorId": indicator.id, "years": years, "quadrants": lisa}


def aggregate_document(rollup: DataFrame, years: list[int], classes: int = 5) -> dict:
    """Series of the region and the counties; breaks are those of the counties, margins are there if any is."""
    years = sorted(years)
    rows = {r["geoid"]: r for r in aligned_series(rollup, years, ["value", "moe"]).collect()}  # counties
    region = rows.pop(REGION, None)
    counties = sorted(rows)
    blank = [None] * len(years)
    pooled = rollup.where((F.col("geoid") != REGION) & F.col("year").isin(years)).agg(summary(F.round("value", 4), classes).alias("s")).first()["s"]
    doc = {
        "years": years, "regionAvg": list(region["value"]) if region else blank, "countyAvg": {c: list(rows[c]["value"]) for c in counties},
        "breaks": _rounded(pooled["breaks"]), "domain": {k: round(pooled[k], 4) for k in ("min", "max")},
    }
    if any(m is not None for r in [*rows.values(), *([region] if region else [])] for m in r["moe"]):
        doc |= {"regionMoe": list(region["moe"]) if region else blank, "countyMoe": {c: list(rows[c]["moe"]) for c in counties}}
    return doc


# --- Text -------------------------------------------------------------------

# Labels and links of the sources, and what their values are.
_SOURCES = {
    "acs": ("American Community Survey, 5-year estimates", "https://www.census.gov/programs-surveys/acs"),
    "cdc_places": ("CDC PLACES", "https://www.cdc.gov/places"),
    "lodes": ("LEHD Origin-Destination Employment Statistics", "https://lehd.ces.census.gov/data/"),
    "raster": ("National Land Cover Database", "https://www.mrlc.gov"),
    "viirs": ("VIIRS Nighttime Lights", "https://eogdata.mines.edu/products/vnl/"),
}


def source_of(indicator) -> tuple[str, str | None]:
    """Label and link of an indicator's source; a user's file has its own."""
    if indicator.csv:
        return indicator.csv.source_label, indicator.csv.source_url
    return _SOURCES.get(indicator.source, (indicator.source, None))


_KINDS = {
    "acs": "A survey estimate over five years with a 90 % margin of error.", "cdc_places": "A model-based estimate; its interval is shown as a 90 % margin.",
    "lodes": "A count of jobs at their place of work, with noise for privacy and without margins.", "raster": "A share of land cover, from cells by the part of an area that they cover.",
    "viirs": "A mean of light at night, from cells by the part of an area that they cover.",
}


def about(indicator) -> str:
    direction = {True: "Higher values are better.", False: "Lower values are better."}.get(indicator.higher_is_better, "Neither direction is better.")
    derived = " County and regional values are derived from the tracts." if indicator.source == "tract_csv" else ""
    return " ".join(x for x in (indicator.description, _KINDS.get(indicator.source, ""), direction + derived) if x)


def meta_text(indicator, years: list[int]) -> str:
    label, link = source_of(indicator)
    span = f"{min(years)}-{max(years)}" if years else "no years"
    named = f"[{label}]({link})" if link else label
    return f"# {indicator.label}\n\n{about(indicator)}\n\n## Why it matters\n\n{indicator.meta_why.strip()}\n\n## Source\n\n{named}, {span}.\n"


# The keys of a manifest entry, each with the indicator's attribute, or what it is made of.
ENTRY = {
    "id": "id", "slug": "slug", "label": "label", "description": "description", "category": "theme", "format": "format", "decimals": "decimals", "higherIsBetter": "higher_is_better",
    "classMethod": lambda i, years: "quantile", "years": lambda i, years: years, "geoLevels": lambda i, years: ["tract", "county"], "source": lambda i, years: source_of(i)[0],
    "vintage": lambda i, years: "–".join(str(y) for y in (years[0], years[-1])) if years else "", "metaPath": lambda i, years: f"/data/meta/m{i.id}.md",
    "related": lambda i, years: [], "hasZ": lambda i, years: True, "hasLisa": lambda i, years: True,
}
#: Further keys of the entries of some sources.
SOURCE_ENTRY = {
    "cdc_places": {"crossReleaseTrend": True, "trendNote": "Each year is a separate model release; levels are not comparable over time."},
    "tract_csv": {"countyMethod": "derived from tracts"},
}


def manifest_entry(indicator, years: list[int]) -> dict:
    made = {key: getattr(indicator, how) if isinstance(how, str) else how(indicator, years) for key, how in ENTRY.items()}
    return {**made, **SOURCE_ENTRY.get(indicator.source, {})}


def merged_manifest(old: dict, entry: dict) -> dict:
    """A manifest with the entry in its place by id, and the years of all entries."""
    others = [i for i in old["indicators"] if i["id"] != entry["id"]]
    indicators = sorted([*others, entry], key=lambda i: i["id"])
    years = sorted(set().union(*(i.get("years", []) for i in indicators)))
    return {**old, "schemaVersion": SCHEMA_VERSION, "indicators": indicators, "years": years}


# --- Files ------------------------------------------------------------------

def write_atomic(path: Path, text: str) -> None:
    """Readers see the old file or the new one, never a part."""
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent)
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(name, path)


def write_documents(indicator, values: dict, z: dict, lisa: dict, folder: Path) -> None:
    for part, doc in (("values", values), ("analytics/z", z), ("analytics/lisa", lisa)):
        write_atomic(folder / part / f"{indicator.id}.json", json.dumps(doc))


def _json_at(path: Path, otherwise: dict | None = None) -> dict:
    return json.loads(path.read_text(encoding="utf-8")) if otherwise is None or path.exists() else otherwise


def merge_into(folder: Path, indicator, values: dict, z: dict, lisa: dict, aggregates: dict) -> None:
    """Everything of an indicator in an application's folder; nothing is written if its theme is unknown there."""
    entry, old = manifest_entry(indicator, values["years"]), _json_at(folder / "manifest.json")
    if all(c["key"] != indicator.theme for c in old["categories"]):
        raise ValueError(f"{indicator.slug}: the manifest has no category {indicator.theme!r}")
    files = {
        f"meta/m{indicator.id}.md": meta_text(indicator, values["years"]),
        "manifest.json": json.dumps(merged_manifest(old, entry)),
        "aggregates.json": json.dumps({**_json_at(folder / "aggregates.json", {}), str(indicator.id): aggregates}),
    }
    write_documents(indicator, values, z, lisa, folder)
    for name, text in files.items():
        write_atomic(folder / name, text)


def provenance(spark_version: str, build_date: str | None = None) -> dict:
    """Versions of what made the export; a date only if one is given, so that builds can be compared."""
    import platform
    from importlib.metadata import PackageNotFoundError, version

    def found(name: str) -> str | None:
        try:
            return version(name)
        except PackageNotFoundError:
            return None

    doc = {"python": platform.python_version(), "spark": spark_version, "libraries": {n: found(n) for n in ("pyspark", "numpy", "pandas", "pyarrow", "rasterio", "shapely")}}
    try:  # the versions of the libraries behind rasterio
        import rasterio

        doc["libraries"] |= {"gdal": rasterio.__gdal_version__, "proj": getattr(rasterio, "__proj_version__", None)}
    except ImportError:
        doc["libraries"] |= {"gdal": None, "proj": None}
    return doc | ({"built": build_date} if build_date else {})


def definitions_yaml(rows: list[dict]) -> dict[str, str]:
    """Indicator definitions as YAML documents by slug, from compact rows."""
    import yaml

    return {r["slug"]: yaml.safe_dump(r, sort_keys=False, allow_unicode=True, width=110) for r in rows}
