import json

import pytest
from pyspark.sql import functions as F

from arealis.operators.quality import QualityError
from arealis.plans import contract
from arealis.plans.build import Build
from arealis.plans.warehouse import Warehouse, stage_measures
from arealis.sources.config import ConfigError, indicator
from arealis.sources.registry import Landing
from arealis.streaming.refresh import landed, refresh

AREAS = [f"37119{i:06d}" for i in range(1, 13)] + [f"37025{i:06d}" for i in range(1, 5)]


@pytest.fixture
def build(spark, tmp_path):
    frame = spark.createDataFrame
    years = (2014, 2019, 2024)
    acs = frame([(g[:2], g[2:5], g[5:], y, str(10 + i + y % 7), "1.5", "100", "2") for i, g in enumerate(AREAS) for y in years], "state string, county string, tract string, year int, N_001E string, N_001M string, D_001E string, D_001M string")
    counties = frame([(c, y, 60.0, 5.0, 500.0, 6.0) for c in ("37119", "37025") for y in years], "geoid string, year int, N_001E double, N_001M double, D_001E double, D_001M double")
    csv = tmp_path / "v.csv"
    csv.write_text("g,v,m\n" + "\n".join(f"{g},{i + 1},0.5" for i, g in enumerate(AREAS)))
    tables = {
        "acs": acs, "acs_county": counties, "publish": frame([(g,) for g in AREAS], "geoid string"), "edges": frame([(g, g, 1.0) for g in AREAS], "t10 string, t20 string, afact double"),
        "area": frame([(g, 2.0) for g in AREAS], "geoid string, area double"), "points": frame([(g, float(i % 4), float(i // 4)) for i, g in enumerate(AREAS)], "id string, x double, y double"),
        "viirs": frame([(g, 2022, float(i), 0.5) for i, g in enumerate(AREAS)], "geoid string, year int, value double, frac double"),
    }
    landing = Landing(tables, ["37119", "37025"], (2014,))
    return Build(spark, landing, Warehouse(spark, str(tmp_path / "wh")), tmp_path, "2026-01-01", permutations=99), csv


SHARE = {"id": 5, "slug": "share", "label": "Share", "theme": "t", "format": "percent", "source": "acs",
         "acs": {"kind": "proportion", "num_vars": ["N_001E"], "num_moe_vars": ["N_001M"], "den_var": "D_001E", "den_moe_var": "D_001M"}}


def test_build_of_a_survey_indicator(build, tmp_path):
    plan, _ = build
    app = tmp_path / "app"
    app.mkdir()
    (app / "manifest.json").write_text(json.dumps({"categories": [{"key": "t"}], "indicators": [{"id": 9, "years": [1999]}, {"id": 5, "years": [1]}]}))
    tally = plan.run(indicator(SHARE), app)
    assert sorted((r["year1"], r["year2"]) for r in tally.collect()) == [(2014, 2024), (2019, 2024)]
    stored = plan.warehouse.read()
    assert stored.count() == 48 and {r["period_start"] for r in stored.where("year = 2024").collect()} == {2020}
    again = plan.run(indicator(SHARE), reharmonize=True)
    assert plan.warehouse.read().count() == 48 and again is not None
    doc = json.loads((app / "values" / "5.json").read_text())
    assert doc["years"] == [2014, 2019, 2024] and all(len(v) == 3 for v in doc["values"].values()) and set(doc["stats"]) == {"2014", "2019", "2024"}
    manifest = json.loads((app / "manifest.json").read_text())
    assert [i["id"] for i in manifest["indicators"]] == [5, 9] and manifest["years"] == [1999, 2014, 2019, 2024]
    aggregates = json.loads((app / "aggregates.json").read_text())["5"]
    assert aggregates["countyAvg"]["37119"] == [12.0] * 3 and len(aggregates["regionMoe"]) == 3
    assert (tmp_path / "qa" / "share.json").exists() and "1 checked, 0 failed" in (tmp_path / "qa" / "summary.md").read_text()
    plan.warehouse.views()
    assert plan.spark.sql("SELECT geoid FROM tract_indicators WHERE indicator_id = 5 ORDER BY cv DESC, geoid LIMIT 3").count() == 3


def test_other_sources_and_failures(build, tmp_path):
    plan, csv = build
    lights = indicator({"id": 6, "slug": "lights", "theme": "t", "source": "viirs", "viirs": {"years": [2022]}})
    plan.run(lights)
    counties = {r["geoid"]: r["value"] for r in plan.warehouse.read_rollup(6).collect()}
    assert counties["37119"] == pytest.approx(5.5) and counties["REGION"] == pytest.approx(7.5)
    own = {"id": 7, "slug": "own", "theme": "t", "source": "tract_csv", "tract_csv": {"path": str(csv), "geoid_col": "g", "value_col": "v", "moe_col": "m", "kind": "count", "source_label": "Mine", "year": 2020}}
    plan.run(indicator(own))
    assert {r["geoid"]: r["value"] for r in plan.warehouse.read_rollup(7).collect()} == {"37119": 78, "37025": 58, "REGION": 136}
    assert contract.manifest_entry(indicator(own), [2020])["countyMethod"] == "derived from tracts" and "Mine" in contract.meta_text(indicator(own), [2020])
    with pytest.raises(QualityError):
        plan.run(indicator(own | {"id": 8, "slug": "bad", "qa": {"range": [0, 3]}}))
    assert json.loads((tmp_path / "qa" / "bad.json").read_text())["status"] == "fail" and plan.warehouse.read(8) is None
    with pytest.raises(ConfigError):
        plan.run(indicator(own | {"id": 8}), reexport=True)


@pytest.mark.parametrize("kind", ["proportion", "rate", "median"])
def test_roll_up_of_a_survey_keeps_the_reliability_of_unrounded_numbers(build, spark, kind):
    plan, _ = build
    counties = spark.createDataFrame([("37025", 2024, 3.0, 1.2, 1e6, 0.0)], "geoid string, year int, N_001E double, N_001M double, D_001E double, D_001M double")
    plan.landing.tables["acs_county"] = counties
    plan.landing.tables["population_county"] = spark.createDataFrame([("37025", 2024, 10.0)], "geoid string, year int, pop double")
    whole = {"kind": "median", "estimate_var": "N_001E", "moe_var": "N_001M"}
    rows = plan.county_rows(indicator(SHARE | {"acs": whole if kind == "median" else SHARE["acs"] | {"kind": kind}}), None).collect()
    # The margin of the share is 0.00012 percent; rounded to 0.0001, it makes a cv of 20.26.
    assert sorted((r["geoid"], r["cv"], r["reliability"]) for r in rows) == [("37025", 24.32, "caution"), ("REGION", 24.32, "caution")]
    assert rows[0].asDict().keys() == {"geoid", "year", "value", "moe", "cv", "reliability", "indicator_id"}


def test_staging_catalog(spark, tmp_path):
    rows = spark.createDataFrame([("tract", "A", 2020, "ok"), ("tract", "A", 2021, None), ("tract", "A", 2021, "ok"), ("county", "A", 2021, "caution")], "level string, measure string, year int, reliability string")
    got = {r["level"]: r for r in stage_measures(rows, str(tmp_path / "s")).collect()}
    assert got["tract"]["years"] == [2020, 2021] and (got["tract"]["n"], got["tract"]["n_ok"], got["tract"]["n_none"]) == (2, 1, 1)


def test_streaming_refresh(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = lambda r: spark.createDataFrame(r, "geoid string, indicator_id int, year int, value double, moe double, release int")
    rows([("a", 1, 2020, 1.0, None, 1), ("b", 1, 2020, 2.0, None, 2), ("a", 2, 2020, 9.0, None, 1)]).coalesce(1).write.parquet(source)
    refresh(landed(spark, source), target, state).awaitTermination()
    rows([("a", 1, 2020, 5.0, None, 3), ("b", 1, 2020, 7.0, None, 1), ("c", 1, 2021, 3.0, None, 1)]).coalesce(1).write.mode("append").parquet(source)
    refresh(landed(spark, source), target, state).awaitTermination()
    got = {(r["indicator_id"], r["geoid"]): r["value"] for r in spark.read.parquet(target).collect()}
    assert got == {(1, "a"): 5.0, (1, "b"): 2.0, (1, "c"): 3.0, (2, "a"): 9.0}
    assert spark.read.parquet(target).select(F.max("release")).first()[0] == 3
