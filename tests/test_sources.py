import gzip
import json

import pytest

from arealis.sources import readers, services
from arealis.sources.config import ConfigError, Definitions, csv_spec, indicator
from arealis.sources.registry import ADAPTERS, Landing, fetch

GOOD = {"path": "x.csv", "geoid_col": "g", "value_col": "v", "kind": "count", "source_label": "s", "year": 2020}


@pytest.mark.parametrize("change", [{"path": ""}, {"kind": "total"}, {"year": None, "year_col": "y"}, {"tract_vintage": 2000}, {"kind": "median", "tract_vintage": 2010},
                                    {"kind": "rate", "tract_vintage": 2010}, {"source_label": None}])
def test_bad_csv_blocks(change):
    with pytest.raises(ConfigError):
        csv_spec(GOOD | change, "slug")
    with pytest.raises(ConfigError):
        csv_spec(None, "slug")


def test_definitions(tmp_path):
    (tmp_path / "indicators").mkdir()
    (tmp_path / "region.yml").write_text("counties: [{fips: '37119'}]\n")
    (tmp_path / "indicators" / "b.yml").write_text("id: 2\nslug: b\nsource: acs\nformat: percent\nacs: {kind: proportion, num_vars: [X_001E], num_moe_vars: [X_001M], den_var: X_002E, den_moe_var: X_002M, num_vars_by_year: {2014: [X_003E]}}\n")
    (tmp_path / "indicators" / "a.yml").write_text("id: 1\nslug: a\nsource: tract_csv\nqa: {range: [0, 5]}\ntract_csv: {path: p, geoid_col: g, value_col: v, kind: count, source_label: s, year: 2020}\n")
    found = Definitions(tmp_path)
    assert found.slugs() == ["a", "b"] and found.region()["counties"][0]["fips"] == "37119"
    b = found.indicator("b").table
    assert b.percent and b.estimates() == ["X_001E", "X_002E", "X_003E"] and b.margins() == ["X_001M", "X_002M"]
    assert found.indicator("a").value_range == (0, 5) and found.indicator("a").csv.year == 2020


def test_user_file(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text("g,v,m\n37119000100.0,1.5,x\n 37025000200 ,2,0.5\n1001020100,3,1\n")
    spec = csv_spec(GOOD | {"path": str(path), "moe_col": "m"}, "s")
    got = {r["geoid"]: r for r in readers.csv_values(spark, spec, ["37119", "37025"]).collect()}
    assert set(got) == {"37119000100", "37025000200"} and got["37119000100"]["moe"] is None and got["37025000200"]["moe"] == 0.5
    for text, counties in (("g,v\n37119000100,1\n37119000100,2\n", ["37119"]), ("g,w\n37119000100,1\n", ["37119"]), ("g,v\n37119000100,1\n", ["99999"])):
        path.write_text(text)
        with pytest.raises(ConfigError):
            readers.csv_values(spark, csv_spec(GOOD | {"path": str(path)}, "s"), counties)


def test_vintage_check(spark):
    edges = spark.createDataFrame([("a100", "a100", 1.0), ("a200", "a201", 0.5), ("a200", "a202", 0.5)], "t10 string, t20 string, afact double")
    old = spark.createDataFrame([("a100",), ("a200",)], "geoid string")
    readers.check_vintage(old, 2010, edges)
    with pytest.raises(ConfigError, match="tract_vintage: 2010"):
        readers.check_vintage(old, 2020, edges)
    with pytest.raises(ConfigError, match="tract_vintage: 2020"):
        readers.check_vintage(spark.createDataFrame([("a201",), ("a202",)], "geoid string"), 2010, edges)


def test_published_formats(spark, tmp_path):
    rows = spark.createDataFrame([("37119000100", "2022", "10", "11", "9", "500"), (None, "2022", "1", "1", "1", "1"), ("b", "2022", "10", None, "9", "x")],
                                 "locationid string, year string, data_value string, low_confidence_limit string, high_confidence_limit string, totalpopulation string")
    got = {r["geoid"]: r for r in readers.health_rows(rows).collect()}
    assert len(got) == 2 and got["37119000100"]["moe"] == pytest.approx(1.645 / 1.96) and got["b"]["moe"] is None and got["b"]["pop"] is None
    both = {r["geoid"]: r for r in readers.health_releases({2024: (rows, 2010), 2025: (rows.where("locationid = 'b'"), 2020)}).collect()}
    assert both["b"]["vintage"] == 2020 and both["37119000100"]["vintage"] == 2010
    survey = spark.createDataFrame([("37", "119", "000100", 2020, "5", "-666666666")], "state string, county string, tract string, year int, E string, M string")
    assert tuple(readers.survey_rows(survey, ["E"], ["M"]).first()) == ("37119000100", 2020, 5.0, None)
    doc = {"release": {"id": "acs2023_5yr"}, "data": {"14000US37119000100": {"B01003": {"estimate": {"B01003001": 7.0}, "error": {"B01003001": 2.0}}}, "04000US37": {"B01003": {"estimate": {}, "error": {}}}}}
    (tmp_path / "r.json").write_text(json.dumps(doc))
    assert [tuple(r) for r in readers.survey_release(spark, str(tmp_path / "r.json"), ["B01003_001E", "B01003_001M"], 2024).collect()] == [("37119000100", 2023, 7.0, 2.0)]
    with gzip.open(tmp_path / "j.csv.gz", "wt") as f:
        f.write("w_geocode,C000,CNS01,other\n371190001001000,5,2,9\n")
    blocks = readers.job_blocks(spark, {2020: [str(tmp_path / "j.csv.gz")]})
    assert blocks.columns == ["w_geocode", "year", "C000", "CNS01"] and blocks.first()["C000"] == 5
    with pytest.raises(ConfigError):
        readers.job_blocks(spark, {})


def test_relations_and_shapes(spark, tmp_path):
    (tmp_path / "rel.txt").write_text("GEOID_TRACT_20|GEOID_TRACT_10|AREALAND_PART\n37119000101|37119000100|30\n37119000102|37119000100|10\n45000000100|37119000100|60\n")
    got = {r["t20"]: r["afact"] for r in readers.relationship_shares(spark, str(tmp_path / "rel.txt"), ["37119"]).collect()}
    assert got == {"37119000101": 0.75, "37119000102": 0.25}
    (tmp_path / "b.txt").write_text("STATE_2020|COUNTY_2020|TRACT_2020|BLK_2020|STATE_2010|COUNTY_2010|TRACT_2010|AREALAND_INT\n37|119|100|1000|37|119|100|5\n37|119|100|1000|37|119|100|7\n37|119|100|1001|37|119|100|x\n")
    assert [tuple(r) for r in readers.block_pieces(spark, str(tmp_path / "b.txt"), ["37119"]).collect()] == [("371190001001000", "37119000100", 12.0)]
    shape = {"type": "Polygon", "coordinates": [[[0, 0], [10, 0], [10, 1], [1, 1], [1, 10], [0, 10], [0, 0]]]}
    (tmp_path / "s.json").write_text(json.dumps({"features": [{"properties": {"GEOID": "L"}, "geometry": shape}]}))
    p = readers.inner_points(spark, str(tmp_path / "s.json")).first()
    assert p["id"] == "L" and ((0 < p["x"] < 1 and 0 < p["y"] < 10) or (0 < p["x"] < 10 and 0 < p["y"] < 1))


def test_services(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([["B_001E", "state", "county"], ["5", "37", "119"], [None, "37", "025"]]))
    spark.dataSource.register(services.TableService)
    rows = spark.read.format("table_service").schema("state string, county string, year string, B_001E string").option("pages", json.dumps([[2020, f"file://{tmp_path}/p.json"]])).load()
    assert sorted(tuple(r) for r in rows.collect()) == [("37", "025", "2020", None), ("37", "119", "2020", "5")]
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("down")
        return "ok"

    assert services.retried(flaky, sleep=lambda s: None) == "ok"
    with pytest.raises(services.ServiceError):
        services.retried(lambda: (_ for _ in ()).throw(OSError("x")), sleep=lambda s: None)
    pages = services.table_pages("http://h", [2019, 2020], ["37119", "37025"], ["S0101_C01E"])
    assert len(pages) == 4 and "/subject?" in pages[0][1]
    assert len(services.complete_years(pages, lambda u: "/2020/" in u)) == 2
    with pytest.raises(services.ServiceError):
        services.complete_years(pages, lambda u: "county:119" in u)
    assert [r["k"] for r in services.paged(lambda s: [{"k": s + i} for i in range(2 if s < 4 else 1)], 2)] == [0, 1, 2, 3, 4]
    assert services.provider(None, "auto", True) == "api" and services.provider("census_reporter", "api", True) == "census_reporter"
    assert services.preferred_tile(["x_global_average.tif", "a_global_median_masked.tif", "b_global_median_masked.tif", "c_local_median_masked.tif"]) == "b_global_median_masked.tif"


def test_unknown_source(spark):
    with pytest.raises(ConfigError):
        fetch(spark, indicator({"id": 1, "slug": "x", "source": "nowhere"}), Landing({}, []))
    assert set(ADAPTERS) == {"acs", "cdc_places", "lodes", "raster", "viirs", "tract_csv"}
