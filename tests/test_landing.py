"""Builds that start from services: recorded answers behind a server on this machine."""

import gzip
import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, unquote, urlparse

import pytest

from arealis.plans.build import Build
from arealis.plans.warehouse import Warehouse
from arealis.sources import services
from arealis.sources.config import ConfigError, indicator
from arealis.sources.landing import Services
from arealis.sources.registry import Landing

AREAS = [f"37119{i:06d}" for i in range(1, 9)] + [f"37025{i:06d}" for i in range(1, 5)]
ASKED: list[str] = []


def answer(path: str, query: dict) -> bytes | None:
    if path.startswith("/api/"):
        year, names = int(path.split("/")[2]), query["get"][0].split(",")
        if year == 2009:
            return None
        if "tract" in query["for"][0]:
            place = query["in"][0].split()
            rows = [[str(10 + k) if n.endswith("E") else "1.5" for n in names] + [g[:2], g[2:5], g[5:]] for k, g in enumerate(AREAS) if f"county:{g[2:5]}" in place]
            if year == 2010 and "county:025" in place:
                return None
            return json.dumps([[*names, "state", "county", "tract"], *rows]).encode()
        return json.dumps([[*names, "state", "county"], *([str(500 + k)] * len(names) + ["37", c] for k, c in enumerate(("025", "119", "999")))]).encode()
    if path.startswith("/latest"):
        data = {f"14000US{g}": {"N": {"estimate": {"N001": 5.0}, "error": {"N001": 1.0}}, "D": {"estimate": {"D001": 50.0}, "error": {"D001": 2.0}}} for g in AREAS}
        return json.dumps({"release": {"id": "acs2023_5yr"}, "data": data}).encode()
    if path.startswith("/health/"):
        release, level = int(path.split("-")[1]), path.split("-")[2]
        places = AREAS if level == "tract" else ["37025", "37119"]
        every = [{"year": str(release - d), "locationid": g, "data_value": str(10 + k + release % 10), "low_confidence_limit": "9", "high_confidence_limit": "12", "totalpopulation": "100"} for d in (2, 3) for k, g in enumerate(places)]
        start = int(query["$offset"][0])
        assert "measureid='M'" in query["$where"][0] and query["$select"][0].startswith("year,locationid")
        return json.dumps(every[start : start + int(query["$limit"][0])]).encode()
    if path.startswith("/jobs/"):
        state, year = path.removesuffix(".csv.gz").split("/")[2].split("-")
        if year == "2001" or state == "sc":
            return None
        return gzip.compress(("w_geocode,C000,CNS07\n" + "".join(f"{g}1000,{8 + k},{k}\n" for k, g in enumerate(AREAS)) + "360010001001000,5,5\n").encode())
    return None


class Recorded(BaseHTTPRequestHandler):
    def do_GET(self):
        parts = urlparse(self.path)
        ASKED.append(unquote(self.path))
        body = answer(parts.path, parse_qs(parts.query))
        self.send_response(200 if body is not None else 404)
        self.end_headers()
        self.wfile.write(body or b"none")

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def server():
    httpd = ThreadingHTTPServer(("127.0.0.1", 0), Recorded)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}"
    httpd.shutdown()


@pytest.fixture
def landed(spark, tmp_path, server):
    region = {
        "counties": [{"fips": "37119"}, {"fips": "37025"}],
        "acs": {"api_base": f"{server}/api", "pause": 0.01, "latest_url": server + "/latest?tables={tables}&places={places}"},
        "cdc_places": {"base": server + "/health/{dataset}", "page": 7, "releases": [
            {"year": 2023, "tract": "d-2023-tract", "county": "d-2023-county", "vintage": 2010}, {"year": 2024, "tract": "d-2024-tract", "county": None, "vintage": 2020}]},
        "lodes": {"url_template": server + "/jobs/{st}-{year}.csv.gz", "states": ["nc", "sc"]},
    }
    frame = spark.createDataFrame
    base = Landing({
        "publish": frame([(g,) for g in AREAS], "geoid string"), "edges": frame([(g, g, 1.0) for g in AREAS], "t10 string, t20 string, afact double"),
        "area": frame([(g, 2.0) for g in AREAS], "geoid string, area double"), "points": frame([(g, float(i % 4), float(i // 4)) for i, g in enumerate(AREAS)], "id string, x double, y double"),
        "households": frame([(g, 2020, 4.0) for g in AREAS], "geoid string, year int, households double"),
    }, ["37119", "37025"])
    return lambda **environment: Services(spark, region, tmp_path, environment), base


def built(spark, tmp_path, landing):
    return Build(spark, landing, Warehouse(spark, str(tmp_path / "wh")), tmp_path, "2026-01-01", permutations=19)


SHARE = {"id": 1, "slug": "share", "theme": "t", "format": "percent", "source": "acs", "acs": {"kind": "proportion", "num_vars": ["N_001E"], "num_moe_vars": ["N_001M"], "den_var": "D_001E", "den_moe_var": "D_001M"}}


def test_survey_from_the_service(spark, tmp_path, landed):
    make, base = landed
    found = make(CENSUS_API_KEY="k")
    plan = built(spark, tmp_path, found.land(indicator(SHARE), [2009, 2019, 2024], base))
    plan.run(indicator(SHARE))
    assert {(r["year"], r["n"]) for r in plan.warehouse.read(1).groupBy("year").count().withColumnRenamed("count", "n").collect()} == {(2019, 12), (2024, 12)}
    assert {r["geoid"] for r in plan.warehouse.read_rollup(1).collect()} == {"37119", "37025", "REGION"}
    assert {(r["geoid"], r["pop"]) for r in found.population([2024]).collect()} == {("37025", 500.0), ("37119", 501.0)}
    with pytest.raises(services.ServiceError, match="2010"):
        found.survey(["N_001E"], [2010, 2019])
    with pytest.raises(ConfigError):
        make(ACS_PROVIDER="api").survey(["N_001E"], [2019])
    latest = make().survey(["N_001E", "N_001M", "D_001E"], [2019]).collect()
    assert len(latest) == 12 and tuple(latest[0])[1:] == (2023, 5.0, 1.0, 50.0)


def test_health_from_the_service(spark, tmp_path, landed):
    make, base = landed
    own = indicator({"id": 2, "slug": "health", "theme": "t", "source": "cdc_places", "cdc_places": {"measure_id": "M"}})
    ASKED.clear()
    plan = built(spark, tmp_path, make(CENSUS_API_KEY="k").land(own, [2021], base))
    plan.run(own)
    rows = plan.warehouse.read(2).where("year = 2021").orderBy("geoid").collect()
    assert len(rows) == 12 and plan.warehouse.read(2).select("year").distinct().count() == 3
    assert rows[0]["geoid"] == "37025000001" and rows[0]["value"] == 22.0  # the newer release of the year
    assert any("$offset=7" in a for a in ASKED)
    assert {r["geoid"] for r in plan.warehouse.read_rollup(2).collect()} == {"37119", "37025", "REGION"}


def test_jobs_from_the_service(spark, tmp_path, landed):
    make, base = landed
    own = indicator({"id": 3, "slug": "jobs", "theme": "t", "source": "lodes", "lodes": {"measure": "total_jobs"}})
    found = make()
    plan = built(spark, tmp_path, found.land(own, [2001, 2020], base))
    plan.run(own)
    assert {r["geoid"]: r["value"] for r in plan.warehouse.read(3).collect()} == {g: 8.0 + k for k, g in enumerate(AREAS)}
    ASKED.clear()
    assert found.jobs([2020]).count() == 12 and not [a for a in ASKED if "nc-2020" in a]  # downloaded once
    with pytest.raises(ConfigError):
        found.jobs([2001])
