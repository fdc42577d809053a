import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.operators import crosswalk, jobs, quality, rollup, spatial, stats, stitch, zonal

EDGES = [("A", "X", 0.6), ("A", "Y", 0.4), ("B", "X", 1.0)]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_allocation(spark):
    edges = frame(spark, EDGES, "t10 string, t20 string, afact double")
    raw = frame(spark, [("A", 2014, 100.0, 10.0), ("B", 2014, 50.0, 8.0), ("X", 2024, 7.0, 1.0)], "geoid string, year int, p double, m double")
    got = by(crosswalk.harmonize(raw, edges, [2014, 2019], ["p"], ["m"]), "geoid", "year")
    assert (got["X", 2014]["p"], got["X", 2014]["m"]) == (110, 10) and (got["Y", 2014]["p"], got["Y", 2014]["m"]) == (40, 4)
    assert got["X", 2024]["p"] == 7
    medians = frame(spark, [("A", 2014, 200.0, 1.0), ("B", 2014, 100.0, 1.0)], "geoid string, year int, p double, m double")
    got = by(crosswalk.allocate(medians, edges, ["p"], ["m"], median=True), "geoid")
    assert got["X"]["p"] == pytest.approx(137.5) and got["Y"]["p"] == pytest.approx(200)


def test_rates(spark):
    edges = frame(spark, [("A", "X", 1.0), ("B", "X", 1.0), ("C", "Y", 0.5), ("C", "Z", 0.5)], "t10 string, t20 string, afact double")
    rows = frame(spark, [("A", 2014, 10.0, 2.0, 1000.0), ("B", 2014, 30.0, 2.0, 3000.0), ("C", 2014, 20.0, None, 1000.0)], "geoid string, year int, value double, moe double, pop double")
    got = by(crosswalk.allocate_rates(rows, edges), "geoid")
    assert (got["X"]["value"], got["X"]["pop"]) == (pytest.approx(25), 4000) and (got["Y"]["value"], got["Y"]["pop"], got["Y"]["moe"]) == (pytest.approx(20), 500, 0)
    kept = by(crosswalk.allocate_values(rows.withColumn("moe", F.lit(None).cast("double")), edges, "rate"), "geoid")
    assert kept["X"]["moe"] is None and kept["X"]["value"] == pytest.approx(25)
    shares = crosswalk.population_shares(frame(spark, [("b1", "A", 1.0), ("b1", "B", 3.0), ("b2", "A", 1.0)], "b20 string, t10 string, area double"), frame(spark, [("b1", "X", 40.0), ("b2", "Y", 10.0)], "b20 string, t20 string, pop double"))
    assert by(shares, "t10", "t20")["A", "X"]["afact"] == 0.5
    assert {r["t10"]: round(r["s"], 6) for r in shares.groupBy("t10").agg(F.sum("afact").alias("s")).collect()} == {"A": 1.0, "B": 1.0}


def test_stitching(spark):
    rows = frame(spark, [("a", 2022, 10.0, 2024, 2010), ("a", 2022, 11.5, 2025, 2020), ("a", 2020, 9.0, 2022, 2010)], "geoid string, year int, value double, release int, vintage int")
    got = by(stitch.newest_release(rows), "year")
    assert got[2022]["value"] == 11.5 and got[2022]["vintage"] == 2020 and got[2020]["vintage"] == 2010 and "release" not in got[2022].asDict()
    first = stitch.first_wins([rows.where("release = 2025").select("geoid", "year", "value"), rows.where("release < 2025").select("geoid", "year", "value")])
    assert by(first, "year")[2022]["value"] == 11.5 and first.count() == 2
    values = frame(spark, [("a", y, float(y), 1.0) for y in (2014, 2019, 2021, 2024)], "geoid string, year int, value double, moe double")
    assert sorted(r["year1"] for r in stitch.comparable_pairs(values).collect()) == [2014, 2019]


def test_derived_rollup(spark):
    tracts = frame(spark, [(g,) for g in ("37119000100", "37119000200", "37025000100", "37007000100")], "geoid string")
    rows = frame(spark, [("37119000100", 2023, 10.0, 3.0), ("37119000200", 2023, 20.0, 4.0), ("37025000100", 2023, 5.0, None)], "geoid string, year int, value double, moe double")
    got = by(rollup.derived(rows, tracts, "count"), "geoid")
    assert (got["37119"]["value"], got["37119"]["moe"]) == (30, 5) and got["37025"]["moe"] is None
    assert got["37007"]["value"] is None and got["REGION"]["value"] is None
    weights = frame(spark, [("37119000100", 2023, 3000.0), ("37119000200", 2023, 1000.0), ("37007000100", 2023, 9.0)], "geoid string, year int, pop double")
    index = frame(spark, [("37119000100", 2023, 10.0, None), ("37119000200", 2023, 40.0, None), ("37025000100", 2023, 99.0, None)], "geoid string, year int, value double, moe double")
    got = by(rollup.derived(index, tracts, "index", weights), "geoid")
    assert got["37119"]["value"] == 17.5 and got["37025"]["value"] is None and got["REGION"]["value"] == 17.5
    near = by(rollup.nearest_year(frame(spark, [(2023,), (2020,), (2021,)], "year int"), frame(spark, [(2019,), (2024,), (2023,)], "year int")), "year")
    assert {y: r["nearest"] for y, r in near.items()} == {2023: 2023, 2020: 2019, 2021: 2023}


def test_job_measures(spark):
    blocks = frame(spark, [("371190001001000", 10, 4), ("371190001001001", 5, 1), ("450910601001000", 7, 0), ("371830001001000", 9, 9)], "w_geocode string, C000 long, CNS05 long")
    got = by(rollup.sum_blocks(blocks, ["37119", "45091"], jobs.INDUSTRIES["industrial"] + ("C000",)), "geoid")
    assert (got["37119000100"]["C000"], got["37119000100"]["CNS05"]) == (15, 5) and got["45091060100"]["C000"] == 7 and len(got) == 2
    counts = frame(spark, [("t", 2020, 100, 40, 30, 50)], "geoid string, year int, C000 long, CNS09 long, CNS05 long, CE03 long")
    long = by(jobs.job_measures(counts, frame(spark, [("t", 2.0)], "geoid string, area double"), frame(spark, [("t", 2020, 25.0)], "geoid string, year int, households double")), "measure")
    assert len(long) == 12
    assert {m: long[m]["value"] for m in ("total_jobs", "job_density", "jobs_housing_balance", "office_share", "industrial_share", "retail_share", "high_wage_share")} == {
        "total_jobs": 100, "job_density": 50, "jobs_housing_balance": 4, "office_share": 40, "industrial_share": 30, "retail_share": 0, "high_wage_share": 50}


def test_ranks_and_discoveries(spark):
    rows = frame(spark, [(i, 1, v) for i, v in enumerate([3.0, None, 1.0, 2.0, 2.0, 1000.0])], "geoid int, g int, value double")
    got = by(stats.rank_normal(rows, ["g"]), "geoid")
    assert got[1]["score"] is None and got[3]["score"] == got[4]["score"] and max(r["score"] for r in got.values() if r["score"] is not None) < 1.5
    assert got[2]["score"] < got[3]["score"] < got[0]["score"] < got[5]["score"]
    assert by(stats.zscores(frame(spark, [(0, 1, 1.0), (1, 1, None), (2, 1, 3.0)], "geoid int, g int, value double"), ["g"]), "geoid")[1]["z"] is None
    for ps, want in (((0.001, 0.6, 0.7, 0.8, 0.9), [True] + [False] * 4), ((0.4, 0.5), [False] * 2), ((0.0001, 0.0002), [True] * 2)):
        tested = stats.false_discovery(frame(spark, [(i, 1, p) for i, p in enumerate(ps)], "geoid int, g int, p double"), ["g"])
        assert [r["significant"] for r in tested.orderBy("geoid").collect()] == want
    s = frame(spark, [(float(i),) for i in range(1, 11)], "value double").agg(stats.summary("value").alias("s")).first()["s"]
    assert len(s["breaks"]) == 4 and list(s["breaks"]) == sorted(set(s["breaks"])) and s["min"] == 1 and s["p99"] == pytest.approx(9.91)
    assert frame(spark, [], "value double").agg(stats.summary("value").alias("s")).first()["s"]["breaks"] == []


def grid(spark, n, value):
    points = frame(spark, [(f"{i}_{j}", float(i), float(j)) for i in range(n) for j in range(n)], "id string, x double, y double")
    values = frame(spark, [(f"{i}_{j}", 2024, float(value(i, j))) for i in range(n) for j in range(n)], "geoid string, year int, value double")
    return points, values


def test_neighbours_equal_brute_force(spark):
    rng = random.Random(3)
    raw = [(f"p{i}", rng.random() ** 4 * 10, rng.choice([0.0, rng.random()])) for i in range(120)]
    got = {}
    for r in spatial.knn_weights(frame(spark, raw, "id string, x double, y double"), 6).collect():
        got.setdefault(r["i"], set()).add(r["j"])
        assert r["w"] == pytest.approx(1 / 6)
    for i, x, y in raw:
        near = sorted(((x - a) ** 2 + (y - b) ** 2, j) for j, a, b in raw if j != i)[:6]
        assert got[i] == {j for _, j in near}


def test_clusters(spark):
    points, values = grid(spark, 8, lambda i, j: 10 + (i * 7 + j * 3) % 5 * 0.01 if i < 3 and j < 3 else (i * 5 + j * 11) % 7 * 0.1)
    edges = spatial.knn_weights(points, 4)
    got = by(spatial.local_moran(values, edges, ["year"], 999), "geoid")
    assert got["0_0"]["quadrant"] == spatial.HIGH_HIGH and got["0_0"]["significant"]
    rng = np.random.default_rng(1)
    points, noise = grid(spark, 8, lambda i, j: rng.normal())
    n = sum(r["significant"] for r in spatial.local_moran(noise, spatial.knn_weights(points, 4), ["year"], 999).collect())
    assert n <= 0.05 * 64 + 2
    with pytest.raises(ValueError):
        spatial.local_moran(values, edges, ["year"], transform="log")


def test_normal_quantile(spark):
    from statistics import NormalDist

    ps = [k / 997 for k in range(1, 997)] + [1e-12, 1e-30, 1 - 1e-12]
    got = frame(spark, [(p,) for p in ps], "p double").select("p", stats.probit(F.col("p")).alias("q")).collect()
    assert all(r["q"] == pytest.approx(NormalDist().inv_cdf(r["p"]), rel=1e-13, abs=1e-15) for r in got)
    assert [r["q"] for r in frame(spark, [(0.0,), (1.0,), (None,)], "p double").select(stats.probit(F.col("p")).alias("q")).collect()] == [None] * 3


def test_neighbours_over_leaves(spark):
    """Several leaves, one of them a dense city, and points in one place."""
    rng = np.random.default_rng(5)
    xy = np.concatenate([rng.random((2500, 2)) * 100, 50 + rng.random((2500, 2)), np.repeat([[7.0, 7.0]], 30, axis=0)])
    got = {}
    for r in spatial.knn_weights(frame(spark, [(k, float(x), float(y)) for k, (x, y) in enumerate(xy)], "id long, x double, y double"), 5).collect():
        got.setdefault(r["i"], set()).add(r["j"])
    for k in [*range(0, len(xy), 37), len(xy) - 1]:
        d = ((xy[k] - xy) ** 2).sum(axis=1)
        d[k] = np.inf
        assert got[k] == set(np.lexsort((np.arange(len(xy)), d))[:5].tolist())
    assert len(got) == len(xy)


def test_draws():
    for n, k in ((50, 4), (10, 8)):
        d = spatial.subsets(np.random.default_rng(1), n, k, 300)
        assert d.shape == (300, k) and all(len(set(r)) == k for r in d.tolist()) and d.max() < n
    counts = np.bincount(spatial.subsets(np.random.default_rng(2), 6, 3, 20_000).ravel(), minlength=6)
    assert abs(counts - 10_000).max() < 400  # each number equally often


def test_zonal(spark):
    cells = frame(spark, [("a", 2020, 41.0, 0.5), ("a", 2020, 11.0, 1.0), ("a", 2020, None, 1.0), ("b", 2020, None, 1.0)], "geoid string, year int, value double, frac double")
    assert by(zonal.class_fraction(cells, [41, 42, 43]), "geoid")["a"]["value"] == pytest.approx(33.3333)
    means = by(zonal.weighted_mean(cells), "geoid")
    assert means["a"]["value"] == 21 and means["b"]["value"] is None


def test_quality_gate(spark):
    expected = frame(spark, [(f"g{i}",) for i in range(10)], "geoid string")
    rows = [(f"g{i}", 2023, float(i)) for i in range(10)] + [("g1", 2022, 5.0)] + [(f"g{i}", 2021, None if i else 1.0) for i in range(10)]
    tidy = frame(spark, rows, "geoid string, year int, value double")
    assert quality.check(tidy, expected, [2023, 1999], (0, 100))[2023] == {"coverage": 1.0, "null_rate": 0.0, "n": 10}
    with pytest.raises(quality.QualityError) as e:
        quality.check(tidy, expected, [2021, 2022, 2023], (0, 8))
    assert len(e.value.problems) == 3 and set(e.value.report) == {2021, 2022, 2023}


def test_series_keep_every_year(spark):
    rows = frame(spark, [("a", 2014, 1.0), ("a", 2016, 3.0), ("b", 2015, None)], "geoid string, year int, value double")
    got = by(stats.aligned_series(rows, [2016, 2014, 2015], ["value"]), "geoid")
    assert got["a"]["value"] == [1.0, None, 3.0] and got["b"]["value"] == [None] * 3
    assert math.isclose(rows.agg(F.sum("value")).first()[0], 4)
