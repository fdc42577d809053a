"""The queries over the test tables, each with SQL that gives the same rows.

Sums of doubles depend on their order in the last bits, so results are rounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions import cleaning, uncertainty
from arealis.operators import crosswalk, jobs, quality, rollup, spatial, stats, stitch, zonal
from arealis.plans.build import Build
from arealis.plans.standins import edges, population, raw, sql, table, tracts, values
from arealis.sources import readers
from arealis.sources.config import TableSpec, indicator
from arealis.sources.registry import Landing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(statement: str | None = None):
    """Registers a query under its name, with its SQL if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if statement:
            SQL[f.__name__] = statement
        return f

    return add


def rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) + F.lit(0.0) for c, n in places.items()})


# --- Uncertainty -----------------------------------------------------------

_CV = "CASE WHEN {v} <> 0 THEN {m} / 1.645 / abs({v}) * 100 END"
_BAND = "CASE WHEN {cv} > 30 THEN 'unreliable' WHEN {cv} > 15 THEN 'caution' WHEN {cv} IS NOT NULL THEN 'ok' END"


def _tidy_sql(value: str, moe: str, source: str = "raw") -> str:
    """Value and margin with cv and reliability."""
    body = f"""SELECT geoid, year, round_even(value, 4) AS value, round_even(moe, 4) AS moe, round_even(cv, 2) AS cv, {_BAND.format(cv='cv')} AS reliability
FROM (SELECT *, {_CV.format(v='value', m='moe')} AS cv FROM (SELECT geoid, year, {value} AS value, {moe} AS moe FROM {source}))"""
    return sql(body)


PROPORTION = TableSpec(kind="proportion", num_vars=("E2",), num_moe_vars=("M2",), den_vars=("E1",), den_moe_vars=("M1",), percent=True)
RATE = TableSpec(kind="rate", num_vars=("E2",), num_moe_vars=("M2",), den_vars=("E1",), den_moe_vars=("M1",), multiplier=1000.0)
OVERRIDE = TableSpec(kind="rate", num_vars=("E2", "E3"), num_moe_vars=("M2", "M3"), den_vars=("E1",), den_moe_vars=("M1",), num_vars_by_year={1997: ("E2",)}, num_moe_vars_by_year={1997: ("M2",)})

_RATIO = "sqrt({n}m * {n}m + power({n}e / E1, 2) * M1 * M1) / E1"


@query(_tidy_sql("E1", "M1"))
def acs_median_passthrough(spark, sf_dir):
    return uncertainty.compute_indicator(raw(spark, sf_dir), TableSpec(kind="median", estimate_var="E1", moe_var="M1"))


_PROPORTION_MOE = """CASE WHEN M2 * M2 - power(E2 / E1, 2) * M1 * M1 < 0 THEN sqrt(M2 * M2 + power(E2 / E1, 2) * M1 * M1) / E1
 ELSE sqrt(M2 * M2 - power(E2 / E1, 2) * M1 * M1) / E1 END * 100"""


@query(_tidy_sql("E2 / E1 * 100", _PROPORTION_MOE))
def acs_proportion_moe(spark, sf_dir):
    return uncertainty.compute_indicator(raw(spark, sf_dir), PROPORTION)


@query(_tidy_sql("E2 / E1 * 1000", "sqrt(M2 * M2 + power(E2 / E1, 2) * M1 * M1) / E1 * 1000"))
def acs_rate_ratio_moe(spark, sf_dir):
    return uncertainty.compute_indicator(raw(spark, sf_dir), RATE)


_TOP = "CASE WHEN year = 1997 THEN E2 ELSE E2 + E3 END"
_TOP_MOE = "CASE WHEN year = 1997 THEN M2 ELSE sqrt(COALESCE(M2 * M2, 0) + COALESCE(M3 * M3, 0)) END"


@query(sql(f"""SELECT geoid, year, round_even(v, 4) AS value, round_even(m, 4) AS moe, round_even(cv, 2) AS cv, {_BAND.format(cv='cv')} AS reliability
FROM (SELECT *, {_CV.format(v='v', m='m')} AS cv FROM (
  SELECT geoid, year, t / E1 AS v, CASE WHEN M2 IS NULL AND (M3 IS NULL OR year = 1997) THEN NULL ELSE sqrt(tm * tm + power(t / E1, 2) * M1 * M1) / E1 END AS m
  FROM (SELECT *, {_TOP} AS t, {_TOP_MOE} AS tm FROM raw)))"""))
def numerator_override_by_year(spark, sf_dir):
    return uncertainty.compute_indicator(raw(spark, sf_dir), OVERRIDE)


@query(sql("""SELECT geoid, round(sqrt(CASE WHEN M2 IS NULL AND M3 IS NULL THEN NULL ELSE COALESCE(M2 * M2, 0) + COALESCE(M3 * M3, 0) END), 3) AS moe,
 round(M1 / 1.645, 3) AS se, round(M1 * 1.645 / 1.96, 3) AS from_interval FROM raw"""))
def margin_sums(spark, sf_dir):
    return raw(spark, sf_dir).select(
        "geoid", F.round(uncertainty.sum_moe(["M2", "M3"]), 3).alias("moe"), F.round(uncertainty.standard_error("M1"), 3).alias("se"),
        F.round(uncertainty.moe_of_interval(F.col("E1") + F.col("M1"), F.col("E1") - F.col("M1")), 3).alias("from_interval"),
    )


@query(sql("SELECT reliability, COUNT(*) AS n FROM (SELECT " + _BAND.format(cv="cv") + " AS reliability FROM (SELECT " + _CV.format(v="E2", m="M2 * (n % 40 + 1)") + " AS cv FROM raw)) GROUP BY 1"))
def reliability_counts(spark, sf_dir):
    cv = uncertainty.cv_percent("E2", F.col("M2") * (F.col("n") % 40 + 1))
    return raw(spark, sf_dir).groupBy(uncertainty.reliability(cv).alias("reliability")).agg(F.count("*").alias("n"))


_PAIRS = """SELECT o.geoid, o.year AS year1, o.value AS v1, o.moe AS m1, n.year AS year2, n.value AS v2, n.moe AS m2
FROM vals o JOIN vals n ON o.geoid = n.geoid AND n.year = (SELECT MAX(year) FROM vals) AND n.year - o.year IN (5, 10)"""
_SIGNIFICANT = "CASE WHEN sqrt(power(m1 / 1.645, 2) + power(m2 / 1.645, 2)) > 0 THEN abs(v1 - v2) / sqrt(power(m1 / 1.645, 2) + power(m2 / 1.645, 2)) > 1.645 END"


@query(sql(f"SELECT geoid, year1, year2, round(v1, 2) AS value1, round(v2, 2) AS value2, {_SIGNIFICANT} AS significant FROM ({_PAIRS})"))
def significant_change_pairs(spark, sf_dir):
    pairs = stitch.comparable_pairs(values(spark, sf_dir))
    return pairs.select("geoid", "year1", "year2", F.round("value1", 2).alias("value1"), F.round("value2", 2).alias("value2"), "significant")


@query(sql(f"SELECT year1, year2, CAST(COUNT(*) FILTER (s) AS BIGINT) AS n_significant, COUNT(s) AS n_tested FROM (SELECT *, {_SIGNIFICANT} AS s FROM ({_PAIRS})) GROUP BY 1, 2".replace("vals", "spaced"), "spaced AS (SELECT geoid, year * 5 AS year, value, moe FROM vals)"))
def significant_change_tally(spark, sf_dir):
    spaced = values(spark, sf_dir).withColumn("year", F.col("year") * 5)  # so that there are periods of 5 and of 10 years
    return stitch.change_tally(stitch.comparable_pairs(spaced))


@query(sql("""SELECT v.geoid, v.year, round(CASE WHEN area > 0 THEN value / area END, 4) AS value, round(CASE WHEN area > 0 THEN moe / area END, 4) AS moe
FROM vals v LEFT JOIN tracts t ON v.geoid = t.geoid"""))
def density_per_area(spark, sf_dir):
    return rollup.per_area(values(spark, sf_dir), tracts(spark, sf_dir).select("geoid", "area"))


# --- Crosswalks ------------------------------------------------------------

@query(sql("""SELECT t20 AS geoid, year, round(SUM(E1 * afact), 4) AS E1, round(SUM(E2 * afact), 4) AS E2,
 round(sqrt(SUM(power(M1 * afact, 2))), 3) AS M1, round(sqrt(SUM(power(M2 * afact, 2))), 3) AS M2
FROM raw JOIN edges ON geoid = t10 GROUP BY 1, 2"""))
def crosswalk_count_allocation(spark, sf_dir):
    out = crosswalk.allocate(raw(spark, sf_dir), edges(spark, sf_dir), ["E1", "E2"], ["M1", "M2"])
    return rounded(out, E1=4, E2=4, M1=3, M2=3)


@query(sql("""SELECT t20 AS geoid, year, round(SUM(E2 * afact) / SUM(CASE WHEN E2 IS NOT NULL THEN afact END), 4) AS E2,
 round(sqrt(SUM(power(M2 * afact, 2))) / SUM(CASE WHEN M2 IS NOT NULL THEN afact END), 3) AS M2
FROM raw JOIN edges ON geoid = t10 GROUP BY 1, 2"""))
def crosswalk_median_allocation(spark, sf_dir):
    out = crosswalk.allocate(raw(spark, sf_dir), edges(spark, sf_dir), ["E2"], ["M2"], median=True)
    return rounded(out, E2=4, M2=3)


@query(sql("""SELECT t20 AS geoid, year, round(SUM(v / 100 * n * afact) / SUM(n * afact) * 100, 4) AS value,
 round(sqrt(SUM(power(COALESCE(m, 0) / 100 * n * afact, 2))) / SUM(n * afact) * 100, 4) AS moe, round(SUM(n * afact), 4) AS pop
FROM (SELECT geoid, year, 100 * E2 / E1 AS v, 100 * M2 / E1 AS m, n FROM raw) JOIN edges ON geoid = t10 WHERE v IS NOT NULL AND n > 0 GROUP BY 1, 2"""))
def crosswalk_rate_pseudocount(spark, sf_dir):
    rates = raw(spark, sf_dir).select("geoid", "year", (100 * F.col("E2") / F.col("E1")).alias("value"), (100 * F.col("M2") / F.col("E1")).alias("moe"), F.col("n").cast("double").alias("pop"))
    return rounded(crosswalk.allocate_rates(rates, edges(spark, sf_dir)), value=4, moe=4, pop=4)


@query(sql("""SELECT t10, t20, round(area / SUM(area) OVER (PARTITION BY t10), 6) AS afact FROM (
  SELECT l_suppkey AS t10, l_partkey AS t20, SUM(l_quantity) AS area FROM lineitem GROUP BY 1, 2)"""))
def crosswalk_share_normalize(spark, sf_dir):
    areas = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("t10"), F.col("l_partkey").alias("t20")).agg(F.sum("l_quantity").alias("area"))
    return crosswalk.area_shares(areas).withColumn("afact", F.round("afact", 6))


_BLOCK_SQL = """pieces AS (SELECT l_orderkey AS b20, l_suppkey AS t10, SUM(l_quantity) AS area FROM lineitem GROUP BY 1, 2),
counts AS (SELECT o_orderkey AS b20, o_custkey % 50 AS t20, CASE WHEN o_orderkey % 7 > 0 THEN floor(o_totalprice / 1000) END AS pop FROM orders),
people AS (SELECT t10, t20, SUM(COALESCE(pop, 0) * share) AS people FROM (
  SELECT p.*, area / SUM(area) OVER (PARTITION BY p.b20) AS share FROM pieces p) q LEFT JOIN counts c ON q.b20 = c.b20
  WHERE COALESCE(pop, 0) * share > 0 GROUP BY 1, 2)"""


@query(f"WITH {_BLOCK_SQL} SELECT t10, t20, round(people / SUM(people) OVER (PARTITION BY t10), 6) AS afact FROM people")
def crosswalk_population_shares(spark, sf_dir):
    pieces = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("b20"), F.col("l_suppkey").alias("t10")).agg(F.sum("l_quantity").alias("area"))
    pop = F.when(F.col("o_orderkey") % 7 > 0, F.floor(F.col("o_totalprice") / 1000).cast("double"))
    counts = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("b20"), (F.col("o_custkey") % 50).alias("t20"), pop.alias("pop"))
    return crosswalk.population_shares(pieces, counts)


@query(sql("""SELECT geoid, year, round(E1, 4) AS E1, round(M1, 3) AS M1 FROM (
  SELECT geoid, year, E1, M1 FROM raw WHERE year NOT IN (1995, 1996)
  UNION ALL SELECT t20, year, SUM(E1 * afact), sqrt(SUM(power(M1 * afact, 2))) FROM raw JOIN edges ON geoid = t10 WHERE year IN (1995, 1996) GROUP BY 1, 2)"""))
def crosswalk_vintage_split(spark, sf_dir):
    return rounded(crosswalk.harmonize(raw(spark, sf_dir), edges(spark, sf_dir), [1995, 1996], ["E1"], ["M1"]), E1=4, M1=3)


# --- Stitching, cleaning, sets ---------------------------------------------

_RELEASES = """releases AS (SELECT o_custkey AS geoid, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS release,
  MAX(o_totalprice) AS value, CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 3 THEN 2010 ELSE 2020 END AS vintage FROM orders GROUP BY 1, 2, 3, 5)"""


def _releases(spark, sf_dir):
    release = F.substring("o_orderpriority", 1, 1).cast("int")
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("geoid"), F.year("o_orderdate").alias("year"), release.alias("release")).agg(F.max("o_totalprice").alias("value"))
    return rows.withColumn("vintage", F.when(F.col("release") <= 3, 2010).otherwise(2020))


@query(f"WITH {_RELEASES} SELECT geoid, year, value, vintage FROM (SELECT *, row_number() OVER (PARTITION BY geoid, year ORDER BY release DESC) AS k FROM releases) WHERE k = 1")
def newest_release_wins(spark, sf_dir):
    return stitch.newest_release(_releases(spark, sf_dir))


@query(f"WITH {_RELEASES}, both_ AS (SELECT geoid, year, value, 0 AS p FROM releases WHERE release = 5 UNION ALL SELECT geoid, year, value, 1 FROM releases WHERE release = 1) "
       "SELECT geoid, year, value FROM (SELECT *, row_number() OVER (PARTITION BY geoid, year ORDER BY p, value) AS k FROM both_) WHERE k = 1")
def priority_dedupe_merge(spark, sf_dir):
    rows = _releases(spark, sf_dir)
    pick = lambda r: rows.where(F.col("release") == r).select("geoid", "year", "value")
    return stitch.first_wins([pick(5), pick(1)])


@query("""SELECT event_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS DOUBLE) > -1e8 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k,
 CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS estimate, TRY_CAST(event_type AS DOUBLE) AS coerced FROM events""")
def jam_and_coercion(spark, sf_dir):
    coded = F.when(F.col("event_id") % 10 == 0, -666666666.0).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", cleaning.estimate(F.get_json_object("props", "$.k")).alias("k"), cleaning.estimate(coded).alias("estimate"), cleaning.number("event_type").alias("coerced"))


@query("""SELECT c_custkey, CASE WHEN length(g) < 11 THEN lpad(g, 11, '0') ELSE g END AS geoid, substr(CASE WHEN length(g) < 11 THEN lpad(g, 11, '0') ELSE g END, 1, 5) AS county
FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '123456789' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS g FROM customer)""")
def geoid_normalize_prefix(spark, sf_dir):
    text = F.concat(F.lit("  "), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("123456789"), F.col("c_custkey"))).otherwise(F.col("c_custkey").cast("string")), F.lit(".0 "))
    coded = table(spark, sf_dir, "customer").select("c_custkey", cleaning.area_id(text).alias("geoid"))
    return coded.withColumn("county", cleaning.county("geoid"))


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def semi_region_filter(spark, sf_dir):
    here = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    return table(spark, sf_dir, "customer").join(here, "c_nationkey", "left_semi").select("c_custkey", "c_nationkey")


@query("""SELECT COUNT(*) AS n_areas, COUNT(*) FILTER (NOT old) AS n_missing, COUNT(*) FILTER (NOT old AND new) AS n_other FROM (
  SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS old, c_custkey IN (SELECT o_custkey + 1 FROM orders) AS new FROM customer)""")
def anti_vintage_check(spark, sf_dir):
    between = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("t10"), (F.col("o_custkey") + 1).alias("t20"))
    return readers.vintage_gaps(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("geoid")), 2010, between)


@query("SELECT COUNT(*) AS n_keys, COUNT(*) FILTER (n > 1) AS n_repeated FROM (SELECT COUNT(*) AS n FROM orders GROUP BY o_custkey, year(o_orderdate))")
def duplicate_keys(spark, sf_dir):
    return readers.repeated_keys(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("geoid"), F.year("o_orderdate").alias("year")))


@query("SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem WHERE year(l_shipdate) NOT IN (SELECT year(o_orderdate) FROM orders WHERE month(o_orderdate) = 12 AND year(o_orderdate) % 2 = 0)")
def set_difference_years(spark, sf_dir):
    have = table(spark, sf_dir, "orders").where("month(o_orderdate) = 12 AND year(o_orderdate) % 2 = 0").select(F.year("o_orderdate").alias("year"))
    return stitch.missing_years(have, table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year")))


# --- Roll-ups --------------------------------------------------------------

@query(sql("""SELECT CASE WHEN grouping(c) = 1 THEN 'REGION' ELSE c END AS geoid, year, round(SUM(E1), 2) AS E1, CAST(SUM(n) AS BIGINT) AS n
FROM (SELECT substr(geoid, 1, 5) AS c, year, E1, n FROM raw) GROUP BY GROUPING SETS ((c, year), (year))"""))
def grouping_sets_rollup(spark, sf_dir):
    rows = raw(spark, sf_dir).withColumn("county", cleaning.county("geoid"))
    return rollup.by_county_and_region(rows, [F.round(F.sum("E1"), 2).alias("E1"), F.sum("n").alias("n")])


@query(sql("SELECT year, round(SUM(E1), 2) AS E1, round(SUM(E2), 2) AS E2, round(sqrt(SUM(M1 * M1)), 2) AS M1, round(sqrt(SUM(M2 * M2)), 2) AS M2 FROM raw GROUP BY 1"))
def pooled_region_quadrature(spark, sf_dir):
    return rounded(rollup.pooled(raw(spark, sf_dir), ["E1", "E2"], ["M1", "M2"]), E1=2, E2=2, M1=2, M2=2)


_NEAR = """near AS (SELECT w.year, max_by(h.year, -abs(h.year - w.year) * 10000 + h.year) AS have
  FROM (SELECT DISTINCT year FROM raw) w, (SELECT DISTINCT year FROM population) h GROUP BY 1),
weights AS (SELECT p.geoid, n.year, p.pop FROM near n JOIN population p ON p.year = n.have)"""


@query(sql("SELECT geoid, year, pop FROM weights", _NEAR))
def nearest_year_population(spark, sf_dir):
    return rollup.population_near(raw(spark, sf_dir), population(spark, sf_dir))


@query(sql("""SELECT v.year, round(SUM(value * pop) / SUM(pop), 3) AS value, round(sqrt(SUM(power(moe * pop, 2))) / SUM(pop), 3) AS moe
FROM vals v JOIN weights w ON v.geoid = w.geoid AND v.year = w.year WHERE pop > 0 AND value IS NOT NULL GROUP BY 1""", _NEAR))
def popweighted_region(spark, sf_dir):
    weights = rollup.population_near(raw(spark, sf_dir), population(spark, sf_dir))
    return rounded(rollup.population_weighted(values(spark, sf_dir), weights), value=3, moe=3)


@query(sql("""SELECT l.geoid, y.year, round(v, 4) AS value FROM (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS geoid FROM nation UNION ALL SELECT 'REGION') l
CROSS JOIN (SELECT DISTINCT year FROM vals) y LEFT JOIN (
  SELECT CASE WHEN grouping(c) = 1 THEN 'REGION' ELSE c END AS geoid, year, SUM(value * area) / SUM(CASE WHEN value IS NOT NULL THEN area END) AS v
  FROM (SELECT substr(v.geoid, 1, 5) AS c, year, value, area FROM vals v LEFT JOIN tracts t ON v.geoid = t.geoid) GROUP BY GROUPING SETS ((c, year), (year))) s
ON l.geoid = s.geoid AND y.year = s.year"""))
def zonal_weighted_mean(spark, sf_dir):
    counties = table(spark, sf_dir, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("county"))
    return rollup.zonal(values(spark, sf_dir), tracts(spark, sf_dir).select("geoid", "area"), counties).drop("moe")


@query(sql("""SELECT CASE WHEN grouping(c) = 1 THEN 'REGION' ELSE c END AS geoid, year,
 round(CASE WHEN COUNT(value) = COUNT(*) THEN SUM(value) END, 2) AS value, round(CASE WHEN COUNT(value) = COUNT(*) THEN sqrt(SUM(moe * moe)) END, 2) AS moe
FROM (SELECT substr(t.geoid, 1, 5) AS c, y.year, v.value, v.moe FROM tracts t CROSS JOIN (SELECT DISTINCT year FROM raw WHERE year > 1995) y
  LEFT JOIN (SELECT geoid, year, E2 AS value, M2 AS moe FROM raw WHERE year > 1995) v ON v.geoid = t.geoid AND v.year = y.year) GROUP BY GROUPING SETS ((c, year), (year))"""))
def complete_count_rollup(spark, sf_dir):
    rows = raw(spark, sf_dir).where("year > 1995").select("geoid", "year", F.col("E2").alias("value"), F.col("M2").alias("moe"))
    return rounded(rollup.derived(rows, tracts(spark, sf_dir), "count"), value=2, moe=2)


_JOBS = """counts AS (SELECT geoid, year, CAST(n AS DOUBLE) AS C000, CAST(floor(n * 0.3) AS DOUBLE) AS CNS09, CAST(floor(n * 0.2) AS DOUBLE) AS CNS05, CAST(floor(n * 0.1) AS DOUBLE) AS CNS07, CAST(floor(n * 0.5) AS DOUBLE) AS CE03 FROM raw)"""
_MEASURES = [("total_jobs", "C000"), ("job_density", "CASE WHEN area > 0 THEN C000 / area END"), ("jobs_housing_balance", "CASE WHEN pop > 0 THEN C000 / pop END"),
             ("office_share", "CASE WHEN C000 > 0 THEN 100 * CNS09 / C000 END"), ("office_density", "CASE WHEN area > 0 THEN CNS09 / area END"),
             ("industrial_share", "CASE WHEN C000 > 0 THEN 100 * CNS05 / C000 END"), ("industrial_density", "CASE WHEN area > 0 THEN CNS05 / area END"),
             ("retail_share", "CASE WHEN C000 > 0 THEN 100 * CNS07 / C000 END"), ("retail_density", "CASE WHEN area > 0 THEN CNS07 / area END"),
             ("health_ed_share", "CASE WHEN C000 > 0 THEN 0.0 END"), ("health_ed_density", "CASE WHEN area > 0 THEN 0.0 END"),
             ("high_wage_share", "CASE WHEN C000 > 0 THEN 100 * CE03 / C000 END")]
_LONG = " UNION ALL ".join(f"SELECT geoid, year, '{name}' AS measure, round({x}, 4) AS value FROM wide" for name, x in _MEASURES)


def _job_inputs(spark, sf_dir):
    part = lambda share, name: F.floor(F.col("n") * share).cast("double").alias(name)
    counts = raw(spark, sf_dir).select("geoid", "year", F.col("n").cast("double").alias("C000"), part(0.3, "CNS09"), part(0.2, "CNS05"), part(0.1, "CNS07"), part(0.5, "CE03"))
    return counts, tracts(spark, sf_dir).select("geoid", "area"), population(spark, sf_dir).withColumnRenamed("pop", "households")


@query(sql(_LONG, _JOBS + ", wide AS (SELECT c.*, area, pop FROM counts c LEFT JOIN tracts t ON c.geoid = t.geoid LEFT JOIN population p ON c.geoid = p.geoid AND c.year = p.year)"))
def jobs_measures_long(spark, sf_dir):
    return jobs.job_measures(*_job_inputs(spark, sf_dir))


@query(sql(_LONG, _JOBS + """, sums AS (SELECT CASE WHEN grouping(c) = 1 THEN 'REGION' ELSE c END AS geoid, year, SUM(C000) AS C000, SUM(CNS09) AS CNS09, SUM(CNS05) AS CNS05, SUM(CNS07) AS CNS07, SUM(CE03) AS CE03
  FROM (SELECT substr(geoid, 1, 5) AS c, * FROM counts) GROUP BY GROUPING SETS ((c, year), (year))),
homes AS (SELECT CASE WHEN grouping(c) = 1 THEN 'REGION' ELSE c END AS geoid, year, SUM(pop) AS pop FROM (SELECT substr(geoid, 1, 5) AS c, * FROM population) GROUP BY GROUPING SETS ((c, year), (year))),
land AS (SELECT substr(geoid, 1, 5) AS geoid, SUM(area) AS area FROM tracts GROUP BY 1 UNION ALL SELECT 'REGION', SUM(area) FROM tracts),
wide AS (SELECT s.*, area, pop FROM sums s LEFT JOIN land l ON s.geoid = l.geoid LEFT JOIN homes h ON s.geoid = h.geoid AND s.year = h.year)"""))
def jobs_measures_rollup(spark, sf_dir):
    return jobs.job_rollup(*_job_inputs(spark, sf_dir))


_CODE = "lpad(CAST(o_custkey % 25 AS VARCHAR), 5, '0') || lpad(CAST(o_custkey % 400 AS VARCHAR), 6, '0') || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0')"


@query(f"""SELECT substr(code, 1, 11) AS geoid, year, SUM(a) AS C000, SUM(b) AS CNS05 FROM (
  SELECT {_CODE} AS code, CAST(year(o_orderdate) AS INTEGER) AS year, floor(o_totalprice / 1000) AS a, floor(o_totalprice / 5000) AS b FROM orders) WHERE substr(code, 1, 5) IN ('00001', '00007', '00024') GROUP BY 1, 2""")
def blocks_to_tracts(spark, sf_dir):
    digits = lambda c, n: F.lpad(c.cast("string"), n, "0")
    code = F.concat(digits(F.col("o_custkey") % 25, 5), digits(F.col("o_custkey") % 400, 6), digits(F.col("o_orderkey") % 10000, 4))
    jobs_in = lambda size, name: F.floor(F.col("o_totalprice") / size).cast("double").alias(name)
    blocks = table(spark, sf_dir, "orders").select(code.alias("w_geocode"), F.year("o_orderdate").alias("year"), jobs_in(1000, "C000"), jobs_in(5000, "CNS05"))
    return rollup.sum_blocks(blocks, ["00001", "00007", "00024"], ["C000", "CNS05", "CE03"])


@query(sql("""SELECT t20 AS geoid, year, round(SUM(v / 100 * n * afact) / SUM(n * afact) * 100, 4) AS value, CAST(NULL AS DOUBLE) AS moe
FROM (SELECT geoid, year, 100 * E2 / E1 AS v, n FROM raw) JOIN edges ON geoid = t10 WHERE v IS NOT NULL AND n > 0 GROUP BY 1, 2"""))
def user_rates_without_margins(spark, sf_dir):
    rates = raw(spark, sf_dir).select("geoid", "year", (100 * F.col("E2") / F.col("E1")).alias("value"), F.lit(None).cast("double").alias("moe"), F.col("n").cast("double").alias("pop"))
    return rounded(crosswalk.allocate_values(rates, edges(spark, sf_dir), "rate"), value=4)


@query(sql("""SELECT CASE WHEN grouping(c) = 1 THEN 'REGION' ELSE c END AS geoid, year, round(SUM(v * w) / SUM(w), 4) AS value, round(sqrt(SUM(power(m * w, 2))) / SUM(w), 4) AS moe
FROM (SELECT substr(t.geoid, 1, 5) AS c, y.year, r.v, r.m, CASE WHEN r.v IS NOT NULL AND p.pop > 0 THEN p.pop END AS w FROM tracts t CROSS JOIN (SELECT DISTINCT year FROM raw) y
  LEFT JOIN (SELECT geoid, year, 100 * E2 / E1 AS v, 100 * M2 / E1 AS m FROM raw) r ON r.geoid = t.geoid AND r.year = y.year
  LEFT JOIN population p ON p.geoid = t.geoid AND p.year = y.year) GROUP BY GROUPING SETS ((c, year), (year))"""))
def derived_mean_rollup(spark, sf_dir):
    rows = raw(spark, sf_dir).select("geoid", "year", (100 * F.col("E2") / F.col("E1")).alias("value"), (100 * F.col("M2") / F.col("E1")).alias("moe"))
    return rounded(rollup.derived(rows, tracts(spark, sf_dir), "index", population(spark, sf_dir)), value=4, moe=4)


@query(sql("SELECT substr(geoid, 1, 5) AS county, round(SUM(area), 2) AS area, round(SUM(area) * 1000000 / 2589988.110336, 4) AS square_miles FROM tracts GROUP BY 1"))
def county_land(spark, sf_dir):
    land = rollup.county_areas(tracts(spark, sf_dir).select("geoid", "area"))
    return rounded(land.withColumn("square_miles", cleaning.square_miles(F.col("area") * 1000000)), area=2, square_miles=4)


def _published(spark, sf_dir):
    """Raw variables of counties, as a survey publishes them."""
    squares = lambda c: F.sqrt(F.sum(F.col(c) * F.col(c))).alias(c)
    return raw(spark, sf_dir).groupBy(cleaning.county("geoid").alias("geoid"), "year").agg(F.sum("E1").alias("E1"), F.sum("E2").alias("E2"), squares("M1"), squares("M2"))


def _roll_up(spark, sf_dir, source: dict, tables: dict):
    """What a build publishes for counties and the region, by the rule of the source."""
    own = indicator({"id": 1, "slug": "x", "theme": "t", **source})
    return Build(spark, Landing(tables, []), None, None, "").county_rows(own, values(spark, sf_dir)).drop("indicator_id")


_ROLLED = """rolled AS (SELECT CASE WHEN grouping(c) = 1 THEN 'REGION' ELSE c END AS geoid, year, SUM(E1) AS E1, SUM(E2) AS E2, sqrt(SUM(M1 * M1)) AS M1, sqrt(SUM(M2 * M2)) AS M2
  FROM (SELECT substr(geoid, 1, 5) AS c, * FROM raw) GROUP BY GROUPING SETS ((c, year), (year)))"""


@query(sql(
    f"""SELECT geoid, year, round_even(value, 4) AS value, round_even(moe, 4) AS moe, round_even(cv, 2) AS cv, {_BAND.format(cv='cv')} AS reliability
FROM (SELECT *, {_CV.format(v='value', m='moe')} AS cv FROM (SELECT geoid, year, E2 / E1 * 100 AS value, {_PROPORTION_MOE} AS moe FROM rolled))""", _ROLLED))
def survey_rollup(spark, sf_dir):
    survey = {"source": "acs", "format": "percent", "acs": {"kind": "proportion", "num_vars": ["E2"], "num_moe_vars": ["M2"], "den_var": "E1", "den_moe_var": "M1"}}
    return _roll_up(spark, sf_dir, survey, {"acs_county": _published(spark, sf_dir)})


@query(sql(f"""SELECT geoid, year, round_even(value, 4) AS value, round_even(moe, 4) AS moe, round_even(cv, 2) AS cv, {_BAND.format(cv='cv')} AS reliability
FROM (SELECT *, {_CV.format(v='value', m='moe')} AS cv FROM (SELECT * FROM published UNION ALL SELECT 'REGION', p.year, SUM(value * pop) / SUM(pop), sqrt(SUM(power(moe * pop, 2))) / SUM(pop)
  FROM published p JOIN near n ON p.year = n.year JOIN people q ON q.geoid = p.geoid AND q.year = n.have GROUP BY 2))""",
           """published AS (SELECT substr(geoid, 1, 5) AS geoid, year, SUM(E2) / SUM(E1) * 100 AS value, sqrt(SUM(M2 * M2)) / SUM(E1) * 100 AS moe FROM raw GROUP BY 1, 2),
people AS (SELECT substr(geoid, 1, 5) AS geoid, year, SUM(pop) AS pop FROM population GROUP BY 1, 2),
near AS (SELECT w.year, max_by(h.year, -abs(h.year - w.year) * 10000 + h.year) AS have FROM (SELECT DISTINCT year FROM raw) w, (SELECT DISTINCT year FROM population) h GROUP BY 1)"""))
def health_rollup(spark, sf_dir):
    rates = _published(spark, sf_dir).select("geoid", "year", (F.col("E2") / F.col("E1") * 100).alias("value"), (F.col("M2") / F.col("E1") * 100).alias("moe"))
    people = population(spark, sf_dir).groupBy(cleaning.county("geoid").alias("geoid"), "year").agg(F.sum("pop").alias("pop"))
    return _roll_up(spark, sf_dir, {"source": "cdc_places", "cdc_places": {}}, {"cdc_places_county": rates, "population_county": people})


# --- Scores, ranks, quantiles ----------------------------------------------

@query(sql("""SELECT geoid, year, round((value - AVG(value) OVER g) / CASE WHEN stddev_samp(value) OVER g > 0 THEN stddev_samp(value) OVER g END, 6) AS z
FROM vals WINDOW g AS (PARTITION BY year)"""))
def zscore_by_year(spark, sf_dir):
    return stats.zscores(values(spark, sf_dir), ["year"]).select("geoid", "year", F.round("z", 6).alias("z"))


@query("SELECT p_partkey, p_brand, rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (COUNT(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2 AS rank FROM part")
def rank_average(spark, sf_dir):
    ranked = stats.average_ranks(table(spark, sf_dir, "part"), ["p_brand"], "p_size")
    return ranked.select("p_partkey", "p_brand", F.col("rank").cast("double").alias("rank"))


_P = "CAST(p_partkey * 7919 % 10007 AS DOUBLE) / 10007 * p_size / 50"


@query(f"""SELECT p_partkey, p_brand, COALESCE(k <= MAX(CASE WHEN p <= k / m * 0.05 THEN k END) OVER (PARTITION BY p_brand), FALSE) AS significant FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p, p_partkey) AS k, COUNT(*) OVER (PARTITION BY p_brand) AS m FROM (SELECT p_partkey, p_brand, power({_P}, 3) AS p FROM part))""")
def bh_fdr(spark, sf_dir):
    p = F.pow((F.col("p_partkey") * 7919 % 10007).cast("double") / 10007 * F.col("p_size") / 50, 3)
    tested = stats.false_discovery(table(spark, sf_dir, "part").withColumn("p", p), ["p_brand"])
    return tested.select("p_partkey", "p_brand", "significant")


@query("SELECT p_brand, round(quantile_cont(p_retailprice, 0.2), 4) AS b1, round(quantile_cont(p_retailprice, 0.4), 4) AS b2, round(quantile_cont(p_retailprice, 0.6), 4) AS b3, round(quantile_cont(p_retailprice, 0.8), 4) AS b4, "
       "CAST(len(list_distinct(quantile_cont(p_size, [0.2, 0.4, 0.6, 0.8]))) AS INTEGER) AS n_size_breaks FROM part GROUP BY 1")
def quantile_breaks(spark, sf_dir):
    rows = table(spark, sf_dir, "part").groupBy("p_brand").agg(stats.class_breaks("p_retailprice").alias("b"), F.size(stats.class_breaks("p_size")).alias("n_size_breaks"))
    return rows.select("p_brand", *(F.round(F.get("b", F.lit(i)), 4).alias(f"b{i + 1}") for i in range(4)), "n_size_breaks")


_STATS = "round(MIN(value), 2) AS min, round(MAX(value), 2) AS max, round(quantile_cont(value, 0.01), 2) AS p1, round(quantile_cont(value, 0.99), 2) AS p99, round(quantile_cont(value, 0.2), 2) AS b1, round(quantile_cont(value, 0.4), 2) AS b2, round(quantile_cont(value, 0.6), 2) AS b3, round(quantile_cont(value, 0.8), 2) AS b4"


@query(sql(f"SELECT year, grouping(year) = 1 AS pooled, {_STATS} FROM vals GROUP BY GROUPING SETS ((year), ())"))
def summary_stats(spark, sf_dir):
    rows = stats.summaries(values(spark, sf_dir))
    return rounded(rows.select("*", *(F.get("breaks", F.lit(k)).alias(f"b{k + 1}") for k in range(4))).drop("breaks"), min=2, max=2, p1=2, p99=2, b1=2, b2=2, b3=2, b4=2)


@query(sql("""SELECT g.geoid, string_agg(COALESCE(CAST(CAST(round(E2) AS BIGINT) AS VARCHAR), 'null'), ',' ORDER BY y.year) AS series
FROM (SELECT DISTINCT geoid FROM raw) g CROSS JOIN (SELECT UNNEST(range(1994, 2003)) AS year) y LEFT JOIN raw r ON r.geoid = g.geoid AND r.year = y.year GROUP BY 1"""))
def densified_series_arrays(spark, sf_dir):
    years = list(range(1994, 2003))
    rows = stats.aligned_series(raw(spark, sf_dir).select("geoid", "year", F.round("E2").cast("long").alias("value")), years, ["value"])
    return rows.select("geoid", F.array_join(F.transform("value", lambda v: v.cast("string")), ",", "null").alias("series"))


@query("SELECT p_partkey, ntile(3) OVER (ORDER BY p_size, p_partkey) AS p_size_third, ntile(3) OVER (ORDER BY p_retailprice, p_partkey) AS p_retailprice_third, "
       "(ntile(3) OVER (ORDER BY p_retailprice, p_partkey) - 1) * 3 + ntile(3) OVER (ORDER BY p_size, p_partkey) AS bivariate_class FROM part")
def bivariate_terciles(spark, sf_dir):
    rows = stats.terciles(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), "p_size", "p_retailprice", "p_partkey")
    return rows.select("p_partkey", *(F.col(c).cast("long").alias(c) for c in ("p_size_third", "p_retailprice_third", "bivariate_class")))


@query("""SELECT round(corr(x, y), 8) AS pearson, round(corr(rx, ry), 8) AS spearman, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 4) AS intercept FROM (
  SELECT x, y, rank() OVER (ORDER BY x) + (COUNT(*) OVER (PARTITION BY x) - 1) / 2 AS rx, rank() OVER (ORDER BY y) + (COUNT(*) OVER (PARTITION BY y) - 1) / 2 AS ry
  FROM (SELECT CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM part))""")
def corr_pearson_spearman(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    return rounded(stats.association(rows, "x", "y"), pearson=8, spearman=8, slope=6, intercept=4)


# --- Space -----------------------------------------------------------------

_POINTS = "points AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS value FROM embeddings)"
_KNN = _POINTS + """, knn AS (SELECT i, j, 1.0 / COUNT(*) OVER (PARTITION BY i) AS w FROM (
  SELECT a.id AS i, b.id AS j, row_number() OVER (PARTITION BY a.id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.id) AS k
  FROM points a JOIN points b ON a.id <> b.id) WHERE k <= 8)"""


def _points(spark, sf_dir):
    part = lambda k: F.col("embedding")[k].cast("double")
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), part(0).alias("x"), part(1).alias("y"), part(2).alias("value"))


@query(f"WITH {_KNN} SELECT i, j, w FROM knn")
def knn_weights(spark, sf_dir):
    return spatial.knn_weights(_points(spark, sf_dir))


_LAG = _KNN + """, z AS (SELECT id, (value - AVG(value) OVER ()) / stddev_samp(value) OVER () AS z FROM points),
lagged AS (SELECT i AS geoid, SUM(w * n.z) / SUM(w) AS lag FROM knn JOIN z n ON j = n.id GROUP BY 1)"""


@query(f"WITH {_LAG} SELECT geoid, round(lag, 6) AS lag, round(z * lag, 6) AS local_i, CASE WHEN z >= 0 AND lag >= 0 THEN 1 WHEN z < 0 AND lag < 0 THEN 3 WHEN z >= 0 THEN 4 ELSE 2 END AS quadrant FROM lagged JOIN z ON geoid = id")
def spatial_lag_quadrant(spark, sf_dir):
    points = _points(spark, sf_dir)
    scored = stats.zscores(points.select(F.col("id").alias("geoid"), "value", F.lit(1).alias("g")), ["g"])
    out = spatial.with_quadrant(spatial.spatial_lag(scored, spatial.knn_weights(points), ["g"]))
    return rounded(out, lag=6, local_i=6).select("geoid", "lag", "local_i", "quadrant")


@query(f"WITH {_LAG} SELECT round(SUM(z * lag) / SUM(z * z), 6) AS moran_i FROM lagged JOIN z ON geoid = id")
def global_moran(spark, sf_dir):
    points = _points(spark, sf_dir)
    rows = points.select(F.col("id").alias("geoid"), "value", F.lit(1).alias("g"))
    return rounded(spatial.global_moran(rows, spatial.knn_weights(points), ["g"]), moran_i=6).select("moran_i")


@query()
def lisa_permutation(spark, sf_dir):
    points = _points(spark, sf_dir)
    rows = points.select(F.col("id").cast("string").alias("geoid"), F.lit(2024).alias("year"), (F.col("x") + F.col("value")).alias("value"))
    links = spatial.knn_weights(points).select(F.col("i").cast("string").alias("i"), F.col("j").cast("string").alias("j"), "w")
    return spatial.local_moran(rows, links, ["year"]).select("geoid", "year", "local_i", "p", "significant", "quadrant")


def _probit_sql(p: str) -> str:
    """The normal quantile in SQL, from the same coefficients."""

    def fraction(r: str, parts) -> str:
        top, bottom = (repr(c[-1]) for c in parts)
        for x, y in zip(parts[0][-2::-1], parts[1][-2::-1]):
            top, bottom = f"({top} * {r} + {x!r})", f"({bottom} * {r} + {y!r})"
        return f"({top} / {bottom})"

    root = f"sqrt(-ln(least({p}, 1 - {p})))"
    tail = f"CASE WHEN {root} <= 5 THEN {fraction(f'({root} - 1.6)', stats.MIDDLE)} ELSE {fraction(f'({root} - 5)', stats.TAIL)} END"
    center = f"({p} - 0.5) * {fraction(f'(0.180625 - ({p} - 0.5) * ({p} - 0.5))', stats.CENTER)}"
    return f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN {center} ELSE sign({p} - 0.5) * {tail} END"


@query(f"SELECT p_partkey, p_brand, round({_probit_sql('p')}, 9) AS score FROM (SELECT *, (rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (COUNT(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2) / (COUNT(*) OVER (PARTITION BY p_brand) + 1) AS p FROM part)")
def rank_normal_scores(spark, sf_dir):
    return rounded(stats.rank_normal(table(spark, sf_dir, "part"), ["p_brand"], "p_size").select("p_partkey", "p_brand", "score"), score=9)


@query(f"WITH {_KNN}, ranked AS (SELECT id, (rank() OVER (ORDER BY v) + (COUNT(*) OVER (PARTITION BY v) - 1) / 2) / (COUNT(*) OVER () + 1) AS p FROM (SELECT id, x + value AS v FROM points)), "
       f"scores AS (SELECT id, {_probit_sql('p')} AS s FROM ranked), z AS (SELECT id, (s - AVG(s) OVER ()) / stddev_samp(s) OVER () AS z FROM scores), "
       "lagged AS (SELECT i AS geoid, SUM(w * n.z) / SUM(w) AS lag FROM knn JOIN z n ON j = n.id GROUP BY 1) "
       "SELECT geoid, round(z, 6) AS z, round(lag, 6) AS lag, round(z * lag, 6) AS local_i FROM lagged JOIN z ON geoid = id")
def lisa_scores(spark, sf_dir):
    """The local statistic before its permutations."""
    points = _points(spark, sf_dir)
    rows = points.select(F.col("id").alias("geoid"), F.lit(2024).alias("year"), (F.col("x") + F.col("value")).alias("value"))
    scored = stats.zscores(stats.rank_normal(rows, ["year"]), ["year"], "score")
    out = spatial.with_quadrant(spatial.spatial_lag(scored, spatial.knn_weights(points), ["year"]))
    return rounded(out.select("geoid", "z", "lag", "local_i"), z=6, lag=6, local_i=6)


_CELLS = "cells AS (SELECT l_suppkey AS geoid, CAST(year(l_shipdate) AS INTEGER) AS year, CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS class, l_discount AS value, l_quantity / 50 AS frac FROM lineitem)"


def _cells(spark, sf_dir, value):
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("geoid"), F.year("l_shipdate").alias("year"), value.alias("value"), (F.col("l_quantity") / 50).alias("frac"))


@query(f"WITH {_CELLS} SELECT geoid, year, round(100 * SUM(CASE WHEN class IN (1, 3) THEN frac ELSE 0 END) / SUM(frac), 4) AS value FROM cells WHERE class IS NOT NULL GROUP BY 1, 2")
def class_fraction_zonal(spark, sf_dir):
    return zonal.class_fraction(_cells(spark, sf_dir, F.when(F.col("l_linenumber") != 7, F.col("l_linenumber"))), [1, 3])


@query(f"WITH {_CELLS} SELECT geoid, year, round(SUM(value * frac) / SUM(frac), 4) AS value FROM cells GROUP BY 1, 2")
def coverage_mean_zonal(spark, sf_dir):
    return zonal.weighted_mean(_cells(spark, sf_dir, F.col("l_discount")))


# --- Checks and SQL over stored facts --------------------------------------

@query("""SELECT CAST(day(ts) AS INTEGER) AS year, round(COUNT(DISTINCT CASE WHEN k.geoid IS NOT NULL THEN user_id END) / (SELECT COUNT(DISTINCT c_custkey) FROM customer WHERE c_custkey % 10 <> 0), 6) AS coverage,
 round(1 - COUNT(v) / COUNT(*), 6) AS null_rate, COUNT(*) AS n, CAST(COUNT(*) FILTER (v < 5 OR v > 200) AS BIGINT) AS n_outside
FROM (SELECT *, CASE WHEN event_id % 11 <> 0 THEN value END AS v FROM events) LEFT JOIN (SELECT DISTINCT c_custkey AS geoid FROM customer WHERE c_custkey % 10 <> 0) k ON user_id = k.geoid GROUP BY 1""")
def qa_gate_metrics(spark, sf_dir):
    expected = table(spark, sf_dir, "customer").where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("geoid"))
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("geoid"), F.day("ts").alias("year"), F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("value"))
    return rounded(quality.metrics(rows, expected, ["year"], 5, 200).drop("example"), coverage=6, null_rate=6)


@query(sql(f"SELECT geoid, year, round(cv, 4) AS cv FROM (SELECT geoid, year, {_CV.format(v='E2', m='M2')} AS cv FROM raw) WHERE cv IS NOT NULL ORDER BY round(cv, 4) DESC, geoid, year LIMIT 20"))
def topn_uncertain(spark, sf_dir):
    facts = raw(spark, sf_dir).select("geoid", "year", F.round(uncertainty.cv_percent("E2", "M2"), 4).alias("cv"))
    return spark.sql("SELECT geoid, year, cv FROM {facts} WHERE cv IS NOT NULL ORDER BY cv DESC, geoid, year LIMIT 20", facts=facts)


_INDICATORS = [indicator({"id": k, "slug": f"i{k}", "theme": "t", "source": "viirs", **({"qa": {"range": r}} if r else {})}) for k, r in enumerate(([5, 200], None, [0, 50]))]


@query("""SELECT CAST(event_id % 3 AS INTEGER) AS indicator_id, CAST(day(ts) AS INTEGER) AS year, round(COUNT(DISTINCT user_id) / (SELECT COUNT(*) FROM customer), 6) AS coverage, COUNT(*) AS n,
 CAST(COUNT(*) FILTER (event_id % 3 = 0 AND (value < 5 OR value > 200) OR event_id % 3 = 2 AND (value < 0 OR value > 50)) AS BIGINT) AS n_outside
FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2""")
def qa_sweep_metrics(spark, sf_dir):
    expected = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("geoid"))
    facts = table(spark, sf_dir, "events").select((F.col("event_id") % 3).cast("int").alias("indicator_id"), F.day("ts").alias("year"), F.col("user_id").alias("geoid"), "value")
    rows = quality.metrics(quality.with_ranges(facts.join(expected, "geoid", "left_semi"), _INDICATORS), expected, ["indicator_id", "year"], "low", "high")
    return rounded(rows.select("indicator_id", "year", "coverage", "n", "n_outside"), coverage=6)


_FLAG = f"""SELECT geoid, year, round_even(v, 4) AS value, round_even(m, 4) AS moe, {_BAND.format(cv='cv')} AS reliability FROM (SELECT *, {_CV.format(v='v', m='m')} AS cv FROM (
  SELECT geoid, year, E2 / E1 * 100 AS v, CASE WHEN r < 0 THEN sqrt(M2 * M2 + power(E2 / E1, 2) * M1 * M1) / E1 ELSE sqrt(r) / E1 END * 100 AS m
  FROM (SELECT *, M2 * M2 - power(E2 / E1, 2) * M1 * M1 AS r FROM rolled)))"""


@query(sql(_FLAG, """rolled AS (SELECT CASE WHEN grouping(c) = 1 THEN 'REGION' ELSE c END AS geoid, year, SUM(E1) AS E1, SUM(E2) AS E2, sqrt(SUM(M1 * M1)) AS M1, sqrt(SUM(M2 * M2)) AS M2
  FROM (SELECT substr(geoid, 1, 5) AS c, * FROM raw) GROUP BY GROUPING SETS ((c, year), (year)))"""))
def flagship(spark, sf_dir):
    """A part of a whole for counties and the region, with margin and reliability."""
    rows = raw(spark, sf_dir).withColumn("county", cleaning.county("geoid"))
    squares = lambda c: F.sqrt(F.sum(F.col(c) * F.col(c))).alias(c)
    rolled = rollup.by_county_and_region(rows, [F.sum("E1").alias("E1"), F.sum("E2").alias("E2"), squares("M1"), squares("M2")])
    return uncertainty.compute_indicator(rolled, PROPORTION).drop("cv")
