"""Every query against its SQL in DuckDB on the smallest tables, where these are present."""

import glob
import math
import os

import pytest

from arealis.plans.catalog import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
#: A part of the catalog that covers each family; the driver holds all of it against the SQL.
NAMES = ["flagship", "acs_proportion_moe", "numerator_override_by_year", "crosswalk_rate_pseudocount", "complete_count_rollup", "zonal_weighted_mean", "jobs_measures_rollup",
         "newest_release_wins", "bh_fdr", "quantile_breaks", "densified_series_arrays", "knn_weights", "class_fraction_zonal", "qa_gate_metrics", "topn_uncertain",
         "reliability_counts", "significant_change_tally", "anti_vintage_check", "duplicate_keys", "set_difference_years", "blocks_to_tracts", "user_rates_without_margins", "derived_mean_rollup",
         "county_land", "survey_rollup", "health_rollup", "zscore_by_year", "rank_average", "summary_stats", "bivariate_terciles", "corr_pearson_spearman", "rank_normal_scores", "lisa_scores", "qa_sweep_metrics"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(c) for c in columns]
    got = sorted((tuple(plain(r[c]) for c in columns) for r in found.collect()), key=str)
    assert got and got == sorted((tuple(plain(r[i]) for i in places) for r in relation.fetchall()), key=str)


def test_every_query_is_registered():
    assert set(SQL) <= set(QUERIES) and set(NAMES) <= set(SQL)
