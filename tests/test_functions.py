import math

import pytest
from pyspark.sql import functions as F

from arealis.functions import cleaning, uncertainty
from arealis.sources.config import TableSpec


def one(spark, *columns, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    out = row.select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()
    return list(out)


def test_published_cases(spark):
    u, lit = uncertainty, F.lit
    got = one(spark, u.cv_percent(lit(50000.0), lit(8225.0)), u.cv_percent(lit(0.0), lit(100.0)), u.sum_moe([lit(3.0), lit(None).cast("double"), lit(4.0)]),
              u.ratio_moe(lit(200.0), lit(30.0), lit(1000.0), lit(50.0)), u.proportion_moe(lit(200.0), lit(30.0), lit(1000.0), lit(50.0)),
              u.proportion_moe(lit(200.0), lit(10.0), lit(1000.0), lit(200.0)), u.sum_moe([lit(None).cast("double")]))
    want = [10, None, 5, math.sqrt(1000) / 1000, math.sqrt(800) / 1000, math.sqrt(100 + 0.04 * 40000) / 1000, None]
    assert got == [w if w is None else pytest.approx(w) for w in want]


def test_bands_and_change(spark):
    u, lit = uncertainty, F.lit
    bands = [u.reliability(lit(v).cast("double")) for v in (10, 15, 20, 30, 40, None)]
    assert one(spark, *bands) == ["ok", "ok", "caution", "caution", "unreliable", None]
    pairs = [(50000.0, 53000.0, 1645.0), (50000.0, 50500.0, 1645.0), (50000.0, 53000.0, None), (1.0, 2.0, 0.0)]
    assert one(spark, *(u.significant_change(lit(a), lit(m).cast("double"), lit(b), lit(1645.0 if m else 0.0)) for a, b, m in pairs)) == [True, False, None, None]
    assert one(spark, u.moe_of_interval(lit(11.0), lit(9.0))) == [pytest.approx(1.645 / 1.96)]


def test_cleaning(spark):
    c, lit = cleaning, F.lit
    assert one(spark, c.estimate(lit("-666666666")), c.estimate(lit("12.5")), c.number(lit("x")), c.finite(lit(float("nan"))), c.finite(lit(float("inf")))) == [None, 12.5, None, None, None]
    assert one(spark, c.area_id(lit("37119000100.0")), c.area_id(lit(" 37025000200 ")), c.area_id(lit("1001020100")), c.area_id(lit("123456789012"))) == ["37119000100", "37025000200", "01001020100", "123456789012"]
    assert one(spark, c.strict_year(lit("2019")), c.ratio(lit(1.0), lit(0.0)), c.square_miles(lit(2589988.110336))) == [2019, None, 1.0]


def test_indicator_kinds(spark):
    raw = spark.createDataFrame([("a", 2014, 10.0, 5.0, 1.0, None, 100.0, 2.0), ("b", 2015, 10.0, None, 1.0, 1.0, 100.0, 2.0), ("c", 2015, 10.0, 5.0, 1.0, 1.0, 0.0, 2.0)],
                                "geoid string, year int, x double, y double, xm double, ym double, d double, dm double")
    spec = TableSpec(kind="proportion", num_vars=("x", "y"), num_moe_vars=("xm", "ym"), den_vars=("d",), den_moe_vars=("dm",), percent=True, num_vars_by_year={2014: ("x",)})
    got = {r["geoid"]: r for r in uncertainty.compute_indicator(raw, spec).collect()}
    assert (got["a"]["value"], got["a"]["moe"]) == (10.0, None)  # the year's own list, which has no margins
    assert got["b"]["value"] is None  # a missing part
    assert (got["c"]["value"], got["c"]["moe"], got["c"]["reliability"]) == (None, None, None)
    with pytest.raises(ValueError):
        uncertainty.indicator_columns(TableSpec(kind="index"))
