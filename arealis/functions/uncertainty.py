"""Margins of error of published estimates, as Column builders.

Margins are at 90 % confidence (z = 1.645). A NULL margin spoils no value, and
a NULL part spoils a sum of parts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from arealis.functions.cleaning import _col, finite

Z90, Z95 = 1.645, 1.96
CAUTION, UNRELIABLE = 15.0, 30.0


def standard_error(moe: Column | str) -> Column:
    return _col(moe) / Z90


def cv_percent(value: Column | str, moe: Column | str) -> Column:
    """Coefficient of variation in percent; NULL for a missing or zero estimate."""
    value, moe = finite(value), finite(moe)
    return F.when(value != 0, moe / Z90 / F.abs(value) * 100)


def reliability(cv: Column | str, caution: float = CAUTION, unreliable: float = UNRELIABLE) -> Column:
    cv = _col(cv)
    return F.when(cv > unreliable, "unreliable").when(cv > caution, "caution").when(cv.isNotNull(), "ok")


def sum_moe(moes: list[Column | str]) -> Column:
    """Root of the sum of squares of the margins that are there; NULL if none is."""
    found = F.filter(F.array(*(finite(m) for m in moes)), lambda m: m.isNotNull())
    return F.when(F.size(found) > 0, F.sqrt(F.aggregate(found, F.lit(0.0), lambda a, m: a + m * m)))


def ratio_moe(n: Column | str, n_moe: Column | str, d: Column | str, d_moe: Column | str) -> Column:
    n, n_moe, d, d_moe = (_col(c) for c in (n, n_moe, d, d_moe))
    d = F.when(d != 0, d)
    return F.sqrt(n_moe * n_moe + n * n / (d * d) * d_moe * d_moe) / d


def proportion_moe(n: Column | str, n_moe: Column | str, d: Column | str, d_moe: Column | str) -> Column:
    """For a part of a whole; where the radicand is negative, the ratio's formula holds."""
    n, n_moe, d, d_moe = (_col(c) for c in (n, n_moe, d, d_moe))
    whole = F.when(d != 0, d)
    radicand = n_moe * n_moe - n * n / (whole * whole) * d_moe * d_moe
    return F.when(radicand < 0, ratio_moe(n, n_moe, d, d_moe)).otherwise(F.sqrt(F.greatest(radicand, F.lit(0.0) * radicand)) / whole)


def significant_change(v1: Column | str, m1: Column | str, v2: Column | str, m2: Column | str) -> Column:
    """Whether two estimates differ at 90 %; NULL if anything is missing or both margins are zero."""
    v1, m1, v2, m2 = (finite(c) for c in (v1, m1, v2, m2))
    error = F.sqrt(standard_error(m1) ** 2 + standard_error(m2) ** 2)
    return F.when(error > 0, F.abs(v1 - v2) / error > Z90)


def moe_of_interval(low: Column | str, high: Column | str) -> Column:
    """The 90 % margin of a 95 % interval; its bounds may be swapped."""
    low, high = finite(low), finite(high)
    return F.abs(high - low) / 2 * (Z90 / Z95)


def poisoning_sum(columns: list[Column | str]) -> Column:
    """Sum that is NULL if any part is."""
    return reduce(lambda a, b: a + b, (_col(c) for c in columns))


def with_reliability(df, caution: float = CAUTION, unreliable: float = UNRELIABLE):
    """Adds cv and reliability, computed on unrounded numbers; rounds value and margin to 4, cv to 2 places, halves to the even digit."""
    df = df.withColumns({"value": finite("value"), "moe": finite("moe")})
    cv = cv_percent("value", "moe")
    return df.withColumns({"cv": cv, "reliability": reliability(cv, caution, unreliable)}).withColumns(
        {"value": F.bround("value", 4), "moe": F.bround("moe", 4), "cv": F.bround("cv", 2)}
    )


KINDS = ("median", "count", "number", "proportion", "rate")


def indicator_columns(spec) -> tuple[Column, Column]:
    """Value and margin of an indicator (``sources.config.TableSpec``) over a wide row of variables."""
    if spec.kind not in KINDS:
        raise ValueError(f"unknown kind {spec.kind!r}")
    if spec.kind in ("median", "count", "number"):
        return F.col(spec.estimate_var), F.col(spec.moe_var) if spec.moe_var else F.lit(None).cast("double")
    top, top_moe = poisoning_sum(spec.num_vars), sum_moe(spec.num_moe_vars) if spec.num_moe_vars else F.lit(None).cast("double")
    for year, names in sorted(spec.num_vars_by_year.items()):
        moes = spec.num_moe_vars_by_year.get(year, [])
        here = F.col("year") == year
        top = F.when(here, poisoning_sum(names)).otherwise(top)
        top_moe = F.when(here, sum_moe(moes) if moes else F.lit(None).cast("double")).otherwise(top_moe)
    bottom, bottom_moe = poisoning_sum(spec.den_vars), sum_moe(spec.den_moe_vars) if spec.den_moe_vars else F.lit(None).cast("double")
    scale = 100.0 if spec.percent else spec.multiplier
    moe = (proportion_moe if spec.kind == "proportion" else ratio_moe)(top, top_moe, bottom, bottom_moe)
    return top / F.when(bottom != 0, bottom) * scale, moe * scale


def compute_indicator(raw, spec, caution: float = CAUTION, unreliable: float = UNRELIABLE):
    """Tidy rows (geoid, year, value, moe, cv, reliability) of one indicator."""
    value, moe = indicator_columns(spec)
    return with_reliability(raw.select("geoid", "year", value.alias("value"), moe.alias("moe")), caution, unreliable)
