"""Scores, ranks, quantiles and class breaks, by group.

Groups may be as large as the table: means and counts are partial aggregations
joined back, ranks come from a sort over ranges (``operators.order``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.cleaning import finite
from arealis.operators.order import keyed_join, running_totals


def zscores(df: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Adds z: (value - mean) / sample deviation; NULL for a missing value or no spread."""
    v = finite(value)
    moments = df.groupBy(*by).agg(F.avg(v).alias("_mean"), F.stddev_samp(v).alias("_spread"))
    z = (v - F.col("_mean")) / F.when(F.col("_spread") > 0, F.col("_spread"))
    return keyed_join(df, moments, by).withColumn("z", z).drop("_mean", "_spread")


def _counted(df: DataFrame, by: list[str], value: Column) -> tuple[DataFrame, DataFrame]:
    """The distinct values (_v) of each group with their rows (_c) and how many rows have smaller ones (before), and rows by group (n)."""
    counted = df.select(*by, value.alias("_v")).where("_v IS NOT NULL").groupBy(*by, "_v").agg(F.count("*").alias("_c"))
    return running_totals(counted, by, ["_v"], "_c"), counted.groupBy(*by).agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("n"))


def average_ranks(df: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Adds rank (ties share their mean rank) and n (values in the group); NULL values have no rank."""
    places, rows = _counted(df, by, finite(value))
    ranks = places.select(*by, "_v", (F.col("before") + (F.col("_c") + 1) / 2).alias("rank"))
    ranked = df.withColumn("_v", finite(value)).join(ranks, [*by, "_v"], "left").drop("_v")
    return keyed_join(ranked, rows, by).withColumn("n", F.coalesce("n", F.lit(0)))


# The coefficients of algorithm AS 241 (PPND16) for the standard normal quantile, by power.
CENTER = ((3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
          (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3))
MIDDLE = ((1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
          (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9))
TAIL = ((6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
        (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15))


def probit(p: Column) -> Column:
    """The standard normal quantile; NULL outside of (0, 1)."""

    def fraction(r: Column, parts: tuple) -> Column:
        top, bottom = (F.lit(c[-1]) for c in parts)
        for x, y in zip(parts[0][-2::-1], parts[1][-2::-1]):
            top, bottom = top * r + x, bottom * r + y
        return top / bottom

    q = p - 0.5
    r = F.sqrt(-F.ln(F.least(p, 1 - p)))
    tail = F.when(r <= 5, fraction(r - 1.6, MIDDLE)).otherwise(fraction(r - 5, TAIL))
    inner = q * fraction(0.180625 - q * q, CENTER)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, inner).otherwise(F.signum(q) * tail))


def rank_normal(df: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Adds score: the normal quantile of rank / (n + 1)."""
    return average_ranks(df, by, value).withColumn("score", probit(F.col("rank") / (F.col("n") + 1))).drop("rank", "n")


def false_discovery(df: DataFrame, by: list[str], p: str = "p", alpha: float = 0.05) -> DataFrame:
    """Adds significant: the step-up rule on the ordered p values of each group; equal p values share their verdict."""
    places, rows = _counted(df, by, F.col(p))
    within = F.col("_v") <= (F.col("before") + F.col("_c")) / F.col("n") * alpha
    cut = keyed_join(places, rows, by).where(within).groupBy(*by).agg(F.max("_v").alias("_cut"))
    tested = F.when(F.col(p).isNotNull(), F.coalesce(F.col(p) <= F.col("_cut"), F.lit(False)))
    return keyed_join(df, cut, by).withColumn("significant", tested).drop("_cut")


def quantiles(df: DataFrame, by: list[str], value: Column, fractions: list[float]) -> DataFrame:
    """For each group an array q of exact quantiles, linear between the two nearest values."""
    places, rows = _counted(df, by, value)
    joined = keyed_join(places, rows, by)

    def at(k: Column) -> Column:
        return F.max(F.when((F.col("before") <= k) & (k < F.col("before") + F.col("_c")), F.col("_v")))

    out = []
    for f in fractions:
        h = (F.col("n") - 1) * f
        low, part = F.floor(h), F.max(h - F.floor(h))
        out.append(at(low) + (at(F.ceil(h)) - at(low)) * part)
    return joined.groupBy(*by).agg(F.array(*out).alias("q"))


def class_breaks(value: Column | str, classes: int = 5) -> Column:
    """Aggregate: the inner quantiles, each once."""
    inner = [F.lit(i / classes) for i in range(1, classes)]
    return F.array_distinct(F.percentile(finite(value), F.array(*inner)))


def summary(value: Column | str, classes: int = 5) -> Column:
    """Aggregate: smallest, largest, 1st and 99th percentile and class breaks; zeros if there is no value."""
    v = finite(value)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    ends = F.percentile(v, F.array(F.lit(0.01), F.lit(0.99)))
    return F.struct(
        zero(F.min(v)).alias("min"), zero(F.max(v)).alias("max"), zero(ends[0]).alias("p1"), zero(ends[1]).alias("p99"),
        F.coalesce(class_breaks(v, classes), F.array().cast("array<double>")).alias("breaks"),
    )


def summaries(df: DataFrame, value: str = "value", classes: int = 5) -> DataFrame:
    """One summary for each year and one over all (year NULL); zeros if there is no value."""
    v, fractions = finite(value), [0.01, 0.99, *(i / classes for i in range(1, classes))]
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = []
    for by in (["year"], []):
        ends = df.groupBy(*by).agg(F.min(v).alias("min"), F.max(v).alias("max"))
        rows = keyed_join(ends, quantiles(df, by, v, fractions), by)
        breaks = F.array_distinct(F.filter(F.slice("q", 3, classes - 1), lambda x: x.isNotNull()))
        year = F.col("year") if by else F.lit(None).cast(dict(df.dtypes)["year"])
        out.append(rows.select(
            year.alias("year"), F.lit(not by).alias("pooled"), zero(F.col("min")).alias("min"), zero(F.col("max")).alias("max"),
            zero(F.col("q")[0]).alias("p1"), zero(F.col("q")[1]).alias("p99"), F.coalesce(breaks, F.array().cast("array<double>")).alias("breaks"),
        ))
    return out[0].unionByName(out[1])


def aligned_series(df: DataFrame, years: list[int], columns: list[str], rounding: int | None = 4) -> DataFrame:
    """For each area arrays with one place for each year, NULL where there is no value."""
    shape = lambda c: F.round(c, rounding) if rounding is not None and dict(df.dtypes)[c] == "double" else F.col(c)
    found = df.where(F.col("year").isin(years)).groupBy("geoid").agg(F.map_from_entries(F.collect_list(F.struct("year", F.struct(*(shape(c).alias(c) for c in columns))))).alias("_by_year"))
    every = df.select("geoid").distinct().join(found, "geoid", "left")
    wanted = F.array(*(F.lit(y).cast("int") for y in sorted(years)))
    series = lambda c: F.transform(wanted, lambda y: F.try_element_at("_by_year", y)[c]).alias(c)
    return every.select("geoid", *(series(c) for c in columns))


def terciles(df: DataFrame, x: str, y: str, key: str) -> DataFrame:
    """Adds the third of each of two measures (the first ones larger if the rows can't be divided) and the class of nine they make together."""
    rows = df.agg(F.count("*").alias("_n"))  # one row
    for c in (x, y):
        placed = running_totals(df.withColumn("_one", F.lit(1)), [], [c, key], "_one").drop("_one").crossJoin(F.broadcast(rows))
        size, more = F.floor(F.col("_n") / 3), F.col("_n") % 3
        large = more * (size + 1)
        third = F.when(F.col("before") < large, F.floor(F.col("before") / (size + 1))).otherwise(more + F.floor((F.col("before") - large) / F.greatest(size, F.lit(1))))
        df = placed.withColumn(f"{c}_third", (third + 1).cast("int")).drop("before", "_n")
    return df.withColumn("bivariate_class", (F.col(f"{y}_third") - 1) * 3 + F.col(f"{x}_third"))


def association(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson and rank correlation and the least-squares line of y on x, in one row."""
    both = df.where(finite(x).isNotNull() & finite(y).isNotNull())
    ranked = average_ranks(average_ranks(both, [], x).withColumnRenamed("rank", "_rx").drop("n"), [], y)
    return ranked.agg(F.corr(x, y).alias("pearson"), F.corr("_rx", "rank").alias("spearman"), F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept"))
