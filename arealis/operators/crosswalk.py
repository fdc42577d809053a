"""From one vintage of areas to another by weighted edges (t10, t20, afact).

The edge table grows with the number of areas, not with the facts: the joins
leave the choice to the optimizer, which broadcasts it while it is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealis.functions.cleaning import finite


def area_shares(relations: DataFrame) -> DataFrame:
    """Edges weighted by land area: columns t10, t20, area; shares sum to 1 for each t10."""
    whole = F.sum("area").over(Window.partitionBy("t10"))
    return relations.where(F.col("area") > 0).select("t10", "t20", (F.col("area") / whole).alias("afact"))


def population_shares(blocks: DataFrame, population: DataFrame) -> DataFrame:
    """Edges weighted by population: block pieces (b20, t10, area) and block counts (b20, t20, pop).

    A block's people are spread over the older tracts that it overlaps by area;
    blocks without people carry no weight.
    """
    share = F.col("area") / F.sum("area").over(Window.partitionBy("b20"))
    pieces = blocks.where(F.col("area") > 0).withColumn("share", share).join(population, "b20", "left")
    people = pieces.withColumn("people", F.coalesce("pop", F.lit(0.0)) * F.col("share")).where("people > 0")
    edges = people.groupBy("t10", "t20").agg(F.sum("people").alias("people"))
    whole = F.sum("people").over(Window.partitionBy("t10"))
    return edges.select("t10", "t20", F.round(F.col("people") / whole, 6).alias("afact"))


def _spread(df: DataFrame, edges: DataFrame) -> DataFrame:
    return df.join(edges, df["geoid"] == edges["t10"]).drop("geoid", "t10").withColumnRenamed("t20", "geoid")


def _root_of_squares(x) -> F.Column:
    return F.sqrt(F.sum(x * x))


def allocate(df: DataFrame, edges: DataFrame, estimates: list[str], moes: list[str], median: bool = False) -> DataFrame:
    """Counts are spread by weight, margins in quadrature; medians become weighted means.

    Missing parts are left out; a result without any part is NULL.
    """
    parts = _spread(df, edges)
    a = F.col("afact")
    columns = []
    for c in estimates:
        v = finite(c)
        total = F.sum(v * a)
        columns.append((total / F.nullif(F.sum(F.when(v.isNotNull(), a)), F.lit(0.0)) if median else total).alias(c))
    for c in moes:
        v = finite(c)
        total = _root_of_squares(v * a)
        columns.append((total / F.nullif(F.sum(F.when(v.isNotNull(), a)), F.lit(0.0)) if median else total).alias(c))
    return parts.groupBy("geoid", "year").agg(*columns)


def allocate_rates(df: DataFrame, edges: DataFrame) -> DataFrame:
    """Percentages with populations (value, moe, pop) as pseudo-counts: people with the trait over people."""
    rows = df.where(finite("value").isNotNull() & (finite("pop") > 0))
    rows = rows.withColumns({"cases": F.col("value") / 100 * F.col("pop"), "spread": F.coalesce(finite("moe"), F.lit(0.0)) / 100 * F.col("pop")})
    a = F.col("afact")
    out = _spread(rows, edges).groupBy("geoid", "year").agg(
        F.sum(F.col("cases") * a).alias("cases"), _root_of_squares(F.col("spread") * a).alias("spread"), F.sum(F.col("pop") * a).alias("pop")
    )
    out = out.where("pop > 0")
    return out.select("geoid", "year", (F.col("cases") / F.col("pop") * 100).alias("value"), (F.col("spread") / F.col("pop") * 100).alias("moe"), "pop")


def harmonize(df: DataFrame, edges: DataFrame, old_years: list[int], estimates: list[str], moes: list[str], median: bool = False) -> DataFrame:
    """Rows of the old vintage's years are allocated, the others pass."""
    old = F.col("year").isin([int(y) for y in old_years])
    keep = ["geoid", "year", *estimates, *moes]
    return df.where(~old).select(keep).unionByName(allocate(df.where(old), edges, estimates, moes, median).select(keep))


def allocate_values(df: DataFrame, edges: DataFrame, kind: str) -> DataFrame:
    """A user's old-vintage values (geoid, year, value, moe[, pop]); rates without any margin keep none."""
    if kind == "count":
        return allocate(df, edges, ["value"], ["moe"])
    if kind not in ("proportion", "rate"):
        raise ValueError(f"kind {kind!r} cannot be allocated")
    any_moe = df.agg(F.coalesce(F.bool_or(finite("moe").isNotNull()), F.lit(False)).alias("any_moe"))
    out = allocate_rates(df, edges).crossJoin(any_moe)  # one row
    return out.select("geoid", "year", "value", F.when(F.col("any_moe"), F.col("moe")).alias("moe"))
