"""Union, priorities between sources, and change between periods."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealis.functions.uncertainty import significant_change


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def newest_release(df: DataFrame, keys: tuple[str, ...] = ("geoid", "year"), release: str = "release") -> DataFrame:
    """Of each key the row of the latest release; the release itself goes, its other columns stay."""
    rest = [c for c in df.columns if c not in keys and c != release]
    best = F.max_by(F.struct(*rest), F.struct(F.col(release), F.struct(*rest)))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, *(F.col("_row")[c].alias(c) for c in rest))


def first_wins(frames: list[DataFrame], keys: tuple[str, ...] = ("geoid", "year")) -> DataFrame:
    """Of each key the row of the first frame that has it; equal keys in a frame go by their other columns."""
    tagged = union_all([f.withColumn("_priority", F.lit(k)) for k, f in enumerate(frames)])
    rest = [c for c in tagged.columns if c not in keys and c != "_priority"]
    order = Window.partitionBy(*keys).orderBy("_priority", *rest)
    return tagged.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "_priority")


def missing_years(df: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.select("year").distinct().join(df.select("year").distinct(), "year", "left_anti")


def comparable_pairs(df: DataFrame, gaps: tuple[int, ...] = (5, 10)) -> DataFrame:
    """Each area's estimates ``gap`` years before the last year beside those of the last year, and whether they differ.

    Only non-overlapping periods are compared; a year that is absent gives no pair.
    """
    last = df.agg(F.max("year").alias("last_year"))  # one row
    dated = df.crossJoin(F.broadcast(last))
    new = dated.where(F.col("year") == F.col("last_year")).select("geoid", F.col("year").alias("year2"), F.col("value").alias("value2"), F.col("moe").alias("moe2"))
    old = dated.where((F.col("last_year") - F.col("year")).isin(list(gaps))).select("geoid", F.col("year").alias("year1"), F.col("value").alias("value1"), F.col("moe").alias("moe1"))
    return old.join(new, "geoid").withColumn("significant", significant_change("value1", "moe1", "value2", "moe2"))


def change_tally(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("year1", "year2").agg(F.count_if("significant").alias("n_significant"), F.count("significant").alias("n_tested"))
