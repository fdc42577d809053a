"""Small-area tables made from the test tables, in Spark and in SQL.

Suppliers stand for tracts (with a code that begins with their nation, the
county), lineitem for raw variables with margins, orders for releases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code(county: str, key: str):
    return F.concat(F.lpad(F.col(county).cast("string"), 5, "0"), F.lpad(F.col(key).cast("string"), 6, "0"))


def tracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s_suppkey, geoid, area (NULL unless positive)."""
    area = F.when(F.col("s_acctbal") > 0, F.col("s_acctbal"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", code("s_nationkey", "s_suppkey").alias("geoid"), area.alias("area"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """geoid, year and raw variables: part E2 (and E3) of whole E1, margins M1 to M3, rows n."""
    price = F.col("l_extendedprice")
    part = lambda flag: F.when(F.col("l_returnflag") == flag, price)
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("year"), "l_extendedprice", "l_returnflag")
    sums = lines.groupBy("l_suppkey", "year").agg(
        F.sum(price).alias("E1"), F.sum(part("R")).alias("E2"), F.sum(part("A")).alias("E3"),
        (0.05 * F.sqrt(F.sum(price * price))).alias("M1"), (0.1 * F.sqrt(F.sum(part("R") * part("R")))).alias("M2"),
        (0.1 * F.sqrt(F.sum(part("A") * part("A")))).alias("M3"), F.count("*").alias("n"),
    )
    return sums.join(tracts(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")).drop("l_suppkey", "s_suppkey", "area")


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """geoid, year, value, moe: the whole with its margin."""
    return raw(spark, sf_dir).select("geoid", "year", F.col("E1").alias("value"), F.col("M1").alias("moe"))


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """geoid, year, pop: rows of each tract and year, in every second year only."""
    return raw(spark, sf_dir).where("year % 2 = 0").select("geoid", "year", F.col("n").cast("double").alias("pop"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t10, t20, afact: three quarters stay, a quarter goes to the tract with the next key."""
    t = tracts(spark, sf_dir)
    last = t.agg(F.max("s_suppkey").alias("m"))
    own = t.select(F.col("geoid").alias("t10"), F.col("geoid").alias("t20"), F.lit(0.75).alias("afact"))
    following = t.crossJoin(last).select(F.col("geoid").alias("t10"), (F.col("s_suppkey") % F.col("m") + 1).alias("k"))
    moved = following.join(t.select(F.col("s_suppkey").alias("k"), F.col("geoid").alias("t20")), "k").select("t10", "t20", F.lit(0.25).alias("afact"))
    return own.unionByName(moved)


#: The same as common table expressions.
CTE = """
tracts AS (
  SELECT s_suppkey, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS geoid,
         CASE WHEN s_acctbal > 0 THEN s_acctbal END AS area
  FROM supplier
), raw AS (
  SELECT t.geoid, CAST(year(l_shipdate) AS INTEGER) AS year, SUM(l_extendedprice) AS E1,
         SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS E2,
         SUM(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS E3,
         0.05 * sqrt(SUM(l_extendedprice * l_extendedprice)) AS M1,
         0.1 * sqrt(SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_extendedprice END)) AS M2,
         0.1 * sqrt(SUM(CASE WHEN l_returnflag = 'A' THEN l_extendedprice * l_extendedprice END)) AS M3,
         COUNT(*) AS n
  FROM lineitem JOIN tracts t ON l_suppkey = t.s_suppkey GROUP BY 1, 2
), vals AS (
  SELECT geoid, year, E1 AS value, M1 AS moe FROM raw
), population AS (
  SELECT geoid, year, CAST(n AS DOUBLE) AS pop FROM raw WHERE year % 2 = 0
), edges AS (
  SELECT geoid AS t10, geoid AS t20, 0.75 AS afact FROM tracts
  UNION ALL
  SELECT a.geoid, b.geoid, 0.25 FROM tracts a JOIN tracts b
    ON b.s_suppkey = a.s_suppkey % (SELECT MAX(s_suppkey) FROM supplier) + 1
)
"""


def sql(body: str, more: str = "") -> str:
    """A query over the stand-ins, with further table expressions."""
    return f"WITH {CTE}{', ' + more if more else ''}\n{body}"
