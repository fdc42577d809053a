"""The fact tables: Parquet by indicator, replaced one indicator at a time.

Partition overwrite gives the upsert: writing an indicator again replaces its
rows and no others, and a repeated write changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRACT = "tract_indicators"
COUNTY = "county_indicators"

FACT = T.StructType([
    T.StructField("geoid", T.StringType()), T.StructField("indicator_id", T.IntegerType()), T.StructField("year", T.IntegerType()),
    T.StructField("period_start", T.IntegerType()), T.StructField("period_end", T.IntegerType()), T.StructField("value", T.DoubleType()),
    T.StructField("moe", T.DoubleType()), T.StructField("cv", T.DoubleType()), T.StructField("reliability", T.StringType()),
    T.StructField("is_rolling", T.BooleanType()), T.StructField("source", T.StringType()), T.StructField("source_vintage", T.StringType()),
    T.StructField("tract_vintage", T.IntegerType()), T.StructField("redacted", T.BooleanType()), T.StructField("created", T.StringType()),
])
ROLLUP = T.StructType([FACT[c] for c in ("geoid", "indicator_id", "year", "value", "moe", "cv", "reliability")])
TIDY = ["geoid", "year", "value", "moe", "cv", "reliability"]

#: Years that a survey's estimate reaches back.
SURVEY_SPAN = 4


def facts(tidy: DataFrame, indicator, created: str) -> DataFrame:
    """Tidy rows with the columns that every fact carries."""
    span = SURVEY_SPAN if indicator.source == "acs" else 0
    more = {
        "indicator_id": F.lit(indicator.id), "period_start": F.col("year") - span, "period_end": F.col("year"), "is_rolling": F.lit(span > 0), "source": F.lit(indicator.source),
        "source_vintage": F.col("year").cast("string"), "tract_vintage": F.lit(2020), "redacted": F.lit(False), "created": F.lit(created),
    }
    return tidy.withColumns(more).select(*(F.col(f.name).cast(f.dataType) for f in FACT))


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def _write(self, df: DataFrame, name: str, schema: T.StructType) -> None:
        rows = df.select(*(F.col(f.name).cast(f.dataType) for f in schema))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("indicator_id").parquet(f"{self.root}/{name}")

    def write(self, df: DataFrame) -> None:
        self._write(df, TRACT, FACT)

    def write_rollup(self, df: DataFrame) -> None:
        self._write(df, COUNTY, ROLLUP)

    def _read(self, name: str, schema: T.StructType, indicator_id: int | None) -> DataFrame | None:
        path = f"{self.root}/{name}"
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        if not place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return None
        rows = self.spark.read.schema(schema).parquet(path)
        if indicator_id is None:
            return rows
        rows = rows.where(F.col("indicator_id") == indicator_id).select(TIDY)
        return None if rows.isEmpty() else rows

    def read(self, indicator_id: int | None = None) -> DataFrame | None:
        """Tidy rows of one indicator, from its partition alone, or all facts; None if there are none."""
        return self._read(TRACT, FACT, indicator_id)

    def read_rollup(self, indicator_id: int | None = None) -> DataFrame | None:
        return self._read(COUNTY, ROLLUP, indicator_id)

    def views(self) -> list[str]:
        """Registers the tables for SQL."""
        found = []
        for name, rows in ((TRACT, self.read()), (COUNTY, self.read_rollup())):
            if rows is not None:
                rows.createOrReplaceTempView(name)
                found.append(name)
        return found


def write_table_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """A small reference table as one sorted CSV file."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def stage_measures(rows: DataFrame, path: str) -> DataFrame:
    """Stores measures by level and measure and returns their catalog: years and, for the latest one, counts by reliability."""
    rows.write.mode("overwrite").partitionBy("level", "measure").parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(path)
    years = stored.groupBy("level", "measure").agg(F.array_sort(F.collect_set("year")).alias("years"), F.max("year").alias("year"))
    latest = stored.join(years, ["level", "measure", "year"]).groupBy("level", "measure", "years")
    flag = lambda v: F.count_if(F.col("reliability").eqNullSafe(F.lit(v))).alias(f"n_{v or 'none'}")
    return latest.agg(F.count("*").alias("n"), flag("ok"), flag("caution"), flag("unreliable"), flag(None)).orderBy("level", "measure")
