"""Structured streaming into the warehouse.

Landed files of tidy rows with a release number arrive in any order, some
twice. Each batch is merged with the stored rows of its indicators, the newest
release winning, and replaces their partitions; a repeated batch changes
nothing. Only indicators in the batch are read and written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "geoid string, indicator_id int, year int, value double, moe double, release int"
KEYS = ("indicator_id", "geoid", "year")


def landed(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def merged(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """The newest release of each key; of equal releases the new row, then the larger value."""
    rows = new.withColumn("_new", F.lit(1))
    if old is not None:
        rows = rows.unionByName(old.withColumn("_new", F.lit(0)))
    order = Window.partitionBy(*KEYS).orderBy(F.desc("release"), F.desc("_new"), F.desc_nulls_last("value"))
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "_new")


def write_batch(batch: DataFrame, path: str, staging: str, batch_id: int) -> None:
    """Merge one batch; it is written aside first, as a table cannot be replaced by what is read from it."""
    spark = batch.sparkSession
    touched = [r[0] for r in batch.select("indicator_id").distinct().collect()]  # indicators, a few dozen
    try:
        old = spark.read.schema(SCHEMA).parquet(path).where(F.col("indicator_id").isin(touched)).select(*batch.columns)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = None
    aside = f"{staging}/{batch_id}"
    merged(batch, old).write.mode("overwrite").parquet(aside)
    rows = spark.read.schema(batch.schema).parquet(aside)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("indicator_id").parquet(path)


def refresh(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start the refresh over all that has arrived; ``checkpoint`` also holds the staging area."""
    return (
        stream.writeStream.foreachBatch(lambda batch, k: write_batch(batch, path, f"{checkpoint}/staging", k))
        .option("checkpointLocation", f"{checkpoint}/offsets").trigger(availableNow=True).start()
    )


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events and their mean by type in event-time windows, with rows later than ``late`` left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
