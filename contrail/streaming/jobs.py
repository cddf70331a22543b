"""Structured Streaming jobs: each run takes what is new, then ends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.traffic import daily_traffic
from ..operators.upsert import add_up

KEY = ["airport_code", "flight_date"]
COUNTS = ["arrivals_count", "departures_count"]


def merge_batch(target: str) -> Callable[[DataFrame, int], None]:
    """Adds a micro-batch's counts under its own number, so that a batch that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        daily_traffic(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    return write


def merged(spark: SparkSession, target: str) -> DataFrame:
    """The counts of all batches."""
    rows = spark.read.parquet(target).select(*KEY, *COUNTS)
    return add_up(rows.limit(0), rows, KEY, COUNTS)


def run_daily_traffic(spark: SparkSession, source: str, to_flights: Callable[[DataFrame], DataFrame], root: str) -> DataFrame:
    """Reads new files of source as a stream, merges their counts, and returns the totals."""
    schema = spark.read.parquet(source).schema
    folder, _, name = source.rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    job = to_flights(stream).writeStream.foreachBatch(merge_batch(f"{root}/table")).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    job.awaitTermination()
    return merged(spark, f"{root}/table")


def hourly_windows(flights: DataFrame) -> DataFrame:
    """Flights by the hour in which they were first seen; for batch and stream alike."""
    return flights.groupBy(F.window("first_seen", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("hour_start"), "n")


def fresh_flights(stream: DataFrame, late: str = "30 days") -> DataFrame:
    """A stream without flights seen before; state is kept for as long as a flight may be late."""
    return stream.withWatermark("first_seen", late).dropDuplicatesWithinWatermark(["icao24", "first_seen", "callsign"])
