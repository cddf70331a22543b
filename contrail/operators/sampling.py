"""Samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import airline, blank_to_null, hour_block

TARGET = 400


def stratified(flights: DataFrame, *order: Column | str, target: int = TARGET, crowd: int = 10) -> DataFrame:
    """Flights from every stratum (route, airline, quarter of the day), larger strata first.

    A stratum gives one flight, or two with ``crowd`` or more, until there are ``target``. All
    flights with a callsign take part. Only strata, not flights, meet in one task.
    """
    known = lambda c: F.coalesce(blank_to_null(F.col(c)), F.lit("UNKNOWN"))
    rows = flights.where("callsign is not null").withColumn("stratum", F.concat(
        known("est_departure_airport"), F.lit("→"), known("est_arrival_airport"), F.lit("|"), airline(known("callsign")), F.lit("|"), hour_block(F.col("first_seen")),
    ))
    sizes = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    take = F.when(F.col("n") >= crowd, 2).otherwise(1)
    before = Window.orderBy(F.desc("n"), "stratum").rowsBetween(Window.unboundedPreceding, -1)
    quota = sizes.withColumn("take", F.least(take, target - F.coalesce(F.sum(take).over(before), F.lit(0)))).where("take > 0").select("stratum", "take")
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy("stratum").orderBy(*order))).where(F.col("_n") <= 2)
    return ranked.join(quota, "stratum").where("_n <= take").drop("_n", "take")


def at_most(rows: DataFrame, key: list[str], n: int, seed: int, *identity: str) -> DataFrame:
    """Up to n rows of each key, chosen by a seeded hash of the columns that identify a row."""
    order = F.xxhash64(F.lit(seed), *identity), *identity
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("_n") <= n).drop("_n")
