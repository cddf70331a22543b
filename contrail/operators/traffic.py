"""Traffic aggregates over flights, and reads of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null


def _ends(flights: DataFrame, *more: Column) -> DataFrame:
    """A row for each known end of a flight: airport_code, arr and dep (0 or 1)."""
    ends = F.filter(
        F.array(
            F.struct(F.col("est_arrival_airport").alias("airport_code"), F.lit(1).alias("arr"), F.lit(0).alias("dep")),
            F.struct(F.col("est_departure_airport").alias("airport_code"), F.lit(0).alias("arr"), F.lit(1).alias("dep")),
        ),
        lambda e: e["airport_code"] != "",
    )
    return flights.select(*more, F.explode(ends).alias("e")).select("*", "e.*").drop("e")


def _counts() -> list[Column]:
    return [F.sum("arr").cast("bigint").alias("arrivals_count"), F.sum("dep").cast("bigint").alias("departures_count")]


def daily_traffic(flights: DataFrame) -> DataFrame:
    """Arrivals and departures by airport and day; a day is that of first_seen for both."""
    day = F.to_date("first_seen").alias("flight_date")
    return _ends(flights, day).groupBy("airport_code", "flight_date").agg(*_counts())


def hourly_distribution(flights: DataFrame) -> DataFrame:
    more = F.to_date("first_seen").alias("flight_date"), F.hour("first_seen").alias("hour")
    return _ends(flights, *more).groupBy("airport_code", "flight_date", "hour").agg(*_counts())


def route_density(flights: DataFrame) -> DataFrame:
    """Flights with both ends by route, with the first and last day."""
    known = flights.where("est_departure_airport <> '' and est_arrival_airport <> ''")
    day = F.to_date("first_seen")
    return known.groupBy(F.col("est_departure_airport").alias("departure_airport"), F.col("est_arrival_airport").alias("arrival_airport")).agg(
        F.count(F.lit(1)).alias("flight_count"), F.min(day).alias("first_seen"), F.max(day).alias("last_seen")
    )


def airport_date_ranges(flights: DataFrame, coords: DataFrame | None = None) -> DataFrame:
    """First and last flight day of each airport, at either end; with coords, only airports that have some."""
    side = lambda c: flights.groupBy(blank_to_null(F.col(c)).alias("airport_code")).agg(F.min("flight_date").alias("lo"), F.max("flight_date").alias("hi"))
    both = side("est_departure_airport").unionByName(side("est_arrival_airport")).where("airport_code is not null")
    out = both.groupBy("airport_code").agg(F.min("lo").alias("start_date"), F.max("hi").alias("end_date"))
    return out.join(coords.select(F.col("icao").alias("airport_code")), "airport_code", "left_semi") if coords is not None else out


def overlap(ranges: DataFrame, first, last) -> DataFrame:
    """The part of each date range inside first..last; ranges without one are dropped."""
    return ranges.where((F.col("start_date") <= last) & (F.col("end_date") >= first)).withColumns(
        {"start_date": F.greatest("start_date", first), "end_date": F.least("end_date", last)}
    )


def airports_seen(flights: DataFrame) -> DataFrame:
    return flights.select(F.explode(F.array("est_departure_airport", "est_arrival_airport")).alias("airport_code")).where("airport_code <> ''").distinct()


def top_days(daily: DataFrame, airport_code: str | None = None, limit: int = 20) -> DataFrame:
    """Latest days first; within a day the busiest airport first."""
    if airport_code is not None:
        daily = daily.where(F.col("airport_code") == airport_code)
    total = daily.withColumn("total_count", F.col("arrivals_count") + F.col("departures_count"))
    return total.orderBy(F.desc("flight_date"), F.desc("total_count"), "airport_code").limit(limit)


def top_routes(routes: DataFrame, limit: int = 20) -> DataFrame:
    return routes.orderBy(F.desc("flight_count"), "departure_airport", "arrival_airport").limit(limit)


def incomplete_days(flights: DataFrame, first, last, least: int = 1000) -> DataFrame:
    """Every day of first..last with fewer than ``least`` rows, days without any included."""
    days = flights.sparkSession.range(1).select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("flight_date"))
    n = flights.groupBy("flight_date").agg(F.count(F.lit(1)).alias("n"))
    return days.join(n, "flight_date", "left").select("flight_date", F.coalesce("n", F.lit(0)).alias("n_rows")).where(F.col("n_rows") < least)
