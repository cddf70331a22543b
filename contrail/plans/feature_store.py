"""The flight feature table: one wide row for an aircraft's day, or for each flight."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null, iso_weekday, minutes, real_date, years, zero_to_null
from ..operators.match import match_schedules, match_weather, route_traffic, weather_days, weather_hours, with_lookup
from ..operators.upsert import first_by

#: What identifies a flight here.
FLIGHT = ["icao24", "first_seen", "callsign", "est_departure_airport", "est_arrival_airport", "last_seen"]
_WEATHER = {"temperature": "temperature_2m", "precipitation": "precipitation", "wind_speed": "wind_speed_10m", "visibility": "visibility"}


@dataclass
class Tables:
    """schedules and weather have a column seq, their order of arrival; aircraft has one row an icao24."""

    flights: DataFrame
    schedules: DataFrame
    aircraft: DataFrame
    weather: DataFrame
    daily: DataFrame
    hourly: DataFrame
    routes: DataFrame


def recent(flights: DataFrame, today: Column, days: int = 30) -> DataFrame:
    """Flights of the last days before today."""
    return flights.where(F.col("flight_date") >= F.date_sub(today, days))


def feature_store(t: Tables, grain: str = "aircraft_day", rounding=minutes) -> DataFrame:
    """grain: "aircraft_day" keeps the first flight (by times, callsign) of an aircraft's day; "flight" all.

    Flights without a callsign or day are left out. The row is chosen before any join, as no
    later step drops rows; so the joins see a row a key.
    """
    f = t.flights.where("callsign <> '' and flight_date is not null")
    if grain == "aircraft_day":
        f = first_by(f, ["icao24", "flight_date"], "first_seen", "last_seen", "callsign", "est_departure_airport", "est_arrival_airport")
    elif grain == "flight":
        f = f.dropDuplicates(FLIGHT)
    else:
        raise ValueError(f"unknown grain {grain!r}")
    f = f.select(*FLIGHT, "flight_date").withColumns({
        "airborne_minutes": rounding(F.col("first_seen"), F.col("last_seen")),
        "departure_hour": F.hour("first_seen"), "day_of_week": iso_weekday(F.col("flight_date")), "month": F.month("flight_date"),
        "_icao": F.lower("icao24"), "_dep": F.coalesce("est_departure_airport", F.lit("")), "_arr": F.coalesce("est_arrival_airport", F.lit("")),
    })
    f = match_schedules(f, t.schedules)
    days = weather_days(weather_hours(t.weather))
    f = match_weather(f, days, "_dep", "departure_hour", "dep_weather")
    f = match_weather(f, days, "_arr", "departure_hour", "arr_weather")
    names = {"typecode": "_type", "manufacturer": "_maker", "operator": "_operator", "first_flight_date": "_first_flight"}
    f = with_lookup(f, t.aircraft, {"_icao": "icao24"}, names)
    f = with_lookup(f, t.routes, {"_dep": "departure_airport", "_arr": "arrival_airport"}, {"flight_count": "_density"})
    total = t.daily.withColumn("total", F.col("arrivals_count") + F.col("departures_count"))
    hour_total = t.hourly.withColumn("total", F.col("arrivals_count") + F.col("departures_count"))
    for end in ("_dep", "_arr"):
        f = with_lookup(f, total, {end: "airport_code", "flight_date": "flight_date"}, {"total": f"{end}_daily"})
        f = with_lookup(f, hour_total, {end: "airport_code", "flight_date": "flight_date", "departure_hour": "hour"}, {"total": f"{end}_hourly"})
    weather = [F.col(f"{end}_weather.{v}").alias(f"{end}_{n}") for end in ("dep", "arr") for n, v in _WEATHER.items()]
    return f.select(
        "icao24", "flight_date", "callsign", blank_to_null(F.col("_dep")).alias("departure_airport"), blank_to_null(F.col("_arr")).alias("arrival_airport"),
        rounding(F.col("schedule.arrival_scheduled"), F.col("last_seen")).alias("delay_minutes"), "airborne_minutes", "departure_hour", "day_of_week", "month",
        blank_to_null(F.col("_type")).alias("aircraft_type"), blank_to_null(F.col("_maker")).alias("aircraft_manufacturer"),
        blank_to_null(F.col("_operator")).alias("aircraft_operator"),
        years(real_date(F.col("_first_flight").cast("string")), F.to_date("first_seen")).alias("aircraft_age_years"),
        route_traffic(F.col("_dep_daily"), F.col("_arr_daily")).alias("route_daily_traffic"), zero_to_null(F.col("_density")).alias("route_total_density"),
        zero_to_null(F.col("_dep_hourly")).alias("departure_airport_hourly_traffic"), zero_to_null(F.col("_arr_hourly")).alias("arrival_airport_hourly_traffic"),
        *weather, F.col("schedule.source").alias("schedule_source"),
    )
