"""Joins that pick one row: schedules by tier, weather by hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null, iso_time, minutes, zero_to_null


def _first(rows: DataFrame, key: list[str], seq: str) -> DataFrame:
    """key and a struct ``v`` of all columns, seq first: of each key the first row by seq."""
    row = F.struct(seq, *(c for c in rows.columns if c != seq))
    return rows.groupBy(*key).agg(F.min_by(row, seq).alias("v"))


def match_schedules(flights: DataFrame, schedules: DataFrame, seq: str = "seq") -> DataFrame:
    """flights with the struct ``schedule``: of the schedules of its callsign and day the first by tier.

    Tiers: both airports agree; the departure; the arrival; any. An unknown airport agrees with
    none. Within a tier the order is ``seq``. Schedules are reduced to one row a callsign and day
    before they meet a flight, with the first schedule of each of its airport pairs in order, so
    a flight is joined once and no group by flight follows.
    """
    key = ["callsign", "flight_date"]
    pairs = _first(schedules, [*key, "departure_airport", "arrival_airport"], seq)
    days = pairs.groupBy(*(F.col(c).alias(f"_s_{c}") for c in key)).agg(F.array_sort(F.collect_list("v")).alias("_options"))
    joined = flights.join(days, (F.col("callsign") == F.col("_s_callsign")) & (F.col("flight_date") == F.col("_s_flight_date")), "left")
    dep, arr = (blank_to_null(F.col(f"est_{x}_airport")) for x in ("departure", "arrival"))
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    tiers = (
        lambda s: same(dep, s["departure_airport"]) & same(arr, s["arrival_airport"]),
        lambda s: same(dep, s["departure_airport"]),
        lambda s: same(arr, s["arrival_airport"]),
        lambda s: F.lit(True),
    )
    chosen = F.coalesce(*(F.get(F.filter("_options", t), F.lit(0)) for t in tiers))
    return joined.withColumn("schedule", chosen).drop("_options", *(f"_s_{c}" for c in key))


def delay_minutes(last_seen: Column, scheduled: Column, rounding=minutes) -> Column:
    """Minutes between the schedule's arrival and the flight's; NULL if either is unknown."""
    return rounding(scheduled, last_seen)


def scheduled_time(text: Column) -> Column:
    return iso_time(text)


def weather_hours(weather: DataFrame, seq: str = "seq") -> DataFrame:
    """Weather with the hour of its timestamp; of rows with one airport, day and hour the first."""
    hour = F.when(F.length("timestamp") >= 13, F.substring("timestamp", 12, 2).try_cast("int"))
    rows = weather.withColumn("hour", hour)
    values = [c for c in rows.columns if c not in ("airport_code", "flight_date", "hour")]
    first = rows.groupBy("airport_code", "flight_date", "hour").agg(F.min_by(F.struct(*values), seq).alias("v"))
    return first.select("airport_code", "flight_date", "hour", "v.*")


def weather_days(hours: DataFrame, seq: str = "seq") -> DataFrame:
    """(airport_code, flight_date, by_hour, first): a day's hours as a map, and its first row by seq."""
    row = F.struct(seq, *(c for c in hours.columns if c != seq))
    by_hour = F.map_from_entries(F.filter(F.collect_list(F.struct(F.col("hour").alias("key"), row.alias("value"))), lambda e: e["key"].isNotNull()))
    return hours.groupBy("airport_code", "flight_date").agg(by_hour.alias("by_hour"), F.min_by(row, seq).alias("first"))


def match_weather(flights: DataFrame, days: DataFrame, airport: str, hour: str, name: str) -> DataFrame:
    """flights with the struct ``name``: the airport's weather at that hour, else the first of the day.

    days has one row a key, so this is a lookup. A NULL hour of the flight counts as 0.
    """
    d = days.select(F.col("airport_code").alias("_w_airport"), F.col("flight_date").alias("_w_date"), F.col("by_hour").alias("_by_hour"), F.col("first").alias("_first"))
    joined = flights.join(d, (F.col(airport) == F.col("_w_airport")) & (F.col("flight_date") == F.col("_w_date")), "left")
    chosen = F.coalesce(F.try_element_at("_by_hour", F.coalesce(F.col(hour), F.lit(0)).cast("int")), F.col("_first"))
    return joined.withColumn(name, chosen).drop("_w_airport", "_w_date", "_by_hour", "_first")


def with_lookup(left: DataFrame, table: DataFrame, on: dict[str, str], values: dict[str, str], default=None) -> DataFrame:
    """left with columns of a table that has one row a key. on: left column -> table column.

    No hint is given: a small side is broadcast by its size, a large one sorted and merged.
    """
    keys = {c: f"_k{i}" for i, c in enumerate(on.values())}
    right = table.select(*(F.col(c).alias(k) for c, k in keys.items()), *(F.col(c).alias(n) for c, n in values.items()))
    cond = None
    for mine, theirs in on.items():
        eq = F.col(mine) == F.col(keys[theirs])
        cond = eq if cond is None else cond & eq
    out = left.join(right, cond, "left").drop(*keys.values())
    return out if default is None else out.fillna(default, list(values.values()))


def without(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """The rows of left whose key right lacks: pending days, missing airports, unscheduled flights, uncached empties."""
    return left.join(right.select(*on).distinct(), on, "left_anti")


def prefer(first: DataFrame, second: DataFrame, key: list[str]) -> DataFrame:
    """The rows of first, and those of second whose key first lacks."""
    return first.unionByName(without(second, first, key), allowMissingColumns=True)


def route_traffic(dep_total: Column, arr_total: Column) -> Column:
    """The traffic of both ends; NULL instead of 0."""
    return zero_to_null(F.coalesce(dep_total, F.lit(0)) + F.coalesce(arr_total, F.lit(0)))
