"""Upserts as functions of (stored rows, new rows); a table format's writer only swaps the result in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clip, iso_time, real_date


def first_by(rows: DataFrame, key: list[str], *order: Column | str) -> DataFrame:
    """One row a key, the first by order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def latest_wins(stored: DataFrame, new: DataFrame, key: list[str], seq: str = "seq", *ties: Column | str) -> DataFrame:
    """The last new row of each key, of equal seq the first by ties, and the stored rows of other keys.

    A NULL is a key like any other.
    """
    last = first_by(new, key, F.desc(seq), *ties).select(stored.columns)
    keys = last.select(*(F.col(c).alias(f"_{c}") for c in key))
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return last.unionByName(stored.join(keys, same, "left_anti"))


def insert_new(stored: DataFrame, new: DataFrame, key: list[str], *order: Column | str) -> DataFrame:
    """The stored rows, and of the new ones the first of each key that isn't stored.

    A key with a NULL conflicts with none, so all such rows are added.
    """
    whole = F.lit(True)
    for c in key:
        whole = whole & F.col(c).isNotNull()
    fresh = first_by(new.where(whole), key, *order).join(stored.select(*key), key, "left_anti")
    cols = stored.columns
    return stored.unionByName(fresh.select(cols)).unionByName(new.where(~whole).select(cols))


def add_up(stored: DataFrame, new: DataFrame, key: list[str], sums=(), least=(), greatest=()) -> DataFrame:
    """Counts of both added, dates widened. Not idempotent: adding a batch twice counts it twice."""
    aggs = [F.sum(c).alias(c) for c in sums] + [F.min(c).alias(c) for c in least] + [F.max(c).alias(c) for c in greatest]
    return stored.unionByName(new).groupBy(*key).agg(*aggs).select(stored.columns)


def gold_aircraft(rows: DataFrame) -> DataFrame:
    """Aircraft as the last table holds them: clipped texts, dates that exist."""
    widths = {"typecode": 30, "manufacturer": 150, "operator": 100, "icao_aircraft_type": 20, "registration": 20, "serial_number": 50}
    return rows.withColumns({**{c: clip(F.col(c), n) for c, n in widths.items() if c in rows.columns}, "first_flight_date": real_date(F.col("first_flight_date"))})


def gold_weather(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"timestamp": iso_time(F.col("timestamp")), "flight_date": real_date(F.col("flight_date"))})


def unique_flights(flights: DataFrame, *order: Column | str) -> DataFrame:
    """The first row of each (icao24, first_seen, callsign); a NULL is a value here."""
    return first_by(flights, ["icao24", "first_seen", "callsign"], *order)
