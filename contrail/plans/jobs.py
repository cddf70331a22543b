"""Jobs between the layers of a lake: raw responses, typed rows, aggregates and features."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import TABLES, Lake
from ..functions import iso_time, real_date
from ..operators.match import without
from ..operators.parse import parse_flights, parse_schedule_one, parse_schedule_two, parse_states, parse_tracks, parse_weather
from ..operators.traffic import daily_traffic, hourly_distribution
from ..operators.upsert import first_by, gold_aircraft, gold_weather, insert_new
from ..sources.files import read_aircraft
from .feature_store import Tables, feature_store

_EMPTY = "airport_code string, flight_date date, endpoint string"


def bronze_to_silver(lake: Lake) -> int:
    """Parses all pending ingestion days; a flight that silver has is not added again. Returns the new rows."""
    bronze = lake.read("bronze/flights")
    pending = without(bronze.select(F.col("ingestion_date").cast("string").alias("item")).distinct(), lake.done("bronze_to_silver"), ["item"])
    rows = bronze.join(pending, F.col("ingestion_date").cast("string") == F.col("item"), "left_semi")
    parsed = parse_flights(rows, "fetched_at").withColumnRenamed("fetched_at", "ingested_at")
    key = list(TABLES["silver/flights"].key)
    fresh = first_by(parsed, key, "ingested_at", "pos", "last_seen").drop("pos")
    if lake.exists("silver/flights"):
        old = lake.read("silver/flights").select(*(F.col(c).alias(f"o_{c}") for c in key))
        same = F.lit(True)
        for c in key:
            same = same & F.col(c).eqNullSafe(F.col(f"o_{c}"))
        fresh = fresh.join(old, same, "left_anti")
    days = [r[0] for r in pending.collect()]  # days, not rows
    before = lake.read("silver/flights").count() if lake.exists("silver/flights") else 0
    lake.append("silver/flights", fresh)
    if days:
        lake.mark("bronze_to_silver", lake.spark.createDataFrame([(d,) for d in days], "item string"))
    return lake.read("silver/flights").count() - before


def schedules_to_silver(lake: Lake) -> None:
    """Both vendors' answers as typed schedules; of a vendor's flight and day the answer fetched last.

    An answer that has no day of its own takes ``flight_date`` of its request's params.
    """
    rows = None
    for k, (vendor, parse) in enumerate((("one", parse_schedule_one), ("two", parse_schedule_two))):
        if lake.exists(f"bronze/schedules_{vendor}"):
            asked = lake.read(f"bronze/schedules_{vendor}").withColumn("flight_date", F.get_json_object("params", "$.flight_date"))
            some = parse(asked.drop("source"), vendor, ("fetched_at",)).withColumn("seq", F.unix_micros("fetched_at") * 2 + k)
            rows = some if rows is None else rows.unionByName(some)
    if rows is not None:
        times = [f"{leg}_{kind}" for leg in ("departure", "arrival") for kind in ("scheduled", "actual", "estimated")]
        rows = rows.withColumns({"flight_date": real_date(F.col("flight_date")), **{c: iso_time(F.col(c)) for c in times}})
        rows = rows.where("callsign <> '' and flight_date is not null")
        lake.replace("silver/schedules", first_by(rows, list(TABLES["silver/schedules"].key), F.desc("seq"), "arrival_scheduled", "departure_scheduled"))


def weather_to_silver(lake: Lake) -> None:
    """Hours of all answers whose params name an airport; of an airport's hour the one fetched last."""
    if lake.exists("bronze/weather"):
        asked = lake.read("bronze/weather").withColumn("airport_code", F.get_json_object("params", "$.airport")).where("airport_code is not null")
        at = iso_time(F.col("timestamp"))
        rows = parse_weather(asked, "fetched_at").withColumns({
            "flight_date": real_date(F.col("flight_date")), "ingested_at": F.col("fetched_at"),
            "seq": F.unix_micros("fetched_at") + F.coalesce(F.hour(at) * 60 + F.minute(at), F.lit(1440)),  # an answer's hours in their order
        }).drop("fetched_at")
        lake.replace("silver/weather", first_by(rows, list(TABLES["silver/weather"].key), F.desc("seq")))


def aircraft_to_silver(lake: Lake, path: str) -> None:
    """The aircraft CSV, one row an icao24."""
    rows = read_aircraft(lake.spark, path)
    lake.replace("silver/aircraft", first_by(rows, ["icao24"], *(F.desc(c) for c in rows.columns if c != "icao24")))


def positions_to_silver(lake: Lake) -> None:
    """State vectors and waypoints of all answers, each once."""
    if lake.exists("bronze/states"):
        rows = parse_states(lake.read("bronze/states")).withColumn("snapshot_date", F.to_date("snapshot_time"))
        lake.replace("silver/state_vectors", first_by(rows, list(TABLES["silver/state_vectors"].key), F.desc("last_contact"), "longitude", "latitude"))
    if lake.exists("bronze/tracks"):
        rows = parse_tracks(lake.read("bronze/tracks"))
        lake.replace("silver/track_waypoints", first_by(rows, list(TABLES["silver/track_waypoints"].key), "end_time", "latitude", "longitude"))


def changed_days(lake: Lake) -> DataFrame:
    """(flight_date, n) of the days whose number of flights in silver isn't the one that gold was made from.

    Silver only grows, so a day with as many flights as before has the same flights. The count
    reads no column of the files, as the day is in the folders' names.
    """
    now = lake.read("silver/flights").groupBy("flight_date").agg(F.count(F.lit(1)).alias("n"))
    seen = lake.read("system/gold_days", "flight_date date, n long").select(F.col("flight_date").alias("d"), F.col("n").alias("seen"))
    return now.join(seen, F.col("flight_date").eqNullSafe(F.col("d")), "left").where("seen is null or seen <> n").select("flight_date", "n")


def silver_to_gold(lake: Lake) -> int:
    """Aggregates of the days that changed, so that it may run any number of times. Returns how many days did.

    Only the changed partitions of silver are read. Aggregates are small next to flights: the rows of
    other days are kept, and a route's totals are sums of its days.
    """
    changed = [(r["flight_date"], r["n"]) for r in changed_days(lake).collect()]  # days, not rows
    if not changed:
        return 0
    days = [d for d, _ in changed if d is not None]
    one_of = lambda: F.coalesce(F.col("flight_date").isin(days), F.lit(False)) | (F.col("flight_date").isNull() if len(days) < len(changed) else F.lit(False))
    flights = lake.read("silver/flights").where(one_of())
    known = flights.where("est_departure_airport <> '' and est_arrival_airport <> ''")
    routes = known.groupBy(F.col("est_departure_airport").alias("departure_airport"), F.col("est_arrival_airport").alias("arrival_airport"), F.to_date("first_seen").alias("flight_date"))
    parts = {
        "gold/daily_airport_traffic": daily_traffic(flights), "gold/hourly_distribution": hourly_distribution(flights),
        "gold/route_days": routes.agg(F.count(F.lit(1)).alias("flight_count")),
    }
    for name, rows in parts.items():
        lake.replace(name, lake.read(name).where(~one_of()).unionByName(rows) if lake.exists(name) else rows)
    totals = lake.read("gold/route_days").groupBy("departure_airport", "arrival_airport")
    lake.replace("gold/route_density", totals.agg(F.sum("flight_count").alias("flight_count"), F.min("flight_date").alias("first_seen"), F.max("flight_date").alias("last_seen")))
    key = list(TABLES["gold/flights"].key)
    fresh = first_by(flights.where("flight_date is not null and icao24 is not null and first_seen is not null"), key, "callsign", "last_seen")
    lake.append("gold/flights", fresh.join(lake.read("gold/flights").select(*key), key, "left_anti") if lake.exists("gold/flights") else fresh)
    made = lake.spark.createDataFrame(changed, "flight_date date, n long")
    lake.replace("system/gold_days", lake.read("system/gold_days", "flight_date date, n long").where(~one_of()).unionByName(made))
    return len(changed)


def entities_to_gold(lake: Lake) -> None:
    if lake.exists("silver/aircraft"):
        lake.replace("gold/aircraft", gold_aircraft(lake.read("silver/aircraft")).withColumn("tracked", F.current_timestamp()))
    if lake.exists("silver/weather"):
        rows = gold_weather(lake.read("silver/weather"))
        lake.replace("gold/weather", insert_new(rows.limit(0), rows, list(TABLES["gold/weather"].key), "ingested_at"))


def build_features(lake: Lake, grain: str = "aircraft_day") -> None:
    t = Tables(
        lake.read("silver/flights"), lake.read("silver/schedules", "seq long, callsign string, flight_date date, departure_airport string, arrival_airport string, arrival_scheduled timestamp, source string"),
        lake.read("silver/aircraft", "icao24 string, typecode string, manufacturer string, operator string, first_flight_date string"),
        lake.read("silver/weather", "seq long, airport_code string, flight_date date, timestamp string, temperature_2m double, precipitation double, wind_speed_10m double, visibility double"),
        lake.read("gold/daily_airport_traffic"), lake.read("gold/hourly_distribution"), lake.read("gold/route_density"),
    )
    lake.replace("gold/feature_store", feature_store(t, grain))


def pending_calls(lake: Lake, airports: DataFrame, days: DataFrame) -> DataFrame:
    """(airport_code, flight_date, endpoint) to fetch: those neither loaded nor known to be empty."""
    ends = lake.spark.createDataFrame([("arrival",), ("departure",)], "endpoint string")
    # a few airports by a few days: the request list, not data
    wanted = airports.select("airport_code").join(days.select("flight_date"), F.lit(True)).join(ends, F.lit(True))
    key = ["airport_code", "flight_date", "endpoint"]
    loaded = lake.read("bronze/flights", "params string, ingestion_date date, endpoint string").select(
        F.get_json_object("params", "$.airport").alias("airport_code"), F.col("ingestion_date").alias("flight_date"), "endpoint"
    )
    return without(without(wanted, loaded, key), lake.read("system/empty_airports", _EMPTY), key)


def remember_empty(lake: Lake, calls: DataFrame) -> None:
    lake.append("system/empty_airports", calls.select("airport_code", "flight_date", "endpoint").withColumn("cached_at", F.current_timestamp()))


STEPS = {
    "silver": bronze_to_silver, "schedules": schedules_to_silver, "weather": weather_to_silver, "positions": positions_to_silver, "gold": silver_to_gold, "entities": entities_to_gold, "features": build_features,
}


def main(argv: list[str] | None = None) -> int:
    from ..session import session

    parser = argparse.ArgumentParser(description="Runs the jobs of a lake in order.")
    parser.add_argument("root")
    parser.add_argument("--skip", nargs="*", choices=STEPS, default=[])
    parser.add_argument("--aircraft", help="the aircraft CSV, to be imported first")
    parser.add_argument("--dry-run", action="store_true", help="only say how many rows each table has")
    args = parser.parse_args(argv)
    lake = Lake(session(), args.root)
    if args.dry_run:
        for name in TABLES:
            print(name, lake.read(name).count() if lake.exists(name) else 0)
        return 0
    if args.aircraft:
        aircraft_to_silver(lake, args.aircraft)
    for name, step in STEPS.items():
        if name not in args.skip:
            step(lake)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
