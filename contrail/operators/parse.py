"""Raw JSON to typed rows. Malformed input is dropped and can be counted, never fatal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import blank_to_null, epoch, unquote

_FLIGHT = {
    "departure_airport_horiz_distance": "estDepartureAirportHorizDistance", "departure_airport_vert_distance": "estDepartureAirportVertDistance",
    "arrival_airport_horiz_distance": "estArrivalAirportHorizDistance", "arrival_airport_vert_distance": "estArrivalAirportVertDistance",
    "departure_airport_candidates_count": "departureAirportCandidatesCount", "arrival_airport_candidates_count": "arrivalAirportCandidatesCount",
}


def flight_columns() -> list[Column]:
    """The columns of a flight from its raw fields."""
    return [
        "icao24", blank_to_null(F.trim("callsign")).alias("callsign"), epoch(F.col("firstSeen")).alias("first_seen"),
        epoch(F.col("lastSeen")).alias("last_seen"), F.col("estDepartureAirport").alias("est_departure_airport"),
        F.col("estArrivalAirport").alias("est_arrival_airport"), *(F.col(raw).alias(name) for name, raw in _FLIGHT.items()),
        F.to_date(epoch(F.col("firstSeen"))).alias("flight_date"),
    ]


def is_array(response: Column) -> Column:
    """Whether a response is a JSON array; an object read as an array of objects would be a row of NULLs."""
    return F.coalesce(F.ltrim(response).startswith("["), F.lit(False))


def parse_flights(bronze: DataFrame, *keep: str) -> DataFrame:
    """Flights of all responses that are arrays; elements without an icao24 are dropped."""
    rows = F.from_json("response", f"array<struct<{schemas.FLIGHT_JSON.replace(' ', ':').replace(',:', ',')}>>")
    raw = bronze.where(is_array(F.col("response"))).select(*keep, F.posexplode(rows).alias("pos", "f")).select(*keep, "pos", "f.*")
    return raw.where(F.col("icao24").isNotNull()).select(*keep, *(["pos"] if keep else []), *flight_columns())


def bad_responses(bronze: DataFrame) -> DataFrame:
    """One row: responses, empty ones, and those that can't be parsed."""
    rows = F.from_json("response", "array<string>")
    empty = blank_to_null(F.trim("response")).isNull() | (F.trim("response") == "[]")
    return bronze.agg(
        F.count(F.lit(1)).alias("responses"), F.count_if(empty).alias("empty"), F.count_if(~empty & (rows.isNull() | ~is_array(F.col("response")))).alias("errors")
    )


def parse_states(bronze: DataFrame) -> DataFrame:
    """State vectors by position; the last, the category, may be absent."""
    body = F.from_json("response", f"struct<{schemas.STATES_JSON.replace('time bigint', 'time:bigint').replace('states array', 'states:array')}>")
    r = F.col("r")
    at = lambda i, kind: F.get(r, F.lit(i)).try_cast(kind)
    flag = lambda i: F.coalesce(at(i, "boolean"), F.lit(False))
    return bronze.select(body.alias("b")).select(F.col("b.time").alias("time"), F.explode("b.states").alias("r")).select(
        F.get(r, F.lit(0)).alias("icao24"), blank_to_null(F.trim(F.get(r, F.lit(1)))).alias("callsign"),
        F.coalesce(F.get(r, F.lit(2)), F.lit("")).alias("origin_country"), epoch(at(3, "bigint")).alias("time_position"),
        epoch(at(4, "bigint")).alias("last_contact"), at(5, "double").alias("longitude"), at(6, "double").alias("latitude"),
        at(7, "double").alias("baro_altitude"), flag(8).alias("on_ground"), at(9, "double").alias("velocity"), at(10, "double").alias("true_track"),
        at(11, "double").alias("vertical_rate"), F.from_json(F.get(r, F.lit(12)), "array<int>").alias("sensors"),
        at(13, "double").alias("geo_altitude"), F.get(r, F.lit(14)).alias("squawk"), flag(15).alias("spi"),
        F.coalesce(at(16, "int"), F.lit(0)).alias("position_source"), at(17, "int").alias("category"), epoch(F.col("time")).alias("snapshot_time"),
    )


def parse_tracks(bronze: DataFrame) -> DataFrame:
    """One row a waypoint of six fields or more, with its track's header."""
    kind = f"struct<{schemas.TRACK_JSON.replace(', ', ',').replace(' ', ':')}>"
    t = bronze.select(F.from_json("response", kind).alias("t")).select("t.*").where("icao24 is not null")
    w = F.col("w")
    return t.withColumn("w", F.explode(F.filter("path", lambda p: F.size(p) >= 6))).select(
        "icao24", blank_to_null(F.trim("callsign")).alias("callsign"), epoch(F.col("startTime").cast("bigint")).alias("start_time"),
        epoch(F.col("endTime").cast("bigint")).alias("end_time"), epoch(F.get(w, F.lit(0)).try_cast("bigint")).alias("waypoint_time"),
        *(F.get(w, F.lit(i + 1)).try_cast("double").alias(n) for i, n in enumerate(("latitude", "longitude", "baro_altitude", "true_track"))),
        F.coalesce(F.get(w, F.lit(5)).try_cast("boolean"), F.lit(False)).alias("on_ground"),
        F.to_date(epoch(F.col("startTime").cast("bigint"))).alias("track_date"),
    )


def parse_weather(bronze: DataFrame, *keep: str) -> DataFrame:
    """(airport_code, response) -> a row an hour; arrays that are missing or too short give NULL."""
    h = F.from_json("response", schemas.HOURLY_JSON.replace("hourly struct", "struct<hourly:struct") + ">")
    names = ("time", *schemas.WEATHER_VARIABLES)
    rows = bronze.select(*keep, "airport_code", h["hourly"].alias("h")).select(
        *keep, "airport_code", F.explode(F.arrays_zip(*(F.coalesce(F.col(f"h.{n}"), F.array()).alias(n) for n in names))).alias("r")
    )
    return rows.where("r.time is not null").select(
        *keep, "airport_code", F.col("r.time").alias("timestamp"), F.substring("r.time", 1, 10).alias("flight_date"), *(F.col(f"r.{v}").alias(v) for v in schemas.WEATHER_VARIABLES)
    )


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def parse_schedule_one(bronze: DataFrame, source: str = "one", keep: tuple[str, ...] = ()) -> DataFrame:
    """The first flight of ``data`` in vendor one's answer."""
    d = F.get(F.from_json("response", f"struct<{schemas.SCHEDULE_ONE_JSON.replace('data array', 'data:array')}>")["data"], F.lit(0))
    legs = [
        c for leg in ("departure", "arrival") for c in (
            _text(F.col(f"d.{leg}.icao")).alias(f"{leg}_airport"), F.col(f"d.{leg}.scheduled").alias(f"{leg}_scheduled"),
            F.col(f"d.{leg}.actual").alias(f"{leg}_actual"), F.col(f"d.{leg}.estimated").alias(f"{leg}_estimated"),
            F.col(f"d.{leg}.terminal").alias(f"{leg}_terminal"), F.col(f"d.{leg}.gate").alias(f"{leg}_gate"),
        )
    ]
    return bronze.select(*keep, d.alias("d")).where("d is not null").select(
        *keep, F.lit(source).alias("source"), _text(F.col("d.flight.icao")).alias("callsign"), _text(F.col("d.flight_date")).alias("flight_date"),
        _text(F.col("d.flight_status")).alias("flight_status"), *legs, _text(F.col("d.airline.name")).alias("airline_name"),
        _text(F.col("d.airline.icao")).alias("airline_icao"), F.lit(None).cast("string").alias("aircraft_type"),
        F.col("d.aircraft.registration").alias("aircraft_reg"),
    )


def parse_schedule_two(bronze: DataFrame, source: str = "two", keep: tuple[str, ...] = ()) -> DataFrame:
    """The first flight of vendor two's answer: an array, or an object with ``flights``.

    Terminals and gates are text or an object with ``local``; the actual time is the first
    of three fields that is there.
    """
    root = F.when(is_array(F.col("response")), F.get_json_object("response", "$[0]")).otherwise(F.get_json_object("response", "$.flights[0]"))
    at = lambda path: F.get_json_object("f", f"$.{path}")

    def either(path: str) -> Column:
        whole = at(path)
        return F.when(whole.startswith("{"), _text(at(f"{path}.local"))).otherwise(whole)

    def actual(leg: str) -> Column:
        fields = [at(f"{leg}.{k}") for k in ("actualTime", "revisedTime", "runwayTime")]
        chosen = F.coalesce(*(F.when(f != "{}", f) for f in fields))
        return F.get_json_object(chosen, "$.local")

    legs = [
        c for leg in ("departure", "arrival") for c in (
            _text(at(f"{leg}.airport.icao")).alias(f"{leg}_airport"), at(f"{leg}.scheduledTime.local").alias(f"{leg}_scheduled"),
            actual(leg).alias(f"{leg}_actual"), F.lit(None).cast("string").alias(f"{leg}_estimated"),
            either(f"{leg}.terminal").alias(f"{leg}_terminal"), either(f"{leg}.gate").alias(f"{leg}_gate"),
        )
    ]
    flights = bronze.select(*keep, root.alias("f"), *(c for c in bronze.columns if c == "flight_date")).where("f is not null")
    asked = F.col("flight_date") if "flight_date" in bronze.columns else F.lit("")
    return flights.select(
        *keep, F.lit(source).alias("source"), F.coalesce(blank_to_null(at("callSign")), at("number"), F.lit("")).alias("callsign"),
        F.coalesce(at("date"), asked).alias("flight_date"), _text(at("status")).alias("flight_status"), *legs,
        _text(at("airline.name")).alias("airline_name"), _text(at("airline.icao")).alias("airline_icao"),
        F.coalesce(blank_to_null(at("aircraft.model")), at("aircraft.type"), F.lit("")).alias("aircraft_type"), _text(at("aircraft.reg")).alias("aircraft_reg"),
    )


def conform_aircraft(raw: DataFrame) -> DataFrame:
    """The aircraft table from a CSV of text: quoted header and values cleaned, columns chosen and renamed.

    Rows without an icao24 are dropped; columns that the file lacks are empty.
    """
    clean = raw.toDF(*(c.strip().strip("'").strip('"').lower() for c in raw.columns))
    there = set(clean.columns)
    value = lambda c: _text(unquote(F.col(f"`{c}`"))) if c in there else F.lit("")
    out = clean.select(*(value(raw_name).alias(name) for raw_name, name in schemas.AIRCRAFT_COLUMNS.items()))
    return out.where("icao24 <> ''").withColumn("icao24", F.lower("icao24"))
