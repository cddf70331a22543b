"""Declared schemas; nothing is inferred."""

from __future__ import annotations

FLIGHT_JSON = (
    "icao24 string, firstSeen bigint, lastSeen bigint, estDepartureAirport string, estArrivalAirport string, callsign string, "
    "estDepartureAirportHorizDistance double, estDepartureAirportVertDistance double, estArrivalAirportHorizDistance double, "
    "estArrivalAirportVertDistance double, departureAirportCandidatesCount int, arrivalAirportCandidatesCount int"
)
STATES_JSON = "time bigint, states array<array<string>>"
TRACK_JSON = "icao24 string, startTime double, endTime double, callsign string, path array<array<string>>"
WEATHER_VARIABLES = (
    "temperature_2m", "precipitation", "wind_speed_10m", "wind_gusts_10m", "visibility", "cloud_cover", "relative_humidity_2m",
)
HOURLY_JSON = "hourly struct<time:array<string>," + ",".join(f"{v}:array<double>" for v in WEATHER_VARIABLES) + ">"
_LEG = "struct<icao:string,scheduled:string,actual:string,estimated:string,terminal:string,gate:string>"
SCHEDULE_ONE_JSON = (
    f"data array<struct<flight:struct<icao:string>,flight_date:string,flight_status:string,departure:{_LEG},arrival:{_LEG},"
    "airline:struct<name:string,icao:string>,aircraft:struct<registration:string>>>"
)
BRONZE = "endpoint string, params string, fetched_at timestamp, response string, ingestion_date date"
AIRCRAFT_COLUMNS = {
    "icao24": "icao24", "registration": "registration", "manufacturername": "manufacturer", "model": "model", "typecode": "typecode",
    "serialnumber": "serial_number", "linenumber": "line_number", "icaoaircraftclass": "icao_aircraft_type", "operator": "operator",
    "operatorcallsign": "operator_callsign", "operatoricao": "operator_icao", "operatoriata": "operator_iata", "firstflightdate": "first_flight_date",
}
