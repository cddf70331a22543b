"""Queries over the test tables, one or more for each operator, with their SQL."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import airline, clip, distance_km, hour_block, iso_time, iso_weekday, minutes, real_date, unquote, years
from ..operators import match, parse, sampling, traffic, upsert
from ..sources.airports import airports, in_box
from ..sources.files import endpoint
from ..streaming.jobs import hourly_windows, run_daily_traffic
from . import adapters as A
from .feature_store import Tables, feature_store, recent
from .ingest import documents_to_flights, flight_documents

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
ID = ["event_id"]
START, END = "2024-01-05", "2024-01-12"


def query(sql: str | None = None):
    """Registers a query under its function's name; sql may use the adapters' table expressions."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = A.WITH + sql
        return f

    return add


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    """UTC timestamps without zone, as the SQL side has them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _daily(spark, sf):
    return traffic.daily_traffic(A.flights(spark, sf))


def _tables(spark, sf, flights=None) -> Tables:
    f = A.flights(spark, sf)
    return Tables(
        flights if flights is not None else f, A.schedules(spark, sf), A.aircraft(spark, sf), A.weather(spark, sf),
        traffic.daily_traffic(f), traffic.hourly_distribution(f), traffic.route_density(f),
    )


# --- scans and parsing -------------------------------------------------------------------


@query("SELECT event_id, icao24, callsign, first_seen, last_seen, est_departure_airport, est_arrival_airport, flight_date FROM flights")
def s16_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _naive(A.flights(spark, sf), "first_seen", "last_seen")


@query("SELECT est_departure_airport, flight_date FROM flights")
def s17_scan_columns(spark, sf):
    return A.flights(spark, sf).select("est_departure_airport", "flight_date")


@query("SELECT DISTINCT flight_date FROM flights")
def s18_partitions(spark, sf):
    return A.flights(spark, sf).select("flight_date").distinct()


@query("SELECT callsign, flight_date, icao24 FROM flights WHERE flight_date >= DATE '2024-01-20' AND callsign <> ''")
def s22_filtered_scan(spark, sf):
    return A.flights(spark, sf).where("flight_date >= date'2024-01-20' and callsign <> ''").select("callsign", "flight_date", "icao24")


@query("SELECT (SELECT count(*) FROM flights) AS flights, (SELECT count(*) FROM aircraft) AS aircraft, (SELECT count(*) FROM schedules) AS schedules")
def s24_counts(spark, sf):
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    out = n(A.flights(spark, sf), "flights").withColumn("one", F.lit(1))
    for name, df in (("aircraft", A.aircraft(spark, sf)), ("schedules", A.schedules(spark, sf))):
        out = out.join(n(df, name).withColumn("one", F.lit(1)), "one")
    return out.drop("one")


@query("SELECT lower(trim(c_name)) AS icao24, c_mktsegment AS typecode, '' AS model FROM customer WHERE c_custkey % 3 <> 0")
def s15_aircraft_csv(spark, sf):
    c = A.table(spark, sf, "customer")
    raw = c.select(
        F.when(F.col("c_custkey") % 3 == 0, F.lit(" '' ")).otherwise(F.concat(F.lit(" '"), "c_name", F.lit("'"))).alias("'icao24'"),
        F.concat(F.lit('"'), "c_mktsegment", F.lit('"')).alias("'TypeCode'"),
    )
    return parse.conform_aircraft(raw).select("icao24", "typecode", "model")


def _bronze(spark, sf, per: int = 50) -> DataFrame:
    """Flights as responses, the raw form."""
    f = A.flights(spark, sf)
    one = F.struct("icao24", F.unix_seconds("first_seen").alias("firstSeen"), F.unix_seconds("last_seen").alias("lastSeen"), F.col("est_departure_airport").alias("estDepartureAirport"), F.col("est_arrival_airport").alias("estArrivalAirport"), F.concat(F.lit(" "), "callsign", F.lit("  ")).alias("callsign"))
    good = f.groupBy((F.col("event_id") / per).cast("bigint").alias("b")).agg(F.to_json(F.collect_list(one)).alias("response"))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "[]"), (-4, '{"icao24": "x"}'), (-5, '[{"callsign": "NOID"}]'), (-6, "oops")], "b bigint, response string")
    return good.unionByName(odd)


@query("SELECT icao24, callsign, first_seen, last_seen, est_departure_airport, est_arrival_airport, flight_date FROM flights")
def p1_parse_flights(spark, sf):
    out = parse.parse_flights(_bronze(spark, sf))
    return _naive(out, "first_seen", "last_seen").select("icao24", "callsign", "first_seen", "last_seen", "est_departure_airport", "est_arrival_airport", "flight_date")


@query("SELECT count(DISTINCT event_id // 50) + 6 AS responses, 3 AS empty, 2 AS errors FROM flights")
def f7_bad_responses(spark, sf):
    return parse.bad_responses(_bronze(spark, sf)).select("responses", "empty", F.col("errors"))


@query("""SELECT o_orderkey::VARCHAR AS icao24, o_orderstatus AS callsign, o_orderkey % 90 + 0.5 AS latitude, o_totalprice AS baro_altitude,
 o_orderkey % 2 = 0 AS on_ground, CASE WHEN o_orderkey % 2 = 0 THEN 3 END AS category, 0 AS position_source, '' AS origin_country FROM orders""")
def p3_states(spark, sf):
    k = F.col("o_orderkey")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    row = F.concat_ws(
        ",", q(k.cast("string")), q(F.concat("o_orderstatus", F.lit("  "))), F.lit("null"), F.lit("1700000000"), F.lit("1700000001"), F.lit("1.5"),
        (k % 90 + F.lit(0.5)).cast("string"), F.col("o_totalprice").cast("string"), F.when(k % 2 == 0, "true").otherwise("null"),
        *(F.lit(x) for x in ("2.0", "3.0", "null", "[1,2]", "null", '"7000"', "false", "null")), F.when(k % 2 == 0, F.lit("3")),
    )
    body = F.concat(F.lit('{"time":1700000000,"states":['), F.lit("["), row, F.lit("]"), F.lit("]}"))
    none = spark.createDataFrame([('{"time": 1, "states": null}',)], "response string")
    out = parse.parse_states(A.table(spark, sf, "orders").select(body.alias("response")).unionByName(none))
    return out.select("icao24", "callsign", "latitude", "baro_altitude", "on_ground", "category", "position_source", "origin_country")


@query("""SELECT l_orderkey::VARCHAR AS icao24, 1700000000 + l_linenumber AS waypoint, l_quantity AS latitude, l_linenumber % 2 = 0 AS on_ground
 FROM lineitem WHERE l_linenumber <> 3""")
def p5_p6_tracks(spark, sf):
    n = F.col("l_linenumber")
    point = F.concat(F.lit("["), F.concat_ws(",", (n + 1700000000).cast("string"), F.col("l_quantity").cast("string"), F.lit("null"), F.lit("1000.5"), F.lit("90")), F.when(n == 3, "").otherwise(F.concat(F.lit(","), (n % 2 == 0).cast("string"))), F.lit("]"))
    tracks = A.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.concat_ws(",", F.collect_list(point)).alias("p"))
    body = F.concat(F.lit('{"icao24":"'), F.col("l_orderkey").cast("string"), F.lit('","startTime":1700000000,"endTime":1700000900,"callsign":null,"path":['), "p", F.lit("]}"))
    odd = spark.createDataFrame([('{"icao24": "x", "path": []}',), ('{"icao24": "y"}',)], "response string")
    out = parse.parse_tracks(tracks.select(body.alias("response")).unionByName(odd))
    return out.select("icao24", F.unix_seconds("waypoint_time").alias("waypoint"), "latitude", "on_ground")


@query("""SELECT airport_code, strftime(flight_date, '%Y-%m-%d') || 'T' || lpad(hour::VARCHAR, 2, '0') || ':00' AS timestamp, temperature_2m,
 CASE WHEN row_number() OVER (PARTITION BY airport_code, flight_date ORDER BY hour) <= 2 THEN precipitation END AS precipitation, NULL::DOUBLE AS visibility FROM weather""")
def p7_weather_pivot(spark, sf):
    w = A.weather(spark, sf).groupBy("airport_code", "flight_date").agg(F.array_sort(F.collect_list(F.struct("timestamp", "temperature_2m", "precipitation"))).alias("h"))
    hourly = F.struct(F.col("h.timestamp").alias("time"), F.col("h.temperature_2m").alias("temperature_2m"), F.slice(F.col("h.precipitation"), 1, 2).alias("precipitation"))
    out = parse.parse_weather(w.select("airport_code", F.to_json(F.struct(hourly.alias("hourly"))).alias("response")))
    return out.select("airport_code", "timestamp", "temperature_2m", "precipitation", "visibility")


@query("""SELECT c_name AS callsign, c_mktsegment AS airline_name, 'T' || (c_nationkey % 4)::VARCHAR AS departure_terminal, '' AS arrival_airport, NULL::VARCHAR AS aircraft_type,
 c_custkey::VARCHAR AS aircraft_reg FROM customer""")
def p8_schedule_one(spark, sf):
    c = A.table(spark, sf, "customer")
    first = F.struct(
        F.struct(F.col("c_name").alias("icao")).alias("flight"), F.lit("2024-01-01").alias("flight_date"),
        F.struct(F.lit("LEMD").alias("icao"), F.concat(F.lit("T"), (F.col("c_nationkey") % 4).cast("string")).alias("terminal")).alias("departure"),
        F.struct(F.col("c_mktsegment").alias("name")).alias("airline"), F.struct(F.col("c_custkey").cast("string").alias("registration")).alias("aircraft"),
    )
    body = c.select(F.to_json(F.struct(F.array(first).alias("data"))).alias("response"))
    out = parse.parse_schedule_one(body.unionByName(spark.createDataFrame([('{"data": []}',), ("x",)], "response string")))
    return out.select("callsign", "airline_name", "departure_terminal", "arrival_airport", "aircraft_type", "aircraft_reg")


@query("""SELECT CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'N' || c_custkey END AS callsign, CASE WHEN c_custkey % 3 = 0 THEN 'obj' WHEN c_custkey % 3 = 1 THEN 'text' ELSE '' END AS departure_terminal,
 CASE WHEN c_custkey % 2 = 0 THEN '2024-01-01 10:00' ELSE '2024-01-01 11:00' END AS departure_actual, c_mktsegment AS aircraft_type FROM customer""")
def p9_schedule_two(spark, sf):
    k = F.col("c_custkey")
    terminal = F.when(k % 3 == 0, '{"local":"obj"}').when(k % 3 == 1, '"text"').otherwise('{"x":1}')
    actual = F.when(k % 2 == 0, '"actualTime":{"local":"2024-01-01 10:00"}').otherwise('"actualTime":{},"runwayTime":{"local":"2024-01-01 11:00"}')
    name = F.when(k % 2 == 0, F.concat(F.lit('"callSign":"'), "c_name", F.lit('"'))).otherwise(F.concat(F.lit('"callSign":"","number":"N'), k.cast("string"), F.lit('"')))
    one = F.concat(F.lit("{"), name, F.lit(',"departure":{"terminal":'), terminal, F.lit(","), actual, F.lit('},"aircraft":{"type":"'), "c_mktsegment", F.lit('"}}'))
    body = F.when(k % 5 == 0, F.concat(F.lit('{"flights":['), one, F.lit("]}"))).otherwise(F.concat(F.lit("["), one, F.lit("]")))
    out = parse.parse_schedule_two(A.table(spark, sf, "customer").select(body.alias("response")).unionByName(spark.createDataFrame([("[]",), ('{"flights":[]}',)], "response string")))
    return out.select("callsign", "departure_terminal", "departure_actual", "aircraft_type")


@query("SELECT event_id, TRY_CAST(s AS DOUBLE) AS as_double, CASE WHEN event_id % 4 = 1 THEN event_id::INT END AS as_int FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'x' WHEN 1 THEN event_id::VARCHAR WHEN 2 THEN event_id || '.5' END AS s FROM flights)")
def p17_safe_casts(spark, sf):
    e = F.col("event_id")
    s = F.when(e % 4 == 0, "x").when(e % 4 == 1, e.cast("string")).when(e % 4 == 2, F.concat(e.cast("string"), F.lit(".5")))
    return A.flights(spark, sf).select("event_id", s.try_cast("double").alias("as_double"), s.try_cast("int").alias("as_int"))


# --- filters -----------------------------------------------------------------------------


@query("SELECT event_id, icao24 FROM flights WHERE flight_date = DATE '2024-01-10'")
def f1_day(spark, sf):
    return A.flights(spark, sf).where("flight_date = date'2024-01-10'").select("event_id", "icao24")


@query("SELECT count(*) > 0 AS found FROM flights WHERE est_departure_airport = 'AP3' AND flight_date = DATE '2024-01-10' AND callsign LIKE 'CLI%'")
def f2_exists(spark, sf):
    rows = A.flights(spark, sf).where("est_departure_airport = 'AP3' and flight_date = date'2024-01-10' and callsign like 'CLI%'")
    return rows.limit(1).agg((F.count(F.lit(1)) > 0).alias("found"))


@query("SELECT event_id, flight_date FROM flights WHERE flight_date >= DATE '2024-01-10'")
def f3_horizon(spark, sf):
    return recent(A.flights(spark, sf), F.to_date(F.lit("2024-02-09"))).select("event_id", "flight_date")


@query(f"""SELECT airport_code, greatest(s, DATE '{START}') AS start_date, least(e, DATE '{END}') AS end_date FROM
 (SELECT airport_code, min(flight_date) AS s, max(flight_date) AS e FROM ends WHERE airport_code <> 'AP1' GROUP BY 1) WHERE s <= DATE '{END}' AND e >= DATE '{START}'""")
def f9_overlap(spark, sf):
    ranges = traffic.airport_date_ranges(A.flights(spark, sf)).where("airport_code <> 'AP1'")
    return traffic.overlap(ranges, F.to_date(F.lit(START)), F.to_date(F.lit(END)))


@query("SELECT lpad((hour(first_seen) // 6 * 6)::VARCHAR, 2, '0') || '-' || lpad((hour(first_seen) // 6 * 6 + 6)::VARCHAR, 2, '0') AS block, count(*) AS n FROM flights GROUP BY 1")
def f11_hour_block(spark, sf):
    return A.flights(spark, sf).groupBy(hour_block(F.col("first_seen")).alias("block")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, TRY_CAST('2024-02-' || lpad((event_id % 32)::VARCHAR, 2, '0') AS DATE) AS d FROM flights")
def f13_real_date(spark, sf):
    e = F.col("event_id")
    return A.flights(spark, sf).select("event_id", real_date(F.concat(F.lit("2024-02-"), F.lpad((e % 32).cast("string"), 2, "0"))).alias("d"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 90 BETWEEN 36.0 AND 43.8 AND o_orderkey % 20 - 10 BETWEEN -9.3 AND 4.3")
def f14_box(spark, sf):
    k = F.col("o_orderkey")
    return in_box(A.table(spark, sf, "orders").select("o_orderkey", (k % 90).alias("latitude"), (k % 20 - 10).alias("longitude")), "spain").select("o_orderkey")


# --- joins -------------------------------------------------------------------------------


@query("SELECT f.event_id, m.seq AS schedule_seq, m.source, m.tier, round(date_diff('second', m.arrival_scheduled, f.last_seen) / 60.0, 1) AS delay_minutes FROM flights f LEFT JOIN matched m USING (event_id)")
def j1_schedule_match(spark, sf):
    f = match.match_schedules(A.flights(spark, sf), A.schedules(spark, sf))
    s = F.col("schedule")
    d, a = s["departure_airport"] == F.col("est_departure_airport"), s["arrival_airport"] == F.col("est_arrival_airport")
    tier = F.when(s.isNotNull(), F.when(d & a, 1).when(d, 2).when(a, 3).otherwise(4))
    return f.select("event_id", s["seq"].alias("schedule_seq"), s["source"].alias("source"), tier.alias("tier"), minutes(s["arrival_scheduled"], F.col("last_seen")).alias("delay_minutes"))


@query("SELECT event_id, typecode, operator, first_flight_date FROM flights f LEFT JOIN aircraft a ON lower(f.icao24) = a.icao24")
def j2_aircraft(spark, sf):
    f = A.flights(spark, sf).withColumn("k", F.lower("icao24"))
    out = match.with_lookup(f, A.aircraft(spark, sf), {"k": "icao24"}, {c: c for c in ("typecode", "operator", "first_flight_date")})
    return out.select("event_id", "typecode", "operator", real_date(F.col("first_flight_date")).alias("first_flight_date"))


@query("""SELECT event_id, w.hour::INT AS weather_hour, w.temperature_2m FROM flights f LEFT JOIN weather w ON f.est_arrival_airport = w.airport_code AND f.flight_date = w.flight_date
 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY (w.hour <> hour(first_seen))::INT, w.seq) = 1""")
def j3_weather(spark, sf):
    f = A.flights(spark, sf).withColumn("h", F.hour("first_seen"))
    out = match.match_weather(f, match.weather_days(match.weather_hours(A.weather(spark, sf))), "est_arrival_airport", "h", "w")
    return out.select("event_id", F.col("w.hour").alias("weather_hour"), F.col("w.temperature_2m").alias("temperature_2m"))


@query("SELECT event_id, flight_count FROM flights LEFT JOIN routes ON est_departure_airport = departure_airport AND est_arrival_airport = arrival_airport")
def j4_route_density(spark, sf):
    f = A.flights(spark, sf)
    on = {"est_departure_airport": "departure_airport", "est_arrival_airport": "arrival_airport"}
    return match.with_lookup(f, traffic.route_density(f), on, {"flight_count": "flight_count"}, 0).select("event_id", "flight_count")


@query("""SELECT event_id, nullif(coalesce(d.arrivals_count + d.departures_count, 0) + coalesce(a.arrivals_count + a.departures_count, 0), 0) AS route_daily_traffic FROM flights f
 LEFT JOIN daily d ON d.airport_code = est_departure_airport AND d.flight_date = f.flight_date LEFT JOIN daily a ON a.airport_code = est_arrival_airport AND a.flight_date = f.flight_date""")
def j5_daily_traffic(spark, sf):
    f, d = A.flights(spark, sf), _daily(spark, sf).withColumn("n", F.col("arrivals_count") + F.col("departures_count"))
    for end in ("departure", "arrival"):
        f = match.with_lookup(f, d, {f"est_{end}_airport": "airport_code", "flight_date": "flight_date"}, {"n": end})
    return f.select("event_id", match.route_traffic(F.col("departure"), F.col("arrival")).alias("route_daily_traffic"))


@query("""SELECT event_id, d.departures_count AS dep_departures, a.arrivals_count AS arr_arrivals FROM flights f
 LEFT JOIN hourly d ON d.airport_code = est_departure_airport AND d.flight_date = f.flight_date AND d.hour = hour(f.first_seen)
 LEFT JOIN hourly a ON a.airport_code = est_arrival_airport AND a.flight_date = f.flight_date AND a.hour = hour(f.first_seen)""")
def j6_hourly_traffic(spark, sf):
    f = A.flights(spark, sf).withColumn("h", F.hour("first_seen"))
    h = traffic.hourly_distribution(A.flights(spark, sf))
    for end, value, name in (("departure", "departures_count", "dep_departures"), ("arrival", "arrivals_count", "arr_arrivals")):
        f = match.with_lookup(f, h, {f"est_{end}_airport": "airport_code", "flight_date": "flight_date", "h": "hour"}, {value: name})
    return f.select("event_id", "dep_departures", "arr_arrivals")


@query("SELECT DISTINCT flight_date FROM flights WHERE flight_date NOT IN (SELECT flight_date FROM flights WHERE event_id % 3 = 0 AND flight_date < DATE '2024-01-15')")
def j7_pending_days(spark, sf):
    f = A.flights(spark, sf)
    return match.without(f.select("flight_date").distinct(), f.where("event_id % 3 = 0 and flight_date < date'2024-01-15'"), ["flight_date"])


@query("SELECT 'AP' || i AS airport_code FROM range(20) AS r(i) WHERE 'AP' || i NOT IN (SELECT airport_code FROM ends WHERE flight_date = DATE '2024-01-10')")
def j8_missing_airports(spark, sf):
    wanted = spark.range(20).select(F.concat(F.lit("AP"), F.col("id").cast("string")).alias("airport_code"))
    return match.without(wanted, traffic.airports_seen(A.flights(spark, sf).where("flight_date = date'2024-01-10'")), ["airport_code"])


@query("SELECT event_id FROM flights f WHERE NOT EXISTS (SELECT 1 FROM schedules s WHERE s.callsign = f.callsign AND s.flight_date = f.flight_date)")
def j9_unscheduled(spark, sf):
    return match.without(A.flights(spark, sf), A.schedules(spark, sf), ["callsign", "flight_date"]).select("event_id")


@query("SELECT DISTINCT airport_code, flight_date FROM ends EXCEPT SELECT airport_code, flight_date FROM daily WHERE arrivals_count = 0 OR departures_count = 0")
def j10_not_empty(spark, sf):
    daily = _daily(spark, sf)
    return match.without(daily.select("airport_code", "flight_date"), daily.where("arrivals_count = 0 or departures_count = 0"), ["airport_code", "flight_date"])


@query("SELECT DISTINCT airport_code, flight_date FROM ends EXCEPT SELECT airport_code, flight_date FROM weather WHERE flight_date <> DATE '2024-01-10'")
def j11_no_weather(spark, sf):
    return match.without(_daily(spark, sf).select("airport_code", "flight_date"), A.weather(spark, sf).where("flight_date <> date'2024-01-10'"), ["airport_code", "flight_date"])


@query("SELECT event_id, 'LEMD' AS icao, 40.4719 AS latitude FROM flights WHERE est_departure_airport = 'AP1' UNION ALL SELECT event_id, 'LEBL', 41.2971 FROM flights WHERE est_departure_airport = 'AP2'")
def j12_coordinates(spark, sf):
    f = A.flights(spark, sf).withColumn("icao", F.when(F.col("est_departure_airport") == "AP1", "LEMD").when(F.col("est_departure_airport") == "AP2", "LEBL").otherwise("XXXX"))
    known = airports(spark).where("latitude is not null").select("icao", "latitude")
    return f.join(known, "icao").select("event_id", "icao", F.col("latitude").cast("decimal(6,4)").alias("latitude"))


@query("SELECT event_id, 'LEMD' AS icao FROM flights WHERE est_departure_airport = 'AP1' UNION ALL SELECT event_id, 'LEBL' FROM flights WHERE est_departure_airport = 'AP2'")
def f10_country(spark, sf):
    code = F.when(F.col("est_departure_airport") == "AP1", "LEMD").when(F.col("est_departure_airport") == "AP2", "LEBL").when(F.col("est_departure_airport") == "AP3", "LPPT")
    home = airports(spark).where("country = 'España'").select("icao")
    return A.flights(spark, sf).select("event_id", code.alias("icao")).join(home, "icao").select("event_id", "icao")


@query("""SELECT event_id, first_seen, last_seen, flight_date FROM flights WHERE event_id % 5 <> 0""")
def p10_p11_documents(spark, sf):
    """Flights to documents and back; those without an end of time are dropped."""
    f = A.flights(spark, sf).withColumn("last_seen", F.when(F.col("event_id") % 5 != 0, F.col("last_seen")))
    out = documents_to_flights(flight_documents(f.withColumn("flight_date", F.lit(None).cast("date"))))
    return _naive(out.select("event_id", "first_seen", "last_seen", "flight_date"), "first_seen", "last_seen")


@query("""SELECT callsign, flight_date, source, seq FROM schedules WHERE source = 'v0' UNION ALL
 SELECT callsign, flight_date, source, seq FROM schedules s WHERE source = 'v1' AND NOT EXISTS (SELECT 1 FROM schedules o WHERE o.source = 'v0' AND o.callsign = s.callsign AND o.flight_date = s.flight_date)""")
def j13_vendor_fallback(spark, sf):
    s = A.schedules(spark, sf).select("callsign", "flight_date", "source", "seq")
    return match.prefer(s.where("source = 'v0'"), s.where("source = 'v1'"), ["callsign", "flight_date"])


# --- aggregates --------------------------------------------------------------------------


@query("SELECT * FROM daily")
def a1_daily_traffic(spark, sf):
    return _daily(spark, sf)


@query("SELECT * FROM routes")
def a2_route_density(spark, sf):
    return traffic.route_density(A.flights(spark, sf))


@query("SELECT * FROM hourly")
def a3_hourly_distribution(spark, sf):
    return traffic.hourly_distribution(A.flights(spark, sf))


@query("SELECT airport_code, min(flight_date) AS start_date, max(flight_date) AS end_date FROM ends WHERE airport_code IN ('AP1', 'AP2', 'AP11') GROUP BY 1")
def a5_airport_date_ranges(spark, sf):
    coords = spark.createDataFrame([("AP1",), ("AP2",), ("AP11",), ("AP99",)], "icao string")
    return traffic.airport_date_ranges(A.flights(spark, sf), coords)


@query("SELECT DISTINCT airport_code FROM ends WHERE flight_date = DATE '2024-01-03'")
def a7_airports_of_day(spark, sf):
    return traffic.airports_seen(A.flights(spark, sf).where("flight_date = date'2024-01-03'"))


@query("SELECT event_id, icao24 FROM flights QUALIFY row_number() OVER (PARTITION BY icao24, first_seen, callsign ORDER BY event_id) = 1")
def a8_dedup_first(spark, sf):
    f = A.flights(spark, sf)
    seen_twice = f.unionByName(f.withColumn("event_id", F.col("event_id") + 10_000_000))
    return upsert.unique_flights(seen_twice, "event_id").select("event_id", "icao24")


@query("SELECT count(DISTINCT est_departure_airport || '>' || est_arrival_airport) AS n_routes, count(DISTINCT substr(callsign, 1, 3)) AS n_airlines FROM flights")
def a9_distinct_counts(spark, sf):
    return A.flights(spark, sf).agg(F.countDistinct("est_departure_airport", "est_arrival_airport").alias("n_routes"), F.countDistinct(airline(F.col("callsign"))).alias("n_airlines"))


@query("SELECT count(*) AS total, count(s.seq) AS found, count(*) - count(s.seq) AS missing, sum(CASE WHEN s.tier = 1 THEN 1 ELSE 0 END)::BIGINT AS exact FROM flights LEFT JOIN matched s USING (event_id)")
def a10_run_stats(spark, sf):
    f = j1_schedule_match(spark, sf)
    return f.agg(F.count(F.lit(1)).alias("total"), F.count("schedule_seq").alias("found"), F.count_if(F.col("schedule_seq").isNull()).alias("missing"), F.count_if(F.col("tier") == 1).alias("exact"))


@query("SELECT airport_code, flight_date, string_agg(hour::VARCHAR, ',' ORDER BY hour) AS hours FROM weather GROUP BY ALL")
def a11_grouped_weather(spark, sf):
    hours = match.weather_hours(A.weather(spark, sf))
    return hours.groupBy("airport_code", "flight_date").agg(F.array_join(F.array_sort(F.collect_list("hour")).cast("array<string>"), ",").alias("hours"))


@query("SELECT min(flight_date) AS first_day, max(flight_date) AS last_day FROM flights")
def a12_first_last(spark, sf):
    return A.flights(spark, sf).agg(F.min("flight_date").alias("first_day"), F.max("flight_date").alias("last_day"))


@query("SELECT d::DATE AS flight_date, count(event_id) AS n_rows FROM range(DATE '2023-12-25', DATE '2024-01-11', INTERVAL 1 DAY) AS r(d) LEFT JOIN flights ON flight_date = d::DATE GROUP BY 1 HAVING count(event_id) < 330")
def a13_incomplete_days(spark, sf):
    return traffic.incomplete_days(A.flights(spark, sf), F.to_date(F.lit("2023-12-25")), F.to_date(F.lit("2024-01-10")), 330)


# --- order, limit, samples ---------------------------------------------------------------


@query("SELECT *, arrivals_count + departures_count AS total_count FROM daily ORDER BY flight_date DESC, total_count DESC, airport_code LIMIT 20")
def l1_top_days(spark, sf):
    return traffic.top_days(_daily(spark, sf))


@query("SELECT *, arrivals_count + departures_count AS total_count FROM daily WHERE airport_code = 'AP4' ORDER BY flight_date DESC LIMIT 5")
def l1_top_days_of_airport(spark, sf):
    return traffic.top_days(_daily(spark, sf), "AP4", 5)


@query("SELECT * FROM routes ORDER BY flight_count DESC, departure_airport, arrival_airport LIMIT 20")
def l2_top_routes(spark, sf):
    return traffic.top_routes(traffic.route_density(A.flights(spark, sf)))


@query(""", r AS (SELECT *, est_departure_airport || '→' || est_arrival_airport || '|' || substr(callsign, 1, 3) || '|' || lpad((hour(first_seen) // 6 * 6)::VARCHAR, 2, '0') || '-' || lpad((hour(first_seen) // 6 * 6 + 6)::VARCHAR, 2, '0') AS stratum FROM flights),
 n AS (SELECT stratum, count(*) AS n, CASE WHEN count(*) >= 10 THEN 2 ELSE 1 END AS take FROM r GROUP BY 1),
 q AS (SELECT stratum, least(take, 400 - coalesce(sum(take) OVER (ORDER BY n DESC, stratum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS take FROM n)
 SELECT event_id, stratum FROM r JOIN q USING (stratum) QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY event_id) <= take""")
def l3_stratified_sample(spark, sf):
    return sampling.stratified(A.flights(spark, sf), "event_id").select("event_id", "stratum")


@query("SELECT airport_code, least(count(*), 50) AS n, least(count(*), 50) AS n_known FROM ends WHERE dep = 1 GROUP BY 1")
def l4_sample_per_airport(spark, sf):
    """n rows, of which n_known are different flights from that airport."""
    f = A.flights(spark, sf)
    some = sampling.at_most(f, ["est_departure_airport"], 50, 7, "event_id").select(F.col("est_departure_airport").alias("airport_code"), "event_id")
    known = some.join(f.select(F.col("event_id").alias("id"), F.col("est_departure_airport").alias("at")), (F.col("event_id") == F.col("id")) & (F.col("airport_code") == F.col("at")), "left")
    return known.groupBy("airport_code").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_known"))


@query("SELECT event_id FROM flights ORDER BY event_id LIMIT 25")
def l6_head(spark, sf):
    return A.flights(spark, sf).select("event_id").orderBy("event_id").limit(25)


# --- sets --------------------------------------------------------------------------------


@query("SELECT airport_code, sum(dep) AS d FROM ends GROUP BY 1")
def u1_union_all(spark, sf):
    f = A.flights(spark, sf)
    arr, dep = f.select(F.col("est_arrival_airport").alias("airport_code"), F.lit(0).alias("d")), f.select(F.col("est_departure_airport").alias("airport_code"), F.lit(1).alias("d"))
    return arr.unionByName(dep).groupBy("airport_code").agg(F.sum("d").alias("d"))


@query("SELECT DISTINCT flight_date FROM flights WHERE flight_date <> DATE '2024-01-10'")
def u3_except(spark, sf):
    days = A.flights(spark, sf).select("flight_date").distinct()
    return days.exceptAll(days.where("flight_date = date'2024-01-10'"))


@query("SELECT flight_date, string_agg(DISTINCT airport_code, ',' ORDER BY airport_code) AS airports FROM ends GROUP BY 1")
def u4_set_add(spark, sf):
    f = A.flights(spark, sf)
    stored = f.select("flight_date", F.col("est_departure_airport").alias("a")).distinct()
    new = f.select("flight_date", F.col("est_arrival_airport").alias("a")).distinct()
    return stored.unionByName(new).groupBy("flight_date").agg(F.array_join(F.array_sort(F.collect_set("a")), ",").alias("airports"))


# --- functions ---------------------------------------------------------------------------


@query("""SELECT event_id, epoch(first_seen)::BIGINT AS seconds, hour(first_seen)::INT AS hour, isodow(flight_date)::INT AS day_of_week, month(flight_date)::INT AS month,
 round(date_diff('second', first_seen, last_seen) / 60.0, 1) AS airborne_minutes, strftime(first_seen, '%Y-%m-%d') AS day FROM flights""")
def c1_c5_times(spark, sf):
    t = F.col("first_seen")
    return A.flights(spark, sf).select(
        "event_id", F.unix_seconds(t).alias("seconds"), F.hour(t).alias("hour"), iso_weekday(F.col("flight_date")).alias("day_of_week"), F.month("flight_date").alias("month"),
        minutes(t, F.col("last_seen")).alias("airborne_minutes"), F.date_format(t, "yyyy-MM-dd").alias("day"),
    )


@query("SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 1 THEN first_seen - INTERVAL 2 HOUR ELSE date_trunc('minute', first_seen) + CASE WHEN event_id % 4 = 1 THEN INTERVAL 0 SECOND ELSE INTERVAL 0 SECOND END END AS t FROM flights")
def c6_iso_times(spark, sf):
    e, t = F.col("event_id"), F.col("first_seen")
    text = F.when(e % 4 == 0, F.date_format(t, "yyyy-MM-dd HH:mm")).when(e % 4 == 1, F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).when(
        e % 4 == 2, F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm"), F.lit("Z"))).otherwise("soon")
    return _naive(A.flights(spark, sf).select("event_id", iso_time(text).alias("t")), "t")


@query("SELECT event_id, round(date_diff('day', first_flight_date, flight_date) / 365.25, 1) AS age FROM flights f JOIN aircraft a ON f.icao24 = a.icao24")
def c7_age(spark, sf):
    return A.flights(spark, sf).join(A.aircraft(spark, sf), "icao24").select("event_id", years(real_date(F.col("first_flight_date")), F.col("flight_date")).alias("age"))


@query("SELECT d::DATE AS flight_date FROM range(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) AS r(d)")
def c9_day_range(spark, sf):
    lo, hi = F.to_date(F.lit("2024-01-01")), F.to_date(F.lit("2024-01-30"))
    return spark.range(1).select(F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))).alias("flight_date"))


@query("SELECT c_custkey, c_name AS unquoted, substr(c_name, 1, 10) AS clipped, NULL::VARCHAR AS nothing, substr(c_mktsegment, 1, 3) AS prefix, upper(c_name) AS up FROM customer")
def c12_c14_strings(spark, sf):
    name = F.col("c_name")
    return A.table(spark, sf, "customer").select(
        "c_custkey", unquote(F.concat(F.lit("  '\""), name, F.lit("\"' "))).alias("unquoted"), clip(F.concat(F.lit(" "), name), 10).alias("clipped"),
        clip(F.lit("   "), 5).alias("nothing"), airline(F.col("c_mktsegment")).alias("prefix"), F.upper(name).alias("up"),
    )


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'arrival' WHEN 1 THEN 'departure' WHEN 2 THEN 'arrival' ELSE 'departure' END AS e FROM flights")
def c16_endpoint(spark, sf):
    e = F.col("event_id") % 4
    text = F.when(e == 0, "/flights/arrivals").when(e == 1, "/flights/departure").when(e == 2, "arrival").otherwise("departures")
    return A.flights(spark, sf).select("event_id", endpoint(text).alias("e"))


@query("SELECT event_id, est_departure_airport AS airport, user FROM (SELECT *, substr(callsign, 4) AS user FROM flights)")
def c17_json_round_trip(spark, sf):
    body = F.to_json(F.struct("est_departure_airport", F.substring("callsign", 4, 20).alias("user")))
    back = F.from_json(body, "struct<est_departure_airport:string,user:string>")
    return A.flights(spark, sf).select("event_id", back["est_departure_airport"].alias("airport"), back["user"].alias("user"))


@query("SELECT airport_code, least(min(nullif(arrivals_count, 0)), min(nullif(departures_count, 0))) AS lo, greatest(max(arrivals_count), max(departures_count)) AS hi, coalesce(nullif(airport_code, 'AP0'), 'none') AS name FROM daily GROUP BY 1")
def c18_c20_defaults(spark, sf):
    z = lambda c: F.nullif(F.col(c), F.lit(0))
    return _daily(spark, sf).groupBy("airport_code").agg(
        F.least(F.min(z("arrivals_count")), F.min(z("departures_count"))).alias("lo"), F.greatest(F.max("arrivals_count"), F.max("departures_count")).alias("hi")
    ).withColumn("name", F.coalesce(F.nullif(F.col("airport_code"), F.lit("AP0")), F.lit("none")))


@query("SELECT o_orderkey, round(2 * 6371.0088 * asin(sqrt(pow(sin(radians(o_orderkey % 60 - 40.0) / 2), 2) + cos(radians(40.0)) * cos(radians(o_orderkey % 60)) * pow(sin(radians(o_orderkey % 50 + 3.5) / 2), 2))), 3) AS km FROM orders")
def c24_distance(spark, sf):
    k = F.col("o_orderkey")
    return A.table(spark, sf, "orders").select("o_orderkey", F.round(distance_km(F.lit(40.0), F.lit(-3.5), (k % 60).cast("double"), (k % 50).cast("double")), 3).alias("km"))


@query(""", d AS (SELECT f.event_id, icao24, flight_date, first_seen, round(date_diff('second', m.arrival_scheduled, f.last_seen) / 60.0, 1) AS delay FROM flights f LEFT JOIN matched m USING (event_id))
 SELECT event_id, lag(delay) OVER (PARTITION BY icao24, flight_date ORDER BY first_seen, event_id) AS previous_delay FROM d""")
def c24_previous_delay(spark, sf):
    f = A.flights(spark, sf).select("event_id", "icao24", "flight_date", "first_seen").join(j1_schedule_match(spark, sf).select("event_id", "delay_minutes"), "event_id")
    from pyspark.sql import Window

    w = Window.partitionBy("icao24", "flight_date").orderBy("first_seen", "event_id")
    return f.select("event_id", F.lag("delay_minutes").over(w).alias("previous_delay"))


@query("SELECT event_id, flight_date IN (DATE '2024-01-01', DATE '2024-01-06') AS holiday, isodow(flight_date) = 5 AND flight_date + 1 IN (DATE '2024-01-01', DATE '2024-01-06') OR isodow(flight_date) = 1 AND flight_date - 1 IN (DATE '2024-01-01', DATE '2024-01-06') AS bridge FROM flights")
def c24_holidays(spark, sf):
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-06",)], "d string").select(F.to_date("d").alias("d"))
    f = A.flights(spark, sf).select("event_id", "flight_date")
    near = days.select(F.col("d").alias("h"), F.explode(F.array(F.struct("d", F.lit(0).alias("k")), F.struct(F.date_sub("d", 1).alias("d"), F.lit(1).alias("k")), F.struct(F.date_add("d", 1).alias("d"), F.lit(2).alias("k")))).alias("x"))
    flags = near.groupBy("x.d").agg(F.max((F.col("x.k") == 0)).alias("holiday"), F.max((F.col("x.k") == 1) & (F.weekday("x.d") == 4) | (F.col("x.k") == 2) & (F.weekday("x.d") == 0)).alias("bridge"))
    return f.join(flags, F.col("flight_date") == F.col("d"), "left").select("event_id", F.coalesce("holiday", F.lit(False)).alias("holiday"), F.coalesce("bridge", F.lit(False)).alias("bridge"))


# --- upserts -----------------------------------------------------------------------------


@query("SELECT l_orderkey, arg_max(l_quantity, l_linenumber) AS q FROM lineitem GROUP BY 1")
def k9_latest_wins(spark, sf):
    # arg_max skips NULLs and takes the first row in the table where line numbers are equal; a key without values stays, with NULL
    rows = A.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_quantity").alias("q"), F.col("l_linenumber").alias("seq"), "_metadata.file_path", "_metadata.row_index")
    keys = rows.select("l_orderkey").distinct().withColumn("q", F.lit(None).cast(rows.schema["q"].dataType))
    return upsert.latest_wins(keys, rows.where("q is not null and seq is not null"), ["l_orderkey"], "seq", "file_path", "row_index")


@query("SELECT * FROM daily")
def k10_add_up(spark, sf):
    f = A.flights(spark, sf)
    old, new = (traffic.daily_traffic(f.where(f"event_id % 2 = {i}")) for i in (0, 1))
    return upsert.add_up(old, new, ["airport_code", "flight_date"], ["arrivals_count", "departures_count"])


@query("SELECT * FROM routes")
def k11_add_up_routes(spark, sf):
    f = A.flights(spark, sf)
    old, new = (traffic.route_density(f.where(f"event_id % 2 = {i}")) for i in (0, 1))
    return upsert.add_up(old, new, ["departure_airport", "arrival_airport"], ["flight_count"], ["first_seen"], ["last_seen"])


@query("""SELECT event_id, icao24, flight_date FROM flights WHERE event_id % 5 = 0 UNION ALL SELECT event_id, icao24, flight_date FROM flights f
 WHERE event_id % 5 <> 0 AND NOT EXISTS (SELECT 1 FROM flights s WHERE s.event_id % 5 = 0 AND s.icao24 = f.icao24 AND s.flight_date = f.flight_date)
 QUALIFY row_number() OVER (PARTITION BY icao24, flight_date ORDER BY event_id) = 1""")
def k12_k15_insert_new(spark, sf):
    f = A.flights(spark, sf).select("event_id", "icao24", "flight_date")
    return upsert.insert_new(f.where("event_id % 5 = 0"), f.where("event_id % 5 <> 0"), ["icao24", "flight_date"], "event_id")


@query("SELECT icao24, substr(typecode, 1, 30) AS typecode, first_flight_date FROM aircraft")
def k13_gold_aircraft(spark, sf):
    rows = A.aircraft(spark, sf).withColumn("typecode", F.concat(F.lit("  "), "typecode", F.lit(" ")))
    return upsert.gold_aircraft(rows).select("icao24", "typecode", "first_flight_date")


@query("SELECT airport_code, flight_date, flight_date + to_hours(hour) AS timestamp, temperature_2m FROM weather")
def k14_gold_weather(spark, sf):
    rows = A.weather(spark, sf).withColumn("flight_date", F.col("flight_date").cast("string")).select("airport_code", "timestamp", "flight_date", "temperature_2m")
    out = upsert.gold_weather(rows)
    return _naive(upsert.insert_new(out.where("hour(timestamp) < 12"), out, ["airport_code", "timestamp"], "temperature_2m"), "timestamp")


# --- streaming ---------------------------------------------------------------------------


@query("SELECT * FROM daily")
def w1_w4_streaming_daily(spark, sf):
    return run_daily_traffic(spark, f"{sf}/events.parquet", flights_of, _scratch(spark))


@query("SELECT date_trunc('hour', first_seen) AS hour_start, count(*) AS n FROM flights GROUP BY 1")
def w6_hourly_windows(spark, sf):
    return _naive(hourly_windows(A.flights(spark, sf)), "hour_start")


def _scratch(spark) -> str:
    """A new folder in the one that driver and executors share; a local one where none is named."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return f"{shared.rstrip('/')}/stream-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="stream-")


def flights_of(events: DataFrame) -> DataFrame:
    """Events as flights with what the daily aggregate reads."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.date_trunc("second", "ts").cast("timestamp").alias("first_seen"), F.concat(F.lit("AP"), (F.col("user_id") % 12).cast("string")).alias("est_departure_airport"),
        F.concat(F.lit("AP"), (k % 12).cast("string")).alias("est_arrival_airport"),
    )


# --- the feature table -------------------------------------------------------------------

_FEATURES = """, chosen AS ({chosen}),
 wx AS (SELECT * FROM weather)
 SELECT f.icao24, f.flight_date, f.callsign, est_departure_airport AS departure_airport, est_arrival_airport AS arrival_airport,
  round(date_diff('second', m.arrival_scheduled, f.last_seen) / 60.0, 1) AS delay_minutes, round(date_diff('second', f.first_seen, f.last_seen) / 60.0, 1) AS airborne_minutes,
  hour(f.first_seen)::INT AS departure_hour, isodow(f.flight_date)::INT AS day_of_week, month(f.flight_date)::INT AS month,
  typecode AS aircraft_type, manufacturer AS aircraft_manufacturer, operator AS aircraft_operator, round(date_diff('day', first_flight_date, f.flight_date) / 365.25, 1) AS aircraft_age_years,
  nullif(coalesce(dd.arrivals_count + dd.departures_count, 0) + coalesce(da.arrivals_count + da.departures_count, 0), 0) AS route_daily_traffic, flight_count AS route_total_density,
  hd.arrivals_count + hd.departures_count AS departure_airport_hourly_traffic, ha.arrivals_count + ha.departures_count AS arrival_airport_hourly_traffic,
  wd.temperature_2m AS dep_temperature, wd.precipitation AS dep_precipitation, wd.wind_speed_10m AS dep_wind_speed, wd.visibility AS dep_visibility,
  wa.temperature_2m AS arr_temperature, wa.precipitation AS arr_precipitation, wa.wind_speed_10m AS arr_wind_speed, wa.visibility AS arr_visibility, m.source AS schedule_source
 FROM chosen f LEFT JOIN matched m USING (event_id) LEFT JOIN aircraft ac ON ac.icao24 = f.icao24
 LEFT JOIN routes r ON r.departure_airport = est_departure_airport AND r.arrival_airport = est_arrival_airport
 LEFT JOIN daily dd ON dd.airport_code = est_departure_airport AND dd.flight_date = f.flight_date LEFT JOIN daily da ON da.airport_code = est_arrival_airport AND da.flight_date = f.flight_date
 LEFT JOIN hourly hd ON hd.airport_code = est_departure_airport AND hd.flight_date = f.flight_date AND hd.hour = hour(f.first_seen)
 LEFT JOIN hourly ha ON ha.airport_code = est_arrival_airport AND ha.flight_date = f.flight_date AND ha.hour = hour(f.first_seen)
 LEFT JOIN wx wd ON wd.airport_code = est_departure_airport AND wd.flight_date = f.flight_date LEFT JOIN wx wa ON wa.airport_code = est_arrival_airport AND wa.flight_date = f.flight_date
 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY (coalesce(wd.hour <> hour(f.first_seen), true))::INT, wd.seq, (coalesce(wa.hour <> hour(f.first_seen), true))::INT, wa.seq) = 1"""
_IDENTITY = "icao24, first_seen, callsign, est_departure_airport, est_arrival_airport, last_seen"


@query(_FEATURES.format(chosen="SELECT * FROM flights QUALIFY row_number() OVER (PARTITION BY icao24, flight_date ORDER BY first_seen, last_seen, callsign, est_departure_airport, est_arrival_airport) = 1"))
def feature_store_aircraft_day(spark, sf):
    return feature_store(_tables(spark, sf))


@query(_FEATURES.format(chosen=f"SELECT * FROM flights QUALIFY row_number() OVER (PARTITION BY {_IDENTITY} ORDER BY event_id) = 1"))
def feature_store_flight(spark, sf):
    return feature_store(_tables(spark, sf), "flight")


QUERIES["feature_store"], ORACLE["feature_store"] = QUERIES.pop("feature_store_aircraft_day"), ORACLE.pop("feature_store_aircraft_day")
