"""The test tables as flights, aircraft, schedules and weather, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def flights(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf, "events").select(
        "event_id", F.lpad(F.col("user_id").cast("string"), 6, "0").alias("icao24"),
        F.concat(F.upper(F.substring("event_type", 1, 3)), F.col("user_id").cast("string")).alias("callsign"),
        F.date_trunc("second", "ts").cast("timestamp").alias("first_seen"),
        (F.date_trunc("second", "ts").cast("timestamp") + F.make_dt_interval(secs=F.floor(F.col("value") * 60))).alias("last_seen"),
        F.concat(F.lit("AP"), (F.col("user_id") % 12).cast("string")).alias("est_departure_airport"),
        F.concat(F.lit("AP"), (k % 12).cast("string")).alias("est_arrival_airport"), F.to_date("ts").alias("flight_date"),
    )


def aircraft(spark: SparkSession, sf: str) -> DataFrame:
    first = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("d"))
    return table(spark, sf, "customer").join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("icao24"), F.col("c_mktsegment").alias("typecode"),
        F.concat(F.lit("M"), (F.col("c_nationkey") % 7).cast("string")).alias("manufacturer"), F.col("c_name").alias("operator"),
        F.date_format("d", "yyyy-MM-dd").alias("first_flight_date"),
    )


def schedules(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    return flights(spark, sf).where(e % 3 == 0).select(
        e.alias("seq"), "callsign", "flight_date", F.when(e % 4 < 2, F.col("est_departure_airport")).otherwise("ZZ").alias("departure_airport"),
        F.when(e % 2 == 0, F.col("est_arrival_airport")).otherwise("ZZ").alias("arrival_airport"),
        (F.col("last_seen") - F.make_dt_interval(mins=(e % 40).cast("int"))).alias("arrival_scheduled"), F.concat(F.lit("v"), (e % 2).cast("string")).alias("source"),
    )


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly means; hours divisible by five are missing, so the first of the day stands in."""
    rows = flights(spark, sf).join(table(spark, sf, "events").select("event_id", "value"), "event_id")
    each = rows.groupBy(F.col("est_departure_airport").alias("airport_code"), "flight_date", F.hour("first_seen").alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    ).where("h % 5 <> 0")
    return each.select(
        F.col("h").alias("seq"), "airport_code", "flight_date",
        F.concat(F.col("flight_date").cast("string"), F.lit("T"), F.lpad(F.col("h").cast("string"), 2, "0"), F.lit(":00")).alias("timestamp"),
        F.col("lo").alias("temperature_2m"), F.col("hi").alias("precipitation"), F.col("n").cast("double").alias("wind_speed_10m"), (F.col("lo") + F.col("hi")).alias("visibility"),
    )


#: The same as common table expressions.
WITH = """
WITH flights AS (
  SELECT event_id, lpad(user_id::VARCHAR, 6, '0') AS icao24, upper(substr(event_type, 1, 3)) || user_id::VARCHAR AS callsign,
         date_trunc('second', ts) AS first_seen, date_trunc('second', ts) + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS last_seen,
         'AP' || (user_id % 12)::VARCHAR AS est_departure_airport, 'AP' || (json_extract_string(props, '$.k')::INT % 12)::VARCHAR AS est_arrival_airport,
         CAST(ts AS DATE) AS flight_date, value FROM events),
aircraft AS (
  SELECT lpad(c_custkey::VARCHAR, 6, '0') AS icao24, c_mktsegment AS typecode, 'M' || (c_nationkey % 7)::VARCHAR AS manufacturer, c_name AS operator,
         CAST(d AS DATE) AS first_flight_date FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS d FROM orders GROUP BY 1) ON c_custkey = o_custkey),
schedules AS (
  SELECT event_id AS seq, callsign, flight_date, CASE WHEN event_id % 4 < 2 THEN est_departure_airport ELSE 'ZZ' END AS departure_airport,
         CASE WHEN event_id % 2 = 0 THEN est_arrival_airport ELSE 'ZZ' END AS arrival_airport,
         last_seen - to_minutes(event_id % 40) AS arrival_scheduled, 'v' || (event_id % 2)::VARCHAR AS source FROM flights WHERE event_id % 3 = 0),
weather AS (
  SELECT hour(first_seen) AS seq, est_departure_airport AS airport_code, flight_date, hour(first_seen) AS hour, min(value) AS temperature_2m, max(value) AS precipitation,
         count(*)::DOUBLE AS wind_speed_10m, min(value) + max(value) AS visibility FROM flights WHERE hour(first_seen) % 5 <> 0 GROUP BY est_departure_airport, flight_date, hour(first_seen)),
ends AS (
  SELECT est_arrival_airport AS airport_code, first_seen, flight_date, 1 AS arr, 0 AS dep FROM flights
  UNION ALL SELECT est_departure_airport, first_seen, flight_date, 0, 1 FROM flights),
daily AS (SELECT airport_code, flight_date, sum(arr)::BIGINT AS arrivals_count, sum(dep)::BIGINT AS departures_count FROM ends GROUP BY ALL),
hourly AS (SELECT airport_code, flight_date, hour(first_seen)::INT AS hour, sum(arr)::BIGINT AS arrivals_count, sum(dep)::BIGINT AS departures_count FROM ends GROUP BY ALL),
routes AS (
  SELECT est_departure_airport AS departure_airport, est_arrival_airport AS arrival_airport, count(*) AS flight_count, min(flight_date) AS first_seen, max(flight_date) AS last_seen
  FROM flights GROUP BY ALL),
matched AS (
  SELECT f.event_id, s.* EXCLUDE (callsign, flight_date), CASE WHEN est_departure_airport = departure_airport AND est_arrival_airport = arrival_airport THEN 1
         WHEN est_departure_airport = departure_airport THEN 2 WHEN est_arrival_airport = arrival_airport THEN 3 ELSE 4 END AS tier
  FROM flights f JOIN schedules s ON f.callsign = s.callsign AND f.flight_date = s.flight_date
  QUALIFY row_number() OVER (PARTITION BY f.event_id ORDER BY tier, s.seq) = 1)
"""
