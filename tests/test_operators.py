import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from contrail.operators import match, parse, sampling, traffic, upsert
from contrail.plans.feature_store import Tables, feature_store
from contrail.sources.airports import airports

FLIGHTS = "icao24 string, callsign string, first_seen timestamp, last_seen timestamp, est_departure_airport string, est_arrival_airport string, flight_date date"


def at(h, m=0, d=12, s=0):
    return datetime(2026, 6, d, h, m, s)


def flights(spark, rows):
    return spark.createDataFrame([(i, c, a, b, x, y, a.date() if a else None) for i, c, a, b, x, y in rows], FLIGHTS)


def responses(spark, *bodies):
    return spark.createDataFrame([(b,) for b in bodies], "response string")


def test_flights_from_odd_responses(spark):
    good = json.dumps([{"icao24": "a", "firstSeen": 1781222400, "lastSeen": 1781226000, "callsign": " IB1 ", "estDepartureAirport": None}, {"icao24": None}, {"icao24": "b", "callsign": None}])
    bronze = responses(spark, good, None, "", "oops", "[]", '{"icao24": "c"}', '[{"icao24": 3}]')
    got = {r["icao24"]: r for r in parse.parse_flights(bronze).collect()}
    assert set(got) == {"a", "b", "3"} and got["a"]["callsign"] == "IB1" and got["b"]["callsign"] is None and got["a"]["flight_date"] == date(2026, 6, 12)
    assert tuple(parse.bad_responses(bronze).first()) == (7, 3, 2)


def test_states_by_position(spark):
    row = ["x", " C ", None, 1, 2, 3.5, 4.5, None, True, 1, 2, 3, [7, 8], 9, "7000", None, None]
    got = parse.parse_states(responses(spark, json.dumps({"time": 5, "states": [row, [*row, 4]]}), '{"time": 1, "states": null}')).orderBy("category").collect()
    assert [r["category"] for r in got] == [None, 4]
    assert (got[0]["callsign"], got[0]["origin_country"], got[0]["position_source"], got[0]["spi"], got[0]["on_ground"], got[0]["sensors"], got[0]["longitude"]) == ("C", "", 0, False, True, [7, 8], 3.5)


def test_tracks_and_weather(spark):
    track = {"icao24": "x", "startTime": 100, "endTime": 200.0, "path": [[100, 1.0, 2.0, None, 3, False], [101, 1, 2, 3, 4], [102, 1, 2, 3, 4, True, 9]]}
    assert [r["on_ground"] for r in parse.parse_tracks(responses(spark, json.dumps(track), '{"icao24": "y", "path": []}', '{"icao24": "z"}')).collect()] == [False, True]
    body = json.dumps({"hourly": {"time": ["2026-06-12T00:00", "2026-06-12T01:00"], "temperature_2m": [1.5], "precipitation": [1, 2, 3]}})
    got = parse.parse_weather(spark.createDataFrame([("LEMD", body), ("LEBL", "{}")], "airport_code string, response string")).orderBy("timestamp").collect()
    assert [(r["timestamp"], r["temperature_2m"], r["precipitation"], r["visibility"], r["flight_date"]) for r in got] == [("2026-06-12T00:00", 1.5, 1.0, None, "2026-06-12"), ("2026-06-12T01:00", None, 2.0, None, "2026-06-12")]


def test_traffic_skips_unknown_ends(spark):
    f = flights(spark, [("a", "x", at(1), at(2), "P", "Q"), ("b", "y", at(3), at(4), "", "Q"), ("c", "z", at(23), at(1, d=13), "Q", None)])
    assert sorted(map(tuple, traffic.daily_traffic(f).collect())) == [("P", date(2026, 6, 12), 0, 1), ("Q", date(2026, 6, 12), 2, 1)]
    assert {tuple(r)[2:] for r in traffic.hourly_distribution(f).where("airport_code = 'Q'").collect()} == {(1, 1, 0), (3, 1, 0), (23, 0, 1)}
    assert [tuple(r) for r in traffic.route_density(f).collect()] == [("P", "Q", 1, date(2026, 6, 12), date(2026, 6, 12))]


@pytest.mark.parametrize("partitions", [1, 5])
def test_schedule_tiers(spark, partitions):
    f = flights(spark, [("a", "C1", at(1), at(2), "P", "Q"), ("b", "C2", at(1), at(2), "", ""), ("c", "C3", at(1), at(2), "P", "Q"), ("d", "C4", at(1), at(2), "P", "Q")]).repartition(partitions)
    s = spark.createDataFrame(
        [(1, "C1", "Z", "Z"), (2, "C1", "Z", "Q"), (3, "C1", "P", "Z"), (4, "C1", "P", "Q"), (5, "C1", "P", "Q"), (6, "C2", "", ""), (7, "C2", "P", "Q"), (8, "C3", "Z", "Q"), (9, "C3", "P", None)],
        "seq int, callsign string, departure_airport string, arrival_airport string",
    ).withColumn("flight_date", F.to_date(F.lit("2026-06-12"))).repartition(partitions)
    got = {r["icao24"]: r["schedule"]["seq"] if r["schedule"] else None for r in match.match_schedules(f, s).collect()}
    assert got == {"a": 4, "b": 6, "c": 9, "d": None}


def test_weather_is_exact_or_first(spark):
    f = flights(spark, [("a", "x", at(5), at(6), "P", "Q"), ("b", "x", at(7), at(8), "P", "Q"), ("c", "x", None, None, "P", "Q")]).withColumn("flight_date", F.to_date(F.lit("2026-06-12"))).withColumn("h", F.hour("first_seen"))
    w = spark.createDataFrame([(1, "P", "2026-06-12T03:00", 3.0), (2, "P", "2026-06-12T05:00", 5.0), (3, "P", "2026-06-12T05:30", 9.0), (4, "P", "2026-06-12T00:00", 0.0), (5, "P", "bad", 7.0)], "seq int, airport_code string, timestamp string, temperature_2m double").withColumn("flight_date", F.to_date(F.lit("2026-06-12")))
    out = match.match_weather(f, match.weather_days(match.weather_hours(w)), "est_departure_airport", "h", "w")
    assert {r["icao24"]: r["w"]["temperature_2m"] for r in out.collect()} == {"a": 5.0, "b": 3.0, "c": 0.0}


def test_upserts(spark):
    stored = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(1, "b", 1), (2, "c", 2), (2, "d", 1), (None, "e", 1), (None, "e", 1)], "k int, v string, seq int")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(upsert.insert_new(stored, new, ["k"], "seq")) == sorted([(1, "a"), (2, "d"), (None, "n"), (None, "e"), (None, "e")], key=str)
    assert rows(upsert.latest_wins(stored, new.where("k is not null"), ["k"])) == sorted([(1, "b"), (2, "c"), (None, "n")], key=str)


def test_incremental_sums_equal_a_recount(spark):
    f = flights(spark, [(str(i), f"C{i}", at(i % 24, d=12 + i % 3), at(i % 24, 59, d=12 + i % 3), f"A{i % 4}", f"A{i % 3}") for i in range(200)])
    one, two = traffic.daily_traffic(f.where("icao24 < '5'")), traffic.daily_traffic(f.where("icao24 >= '5'"))
    both = upsert.add_up(one, two, ["airport_code", "flight_date"], ["arrivals_count", "departures_count"])
    assert sorted(both.collect()) == sorted(traffic.daily_traffic(f).collect())


def test_stratified_sample_stops_at_the_target(spark):
    f = flights(spark, [(f"{i:03d}", f"AB{i % 5}9", at(i % 24), at(i % 24, 30), f"A{i % 4}", "B") for i in range(300)])
    got = sampling.stratified(f, "icao24", target=21, crowd=10).collect()
    assert len(got) == 21 and len({r["stratum"] for r in got}) >= 11
    assert sampling.stratified(f, "icao24").count() <= 300 and sampling.at_most(f, ["est_departure_airport"], 3, 1, "icao24").count() == 12


def test_feature_grains_and_nulls(spark):
    f = flights(spark, [("AB", "C1", at(8), at(9, 2, s=33), "P", ""), ("AB", "C0", at(7), at(8), "P", "Q"), ("cd", None, at(7), at(8), "P", "Q"), ("ef", "", at(7), at(8), "P", "Q")])
    none = "seq int, callsign string, flight_date date, departure_airport string, arrival_airport string, arrival_scheduled timestamp, source string"
    t = Tables(
        f, spark.createDataFrame([(1, "C0", date(2026, 6, 12), "P", "Q", at(7, 50), "v")], none),
        spark.createDataFrame([("ab", "", "M", "O", "2016-06-12"), ("cd", "T", "M", "O", "bad")], "icao24 string, typecode string, manufacturer string, operator string, first_flight_date string"),
        spark.createDataFrame([], "seq int, airport_code string, flight_date date, timestamp string, temperature_2m double, precipitation double, wind_speed_10m double, visibility double"),
        traffic.daily_traffic(f.limit(0)), traffic.hourly_distribution(f.limit(0)), traffic.route_density(f.limit(0)),
    )
    day = feature_store(t).collect()
    assert len(day) == 1 and (day[0]["callsign"], day[0]["delay_minutes"], day[0]["aircraft_type"], day[0]["aircraft_age_years"], day[0]["route_daily_traffic"], day[0]["schedule_source"]) == ("C0", 10.0, None, 10.0, None, "v")
    every = {r["callsign"]: r for r in feature_store(t, "flight").collect()}
    assert set(every) == {"C0", "C1"} and every["C1"]["arrival_airport"] is None and every["C1"]["delay_minutes"] is None and every["C1"]["airborne_minutes"] == 62.6
    with pytest.raises(ValueError):
        feature_store(t, "month")


def test_airports(spark):
    a = airports(spark)
    assert a.count() == len({r["icao"] for r in a.collect()}) and a.where("name is not null").count() == 62 and a.where("name is not null and latitude is null").count() == 0
