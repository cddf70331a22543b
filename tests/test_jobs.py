import json

from contrail.catalog import Lake
from contrail.plans import jobs
from contrail.plans.feature_store import feature_store  # noqa: F401
from contrail.sources.files import read_aircraft, read_flight_files, read_responses
from contrail.streaming.jobs import fresh_flights, merge_batch, merged


def write_files(root, days):
    for day, begin in days.items():
        (root / day).mkdir(parents=True, exist_ok=True)
        for airport in ("LEMD", "LEBL"):
            for k, end in enumerate(("arrivals", "departures")):
                rows = [{"icao24": f"a{i % 5}", "firstSeen": begin + 600 * i + k, "lastSeen": begin + 600 * i + 3600, "estDepartureAirport": airport if k else "LEAL", "estArrivalAirport": "LEAL" if k else airport, "callsign": f"IB{i}"} for i in range(30)]
                (root / day / f"{airport}_{end}.json").write_text(json.dumps(rows, indent=1))
    (root / "2026-06-12" / "notes.json").write_text("[]")


def test_lake_from_files_to_features(spark, tmp_path):
    days = {"2026-06-12": 1781222400, "2026-06-13": 1781308800}
    write_files(tmp_path / "raw", days)
    assert read_flight_files(spark, str(tmp_path / "raw")).count() == 240
    lake = Lake(spark, str(tmp_path / "lake"))
    bronze = read_responses(spark, str(tmp_path / "raw"))
    assert bronze.count() == 8
    lake.append("bronze/flights", bronze.where("ingestion_date = '2026-06-12'"))
    n = jobs.bronze_to_silver(lake)
    assert n == jobs.bronze_to_silver(lake) + n  # nothing is pending the second time
    lake.append("bronze/flights", bronze.where("ingestion_date = '2026-06-13'"))
    assert jobs.bronze_to_silver(lake) == n == 60  # an icao24, time and callsign counts once
    for _ in range(2):
        jobs.silver_to_gold(lake)
    assert lake.read("gold/daily_airport_traffic").agg({"arrivals_count": "sum"}).first()[0] == 120
    jobs.build_features(lake, "flight")
    assert lake.read("gold/feature_store").count() == 120
    jobs.build_features(lake)
    assert lake.read("gold/feature_store").count() == 10
    airports = spark.createDataFrame([("LEMD",), ("LEVC",)], "airport_code string")
    wanted = jobs.pending_calls(lake, airports, bronze.selectExpr("ingestion_date as flight_date").distinct())
    assert wanted.count() == 4
    jobs.remember_empty(lake, wanted.where("endpoint = 'arrival'"))
    assert {r["endpoint"] for r in jobs.pending_calls(lake, airports, bronze.selectExpr("ingestion_date as flight_date").distinct()).collect()} == {"departure"}


def test_feeds_of_all_kinds_reach_the_features(spark, tmp_path):
    from contrail.sources.vendors import envelopes

    write_files(tmp_path / "raw", {"2026-06-12": 1781222400})
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.append("bronze/flights", read_responses(spark, str(tmp_path / "raw")))
    one = {"data": [{"flight": {"icao": "IB0"}, "flight_date": "2026-06-12", "arrival": {"icao": "LEMD", "scheduled": "2026-06-12T00:50:00+00:00"}, "departure": {"icao": "LEAL"}}]}
    two = {"flights": [{"callSign": "IB1", "arrival": {"airport": {"icao": "LEMD"}, "scheduledTime": {"local": "2026-06-12 00:55"}}, "departure": {"airport": {"icao": "LEAL"}}}]}
    lake.append("bronze/schedules_one", envelopes(spark, [("one", "flights", {}, one), ("one", "flights", {}, {"data": []})]))
    lake.append("bronze/schedules_two", envelopes(spark, [("two", "flights", {"flight_date": "2026-06-12"}, two)]))
    hourly = {"time": [f"2026-06-12T{h:02}:00" for h in range(24)], "temperature_2m": [float(h) for h in range(24)]}
    lake.append("bronze/weather", envelopes(spark, [("w", "archive", {"airport": a}, {"hourly": hourly}) for a in ("LEAL", "LEMD", "LEBL")]))
    lake.append("bronze/states", envelopes(spark, [("s", "states", {}, {"time": 1781222400, "states": [["a1", "IB1 ", "Spain", 1781222400, 1781222400, -3.0, 40.0] + [None] * 10]})] * 2))
    lake.append("bronze/tracks", envelopes(spark, [("s", "tracks", {}, {"icao24": "a1", "startTime": 1781222400, "endTime": 1781222500, "path": [[1781222400, 40.0, -3.0, 100.0, 90.0, False]]})] * 2))
    (tmp_path / "a.csv").write_text("icao24,manufacturername,typecode,operator,firstflightdate\nA0,M,T0,O,2016-06-12\nA1,M,T1,O,\n")
    assert jobs.main([lake.root, "--aircraft", str(tmp_path / "a.csv")]) == 0
    rows = {r["icao24"]: r for r in lake.read("gold/feature_store").collect()}
    assert len(rows) == 5 and (rows["a0"]["delay_minutes"], rows["a0"]["schedule_source"]) == (10.0, "one")
    assert (rows["a1"]["delay_minutes"], rows["a1"]["schedule_source"]) == (15.0, "two")
    assert rows["a0"]["aircraft_type"] == "T0" and rows["a0"]["aircraft_age_years"] == 10.0
    assert all(r["dep_temperature"] == r["departure_hour"] for r in rows.values())
    assert lake.read("silver/state_vectors").count() == lake.read("silver/track_waypoints").count() == 1
    assert lake.read("gold/weather").count() == 72


def test_a_reader_outlives_one_replacement(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    name = "gold/route_density"
    for n in range(4):
        lake.replace(name, spark.range(n).withColumnRenamed("id", "flight_count"))
        before, held = lake.read(name) if n == 2 else None, before if n == 3 else None
    assert held.count() == 2 and lake.read(name).count() == 3
    assert len(list((tmp_path / name).iterdir())) == 2


def test_aircraft_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("'icao24','ManufacturerName','typecode'\n'ABC','A \"é\" B',\"'X'\"\n'','none',''\n".encode("latin-1"))
    rows = read_aircraft(spark, str(tmp_path / "a.csv")).collect()
    assert [(r["icao24"], r["typecode"], r["registration"]) for r in rows] == [("abc", "X", "")] and "é" in rows[0]["manufacturer"]


def test_stream_batches_may_run_twice(spark, tmp_path):
    schema = "first_seen timestamp, est_departure_airport string, est_arrival_airport string"
    one = spark.createDataFrame([("P", "Q")] * 3, "d string, a string").selectExpr("timestamp'2026-06-12 10:00:00' as first_seen", "d as est_departure_airport", "a as est_arrival_airport")
    write = merge_batch(str(tmp_path / "t"))
    write(one, 0)
    write(one, 0)
    write(one.limit(1), 1)
    assert {(r["airport_code"], r["arrivals_count"], r["departures_count"]) for r in merged(spark, str(tmp_path / "t")).collect()} == {("P", 0, 4), ("Q", 4, 0)}
    assert schema.count(",") == 2


def test_stream_drops_flights_seen_before(spark, tmp_path):
    rows = spark.createDataFrame([("a", "C"), ("a", "C"), ("b", "C")], "icao24 string, callsign string").selectExpr("icao24", "callsign", "timestamp'2026-06-12 10:00:00' as first_seen")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    job = fresh_flights(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    job.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
