import json
from datetime import date

from contrail.catalog import Lake
from contrail.operators.traffic import route_density
from contrail.plans import ingest, jobs
from contrail.sources import http as H
from contrail.sources.files import read_samples

DAY = 1781222400  # 2026-06-12


def feed(name, down=()):
    """A feed with a flight at each airport, none at LEZZ; calls of airports in ``down`` fail."""

    class Feed(H.FlightFeed):
        @classmethod
        def name(cls):
            return name

        @staticmethod
        def transport(url, headers, params, timeout):
            if params["airport"] in down or headers.get("Authorization") == "Bearer spent":
                return H.Response(429 if headers else 404)
            begin, airport = int(params["begin"]), params["airport"]
            if airport == "LEZZ":
                return H.Response(200, "[]")
            a, b = (airport, "LEAL") if url.endswith("departure") else ("LEAL", airport)
            return H.Response(200, json.dumps([{"icao24": airport[-2:].lower(), "firstSeen": begin + 60, "lastSeen": begin + 3660, "estDepartureAirport": a, "estArrivalAirport": b, "callsign": "IB" + url[-3:]}]))

    return Feed


def airports(spark, *codes):
    return spark.createDataFrame([(c,) for c in codes], "airport_code string")


def test_calls_are_made_once_and_failed_ones_again(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    some, days = airports(spark, "LEMD", "LEBL", "LEZZ"), ingest.days_between(lake, date(2026, 6, 12), date(2026, 6, 13))
    options = {"base": "http://x", "tokens": "spent,good"}
    assert ingest.ingest_flights(lake, some, days, options, feed("one", ("LEBL",)), dry_run=True) == {"calls": 12, "loaded": 0, "empty": 0, "failed": 0}
    assert ingest.ingest_flights(lake, some, days, options, feed("one", ("LEBL",))) == {"calls": 12, "loaded": 4, "empty": 4, "failed": 4}
    assert lake.partitions("bronze/flights") == ["2026-06-12", "2026-06-13"]
    assert jobs.bronze_to_silver(lake) == 4 and jobs.silver_to_gold(lake) == 2 and jobs.silver_to_gold(lake) == 0
    # the days are done, yet what fills their gaps is parsed
    assert ingest.fill_gaps(lake, some, date(2026, 6, 16), options, first=3, last=4, source=feed("two")) == {"calls": 4, "loaded": 4, "empty": 0, "failed": 0}
    assert jobs.bronze_to_silver(lake) == 4 and jobs.silver_to_gold(lake) == 2
    silver = lake.read("silver/flights")
    assert sorted(map(tuple, lake.read("gold/route_density").collect())) == sorted(map(tuple, route_density(silver).collect()))
    assert lake.read("gold/daily_airport_traffic").agg({"arrivals_count": "sum"}).first()[0] == 8 == lake.read("gold/flights").count() * 2
    assert ingest.backfill(lake, airports(spark, "LEMD"), date(2026, 6, 12), date(2026, 6, 14), options, least=4, source=feed("three"))["calls"] == 2
    assert "gold_flights" in lake.register() and spark.sql("select count(*) from gold_flights").first()[0] == 4


def test_only_changed_days_are_read(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = spark.sql("""select 'a' || id as icao24, 'C' as callsign, timestamp'2026-06-12 10:00:00' + make_dt_interval(id % 3) as first_seen,
        timestamp'2026-06-12 11:00:00' as last_seen, 'P' as est_departure_airport, 'Q' as est_arrival_airport, date'2026-06-12' + cast(id % 3 as int) as flight_date from range(9)""")
    lake.append("silver/flights", rows)
    assert jobs.silver_to_gold(lake) == 3
    lake.append("silver/flights", rows.where("icao24 = 'a1'").selectExpr("'z' as icao24", *rows.columns[1:]))
    assert [str(r["flight_date"]) for r in jobs.changed_days(lake).collect()] == ["2026-06-13"]
    assert jobs.silver_to_gold(lake) == 1
    assert {(str(r["flight_date"]), r["arrivals_count"]) for r in lake.read("gold/daily_airport_traffic").where("airport_code = 'Q'").collect()} == {("2026-06-12", 3), ("2026-06-13", 4), ("2026-06-14", 3)}
    assert tuple(lake.read("gold/route_density").first()) == ("P", "Q", 10, date(2026, 6, 12), date(2026, 6, 14)) and lake.read("gold/flights").count() == 10


def test_schedules_and_weather_are_collected(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    samples = spark.createDataFrame([("IB0", "2026-06-12"), ("IB0", "2026-06-12"), ("IB1", "2026-06-12"), ("IB2", "2026-06-12"), ("", "2026-06-12"), ("IB3", None)], "callsign string, flight_date string")
    one = lambda c, d: {"data": [{"flight": {"icao": c}, "flight_date": d, "arrival": {"icao": "LEMD"}}]} if c == "IB0" else {"data": []}
    two = lambda c, d: [{"callSign": c, "arrival": {"airport": {"icao": "LEMD"}}}] if c == "IB1" else []
    assert ingest.collect_schedules(lake, samples, [("one", one), ("two", two)], dry_run=True) == 3
    assert ingest.collect_schedules(lake, samples, [("one", one), ("two", two)]) == 3
    jobs.schedules_to_silver(lake)
    assert {(r["source"], r["callsign"], str(r["flight_date"])) for r in lake.read("silver/schedules").collect()} == {("one", "IB0", "2026-06-12"), ("two", "IB1", "2026-06-12")}
    assert ingest.collect_schedules(lake, samples, [("one", one)], resume=True, dry_run=True) == 1
    assert ingest.collect_schedules(lake, samples, [("one", one)], limit=2, dry_run=True) == 2

    def send(url, headers, params, timeout):
        return H.Response(200, json.dumps({"hourly": {"time": [f"{params['start_date']}T00:00"], "temperature_2m": [1.0]}}))

    ranges = spark.sql("select * from values ('LEMD', date'2026-06-12', date'2026-06-13'), ('XXXX', date'2026-06-12', date'2026-06-13') as t(airport_code, start_date, end_date)")
    assert ingest.collect_weather(lake, ranges, "http://x", send=send) == 1
    jobs.weather_to_silver(lake)
    assert [(r["airport_code"], r["temperature_2m"]) for r in lake.read("silver/weather").collect()] == [("LEMD", 1.0)]


def test_states_tracks_and_credit(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    left = lambda n: lambda url, headers, params, timeout: H.Response(200, json.dumps({"time": DAY, "states": [["a"] + [None] * 16]}), {"X-Rate-Limit-Remaining": n})
    assert ingest.collect_once(lake, H.clients("http://x", ["k"], left("8")), "states", box=(1, 2, 3, 4)) == 1
    assert ingest.collect_once(lake, H.Client("x", send=lambda *a: H.Response(404)), "track", icao24="a") == 0
    jobs.positions_to_silver(lake)
    assert lake.read("silver/state_vectors").count() == 1
    pool = H.Pool([H.Client("x", send=left("8")), H.Client("x", send=left("4")), H.Client("x", send=lambda *a: H.Response(429))])
    assert ingest.pool_credit(pool, 3)["enough"] and not ingest.pool_credit(pool, 4)["enough"] and ingest.pool_credit(pool)["remaining"] == 12


def test_mock_files_copies_and_documents(spark, tmp_path):
    lake, files = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "raw")
    assert ingest.write_mock_files(files, 2, date(2026, 6, 13), n=5) == 60
    assert ingest.load_files(lake, files, dry_run=True) == {"files": 12, "flights": 0}
    assert ingest.load_files(lake, files)["files"] == 12 and ingest.load_files(lake, files) == {"files": 0, "flights": 0}
    ingest.write_mock_files(files, 1, date(2026, 6, 13), n=5, seed=2)  # added to what the files have
    assert len(json.loads((tmp_path / "raw" / "2026-06-13" / "LEMD_arrivals.json").read_text())) == 10
    silver, other = lake.read("silver/flights"), Lake(spark, str(tmp_path / "other"))
    ingest.samples_to_json(silver, str(tmp_path / "samples"), "first_seen", "icao24", target=7)
    assert read_samples(spark, str(tmp_path / "samples")).count() == 7
    n = silver.count()
    assert ingest.copy_tables(lake, other, ["silver/flights", "silver/weather"], dry_run=True) == {"silver/flights": n} and not other.exists("silver/flights")
    ingest.copy_tables(lake, other, ["silver/flights"])
    documents = ingest.flight_documents(silver.withColumnRenamed("departure_airport_horiz_distance", "est_departure_airport_horiz_distance"))
    assert "departure_airport_horiz_distance" in documents.columns and "ingested_at" in documents.columns
    ingest.migrate_flights(other, documents)
    assert other.read("silver/flights").count() == n
    ingest.migrate_flights(other, documents.withColumn("callsign", documents["icao24"]).unionByName(documents.selectExpr("* except (last_seen)", "cast(null as timestamp) as last_seen")))
    assert other.read("silver/flights").count() == 2 * n
    assert ingest.entity_stats(lake)["silver/aircraft"] == 0
    assert ingest.main([lake.root, "copy", str(tmp_path / "third"), "--tables", "gold/flights"]) == 0
    assert Lake(spark, str(tmp_path / "third")).read("gold/flights").count() == lake.read("gold/flights").count()
