"""Jobs that ask the feeds and keep their answers in bronze, and what goes around them: gaps, mocks, copies.

Calls are rows: each is made by the task that has it, and its answer is written before anything
else reads it, so a step that fails later doesn't ask again what it has.
"""

from __future__ import annotations

import argparse
import json
import os
import random
from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta, timezone
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import TABLES, Lake
from ..functions import real_date
from ..operators.match import without
from ..operators.sampling import stratified
from ..operators.traffic import incomplete_days
from ..sources.airports import AIRPORTS, BOXES, COORDINATES
from ..sources.files import endpoint, read_responses
from ..sources.http import Client, Exhausted, FlightFeed, HttpError, Pool, fetch
from ..sources.vendors import envelopes, first_vendor, schedule, second_vendor, weather
from .jobs import bronze_to_silver, pending_calls, remember_empty, silver_to_gold

FIRST_GAP, LAST_GAP = 3, 30
COMPLETE = 1000
ANSWER = "source string, endpoint string, params string, response string, fetched_at timestamp"
CALL = ["airport_code", "flight_date", "endpoint"]


def days_between(lake: Lake, first: date, last: date) -> DataFrame:
    return lake.spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))).alias("flight_date"))


def domestic(lake: Lake, country: str = "España") -> DataFrame:
    """airport_code of the airports of one country."""
    return lake.spark.createDataFrame([(a[0],) for a in AIRPORTS if a[3] == country], "airport_code string")


def ingest_flights(lake: Lake, airports: DataFrame, days: DataFrame, feed: dict[str, str], source: type[FlightFeed] = FlightFeed, force: bool = False, dry_run: bool = False) -> dict[str, int]:
    """Asks for the flights of airports and days that bronze lacks; ``force`` asks for all of them again.

    Answers with flights go to bronze, empty ones are remembered, failed calls stay pending. Days
    that got answers are parsed again by the next bronze_to_silver, which skips known flights.
    """
    key = lake.spark.createDataFrame([("arrival",), ("departure",)], "endpoint string")
    wanted = airports.join(days, F.lit(True)).join(key, F.lit(True)) if force else pending_calls(lake, airports, days)  # the request list, not data
    calls = [f"{r['endpoint']}:{r['airport_code']}:{r['flight_date']}" for r in wanted.orderBy(*CALL).collect()]
    stats = {"calls": len(calls), "loaded": 0, "empty": 0, "failed": 0}
    if dry_run or not calls:
        return stats
    lake.spark.dataSource.register(source)
    asked = lake.spark.read.format(source.name()).options(**feed, calls=",".join(calls), answers="all").load()
    lake.replace("system/answers", asked)
    got = lake.read("system/answers")
    kind = F.when(F.col("response").isNull(), "failed").when(F.col("response").isin("[]", "{}", "null"), "empty").otherwise("loaded")
    stats.update({r["kind"]: r["n"] for r in got.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).collect()})
    full = got.where(kind == "loaded")
    if stats["loaded"]:
        lake.append("bronze/flights", full)
        lake.unmark("bronze_to_silver", full.select(F.col("ingestion_date").alias("item")).distinct())
    if stats["empty"]:
        remember_empty(lake, got.where(kind == "empty").select(F.get_json_object("params", "$.airport").alias("airport_code"), F.col("ingestion_date").alias("flight_date"), "endpoint"))
    return stats


def fill_gaps(lake: Lake, airports: DataFrame, today: date, feed: dict[str, str], first: int = FIRST_GAP, last: int = LAST_GAP, **how: Any) -> dict[str, int]:
    """The calls that the days from ``last`` to ``first`` days ago still lack."""
    return ingest_flights(lake, airports, days_between(lake, today - timedelta(days=last), today - timedelta(days=first)), feed, **how)


def backfill(lake: Lake, airports: DataFrame, first: date, last: date, feed: dict[str, str], least: int = COMPLETE, **how: Any) -> dict[str, int]:
    """All calls of the days with fewer than ``least`` flights in silver, again."""
    flights = lake.read("silver/flights", "flight_date date")
    days = incomplete_days(flights, F.lit(first), F.lit(last), least).select("flight_date")
    return ingest_flights(lake, airports, days, feed, force=True, **how)


def asked(rows: DataFrame, ask: Callable[[dict], tuple[str, str, dict, Any] | None], schema: str = ANSWER) -> DataFrame:
    """A bronze row for each row for which ask() has (source, endpoint, params, answer); made by the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if found := ask(row):
                    source, name, params, answer = found
                    out = source, name, json.dumps(params, ensure_ascii=False, default=str), json.dumps(answer, ensure_ascii=False), datetime.now(timezone.utc)
                    kinds = [pa.string()] * 4 + [pa.timestamp("us", "UTC")]
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(out, kinds)], names=["source", "endpoint", "params", "response", "fetched_at"])

    return rows.mapInArrow(run, schema)


def collect_schedules(lake: Lake, samples: DataFrame, vendors: list[tuple[str, Callable[[str, str], Any]]], limit: int | None = None, resume: bool = False, dry_run: bool = False) -> int:
    """Asks the vendors, named one and two, in turn for the schedule of each sampled (callsign, flight_date).

    Samples without either are left out; ``resume`` leaves out those that silver has. Returns how many are asked.
    """
    rows = samples.select(F.trim("callsign").alias("callsign"), real_date(F.col("flight_date").cast("string")).alias("flight_date"))
    rows = rows.where("callsign <> '' and flight_date is not null").distinct()
    if resume:
        rows = without(rows, lake.read("silver/schedules", "callsign string, flight_date date").select("callsign", "flight_date"), ["callsign", "flight_date"])
    rows = rows.orderBy("flight_date", "callsign").limit(limit) if limit is not None else rows
    n = rows.count()
    if dry_run or not n:
        return n

    def ask(row: dict):
        day = str(row["flight_date"])
        found = schedule(row["callsign"], day, vendors)
        return (found[0], "flights", {"callsign": row["callsign"], "flight_date": day}, found[1]) if found else None

    lake.replace("system/schedule_answers", asked(rows, ask))
    got = lake.read("system/schedule_answers")
    for name, _ in vendors:
        lake.append(f"bronze/schedules_{name}", got.where(F.col("source") == name))
    return n


def collect_weather(lake: Lake, ranges: DataFrame, base: str, dry_run: bool = False, **how: Any) -> int:
    """Hourly weather of each (airport_code, start_date, end_date); airports without coordinates are left out."""
    at = {c: (a, b) for c, a, b in COORDINATES}
    rows = ranges.where(F.col("airport_code").isin(*at) & (F.col("start_date") <= F.col("end_date")))
    n = rows.count()
    if dry_run or not n:
        return n

    def ask(row: dict):
        first, last = str(row["start_date"]), str(row["end_date"])
        answer = weather(base, at, row["airport_code"], first, last, **how)
        return ("weather", "archive", {"airport": row["airport_code"], "start_date": first, "end_date": last}, answer) if answer else None

    lake.replace("system/weather_answers", asked(rows, ask))
    lake.append("bronze/weather", lake.read("system/weather_answers"))
    return n


def collect_once(lake: Lake, client: Client | Pool, name: str, **what: Any) -> int:
    """One answer of the flight feed for states or a track, into bronze; an empty one leaves no row."""
    answer = fetch(client, name, **what)
    if not answer:
        return 0
    table = "bronze/tracks" if name == "track" else "bronze/states"
    params = {k: v.isoformat() if isinstance(v, datetime) else v for k, v in what.items() if v is not None}
    lake.append(table, envelopes(lake.spark, [("flight_feed", name, params, answer)]))
    return 1


def samples_to_json(flights: DataFrame, path: str, *order: Column | str, **how: Any) -> None:
    """A stratified sample of flights as one JSON array that read_samples() reads; ``target`` bounds its rows."""
    row = F.struct("icao24", "callsign", "est_departure_airport", "est_arrival_airport", F.col("flight_date").cast("string").alias("flight_date"))
    stratified(flights, *order, **how).agg(F.to_json(F.collect_list(row))).write.mode("overwrite").text(path)


def flight_documents(flights: DataFrame) -> DataFrame:
    """Flights as documents of a store: the distances and counts of an end without ``est_``, and a stamp."""
    rows = flights if "ingested_at" in flights.columns else flights.withColumn("ingested_at", F.current_timestamp())
    names = {c: c.removeprefix("est_") for c in rows.columns if c.endswith(("_horiz_distance", "_vert_distance"))}
    return rows.withColumnsRenamed(names).withColumn("flight_date", F.coalesce(F.col("flight_date"), F.to_date("first_seen")))


def documents_to_flights(documents: DataFrame) -> DataFrame:
    """Documents as flights again; those without both times are dropped."""
    return documents.where("first_seen is not null and last_seen is not null").withColumn("flight_date", F.to_date("first_seen"))


def copy_tables(lake: Lake, other: Lake, names: list[str] | None = None, dry_run: bool = False) -> dict[str, int]:
    """Overwrites tables of another lake, partitions kept. Returns the rows of each table that there is."""
    out = {}
    for name in names or list(TABLES):
        if lake.exists(name):
            out[name] = lake.read(name).count()
            if not dry_run:
                lake.copy_to(other, name)
    return out


def migrate_flights(lake: Lake, documents: DataFrame) -> None:
    """Flights of an older store into silver; those that silver has, or that come twice, are not added again."""
    key = list(TABLES["silver/flights"].key)
    rows = documents_to_flights(documents).dropDuplicates(key)
    if lake.exists("silver/flights"):
        stored = lake.read("silver/flights")
        old, same = stored.select(*(F.col(c).alias(f"o_{c}") for c in key)), F.lit(True)
        for c in key:
            same = same & F.col(c).eqNullSafe(F.col(f"o_{c}"))
        rows = rows.join(old, same, "left_anti")
        rows = rows.select(*(F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema))
    lake.append("silver/flights", rows)


def write_mock_files(root: str, days: int = 1, last: date | None = None, airports: tuple[str, ...] = ("LEMD", "LEBL", "LEAL"), seed: int = 1, n: int = 100) -> int:
    """Made-up flights as raw files, a file for each day, airport and end; a file that exists keeps its flights.

    Returns the flights added. Fixture files of a few hundred rows, so they are written by the driver.
    """
    rng, last, added = random.Random(seed), last or datetime.now(timezone.utc).date(), 0
    others = [a[0] for a in AIRPORTS]
    for back in range(days):
        day = last - timedelta(days=back)
        midnight = int(datetime(day.year, day.month, day.day, tzinfo=timezone.utc).timestamp())
        os.makedirs(f"{root}/{day}", exist_ok=True)
        for airport in airports:
            for end in ("arrivals", "departures"):
                rows = []
                for _ in range(n):
                    start, other = midnight + rng.randrange(82800), rng.choice([o for o in others if o != airport])
                    a, b = (other, airport) if end == "arrivals" else (airport, other)
                    rows.append({"icao24": f"{0x340000 + rng.randrange(30):06x}", "firstSeen": start, "lastSeen": start + rng.randrange(1800, 14400), "estDepartureAirport": a, "estArrivalAirport": b, "callsign": f"IBE{rng.randrange(1000, 9999)}"})
                path = f"{root}/{day}/{airport}_{end}.json"
                if os.path.exists(path):
                    with open(path) as f:
                        rows = json.load(f) + rows
                with open(f"{path}.part", "w") as f:
                    json.dump(rows, f, ensure_ascii=False, indent=1)
                os.replace(f"{path}.part", path)
                added += n
    return added


def load_files(lake: Lake, root: str, dry_run: bool = False) -> dict[str, int]:
    """Raw flight files that bronze doesn't have, into bronze, silver and gold. Returns files and new flights."""
    rows = read_responses(lake.spark, root)
    key = ["airport", "ingestion_date", "endpoint"]
    rows = rows.withColumn("airport", F.get_json_object("params", "$.airport"))
    stored = lake.read("bronze/flights", "params string, ingestion_date date, endpoint string")
    rows = without(rows, stored.select(F.get_json_object("params", "$.airport").alias("airport"), "ingestion_date", endpoint(F.col("endpoint")).alias("endpoint")), key).drop("airport")
    out = {"files": rows.count(), "flights": 0}
    if out["files"] and not dry_run:
        days = [(r[0],) for r in rows.select(F.col("ingestion_date").cast("string")).distinct().collect()]  # days, not rows
        lake.append("bronze/flights", rows)
        lake.unmark("bronze_to_silver", lake.spark.createDataFrame(days, "item string"))
        out["flights"] = bronze_to_silver(lake)
        silver_to_gold(lake)
    return out


def entity_stats(lake: Lake) -> dict[str, int]:
    """What a sync of aircraft and weather to gold would read and has: rows of silver and gold, distinct makers and operators."""
    out = {n: lake.read(n).count() if lake.exists(n) else 0 for n in ("silver/aircraft", "gold/aircraft", "silver/weather", "gold/weather")}
    if out["silver/aircraft"]:
        r = lake.read("silver/aircraft").agg(F.countDistinct(F.expr("nullif(manufacturer, '')")), F.countDistinct(F.expr("nullif(operator, '')"))).first()
        out |= {"manufacturers": r[0], "operators": r[1]}
    return out


def credit(client: Client) -> dict[str, Any]:
    """What a cheap call says of a client's credit: remaining (None if not told), and the error if it failed."""
    try:
        fetch(client, "states", box=(0, 0.1, 0, 0.1))
    except (HttpError, Exhausted) as e:
        return {"remaining": 0 if isinstance(e, HttpError) and e.status == 429 else None, "error": str(e)}
    return {"remaining": client.remaining, "error": None}


def pool_credit(pool: Pool, calls: int = 0, cost: int = 4) -> dict[str, Any]:
    """The credit of all clients of a pool, and whether it covers so many calls; a client of unknown credit is enough, one that fails is none."""
    found = [credit(c) for c in pool.items]
    told = sum(f["remaining"] or 0 for f in found)
    unknown = any(f["remaining"] is None and f["error"] is None for f in found)
    return {"clients": found, "remaining": told, "enough": unknown or told >= calls * cost}


def main(argv: list[str] | None = None) -> int:
    from ..config import keys
    from ..session import session

    day = date.fromisoformat
    parser = argparse.ArgumentParser(description="Asks the feeds and keeps their answers in a lake.")
    parser.add_argument("root")
    parser.add_argument("--base", default=os.environ.get("FEED_BASE", ""), help="address of the feed")
    parser.add_argument("--dry-run", action="store_true")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("flights", "fill", "backfill"):
        p = commands.add_parser(name)
        p.add_argument("--airports", nargs="*", help="all of the home country if not given")
        p.add_argument("--first", type=day)
        p.add_argument("--last", type=day, default=datetime.now(timezone.utc).date())
        p.add_argument("--force", action="store_true")
    p = commands.add_parser("states")
    p.add_argument("--box", choices=BOXES)
    p.add_argument("--icao24")
    p = commands.add_parser("track")
    p.add_argument("icao24")
    p = commands.add_parser("schedules")
    p.add_argument("samples", help="a JSON file or folder of sampled flights")
    p.add_argument("--limit", type=int)
    p.add_argument("--resume", action="store_true")
    p.add_argument("--second-base")
    p = commands.add_parser("weather")
    p.add_argument("--first", type=day, required=True)
    p.add_argument("--last", type=day, required=True)
    p = commands.add_parser("sample")
    p.add_argument("path")
    p = commands.add_parser("mock")
    p.add_argument("files")
    p.add_argument("--days", type=int, default=0, help="so many days of files are made up first")
    p = commands.add_parser("copy")
    p.add_argument("to")
    p.add_argument("--tables", nargs="*", choices=TABLES)
    commands.add_parser("entities")
    commands.add_parser("setup")
    args = parser.parse_args(argv)
    lake, tokens = Lake(session(), args.root), keys("FEED_TOKEN")
    spark, feed = lake.spark, {"base": args.base, "tokens": ",".join(tokens)}
    out: Any = None
    if args.command in ("flights", "fill", "backfill"):
        airports = spark.createDataFrame([(a,) for a in args.airports], "airport_code string") if args.airports else domestic(lake)
        if args.command == "fill":
            out = fill_gaps(lake, airports, args.last, feed, force=args.force, dry_run=args.dry_run)
        elif args.command == "backfill":
            out = backfill(lake, airports, args.first or args.last, args.last, feed, dry_run=args.dry_run)
        else:
            out = ingest_flights(lake, airports, days_between(lake, args.first or args.last, args.last), feed, force=args.force, dry_run=args.dry_run)
    elif args.command in ("states", "track"):
        from ..sources.http import clients

        what = {"icao24": args.icao24} | ({"box": BOXES[args.box]} if args.command == "states" and args.box else {})
        if not args.dry_run:
            out = collect_once(lake, clients(args.base, tokens), args.command, **{k: v for k, v in what.items() if v})
    elif args.command == "schedules":
        from ..sources.files import read_samples

        first, second = keys("SCHEDULE_ONE"), keys("SCHEDULE_TWO")
        vendors = [("one", lambda c, d: first_vendor(args.base, first, c, d))] if first else []
        vendors += [("two", lambda c, d: second_vendor(args.second_base, args.second_base.split("/")[2], second[0], c, d))] if second and args.second_base else []
        out = collect_schedules(lake, read_samples(spark, args.samples), vendors, args.limit, args.resume, args.dry_run)
    elif args.command == "weather":
        from ..operators.traffic import airport_date_ranges, overlap

        out = collect_weather(lake, overlap(airport_date_ranges(lake.read("silver/flights")), F.lit(args.first), F.lit(args.last)), args.base, args.dry_run)
    elif args.command == "sample":
        samples_to_json(lake.read("silver/flights"), args.path, "first_seen", "icao24", "callsign")
    elif args.command == "mock":
        if args.days and not args.dry_run:
            write_mock_files(args.files, args.days)
        out = load_files(lake, args.files, args.dry_run)
    elif args.command == "copy":
        out = copy_tables(lake, Lake(spark, args.to), args.tables, args.dry_run)
    elif args.command == "entities":
        out = entity_stats(lake)
    else:
        out = lake.register()
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
