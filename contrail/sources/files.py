"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.parse import conform_aircraft

_NAME = r"(\d{4}-\d{2}-\d{2})/([A-Z]{4})_(arrivals|departures)\.json$"


def read_flight_files(spark: SparkSession, root: str) -> DataFrame:
    """<root>/<day>/<airport>_<arrivals|departures>.json as raw flights with file_date, airport and endpoint.

    Files of other names are left out.
    """
    raw = spark.read.schema(schemas.FLIGHT_JSON).option("multiLine", True).json(f"{root}/*/*.json")
    name = F.col("_metadata.file_path")
    part = lambda i: F.regexp_extract(name, _NAME, i)
    return raw.select("*", part(1).alias("file_date"), part(2).alias("airport"), part(3).alias("endpoint")).where("airport <> ''")


def read_responses(spark: SparkSession, root: str) -> DataFrame:
    """The same files as a bronze table: one row a file, with its whole text."""
    raw = spark.read.text(f"{root}/*/*.json", wholetext=True).select(F.col("_metadata.file_path").alias("p"), F.col("value").alias("response"))
    part = lambda i: F.regexp_extract("p", _NAME, i)
    day = part(1)
    params = F.to_json(F.struct(part(2).alias("airport"), F.concat(day, F.lit(" 00:00:00")).alias("begin"), F.concat(day, F.lit(" 23:59:59")).alias("end")))
    return raw.where(part(2) != "").select(
        endpoint(part(3)).alias("endpoint"), params.alias("params"), F.current_timestamp().alias("fetched_at"), "response", day.cast("date").alias("ingestion_date")
    )


def endpoint(c):
    """One name for either spelling of an endpoint, with or without a path: arrival or departure."""
    return F.regexp_extract(c, r"(arrival|departure)s?$", 1)


def read_aircraft(spark: SparkSession, path: str) -> DataFrame:
    """The aircraft CSV, Latin-1, all text."""
    return conform_aircraft(spark.read.option("header", True).option("encoding", "ISO-8859-1").option("quote", '"').csv(path))


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema("icao24 string, callsign string, est_departure_airport string, est_arrival_airport string, flight_date string").json(path)


def partitions(table: DataFrame, column: str = "ingestion_date") -> DataFrame:
    """The values of a partition column; no data column is read."""
    return table.select(column).distinct()
