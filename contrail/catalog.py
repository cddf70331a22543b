"""Tables in a lake folder: where they are, how they are partitioned, what identifies a row.

Writes that replace a table go to a new folder that then becomes the table's current one, so a
reader sees the old or the new rows, and a failed write changes nothing. The version before the
current one is kept, for readers that began before the swap.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Table:
    key: tuple[str, ...] = ()
    partition: tuple[str, ...] = ()


TABLES = {
    "bronze/flights": Table(partition=("ingestion_date",)),
    "bronze/schedules_one": Table(partition=("source",)),
    "bronze/schedules_two": Table(partition=("source",)),
    "bronze/weather": Table(partition=("source",)),
    "bronze/states": Table(partition=("source",)),
    "bronze/tracks": Table(partition=("source",)),
    "silver/flights": Table(("icao24", "first_seen", "callsign"), ("flight_date",)),
    "silver/state_vectors": Table(("icao24", "snapshot_time"), ("snapshot_date",)),
    "silver/track_waypoints": Table(("icao24", "start_time", "waypoint_time"), ("track_date",)),
    "silver/schedules": Table(("source", "callsign", "flight_date")),
    "silver/aircraft": Table(("icao24",)),
    "silver/weather": Table(("airport_code", "timestamp")),
    "gold/daily_airport_traffic": Table(("airport_code", "flight_date")),
    "gold/route_density": Table(("departure_airport", "arrival_airport")),
    "gold/hourly_distribution": Table(("airport_code", "flight_date", "hour")),
    "gold/flights": Table(("icao24", "flight_date", "first_seen")),
    "gold/aircraft": Table(("icao24",)),
    "gold/weather": Table(("airport_code", "timestamp")),
    "gold/feature_store": Table(("icao24", "flight_date")),
    "system/checkpoints": Table(("job", "item")),
    "system/empty_airports": Table(("airport_code", "flight_date", "endpoint")),
    "system/gold_days": Table(("flight_date",)),
    "system/answers": Table(),
    "system/schedule_answers": Table(),
    "system/weather_answers": Table(),
    "gold/route_days": Table(("departure_airport", "arrival_airport", "flight_date")),
}


class Lake:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _current(self, name: str) -> str | None:
        """The folder of the latest complete write: versions are named in order, and marked when done."""
        fs, p = self._fs(f"{self.root}/{name}")
        if not fs.exists(p):
            return None
        done = []
        for s in fs.listStatus(p):
            mark = self._fs(f"{s.getPath().toString()}/_SUCCESS")
            if s.isDirectory() and mark[0].exists(mark[1]):
                done.append(s.getPath().toString())
        return max(done, key=lambda x: x.rsplit("/", 1)[1]) if done else None

    def exists(self, name: str) -> bool:
        return self._current(name) is not None

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        """The table; an empty one of the schema if it was never written."""
        at = self._current(name)
        if at is None:
            if schema is None:
                raise FileNotFoundError(f"{self.root}/{name}")
            return self.spark.createDataFrame([], schema)
        return self.spark.read.format(self.fmt).load(at)

    def replace(self, name: str, rows: DataFrame) -> None:
        old = self._current(name)
        version = int(old.rsplit("/", 1)[1].split("-")[0]) + 1 if old else 0
        rows.write.format(self.fmt).partitionBy(*TABLES[name].partition).save(f"{self.root}/{name}/{version:08d}-{uuid.uuid4().hex[:8]}")
        fs, p = self._fs(f"{self.root}/{name}")
        for s in fs.listStatus(p):
            number = s.getPath().getName().split("-")[0]
            if number.isdigit() and int(number) < version - 1:
                fs.delete(s.getPath(), True)

    def append(self, name: str, rows: DataFrame) -> None:
        at = self._current(name)
        if at is None:
            self.replace(name, rows)
        else:
            rows.write.format(self.fmt).mode("append").partitionBy(*TABLES[name].partition).save(at)

    def overwrite_partitions(self, name: str, rows: DataFrame) -> None:
        """Replaces only the partitions that rows has."""
        at = self._current(name)
        if at is None:
            self.replace(name, rows)
        else:
            rows.write.format(self.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*TABLES[name].partition).save(at)

    def copy_to(self, other: Lake, name: str) -> None:
        other.replace(name, self.read(name))

    def mark(self, job: str, items: DataFrame) -> None:
        """Adds items (column item) to a job's set of done ones."""
        new = items.select(F.lit(job).alias("job"), F.col("item").cast("string").alias("item"))
        stored = self.read("system/checkpoints", "job string, item string")
        self.replace("system/checkpoints", stored.unionByName(new).distinct())

    def unmark(self, job: str, items: DataFrame) -> None:
        """Takes items out of a job's set, so that they are pending again."""
        gone = items.select(F.lit(job).alias("job"), F.col("item").cast("string").alias("item"))
        self.replace("system/checkpoints", self.read("system/checkpoints", "job string, item string").join(gone, ["job", "item"], "left_anti"))

    def partitions(self, name: str) -> list[str]:
        """The values of a table's partition column, from the names of its folders; no file is read."""
        at = self._current(name)
        if at is None or not TABLES[name].partition:
            return []
        fs, p = self._fs(at)
        start = f"{TABLES[name].partition[0]}="
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return sorted(n.removeprefix(start) for n in names if n.startswith(start))

    def register(self) -> list[str]:
        """A temporary view layer_table for each table that was written, for SQL. Returns their names."""
        found = [n for n in TABLES if self.exists(n)]
        for n in found:
            self.read(n).createOrReplaceTempView(n.replace("/", "_"))
        return [n.replace("/", "_") for n in found]

    def done(self, job: str) -> DataFrame:
        return self.read("system/checkpoints", "job string, item string").where(F.col("job") == job).select("item")
