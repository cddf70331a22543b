"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One or more of the six characters that separate words.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def extended(schema: T.StructType, more: str) -> T.StructType:
    """A copy of a schema with the columns of a DDL string after its own."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(more).fields])


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, even where body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def prefix_sums(lengths: Column) -> Column:
    """For each element of an array of longs the sum of those before it.

    Higher-order functions have no running state to emit, so the array is cut into about
    sqrt(n) pieces: sums of pieces first, then sums within a piece. O(n * sqrt(n)) work.
    """

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))

    def with_width(width: Column) -> Column:
        pieces = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / width).cast("int")),
            lambda k: total(F.slice(lengths, k * width + 1, width)),
        )
        starts = let(pieces, lambda p: F.transform(p, lambda _, k: total(F.slice(p, F.lit(1), k))))
        return let(
            starts,
            lambda s: F.transform(
                lengths,
                lambda _, i: F.get(s, F.floor(i / width).cast("int"))
                + total(F.slice(lengths, (F.floor(i / width) * width + 1).cast("int"), (i % width).cast("int"))),
            ),
        )

    return F.when(F.size(lengths) > 0, let(F.ceil(F.sqrt(F.size(lengths))).cast("int"), with_width)).otherwise(
        F.array().cast("array<bigint>")
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where the setting is absent on one machine, as in tests, a temporary folder is made and set; a
    cluster must name one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found


class Stages:
    """Intermediate tables, written as Parquet to the shared folder and read back.

    A written table cuts the lineage and outlives the executors. Shuffle files of a write are
    freed when it ends. drop() removes a table that no later step reads; what is left (the
    tables that the returned DataFrame still reads) goes when the driver's process ends.
    """

    _CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
        atexit.register(self._remove, self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        before = self.spark.conf.get(self._CLEAN)
        self.spark.conf.set(self._CLEAN, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        finally:
            self.spark.conf.set(self._CLEAN, before)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            self._remove(f"{self.root}/{name}")

    def _remove(self, path: str) -> None:
        if self.spark.sparkContext._jsc is None:  # the session has ended
            return
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
