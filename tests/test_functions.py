import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from contrail import functions as C


def test_exact_minutes_round_like_binary_halves_to_even(spark):
    start = datetime(2024, 1, 1)
    seconds = list(range(-4000, 20000)) + random.Random(1).sample(range(20000, 10**6), 3000)
    rows = [(s, start, start + timedelta(seconds=s)) for s in seconds]
    got = spark.createDataFrame(rows, "s int, a timestamp, b timestamp").select("s", C.minutes_exact(F.col("a"), F.col("b")).alias("m")).collect()
    assert [r["s"] for r in got if r["m"] != round(r["s"] / 60.0, 1)] == []


def test_text_and_dates(spark):
    row = spark.createDataFrame([(" '\"x\"' ", "2024-02-30", "2024-3-1T00", "2026-06-12 10:00+02:00", "2026-06-12T10:00:05", "soon", "  ", None)], "q string, d string, e string, t string, u string, v string, w string, n string")
    got = row.select(
        C.unquote(F.col("q")).alias("q"), C.real_date(F.col("d")).alias("d"), C.real_date(F.lit("2024-03-01T00:00")).alias("e"), C.iso_time(F.col("t")).cast("string").alias("t"),
        C.iso_time(F.col("u")).cast("string").alias("u"), C.iso_time(F.col("v")).alias("v"), C.clip(F.col("w"), 3).alias("w"), C.clip(F.col("n"), 3).alias("n"),
        C.iso_weekday(F.to_date(F.lit("2024-01-07"))).alias("sunday"), C.hour_block(F.to_timestamp(F.lit("2024-01-01 18:00:00"))).alias("block"), C.hour_block(F.lit(None).cast("timestamp")).alias("no_block"),
        C.blank_to_null(F.lit("")).alias("blank"), C.zero_to_null(F.lit(0)).alias("zero"), C.years(F.to_date(F.lit("2000-01-01")), F.to_date(F.lit("2024-01-01"))).alias("years"),
        C.day_bounds(F.to_date(F.lit("2024-01-01")))["end"].cast("string").alias("end"),
    ).first()
    assert (got["q"], got["d"], str(got["e"]), got["t"], got["u"]) == ("x", None, "2024-03-01", "2026-06-12 08:00:00", "2026-06-12 10:00:05")
    assert got["v"] is None and got["w"] is None and got["n"] is None and got["blank"] is None and got["zero"] is None
    assert (got["sunday"], got["block"], got["no_block"], got["years"], got["end"]) == (7, "18-24", "00-06", 24.0, "2024-01-01 23:59:59")


def test_distance(spark):
    km = spark.range(1).select(C.distance_km(F.lit(40.4719), F.lit(-3.5626), F.lit(41.2971), F.lit(2.0785))).first()[0]
    assert abs(km - 483) < 2
