"""Seeded times for test data. Never joined to contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def synthetic_times(spark: SparkSession, start: str, end: str, n: int, seed: int, daylight: bool = True) -> DataFrame:
    """``n`` times between start and end, flagged as synthetic.

    With ``daylight`` hours 0 to 5 are drawn again from 6 to 23. No time passes
    the end.
    """
    low, high = [F.unix_timestamp(F.lit(t).cast("timestamp")) for t in (start, end)]
    drawn = spark.range(n).withColumn("at", F.timestamp_seconds(low + F.rand(seed) * (high - low)))
    if daylight:
        day_hour = F.floor(F.rand(seed + 1) * 18).cast("int") + 6
        moved = F.col("at") + F.make_dt_interval(hours=day_hour - F.hour("at"))
        drawn = drawn.withColumn("at", F.when(F.hour("at") < 6, moved).otherwise(F.col("at")))
    last = F.lit(end).cast("timestamp")
    return drawn.select("id", F.least("at", last).alias("at"), F.lit(True).alias("synthetic"))
