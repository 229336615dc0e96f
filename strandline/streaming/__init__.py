"""Extensions for unbounded inputs: islands as session windows and duplicate removal under a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_islands(events: DataFrame, keys: list[str], at: str, gap: str, late: str) -> DataFrame:
    """keys, start, end and n of each run of events with no pause of `gap`; events later than `late` are left out."""
    per = events.withWatermark(at, late).groupBy(*keys, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n"))
    return per.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_only(events: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """The first event of equal keys within the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)
