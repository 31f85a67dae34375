"""Distinct counts for any period from stored sketches.

An exact distinct count has to see every reading of its period. Sketches of each city and day are small, can be merged, and are made
once; a period then reads one row per city and day. Estimates are off by about 1.6 % (one standard deviation) and
exact for a few dozen values. `profiles.distinct_counts` counts exactly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.functions import clock
from hazeframe.operators.fleet import join_sensors

#: Logarithm of the size of a sketch.
SIZE = 12


def daily_sketches(measurements: DataFrame, sensors: DataFrame, column: str) -> DataFrame:
    """(city, date, sketch) of the values of a column, by local day; readings of unknown cities don't count.

    Values are reduced to a sketch in every task before they are shuffled; one city and day is one row whatever it holds.
    """
    by_device = measurements.groupBy("device_id", clock.local_date("timestamp").alias("date")).agg(
        F.hll_sketch_agg(F.col(column).cast("string"), SIZE).alias("sketch")
    )
    located = join_sensors(by_device, sensors).where("city IS NOT NULL")
    return located.groupBy("city", "date").agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketches: DataFrame, start: dt.date, end: dt.date, cities: Sequence[str] | None = None) -> DataFrame:
    """One row: start, end, the estimated number of distinct values and of days with readings between two local days, both included."""
    held = sketches.where(F.col("date").between(F.lit(start), F.lit(end)))
    if cities is not None:
        held = held.where(F.col("city").isin(list(cities)))
    whole = held.agg(F.hll_union_agg("sketch").alias("sketch"), F.count_distinct("date").alias("n_days"))
    counted = F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0).cast("bigint"))
    return whole.select(F.lit(start).alias("start"), F.lit(end).alias("end"), counted.alias("n"), "n_days")
