"""Rollups kept up to date: a stored table of partial sums that follows the fact table month by month.

`hourly_sums` holds, for each device, local day and local hour, the sum and the number of the values of each measurement
column. Sums of sums are sums, so that every mean of the profiles comes from this table, whatever its key; it is smaller than the
readings by what a device sends in an hour. Each version notes which folder of the fact table a month was made from; a
refresh reads the months whose folder has changed and no others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.functions import clock
from hazeframe.functions.numeric import by_label_order, to_number
from hazeframe.operators.fleet import mean_of_sums, sums_and_counts
from hazeframe.schema import measure_columns
from hazeframe.sources import tables, versions
from hazeframe.sources.tables import MONTH, month_of

STATE = "hourly_sums"

#: The keys of rollups, from the local day and hour of a partial sum.
KEYS: Mapping[str, Callable[[], Column]] = {
    "date": lambda: F.col("date"),
    "month": lambda: F.date_format("date", "yyyy-MM"),
    "hour": lambda: F.col("hour"),
    "weekday": lambda: F.date_format("date", "EEEE"),
}


def partial_sums(measurements: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sum and number of values per device, local day and local hour; `utc_month` stays a key, so that months add up."""
    keys = [clock.local_date("timestamp").alias("date"), clock.local_hour("timestamp").alias("hour")]
    return measurements.groupBy("device_id", *keys, MONTH).agg(*sums_and_counts({c: to_number(c) for c in columns}))


def stale_months(spark: SparkSession, root: str, name: str = "measurements") -> tuple[list[str], list[str]]:
    """Folders of the fact table that the state doesn't know, and months of the state that the fact table no longer has."""
    fact, state = tables.table_version(spark, root, name), tables.table_version(spark, root, STATE)
    if not fact:
        raise FileNotFoundError(f"{root}: no table {name}")
    known = state.facts["source"] if state else {}
    fresh = [f for f in fact.folders if known.get(month_of(f)) != f]
    return fresh, sorted(set(known) - set(map(month_of, fact.folders)))


def fresh_readings(spark: SparkSession, root: str, folders: Sequence[str], name: str = "measurements") -> DataFrame:
    """The readings of some folders of the fact table."""
    fact = tables.table_version(spark, root, name)
    return versions.Version(fact.path, fact.number, tuple(folders), fact.schema).read(spark)


def refresh(spark: SparkSession, root: str, name: str = "measurements") -> list[str]:
    """Bring the partial sums up to date with the fact table. Returns the months that were read."""
    fresh, gone = stale_months(spark, root, name)
    state = tables.table_version(spark, root, STATE)
    if state and not fresh and not gone:
        return []
    fact = tables.table_version(spark, root, name)
    readings = fresh_readings(spark, root, fresh, name)
    sums = partial_sums(readings, measure_columns(readings))
    writing = versions.Writing(spark, tables.table_path(root, STATE))
    read = {month_of(f) for f in fresh}
    folders = {month_of(f): f for f in (state.folders if state else ()) if month_of(f) not in read | set(gone)}
    folders |= tables.write_months(writing, sums)
    source = {month_of(f): f for f in fact.folders}
    writing.commit([folders[m] for m in sorted(folders)], sums.schema, {"source": source})
    return sorted(read)


def filled_columns(sums: DataFrame) -> list[str]:
    """Measurement columns with at least one value, by the stored counts alone; all of them if there is no value."""
    names = [c.removeprefix("n_") for c in sums.columns if c.startswith("n_")]
    found = sums.agg(*[F.max(f"n_{c}").alias(c) for c in names]).first()
    return [c for c in names if found[c]] or names


def rollup(
    sums: DataFrame, sensors: DataFrame, columns: Sequence[str], key: str | None = None, by_city: bool = True
) -> DataFrame:
    """Mean of every column per city (optional) and key (of KEYS, or none), each reading weighted equally; ordered."""
    keys = {key: KEYS[key]()} if key else {}
    pieces = [F.sum(f"{kind}_{c}").alias(f"{kind}_{c}") for c in columns for kind in ("sum", "n")]
    per_device = sums.groupBy("device_id", *[column.alias(name) for name, column in keys.items()]).agg(*pieces)
    means = mean_of_sums(per_device, sensors, columns, list(keys), by_city)
    if not key:
        return means.orderBy(F.col(columns[0]).desc_nulls_last(), "city")
    order = by_label_order(key, clock.WEEKDAYS) if key == "weekday" else F.col(key)
    return means.orderBy(*(["city"] if by_city else []), order)
