"""The sensor dimension: building it and joining readings to it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe.functions.clock import local_time
from hazeframe.functions.numeric import mean_of, to_number
from hazeframe.operators.geo import nearest_settlement
from hazeframe.sources.tables import MONTH


def sensor_coordinates(measurements: DataFrame, keep_moves: bool = False) -> DataFrame:
    """Coordinates of each device.

    By default one row per device, its latest known place: a device that moved must not multiply its
    readings in joins. `keep_moves=True` gives one row per distinct place instead.
    """
    if keep_moves:
        return measurements.select("device_id", "latitude", "longitude").distinct()
    known = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    place = F.struct("timestamp", "latitude", "longitude")
    # One row for each instant of a device first, by hash; only those few meet the ordering of whole places.
    spots = measurements.groupBy("device_id", "latitude", "longitude").agg(F.max("timestamp").alias("timestamp"))
    latest = spots.groupBy("device_id").agg(F.max(F.when(known, place)).alias("place"))
    return latest.select("device_id", "place.latitude", "place.longitude")


def build_sensors(
    measurements: DataFrame, gazetteer: DataFrame, keep_moves: bool = False
) -> DataFrame:
    """`sensors` table: device, coordinates, and city / region / country of the nearest settlement."""
    coordinates = sensor_coordinates(measurements, keep_moves).alias("sensor")
    spots = coordinates.select("latitude", "longitude").distinct()
    found = nearest_settlement(spots, gazetteer).alias("place")
    same_spot = [F.col(f"sensor.{c}") == F.col(f"place.{c}") for c in ("latitude", "longitude")]
    return coordinates.join(found, same_spot, "left").select(
        "sensor.*",
        F.col("place.name").alias("city"),
        F.col("place.admin1").alias("region"),
        F.col("place.cc").alias("country_code"),
    )


def join_sensors(
    readings: DataFrame, sensors: DataFrame, attributes: Sequence[str] = ("city",), salt: int = 1
) -> DataFrame:
    """Inner join of rows with a `device_id` to sensor attributes.

    No broadcast hint: the sensor table grows with the fleet, so Spark broadcasts it only while its size is
    under `spark.sql.autoBroadcastJoinThreshold`. Above it the join is shuffled, and AQE splits
    a device that holds a large share of the rows. `salt` > 1 does that split by hand: each device
    is spread over `salt` keys and its sensor row is copied to each of them.
    """
    dimension = sensors.select("device_id", *attributes)
    if salt <= 1:
        return readings.join(dimension, "device_id")
    # A few plain columns, and visibly never NULL: the join must not evaluate computed columns twice.
    by = ["timestamp"] if "timestamp" in readings.columns else readings.columns
    spread = F.coalesce(F.pmod(F.xxhash64(*by), F.lit(salt)).cast("int"), F.lit(0))
    copies = F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))
    return (
        readings.withColumn("_salt", spread)
        .join(dimension.withColumn("_salt", copies), ["_salt", "device_id"])
        .drop("_salt")
    )


def located_readings(
    measurements: DataFrame,
    sensors: DataFrame,
    columns: Sequence[str],
    attributes: Sequence[str] = ("city",),
    salt: int = 1,
) -> DataFrame:
    """Readings with numeric columns, sensor attributes and the local wall-clock time.

    The month that partitions a stored table stays, so that a period filter still skips its folders.
    """
    month = [MONTH] if MONTH in measurements.columns else []
    picked = measurements.select(
        "device_id", "timestamp", *month, *[to_number(c).alias(c) for c in columns]
    )
    return join_sensors(picked, sensors, attributes, salt).withColumn(
        "local_time", local_time("timestamp")
    )


def mean_by(
    measurements: DataFrame,
    sensors: DataFrame,
    columns: Sequence[str],
    keys: Mapping[str, Column],
    by_city: bool = True,
) -> DataFrame:
    """Mean of every column per city (optional) and key, each reading weighted equally.

    Readings are reduced to sums and counts per device and key *before* they meet the sensor table, so raw rows
    are never shuffled, however large the fleet or one device; the join and the second
    aggregation see one row per device and key.
    """
    values = {c: to_number(c) for c in columns}
    grouped = measurements.groupBy("device_id", *[column.alias(name) for name, column in keys.items()])
    return mean_of_sums(grouped.agg(*sums_and_counts(values)), sensors, columns, list(keys), by_city)


def sums_and_counts(values: Mapping[str, Column]) -> list[Column]:
    """sum_{name} and n_{name} of each value, as aggregates."""
    return [
        piece
        for name, value in values.items()
        for piece in (F.sum(value).alias(f"sum_{name}"), F.count(value).alias(f"n_{name}"))
    ]


def mean_of_sums(
    per_device: DataFrame, sensors: DataFrame, columns: Sequence[str], keys: Sequence[str], by_city: bool = True
) -> DataFrame:
    """Mean of every column per city (optional) and key, from its sums and counts per device and key."""
    attributes = ("city",) if by_city else ()
    located = join_sensors(per_device, sensors, attributes)
    if by_city:
        located = located.where(F.col("city").isNotNull())
    means = [mean_of(F.sum(f"sum_{c}"), F.sum(f"n_{c}")).alias(c) for c in columns]
    return located.groupBy(*attributes, *keys).agg(*means)
