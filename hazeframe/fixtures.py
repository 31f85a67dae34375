"""Sensor tables derived from the generic test tables (`events`, `orders`, `nation`, `region`).

Every view covers all rows of its source; expressions only shape values and null patterns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.functions.air_index import cut, index_of_cut

N_CITIES = 7


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """`measurements` from events: 20 devices over January 2024."""
    events = source(spark, folder, "events").withColumns(
        {
            "timestamp": F.col("ts").cast("timestamp"),
            "slot": F.ascii("event_type") * 4 + F.col("user_id") % 4,
            "k": F.get_json_object("props", "$.k").cast("double"),
        }
    )
    i, v = F.col("event_id"), F.col("value")
    no2 = F.when(i % 7 != 0, F.when(i % 5 == 0, F.col("k") * 25).otherwise(F.col("k")))
    events = events.withColumns({"no2": no2, "nowcast": F.when(i % 6 != 0, v * 0.8)}).withColumns(
        {"no2_cut": cut("no2", "no2"), "nowcast_cut": cut("nowcast", "pm25")}
    )
    null = F.lit(None).cast("double")
    return events.select(
        "event_id",
        F.concat_ws("-", "event_type", (F.col("user_id") % 4).cast("string")).alias("device_id"),
        "timestamp",
        v.alias("pm25_raw"),
        F.when(i % 3 != 0, v * 0.9).alias("pm25_24h_raw"),
        F.col("nowcast").alias("pm25_nowcast"),
        (index_of_cut("nowcast_cut", "pm25") + i % 2).alias("pm25_nowcast_aqi_epa"),
        (v * 1.4 + i % 41 - 10).alias("pm10_raw"),
        F.when(i % 4 != 0, v * 1.2 + i % 37).alias("pm10_24h_raw"),
        F.col("no2").alias("no2_raw"),
        (index_of_cut("no2_cut", "no2") + i % 3).alias("no2_aqi_epa"),
        null.alias("o3_raw"),
        (F.col("user_id") % 30).cast("double").alias("temp_internal"),
        F.when(i % 10 != 0, (i % 100).cast("double")).alias("humidity_internal"),
        F.lit(1.0).alias("wind_speed"),
        null.alias("pressure"),
        (F.lit(42.0) + F.col("slot") % 40 / 10.0).alias("latitude"),
        (F.lit(19.0) + F.col("slot") % 30 / 10.0).alias("longitude"),
        (F.col("slot") % N_CITIES).cast("int").alias("nation_key"),
    )


def _placed(devices: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    nation, region = source(spark, folder, "nation"), source(spark, folder, "region")
    return (
        devices.join(nation, devices.nation_key == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            "device_id",
            "latitude",
            "longitude",
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
            F.concat(F.lit("C"), F.col("nation_key").cast("string")).alias("country_code"),
        )
    )


def sensors(spark: SparkSession, folder: str) -> DataFrame:
    """`sensors` of `readings`: several devices per city."""
    devices = readings(spark, folder).select("device_id", "latitude", "longitude", "nation_key").distinct()
    return _placed(devices, spark, folder)


def gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """Settlements: one per nation."""
    nation, region = source(spark, folder, "nation"), source(spark, folder, "region")
    key = F.col("n_nationkey")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        key.cast("bigint").alias("place_id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("admin1"),
        F.concat(F.lit("C"), key.cast("string")).alias("cc"),
        (F.lit(42.0) + key / 6.0).alias("latitude"),
        (F.lit(19.0) + key % 5 / 1.5).alias("longitude"),
    )


def duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Readings whose time is cut to the hour, so that keys collide."""
    return readings(spark, folder).withColumn("timestamp", F.date_trunc("hour", "timestamp"))


def long_readings(spark: SparkSession, folder: str) -> DataFrame:
    """`measurements` from orders: 25 devices over several years, for months and clock changes."""
    orders = source(spark, folder, "orders")
    key = F.col("o_custkey") % 25
    return orders.select(
        F.concat(F.lit("station-"), key.cast("string")).alias("device_id"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        (F.col("o_totalprice") / 1000.0).alias("pm25_raw"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice") / 800.0).alias("pm10_raw"),
        F.col("o_orderkey").alias("order_id"),
        (F.lit(42.0) + key / 10.0).alias("latitude"),
        (F.lit(19.0) + key / 10.0).alias("longitude"),
        (key % N_CITIES).cast("int").alias("nation_key"),
    )


def long_sensors(spark: SparkSession, folder: str) -> DataFrame:
    """`sensors` of `long_readings`."""
    devices = long_readings(spark, folder).select("device_id", "latitude", "longitude", "nation_key").distinct()
    return _placed(devices, spark, folder)
