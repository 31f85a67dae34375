"""CSV exports, table sinks, stage order."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from hazeframe.operators import cleaning, dashboard
from hazeframe.plans import jobs
from hazeframe.schema import COLUMN_MAP, MEASUREMENTS, TABLE_COLUMNS, measure_columns
from hazeframe.sources import exports, tables

PM25, PM10 = (
    "PM2.5 1-Hour Mean Mass Concentration Raw [ug/m3]",
    "PM10 1-Hour Mean Mass Concentration Raw [ug/m3]",
)
TIME = "Time [UTC+00:00]"


def write(path, header, *rows):
    lines = [",".join(header), *[",".join(row) for row in rows]]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture
def folder(tmp_path):
    write(
        tmp_path / "a.csv",
        ["Device ID", TIME, PM25, PM10, "latitude", "longitude"],
        ["D1", "2022-03-01T00:00:00Z", "10.5", "20", "44.0", "20.9"],
        ["D1", "2022-03-01T01:00:00Z", "NA", "n/a", "44.0", "20.9"],
        ["D1", "not a time", "1", "2", "44.0", "20.9"],
    )
    # Same columns in another order, one unknown column, one missing column, a byte order mark.
    (tmp_path / "b.csv").write_text(
        "﻿longitude,latitude,Extra," + PM10 + "," + TIME + ",Device ID\n"
        "20.9,44.0,x,33,2022-03-01 00:00:00,D1\n"
        "21.0,44.5,x,oops,2022-03-02 05:00:00,0042\n",
        encoding="utf-8",
    )
    return tmp_path


def test_column_table_is_complete():
    assert len(COLUMN_MAP) == 35 and len(TABLE_COLUMNS) == 37 and len(MEASUREMENTS) == 37


def test_files_are_matched_by_name(spark, folder):
    df = exports.load_folder(spark, str(folder), "kg")
    assert df.columns == list(TABLE_COLUMNS)
    assert df.schema == MEASUREMENTS
    rows = {
        (r.device_id, r.timestamp, r.source_file): r
        for r in df.select("device_id", "timestamp", "pm25_raw", "pm10_raw", "latitude", "source_dataset", "source_file").collect()
    }
    assert len(rows) == 5
    first = rows["D1", dt.datetime(2022, 3, 1), "a.csv"]
    assert (first.pm25_raw, first.pm10_raw, first.latitude, first.source_dataset) == (10.5, 20.0, 44.0, "kg")
    swapped = rows["D1", dt.datetime(2022, 3, 1), "b.csv"]
    assert (swapped.pm25_raw, swapped.pm10_raw, swapped.latitude) == (None, 33.0, 44.0)
    assert rows["D1", dt.datetime(2022, 3, 1, 1), "a.csv"].pm25_raw is None
    assert rows["0042", dt.datetime(2022, 3, 2, 5), "b.csv"].pm10_raw is None
    assert rows["D1", None, "a.csv"].pm25_raw == 1.0


def test_empty_and_absent_folders(spark, tmp_path):
    for path in (tmp_path, tmp_path / "absent"):
        df = exports.load_folder(spark, str(path), "kg")
        assert df.count() == 0 and df.schema == MEASUREMENTS


def test_timestamp_formats(spark):
    texts = {
        "2022-03-01T10:20:30Z": dt.datetime(2022, 3, 1, 10, 20, 30),
        "2022-03-01T10:20:30.123Z": dt.datetime(2022, 3, 1, 10, 20, 30, 123000),
        "2022-03-01T10:20:30+02:00": dt.datetime(2022, 3, 1, 8, 20, 30),
        "2022-03-01 10:20:30": dt.datetime(2022, 3, 1, 10, 20, 30),
        "2022-03-01T10:20": dt.datetime(2022, 3, 1, 10, 20),
        "2022-03-01 10:20": dt.datetime(2022, 3, 1, 10, 20),
        "2022-03-01": dt.datetime(2022, 3, 1),
        "2022-13-01": None,
        "yesterday": None,
        "": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.p for r in df.select("t", exports.parse_timestamp(F.col("t")).alias("p")).collect()}
    assert got == texts


def test_counts_add_up(spark, folder):
    raw = exports.load_folder(spark, str(folder), "kg")
    row = cleaning.stage_counts(raw).first()
    assert (row.n_read, row.n_unusable, row.n_duplicates, row.n_kept) == (5, 1, 1, 3)
    assert cleaning.deduplicate(cleaning.drop_unusable(raw)).count() == row.n_kept


def test_month_partitions_and_pruning(spark, tmp_path, folder):
    raw = exports.load_folder(spark, str(folder), "kg")
    later = raw.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 40 DAYS"))
    tables.write_measurements(cleaning.drop_unusable(raw.unionByName(later)), str(tmp_path / "t"))
    stored = tables.read_table(spark, str(tmp_path / "t"), "measurements")
    assert dict(stored.dtypes)["utc_month"] == "date"
    assert measure_columns(stored) == measure_columns(raw)
    picked = dashboard.filter_period(stored, dt.date(2022, 3, 1), dt.date(2022, 3, 1)).select("device_id")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*utc_month", plan)
    assert re.search(r"PushedFilters: \[[^\]]*(GreaterThanOrEqual|LessThan)\(timestamp", plan)
    assert "pm25_raw" not in plan.split("ReadSchema", 1)[1].split(">")[0]
    assert picked.count() == 3


def test_replace_semantics(spark, tmp_path):
    root = str(tmp_path)
    assert not tables.table_exists(spark, root, "t")
    for size in (5, 2):
        tables.write_table(spark.range(size), root, "t")
    assert tables.table_exists(spark, root, "t")
    assert tables.read_table(spark, root, "t").count() == 2


def test_loading_nothing(spark, tmp_path):
    counts = jobs.load(spark, {"kg": str(tmp_path / "none")}, str(tmp_path / "tables")).first()
    assert tuple(counts) == (0, 0, 0, 0)


def test_jobs_in_order(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "tables")
    raw.mkdir()
    start = dt.datetime(2022, 2, 1)
    rows = []
    for device, lat in (("A", "44.0"), ("B", "45.0")):
        for hour in range(24 * 12):
            moment = start + dt.timedelta(hours=hour)
            value = 20 + hour / 24 + 10 * ((hour % 24) / 24) + (200 if hour // 24 == 7 and device == "A" else 0)
            rows.append([device, moment.strftime("%Y-%m-%dT%H:%M:%SZ"), f"{value:.2f}", f"{value * 1.5:.2f}", lat, "20.0"])
    header = ["Device ID", TIME, PM25, PM10, "latitude", "longitude"]
    write(raw / "one.csv", header, *rows)
    write(raw / "two.csv", header, *rows[:50])
    counts = jobs.load(spark, {"kg": str(raw), "national": str(tmp_path / "none")}, root).first()
    assert (counts.n_read, counts.n_duplicates, counts.n_kept) == (626, 50, 576)
    gazetteer = spark.createDataFrame(
        [(1, "Near", "R", "RS", 44.1, 20.1), (2, "North", "R", "RS", 45.1, 20.1)],
        "place_id long, name string, admin1 string, cc string, latitude double, longitude double",
    )
    jobs.locate(spark, gazetteer, root)
    assert {(r.device_id, r.city) for r in tables.read_table(spark, root, "sensors").collect()} == {
        ("A", "Near"),
        ("B", "North"),
    }
    jobs.aggregate(spark, root)
    daily = tables.read_table(spark, root, "daily_city_avg")
    assert daily.columns == ["city", "date", "pm25_raw", "pm10_raw"] and daily.count() == 26
    jobs.describe(spark, root, str(tmp_path / "reports"))
    stats = spark.read.option("header", True).csv(str(tmp_path / "reports" / "descriptive_stats"))
    assert {r.column for r in stats.collect()} == {"pm25_raw", "pm10_raw"}
    checks = jobs.index(spark, root).collect()
    assert {r.status for r in checks} == {"empty"}
    assert tables.read_table(spark, root, "daily_city_aqi").count() == 26
    jobs.find_anomalies(spark, root)
    found = tables.read_table(spark, root, "anomalies")
    assert {(r.city, r.severity) for r in found.where("pm25_raw > 150").collect()} == {("Near", "extreme")}
    assert set(jobs.available_tables(spark, root)) == {
        "measurements", "sensors", "daily_city_avg", "monthly_city_avg", "aqi", "daily_city_aqi", "anomalies",
    }


def test_long_and_quoted_headers_are_read_whole(spark, tmp_path):
    many = [f"Extra {i}" for i in range(12_000)]
    write(tmp_path / "long.csv", ["Device ID", TIME, *many, PM25], ["D1", "2022-03-01T00:00:00+0000", *["x"] * len(many), "7.5"])
    assert (tmp_path / "long.csv").stat().st_size > 150_000
    rows = exports.load_folder(spark, str(tmp_path), "kg", maxColumns="30000").select("timestamp", "pm25_raw", "source_file").collect()
    assert [tuple(r) for r in rows] == [(dt.datetime(2022, 3, 1), 7.5, "long.csv")]


def test_month_folders_are_skipped_through_the_join(spark, tmp_path):
    from hazeframe.operators import fleet

    rows = [("A", dt.datetime(2022, m, 10), 1.0 * m) for m in (1, 2, 3)]
    tables.write_measurements(spark.createDataFrame(rows, "device_id string, timestamp timestamp, pm25_raw double"), str(tmp_path))
    sensors = spark.createDataFrame([("A", "x")], "device_id string, city string")
    joined = fleet.located_readings(tables.read_table(spark, str(tmp_path), "measurements"), sensors, ["pm25_raw"])
    picked = dashboard.filter_period(joined, dt.date(2022, 3, 1), dt.date(2022, 3, 31))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(utc_month" in plan and picked.count() == 1


def test_either_kind_of_model_loads(spark, tmp_path):
    import numpy as np
    from pyspark.ml import Pipeline, PipelineModel

    from hazeframe.learning import models, network, training

    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "a double, target double")
    ridge = models.ridge(df, {"a": 2.0})
    path = str(tmp_path / "best")
    ridge.write().overwrite().save(path)
    assert isinstance(training.load_model(spark, path), PipelineModel)
    preparation = Pipeline(stages=models.scaled_features({"a": 2.0})).fit(df)
    network.NetworkModel(preparation, [1, 1], np.array([1.0, 0.0])).save(path)
    assert isinstance(training.load_model(spark, path), network.NetworkModel)
    ridge.write().overwrite().save(path)
    assert isinstance(training.load_model(spark, path), PipelineModel)
