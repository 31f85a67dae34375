"""Versions of tables and models, files that are read once, rollups that follow the fact table."""

import datetime as dt
import os
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_sources import PM10, PM25, TIME, write

from hazeframe.operators import cleaning, profiles
from hazeframe.plans import ingest, jobs, rollups
from hazeframe.schema import MEASUREMENTS
from hazeframe.sources import exports, tables, versions

HEADER = ["Device ID", TIME, PM25, PM10, "latitude", "longitude"]


def line(device, moment, pm25, pm10="5"):
    return [device, f"{moment}Z", str(pm25), pm10, "44.0", "20.9"]


def test_readers_keep_the_version_they_took(spark, tmp_path):
    root = str(tmp_path)
    tables.write_table(spark.range(5), root, "t", {"rows": 5})
    old = tables.read_table(spark, root, "t")
    # A table may be replaced by what is read from it.
    tables.write_table(old.where("id > 2"), root, "t")
    assert old.count() == 5 and tables.read_table(spark, root, "t").count() == 2
    path = tables.table_path(root, "t")
    assert [v.number for v in versions.history(spark, path)] == [1, 2] and versions.history(spark, path)[0].facts == {"rows": 5}
    assert tables.drop_old_versions(spark, root, "t", keep=2) == 0
    assert tables.drop_old_versions(spark, root, "t") == 1
    assert tables.read_table(spark, root, "t").count() == 2 and len(versions.history(spark, path)) == 1
    tables.write_table(spark.range(0), root, "t")
    assert tables.read_table(spark, root, "t").dtypes == [("id", "bigint")]


def test_a_killed_job_leaves_the_old_table(spark, tmp_path):
    """The child dies in a task of its second write, when another task has already written its rows."""
    root, repo = str(tmp_path / "tables"), str(Path(__file__).resolve().parents[1])
    code = f"""
        import os, signal, sys, time
        sys.path.insert(0, {repo!r})
        from hazeframe.session import get_spark
        from hazeframe.sources import tables
        spark = get_spark("child", "local[2]", **{{"spark.ui.enabled": "false"}})
        tables.write_table(spark.range(100), {root!r}, "t")
        driver = os.getpid()
        def die(batches):
            for batch in batches:
                if batch["id"].min() > 0:
                    time.sleep(4)
                    os.kill(driver, signal.SIGKILL)
                    time.sleep(60)
                yield batch
        tables.write_table(spark.range(0, 100, 1, 2).mapInPandas(die, "id long"), {root!r}, "t")
    """
    child = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, timeout=120)
    assert child.returncode == -9
    folders = versions.matching(spark, f"{root}/t/data/version=*")
    assert len(folders) == 2 and len(versions.history(spark, f"{root}/t")) == 1
    assert tables.read_table(spark, root, "t").count() == 100
    # The next job isn't hindered by what was left; the explicit call removes it.
    tables.write_table(spark.range(7), root, "t")
    assert tables.drop_old_versions(spark, root, "t") == 2 and tables.read_table(spark, root, "t").count() == 7


def test_commits_are_whole_and_one_at_a_time(spark, tmp_path):
    root, path = str(tmp_path), str(tmp_path / "t")
    tables.write_table(spark.range(3), root, "t")
    one, other = versions.Writing(spark, path), versions.Writing(spark, path)
    for writing in (one, other):
        spark.range(4).write.parquet(f"{path}/{writing.folder}")
    one.commit([one.folder])
    with pytest.raises(versions.ConcurrentWrite):
        other.commit([other.folder])
    # A commit file that was cut off counts as none.
    (tmp_path / "t" / "_commits" / "00000003.json").write_text('{"folders": ["data/ver')
    assert versions.current(spark, path).number == 2 and tables.read_table(spark, root, "t").count() == 4
    tables.write_table(spark.range(9), root, "t")
    assert versions.current(spark, path).number == 4 and tables.read_table(spark, root, "t").count() == 9


def test_models_are_replaced_whole(spark, tmp_path):
    from hazeframe.learning import models, training

    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "a double, target double")
    path = str(tmp_path / "best")
    run = training.TargetRun("t", df, df, "Ridge", models.ridge(df, {"a": 2.0}))
    run.save_model(path)
    again = models.ridge(df.withColumn("target", F.col("target") * 2), {"a": 2.0})
    broken = training.TargetRun("t", df, df, "Ridge", None)
    with pytest.raises(AttributeError):
        broken.save_model(path)
    first = training.load_model(spark, path).stages[-1].coefficients[0]
    training.TargetRun("t", df, df, "Ridge", again).save_model(path)
    assert training.load_model(spark, path).stages[-1].coefficients[0] == pytest.approx(2 * first)


def full(spark, folders):
    """What a load of all files gives, in one go."""
    rows = exports.append(*[exports.load_folder(spark, path, label) for label, path in folders.items()])
    counts = tuple(cleaning.stage_counts(rows).first())
    kept = cleaning.deduplicate(cleaning.drop_unusable(rows))
    return sorted(map(str, kept.select(*MEASUREMENTS.names).collect())), counts


def held(spark, root):
    return sorted(map(str, tables.read_table(spark, root, "measurements").select(*MEASUREMENTS.names).collect()))


def test_each_load_equals_a_full_one(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "tables")
    raw.mkdir()
    folders = {"kg": str(raw)}
    where = tables.table_path(root, "measurements")
    write(raw / "a.csv", HEADER, line("D1", "2022-01-05T00:00:00", 1), line("D1", "2022-02-05T00:00:00", 2), ["D1", "no time", "1", "2", "", ""])
    write(raw / "empty.csv", HEADER)

    def check():
        counts = tuple(ingest.load(spark, folders, root).first())
        rows, want = full(spark, folders)
        assert held(spark, root) == rows and counts == want
        return versions.current(spark, where)

    first = check()
    assert len(first.folders) == 2 and check().number == first.number  # nothing new, no new version
    # A new file with readings of February and March, one of them a duplicate that wins.
    write(raw / "b.csv", HEADER[::-1], line("D1", "2022-02-05T00:00:00", 3)[::-1], line("D2", "2022-03-05T00:00:00", 4)[::-1])
    second = check()
    assert first.folders[0] in second.folders and first.folders[1] not in second.folders and len(second.folders) == 3
    # A duplicate that is less complete loses; the file is listed all the same.
    write(raw / "c.csv", HEADER, line("D2", "2022-03-05T00:00:00", "NA"))
    check()
    # Changed and removed files take their rows with them; rows that had lost come back.
    write(raw / "b.csv", HEADER, line("D3", "2022-03-06T00:00:00", 9))
    os.utime(raw / "b.csv", (1, 1))
    third = check()
    assert first.folders[0] in third.folders
    (raw / "a.csv").unlink()
    assert len(check().folders) == 1
    other = tmp_path / "other"
    other.mkdir()
    write(other / "b.csv", HEADER, line("D3", "2022-03-06T00:00:00", 8), line("D4", "9999-12-31T00:00:00", 8))
    folders["national"] = str(other)
    check()
    assert {(r.source_dataset, r.source_file) for r in ingest.file_list(spark, root).collect()} == {
        ("kg", "b.csv"), ("kg", "c.csv"), ("kg", "empty.csv"), ("national", "b.csv"),
    }
    del folders["kg"]
    check()
    (other / "b.csv").unlink()
    assert check().folders == () and tables.read_table(spark, root, "measurements").count() == 0


def test_only_changed_files_are_parsed(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "tables")
    raw.mkdir()
    for i in range(4):
        write(raw / f"{i}.csv", HEADER, line("D1", f"2022-0{i + 1}-05T00:00:00", i))
    folders = {"kg": str(raw)}
    ingest.load(spark, folders, root)
    write(raw / "new.csv", HEADER, line("D1", "2022-04-06T00:00:00", 7))
    fresh = ingest.changes(spark, folders, root).where("state <> 'same'")
    files = ingest.parsed(spark, folders, fresh).inputFiles()
    assert [f.rsplit("/", 1)[1] for f in files] == ["new.csv"]


def test_counts_survive_tasks_that_run_twice(spark, tmp_path):
    """A task of the load fails after its rows were read, and is run again."""
    script = f"""
        import sys
        sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
        from hazeframe.plans import ingest
        from hazeframe.session import get_spark
        from pyspark import TaskContext
        spark = get_spark("child", "local[2,3]", **{{"spark.ui.enabled": "false"}})
        whole = ingest.parsed
        def fails_once(batches):
            yield from batches
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost")
        ingest.parsed = lambda *a, **b: (lambda df: df.mapInPandas(fails_once, df.schema))(whole(*a, **b))
        print("COUNTS", *ingest.load(spark, {{"kg": {str(tmp_path / "raw")!r}}}, {str(tmp_path / "tables")!r}).first())
    """
    (tmp_path / "raw").mkdir()
    rows = [line("D1", f"2022-01-05T{h:02}:00:00", h) for h in range(20)]
    write(tmp_path / "raw" / "a.csv", HEADER, *rows, *rows[:5], ["D1", "", "1", "2", "", ""])
    child = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, timeout=180, text=True)
    assert "COUNTS 26 1 5 20" in child.stdout, child.stderr[-2000:]
    assert "lost" in child.stderr


@pytest.fixture
def stored(spark, tmp_path):
    """Three months of readings of three devices, and their sensors."""
    root = str(tmp_path / "tables")
    start = dt.datetime(2022, 1, 1)
    rows = [(f"D{i % 3}", start + dt.timedelta(minutes=37 * i), float(i % 11), None if i % 5 else float(i)) for i in range(3400)]
    readings = spark.createDataFrame(rows, "device_id string, timestamp timestamp, pm25_raw double, pm10_raw double")
    tables.write_measurements(readings, root)
    sensors = spark.createDataFrame([("D0", "x"), ("D1", "x"), ("D2", None)], "device_id string, city string")
    return root, readings, sensors


def same(left, right):
    rows = lambda df: sorted((tuple(round(c, 9) if isinstance(c, float) else c for c in r) for r in df.collect()), key=str)
    return rows(left) == rows(right)


def test_rollups_from_partial_sums_equal_those_from_readings(spark, stored):
    root, readings, sensors = stored
    assert rollups.refresh(spark, root) == ["2021-12-01", "2022-01-01", "2022-02-01", "2022-03-01"][1:]
    sums = tables.read_table(spark, root, rollups.STATE)
    both = ["pm25_raw", "pm10_raw"]
    assert same(rollups.rollup(sums, sensors, both, "date"), profiles.daily_city_avg(readings, sensors, both))
    assert same(rollups.rollup(sums, sensors, both, "month"), profiles.monthly_city_avg(readings, sensors, both))
    assert same(rollups.rollup(sums, sensors, both, "hour", by_city=False), profiles.diurnal_pattern(readings, sensors, both))
    assert same(rollups.rollup(sums, sensors, both, "hour"), profiles.city_diurnal(readings, sensors, both))
    assert same(rollups.rollup(sums, sensors, both, "weekday", by_city=False), profiles.weekly_pattern(readings, sensors, both))
    assert same(rollups.rollup(sums, sensors, both), profiles.city_ranking(readings, sensors, both))


def test_a_refresh_reads_the_changed_month_only(spark, stored):
    root, readings, sensors = stored
    rollups.refresh(spark, root)
    assert rollups.refresh(spark, root) == []
    february = readings.where("month(timestamp) = 2 AND pm25_raw > 3")
    tables.write_measurements(february, root, months=["2022-02-01"])
    fresh, gone = rollups.stale_months(spark, root)
    files = rollups.fresh_readings(spark, root, fresh).inputFiles()
    assert gone == [] and files and all("utc_month=2022-02-01" in f for f in files)
    assert rollups.refresh(spark, root) == ["2022-02-01"]
    sums = tables.read_table(spark, root, rollups.STATE)
    now = tables.read_table(spark, root, "measurements")
    assert same(rollups.rollup(sums, sensors, ["pm25_raw"], "date"), profiles.daily_city_avg(now, sensors, ["pm25_raw"]))
    # A month without readings leaves the state.
    tables.write_measurements(readings.where("month(timestamp) = 1"), root)
    rollups.refresh(spark, root)
    assert {str(r.utc_month) for r in tables.read_table(spark, root, rollups.STATE).select("utc_month").distinct().collect()} == {"2022-01-01"}


def test_aggregates_of_an_empty_table(spark, tmp_path):
    root = str(tmp_path)
    jobs.load(spark, {"kg": str(tmp_path / "none")}, root)
    tables.write_table(spark.createDataFrame([], "device_id string, city string"), root, "sensors")
    jobs.aggregate(spark, root)
    assert tables.read_table(spark, root, "daily_city_avg").count() == 0
    assert jobs.drop_old(spark, root) == 0
