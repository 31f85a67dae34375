"""Column expressions: index edges, calendar, nullable arithmetic."""

import datetime as dt
import math

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazeframe.functions import air_index, clock, numeric
from hazeframe.operators import statistics

# Concentration -> index at both edges of every band, cuts, overflow, no value.
EDGES = {
    "pm25": {
        0.0: 0, 12.0: 50, 12.09: 50, 12.1: 51, 35.4: 100, 35.49: 100, 35.5: 101, 55.4: 150, 55.5: 151,
        150.4: 200, 150.5: 201, 250.4: 300, 250.5: 301, 350.4: 400, 350.5: 401, 500.4: 500, 500.5: 500,
        9999.0: 500, -0.1: None, -5.0: None, 6.0: 25,
    },
    "pm10": {
        0.0: 0, 54.0: 50, 54.9: 50, 55.0: 51, 154.0: 100, 155.0: 101, 254.0: 150, 255.0: 151, 354.0: 200,
        355.0: 201, 424.0: 300, 425.0: 301, 504.0: 400, 505.0: 401, 604.0: 500, 604.9: 500, 605.0: 500, -1.0: None,
    },
    "no2": {
        0.0: 0, 53.0: 50, 53.9: 50, 54.0: 51, 100.0: 100, 101.0: 101, 360.0: 150, 361.0: 151, 649.0: 200,
        650.0: 201, 1249.0: 300, 1250.0: 301, 1649.0: 400, 1650.0: 401, 2049.0: 500, 2050.0: 500, -0.5: None,
    },
}


def apply(spark, values, expression, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression.alias("out")).collect()]


@pytest.mark.parametrize("pollutant", EDGES)
def test_index_edges(spark, pollutant):
    cases = {**EDGES[pollutant]}
    got = apply(spark, [*cases, None], air_index.concentration_to_aqi("v", pollutant))
    assert got == [*cases.values(), None]


def test_index_grows_with_concentration(spark):
    values = [n / 20 for n in range(0, 12100)]
    for pollutant in EDGES:
        got = apply(spark, values, air_index.concentration_to_aqi("v", pollutant))
        assert None not in got and got == sorted(got)


def test_categories_and_marker_colours(spark):
    values = [0.0, 50.0, 50.5, 51.0, 150.0, 200.0, 201.0, 300.0, 301.0, 500.0, 501.0, None]
    assert apply(spark, values, air_index.aqi_category("v")) == [
        "Good", "Good", None, "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy",
        "Very Unhealthy", "Hazardous", "Hazardous", None, None,
    ]
    good, moderate, top, grey = "#00e400", "#ffff00", "#7e0023", "#999999"
    colours = apply(spark, [50.0, 50.5, 300.5, None], air_index.marker_color("v"))
    assert colours == [good, moderate, top, grey]


def test_dominant_ties_and_missing(spark):
    rows = [(50.0, 50.0, 10.0), (None, 7.0, 7.0), (None, None, 3.0), (None, None, None)]
    df = spark.createDataFrame(rows, "pm25 double, pm10 double, no2 double").coalesce(1)
    columns = {c: F.col(c) for c in df.columns}
    got = df.select(air_index.overall(columns), air_index.dominant(columns)).collect()
    assert [tuple(r) for r in got] == [(50.0, "pm25"), (7.0, "pm10"), (3.0, "no2"), (None, None)]


def test_clock_changes(spark):
    moments = [
        dt.datetime(2022, 3, 27, 0, 30),
        dt.datetime(2022, 3, 27, 1, 30),
        dt.datetime(2022, 10, 30, 0, 10),
        dt.datetime(2022, 10, 30, 1, 10),
        dt.datetime(2022, 12, 31, 23, 30),
    ]
    local = clock.local_time("v")
    fields = F.struct(F.hour(local), clock.local_date("v"), clock.local_month("v"), clock.weekday_name("v"))
    got = [tuple(r) for r in apply(spark, moments, fields, "timestamp")]
    assert got == [
        (1, dt.date(2022, 3, 27), "2022-03", "Sunday"),
        (3, dt.date(2022, 3, 27), "2022-03", "Sunday"),
        (2, dt.date(2022, 10, 30), "2022-10", "Sunday"),
        (2, dt.date(2022, 10, 30), "2022-10", "Sunday"),
        (0, dt.date(2023, 1, 1), "2023-01", "Sunday"),
    ]
    assert clock.day_start_utc(dt.date(2022, 7, 1)) == dt.datetime(2022, 6, 30, 22, tzinfo=dt.timezone.utc)
    assert clock.day_start_utc(dt.date(2022, 1, 1)) == dt.datetime(2021, 12, 31, 23, tzinfo=dt.timezone.utc)


def test_calendar_flags(spark):
    moments = [dt.datetime(2022, m, 15, 12) for m in range(1, 13)]
    flags = apply(spark, moments, clock.is_heating_season("v"), "timestamp")
    assert flags == [1, 1, 1, 0, 0, 0, 0, 0, 0, 1, 1, 1]
    week = [dt.datetime(2022, 8, d, 12) for d in range(1, 8)]
    assert apply(spark, week, clock.local_weekday("v"), "timestamp") == list(range(7))
    assert apply(spark, week, clock.is_weekend("v"), "timestamp") == [0, 0, 0, 0, 0, 1, 1]
    assert apply(spark, week[:1], clock.iso_utc("v"), "timestamp") == ["2022-08-01T12:00:00Z"]


def test_numbers_from_text(spark):
    texts = ["1.5", " 2 ", "NaN", "abc", "", None, "-3e2"]
    assert apply(spark, texts, numeric.to_number("v"), "string") == [1.5, 2.0, None, None, None, None, -300.0]
    assert apply(spark, [math.nan, 1.0], numeric.to_number("v")) == [None, 1.0]


def test_half_even(spark):
    assert apply(spark, [0.5, 1.5, 2.5], numeric.half_even("v", 0)) == [0.0, 2.0, 2.0]
    assert apply(spark, [0.25, 0.35], numeric.half_even("v", 1)) == [0.2, 0.4]


def test_skewness_and_correlation_guards(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (7.0, 5.0), (9.5, 5.0)], "a double, b double")
    row = df.agg(numeric.sample_skewness("a"), numeric.sample_skewness("b"), numeric.pearson("a", "b")).first()
    assert row[0] == pytest.approx(0.26689, abs=1e-5) and row[1] == 0.0 and row[2] is None
    assert df.limit(2).agg(numeric.sample_skewness("a")).first()[0] is None


def test_skewness_of_tiny_values(spark):
    for values in ([1e-120, 2e-120, 9e-120], [0.0, 1e-300, 0.0, 0.0], [1e-40, 1.0000000000000002e-40, 1e-40]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        assert df.agg(numeric.sample_skewness("v")).first()[0] == 0.0
        assert statistics.descriptive_stats(df, ["v"]).first().skew == 0.0


def test_missing_comparisons_count_as_false(spark):
    got = apply(spark, [None, 1.0, 5.0], numeric.any_true(F.col("v") > 3, F.col("v") < 0))
    assert got == [False, False, True]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-10**8, 10**8).map(lambda i: i / 100)), min_size=3, max_size=60))
def test_skewness_equals_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.agg(numeric.sample_skewness("v")).first()[0]
    want = pd.Series(values, dtype=float).skew()
    assert (got is None and pd.isna(want)) or got == pytest.approx(want, abs=1e-6)


def test_numbers_are_tested_as_text_only_where_they_are_text(spark):
    from hazeframe.functions.numeric import to_number

    texts = ["12f", "12d", "1.5", " 7 ", "1e3", "inf", "x", "", None, "0x1F", "NaN"]
    text = spark.createDataFrame([(t,) for t in texts], "x string").select(to_number("x").alias("n"))
    assert [r.n for r in text.collect()] == [None, None, 1.5, 7.0, 1000.0, float("inf"), None, None, None, None, None]
    assert "RLIKE" in text._jdf.queryExecution().executedPlan().toString()
    for kind in ("double", "float", "int", "decimal(10,2)"):
        plain = spark.range(3).selectExpr(f"cast(id as {kind}) x").select(to_number("x").alias("n"))
        assert [r.n for r in plain.collect()] == [0.0, 1.0, 2.0]
        assert "RLIKE" not in plain._jdf.queryExecution().executedPlan().toString()


def test_measurement_columns_are_read_as_numbers(spark, small):
    """The plans of the heavy profiles hold no text work."""
    from hazeframe.registry.queries import QUERIES

    for name in ("daily_city_avg", "corr_matrix", "histogram"):
        assert "RLIKE" not in QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()


def test_checkpoints_of_a_piece_of_work_are_released(spark):
    from pathlib import Path

    from hazeframe.session import cut_lineage, ensure_checkpoint_dir, released_checkpoints

    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    stays = cut_lineage(spark.range(5))
    before = set(folder.iterdir())
    with released_checkpoints(spark):
        assert cut_lineage(cut_lineage(spark.range(7))).count() == 7
        assert len(set(folder.iterdir()) - before) == 2
    assert set(folder.iterdir()) == before and stays.count() == 5
