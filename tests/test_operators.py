"""Operators on rows written by hand, and against pandas, numpy or brute force."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazeframe.functions.numeric import by_label_order, to_number
from hazeframe.operators import (
    air_quality,
    anomalies,
    cleaning,
    dashboard,
    fleet,
    profiles,
    quantiles,
    statistics,
    timeseries,
)
from hazeframe.operators import geo
from hazeframe.operators.geo import nearest_settlement
from hazeframe.session import cut_lineage

T0 = dt.datetime(2022, 3, 1)


def readings(spark, rows, columns="pm25_raw double"):
    return spark.createDataFrame(rows, f"device_id string, timestamp timestamp, {columns}")


def sensor_table(spark, *rows):
    return spark.createDataFrame(list(rows), "device_id string, city string")


# --- cleaning ---


def test_most_complete_reading_wins(spark):
    rows = [("D", T0, None, 1.0, "b"), ("D", T0, 2.0, 3.0, "a"), ("D", T0, 4.0, 5.0, "a2"), ("E", T0, None, None, "z")]
    df = readings(spark, rows, "pm25_raw double, pm10_raw double, source_file string")
    kept = cleaning.deduplicate(df)
    got = {(r.device_id, r.pm25_raw, r.source_file) for r in kept.collect()}
    assert got == {("D", 2.0, "a"), ("E", None, "z")}
    assert cleaning.deduplicate(kept).count() == kept.count()
    shuffled = df.orderBy(F.desc("source_file"))
    assert {(r.device_id, r.pm25_raw, r.source_file) for r in cleaning.deduplicate(shuffled).collect()} == got


def test_one_hot_key_is_cut_down_before_the_shuffle(spark):
    device = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 1000).cast("string"))
    hot = spark.range(200_000).select(
        device.alias("device_id"), F.lit(T0).alias("timestamp"), F.col("id").alias("v")
    )
    kept = cleaning.deduplicate(hot, tie_break=["v"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert kept.count() == 1001 and kept.where("device_id = 'hot'").first().v == 0


def test_empty_columns(spark):
    df = readings(spark, [("D", T0, None, 1.0, None)], "pm25_raw double, pm10_raw double, source_file string")
    assert cleaning.empty_columns(df) == ["pm25_raw"]
    assert cleaning.drop_empty_columns(df).columns == ["device_id", "timestamp", "pm10_raw", "source_file"]


# --- fleet ---


def test_latest_place_and_moves(spark):
    rows = [
        ("D", T0, 44.0, 20.0),
        ("D", T0 + dt.timedelta(hours=1), 45.0, 21.0),
        ("D", T0 + dt.timedelta(hours=2), None, 21.0),
        ("E", T0, None, None),
    ]
    df = readings(spark, rows, "latitude double, longitude double")
    latest = {r.device_id: (r.latitude, r.longitude) for r in fleet.sensor_coordinates(df).collect()}
    assert latest == {"D": (45.0, 21.0), "E": (None, None)}
    assert fleet.sensor_coordinates(df, keep_moves=True).count() == 4
    places = spark.createDataFrame(
        [(1, "P", "A", "C", 45.0, 21.0)],
        "place_id long, name string, admin1 string, cc string, latitude double, longitude double",
    )
    cities = {r.device_id: r.city for r in fleet.build_sensors(df, places).collect()}
    assert cities == {"D": "P", "E": None}


def test_salted_join_gives_the_same_rows(spark):
    hot = [("A" if i % 3 else "B", T0 + dt.timedelta(minutes=i), float(i)) for i in range(500)]
    df = readings(spark, hot)
    sensors = sensor_table(spark, ("A", "x"), ("B", "y"), ("C", "z"))
    plain = sorted(map(tuple, fleet.join_sensors(df, sensors).collect()))
    salted = sorted(map(tuple, fleet.join_sensors(df, sensors, salt=8).collect()))
    assert plain == salted and len(plain) == 500


def test_readings_weigh_equally_and_null_cities_drop_out(spark):
    rows = [("A", T0, 1.0), ("A", T0, 2.0), ("A", T0, None), ("B", T0, 9.0), ("C", T0, 5.0), ("X", T0, 7.0)]
    sensors = sensor_table(spark, ("A", "x"), ("B", "x"), ("C", None))
    daily = profiles.daily_city_avg(readings(spark, rows), sensors, ["pm25_raw"])
    assert [(r.city, r.pm25_raw) for r in daily.collect()] == [("x", 4.0)]
    # The profile over all sensors keeps devices without a city, but not unknown ones.
    hours = profiles.diurnal_pattern(readings(spark, rows), sensors, ["pm25_raw"])
    assert [(r.hour, r.pm25_raw) for r in hours.collect()] == [(1, 17.0 / 4)]


def test_raw_rows_are_reduced_before_the_sensor_join(spark, medium):
    from hazeframe import fixtures as fx

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        daily = profiles.daily_city_avg(fx.readings(spark, medium), fx.sensors(spark, medium), ["pm25_raw"])
        plan = daily._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        join = plan[plan.index("SortMergeJoin") :]
        assert "sum_pm25_raw" in join.split("\n")[1] + join.split("\n")[2] + join.split("\n")[3]
        assert daily.count() == 216
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- nearest settlement ---


def _points(n, seed, spread):
    rng = np.random.default_rng(seed)
    if spread == "globe":
        return list(zip(np.degrees(np.arcsin(rng.uniform(-1, 1, n))).tolist(), rng.uniform(-180, 180, n).tolist()))
    return list(zip((44 + rng.normal(0, 0.02, n)).tolist(), (20 + rng.normal(0, 0.02, n)).tolist()))


@pytest.mark.parametrize("place_spread", ["globe", "town"])
def test_nearest_settlement_equals_brute_force(spark, place_spread):
    places = _points(300, 1, place_spread)
    spots = [
        *_points(150, 2, "globe"), *_points(60, 3, "town"), (90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0),
        (10.0, 179.99), places[5],
    ]
    gazetteer = spark.createDataFrame(
        [(i, f"p{i}", "a", "c", *p) for i, p in enumerate(places)],
        "place_id long, name string, admin1 string, cc string, latitude double, longitude double",
    )
    found = nearest_settlement(spark.createDataFrame(spots, "latitude double, longitude double").distinct(), gazetteer)
    got = {(r.latitude, r.longitude): (r.place_id, r.distance_km) for r in found.collect()}
    assert len(got) == len(set(spots))
    for lat, lon in spots:
        distances = [_haversine(lat, lon, *p) for p in places]
        place, km = got[lat, lon]
        assert km == pytest.approx(min(distances), abs=1e-5)
        assert distances[place] == pytest.approx(min(distances), abs=1e-5)


def test_a_far_cluster_is_not_measured_whole(spark, monkeypatch):
    rng = np.random.default_rng(4)
    lat, lon = 44 + rng.uniform(0, 0.5, 20_000), 20 + rng.uniform(0, 0.5, 20_000)
    spots = [(45.8 + i / 1000, 22.0 + i / 500) for i in range(50)]
    schema = "place_id long, name string, admin1 string, cc string, latitude double, longitude double"
    rows = pd.DataFrame({"place_id": range(20_000), "name": "p", "admin1": "a", "cc": "c", "latitude": lat, "longitude": lon})
    most, thinned = [], geo._thinned

    def watched(cubes, occupied):
        kept = thinned(cubes, occupied)
        most.append(kept.groupBy("latitude", "longitude").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0])
        return kept

    monkeypatch.setattr(geo, "_thinned", watched)
    found = nearest_settlement(spark.createDataFrame(spots, "latitude double, longitude double"), spark.createDataFrame(rows, schema))
    got = {(r.latitude, r.longitude): r.place_id for r in found.collect()}
    for spot in spots:
        distances = [_haversine(*spot, *place) for place in zip(lat, lon)]
        assert distances[got[spot]] == pytest.approx(min(distances), abs=1e-6)
    assert most[0] <= geo.MOST


def _haversine(lat_a, lon_a, lat_b, lon_b):
    lat_a, lon_a, lat_b, lon_b = map(math.radians, (lat_a, lon_a, lat_b, lon_b))
    h = math.sin((lat_b - lat_a) / 2) ** 2 + math.cos(lat_a) * math.cos(lat_b) * math.sin((lon_b - lon_a) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(h, 1.0)))


def test_equal_distances_and_shared_spots_go_to_the_first_id(spark):
    gazetteer = spark.createDataFrame(
        [(7, "g", "a", "c", 1.0, 0.0), (3, "b", "a", "c", -1.0, 0.0), (2, "z", "a", "c", 1.0, 0.0), (9, "n", "a", "c", None, 0.0)],
        "place_id long, name string, admin1 string, cc string, latitude double, longitude double",
    )
    spots = spark.createDataFrame([(0.0, 0.0), (2.0, 0.0), (None, 1.0)], "latitude double, longitude double")
    got = {r.latitude: r.name for r in nearest_settlement(spots, gazetteer).collect()}
    assert got == {0.0: "z", 2.0: "z"}


# --- statistics ---


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    n = 4000
    pdf = pd.DataFrame(
        {
            "a": rng.lognormal(3, 2, n),
            "b": rng.integers(0, 7, n).astype(float),
            "c": np.where(rng.random(n) < 0.3, np.nan, rng.normal(0, 1, n)),
            "d": np.full(n, 2.5),
            "e": np.full(n, np.nan),
        }
    )
    pdf.loc[0, "a"] = 1e300
    pdf.loc[1, "a"] = -1e200
    pdf["f"] = pdf["c"] * 2 + rng.normal(0, 1, n)
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    return pdf, df.repartition(5)


def test_quantiles_equal_numpy(spark, table):
    pdf, df = table
    probabilities = [0.0, 0.001, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    got = {(r.column, r.probability): r.value for r in quantiles.exact_quantiles(df, list(pdf), probabilities).collect()}
    assert len(got) == 5 * len(probabilities)
    for column in "abcdf":
        for p in probabilities:
            assert got[column, p] == pytest.approx(pdf[column].quantile(p), rel=1e-12), (column, p)


def test_quantiles_shuffle_only_narrow_segments(spark, monkeypatch):
    df = spark.range(300_000).select((F.xxhash64("id") / 1e12).alias("v"))
    want = df.toPandas()["v"].quantile([0.25, 0.5]).tolist()
    result = quantiles.exact_quantiles(df, ["v"], [0.25, 0.5])
    assert [r.value for r in result.orderBy("probability").collect()] == pytest.approx(want, rel=1e-12)
    # The answer does not depend on how good the sketch is.
    monkeypatch.setattr(quantiles, "SKETCH", 8)
    rough = quantiles.exact_quantiles(df, ["v"], [0.25, 0.5])
    assert [r.value for r in rough.orderBy("probability").collect()] == pytest.approx(want, rel=1e-12)


def test_quantiles_cut_crowded_segments_again(spark, monkeypatch):
    one = spark.createDataFrame([(1e300,)], "v double")
    df = cut_lineage(spark.range(100_000, numPartitions=4).select(F.rand(1).alias("v")).unionByName(one))
    probabilities = [0.25, 0.5, 0.9999, 1.0]
    want = df.toPandas()["v"].quantile(probabilities).tolist()
    windows, narrowed = [], quantiles._narrowed

    def watched(inside, most):
        rows = narrowed(inside, most)
        windows.append(rows.groupBy("position", "rank").count().agg(F.max("count")).first()[0])
        return rows

    monkeypatch.setattr(quantiles, "_narrowed", watched)
    monkeypatch.setattr(quantiles, "WINDOW", 30)
    got = quantiles.exact_quantiles(df, ["v"], probabilities).orderBy("probability").collect()
    assert [r.value for r in got] == pytest.approx(want, rel=1e-12)
    assert windows and windows[0] <= 30


def test_describe_equals_pandas(spark, table):
    pdf, df = table
    pdf, df = pdf.iloc[2:], df.where("a BETWEEN -1e100 AND 1e100")
    got = {r.column: r for r in statistics.descriptive_stats(df, list(pdf)).collect()}
    want = pdf.describe().T
    for c in "abcdf":
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert got[c][ours] == pytest.approx(want.loc[c, theirs], abs=1e-9, rel=1e-9)
        assert got[c].skew == pytest.approx(pdf[c].skew(), rel=1e-9)
    assert got["e"]["count"] == 0 and got["e"]["mean"] is None and got["e"].missing_pct == 100.0
    assert got["c"].missing_pct == pytest.approx(pdf["c"].isna().mean() * 100)


def test_outliers_equal_pandas(spark, table):
    pdf, df = table
    got = {r.column: r.outlier_pct for r in statistics.iqr_outliers(df, list(pdf)).collect()}
    for c in "abcdf":
        s = pdf[c].dropna()
        q1, q3 = s.quantile([0.25, 0.75])
        reach = 1.5 * (q3 - q1)
        assert got[c] == pytest.approx(((s < q1 - reach) | (s > q3 + reach)).mean() * 100)
    assert got["e"] is None
    assert next(iter(got)) == "a"


def test_histogram_equals_numpy(spark, table):
    pdf, df = table
    got = statistics.histogram(df, ["b", "c", "d", "e"]).toPandas()
    assert set(got["column"]) == {"b", "c", "d"}
    for c in "bcd":
        counts, edges = np.histogram(pdf[c].dropna(), bins=40)
        part = got[got["column"] == c].sort_values("bin")
        assert part["n"].tolist() == counts.tolist()
        np.testing.assert_allclose(part["left"], edges[:-1], atol=1e-12)
        np.testing.assert_allclose(part["right"], edges[1:], atol=1e-12)


def test_extreme_magnitudes_do_not_fail(spark):
    rows = [(1e17, 1e-200, 1e-200), (1e17, 2e-200, 3e-200), (1e17, 4e-200, 4e-200)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    counts = statistics.histogram(df, ["a", "b"]).groupBy("column").agg(F.sum("n").alias("n"))
    assert {(r.column, r.n) for r in counts.collect()} == {("a", 3), ("b", 3)}
    assert statistics.correlation_pairs(df, ["a", "b", "c"]).where("corr > 1 OR corr < -1").count() == 0
    assert statistics.iqr_outliers(df, ["a", "b"]).count() == 2


def test_correlations_equal_pandas(spark, table):
    pdf, df = table
    columns = ["b", "c", "d", "e", "f"]
    got = statistics.correlation_matrix(df, columns).toPandas().pivot(index="col_a", columns="col_b", values="corr")
    want = pdf[columns].corr()
    np.testing.assert_allclose(got.loc[columns, columns].astype(float), want, atol=1e-9)
    top = statistics.strongest_pair(statistics.correlation_pairs(df, columns)).first()
    assert (top.col_a, top.col_b) == ("c", "f")


def test_columns_constant_where_the_other_is_present(spark):
    pdf = pd.DataFrame({"x": np.arange(1000) * 0.1 + 3, "y": np.full(1000, np.nan), "z": np.nan, "w": 1e9 + np.arange(1000)})
    pdf.loc[[7, 8], "y"] = [1.0, 2.0]
    pdf.loc[::2, "z"] = 5.7
    df = spark.createDataFrame(pdf).replace(float("nan"), None).repartition(3)
    got = statistics.correlation_matrix(df, list(pdf)).toPandas().pivot(index="col_a", columns="col_b", values="corr")
    assert got.loc["x", "w"] == pytest.approx(1.0) and got.loc["x", "y"] == pytest.approx(1.0)
    assert pd.isna(got.loc["x", "z"]) and pd.isna(got.loc["z", "z"]) and got.loc["y", "y"] == 1.0
    only = df.select("x", F.when(F.col("x") == 3.0, 1.0).alias("y"))
    assert statistics.correlation_pairs(only, ["x", "y"]).first().corr is None


def test_fit_equals_numpy(spark, table):
    pdf, df = table
    paired = pdf[["c", "f"]].dropna()
    fit = statistics.paired_fit(df, "c", "f")
    slope, intercept = np.polyfit(paired["c"], paired["f"], 1)
    row = fit.first()
    assert (row.n, row.strength) == (len(paired), "strong")
    assert (row.slope, row.intercept) == pytest.approx((slope, intercept))
    line = statistics.fit_line(fit).toPandas()
    np.testing.assert_allclose(line["x"], np.linspace(paired["c"].min(), paired["c"].max(), 50))
    np.testing.assert_allclose(line["y"], np.polyval([slope, intercept], line["x"]))


@pytest.mark.parametrize("size", [10, 1000, 10_000])
def test_sample_has_the_smallest_hashes(spark, size):
    df = spark.range(6000).select("id", F.col("id").cast("double").alias("x"), F.when(F.col("id") % 3 > 0, 1.0).alias("y"))
    first = statistics.sampled_pairs(df, "x", "y", ["id"], size)
    second = statistics.sampled_pairs(df.repartition(7), "x", "y", ["id"], size)
    ids = [r.id for r in first.collect()]
    assert ids == [r.id for r in second.collect()]
    assert len(set(ids)) == min(size, 4000) and all(i % 3 for i in ids)
    ranked = df.where("y IS NOT NULL").orderBy(F.md5(F.concat_ws(":", F.lit("42"), F.col("id").cast("string")))).limit(size)
    assert ids == [r.id for r in ranked.collect()]


# --- profiles ---


def test_peaks_take_the_first_of_equals(spark):
    profile = spark.createDataFrame([(0, 1.0, None), (1, 3.0, None), (2, 3.0, None)], "hour int, a double, b double")
    assert [tuple(r) for r in profiles.peaks(profile, "hour", ["a", "b"]).collect()] == [("a", 1, 3.0)]


def test_contrasts_are_means_of_means(spark):
    months = [("2022-01", 10.0), ("2022-02", 20.0), ("2022-06", 5.0), ("2022-07", None), ("2022-10", 99.0)]
    row = profiles.season_contrast(spark.createDataFrame(months, "month string, pm25_raw double")).first()
    assert tuple(row) == (15.0, 5.0, 3.0)
    winter = spark.createDataFrame(months[:2], "month string, pm25_raw double")
    assert tuple(profiles.season_contrast(winter).first()) == (15.0, None, None)
    days = spark.createDataFrame([("Monday", 10.0), ("Friday", 20.0), ("Sunday", 10.0)], "weekday string, pm25_raw double")
    assert tuple(profiles.weekend_contrast(days).first()) == (15.0, 10.0, 50.0)


def test_counts(spark):
    df = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", "p"), (None, "p"), ("x", None)], "city string, label string")
    assert [tuple(r) for r in profiles.value_counts(df, "label").collect()] == [("p", 3), ("q", 1)]
    assert (None, 1) in [tuple(r) for r in profiles.value_counts(df, "label", keep_nulls=True).collect()]
    assert [tuple(r) for r in profiles.pair_counts(df, "city", "label").collect()] == [("x", "p", 1), ("x", "q", 1), ("y", "p", 1)]
    assert tuple(profiles.distinct_counts(df, ["city", "label"]).first()) == (2, 2)
    assert tuple(profiles.distinct_counts(df, ["city"], accuracy=0.05).first()) == (2,)


def test_label_order(spark):
    df = spark.createDataFrame([("b",), ("zzz",), ("a",), (None,)], "x string")
    assert [r.x for r in df.orderBy(by_label_order("x", ("b", "a"))).collect()][:2] == ["b", "a"]


def test_extremes_and_ranking(spark):
    rows = [("A", T0, 4.0), ("B", T0, 1.0), ("C", T0, None), ("D", T0, 4.0)]
    sensors = sensor_table(spark, ("A", "y"), ("B", "z"), ("C", "w"), ("D", "b"))
    ranking = profiles.city_ranking(readings(spark, rows), sensors)
    assert [r.city for r in ranking.collect()] == ["b", "y", "z", "w"]
    assert tuple(profiles.city_extremes(ranking).first()) == ("b", 4.0, "z", 1.0, 4.0, 1)


# --- index ---


def test_index_falls_back_to_the_hourly_value(spark):
    schema = "pm25_raw double, pm25_24h_raw double, pm10_raw double, pm10_24h_raw double, no2_raw double"
    rows = [("A", T0, 12.0, None, 54.0, 154.0, None), ("A", T0, None, None, None, None, None)]
    aqi = air_quality.reading_aqi(readings(spark, rows, schema), sensor_table(spark, ("A", "x")))
    got = {tuple(r)[3:] for r in aqi.collect()}
    assert got == {(50.0, 100.0, None, 100.0, "pm10", "Moderate"), (None, None, None, None, None, None)}
    day = air_quality.daily_city_aqi(aqi).first()
    assert (day.date, day.aqi, day.aqi_category) == (dt.date(2022, 3, 1), 100.0, "Moderate")


def test_cross_check_without_overlap(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0)], "a double, b double")
    row = air_quality.cross_check(df, {"x": ("a", "b")}).first()
    assert (row.n_compared, row.mae, row.status) == (0, None, "empty")


def test_shares_of_an_empty_table(spark):
    empty = spark.createDataFrame([(None,)], "aqi_category string")
    assert air_quality.category_share(empty).count() == 0
    assert air_quality.unhealthy_share(empty).first()[0] is None
    assert tuple(air_quality.top_dominant(empty, "aqi_category").first()) == (None, None)


# --- time series ---


def test_grid_fills_every_hour(spark):
    rows = [("A", T0, 1.0), ("A", T0 + dt.timedelta(minutes=30), 3.0), ("A", T0 + dt.timedelta(hours=3), 5.0), ("B", T0, 7.0)]
    grid = timeseries.hourly_grid(readings(spark, rows), sensor_table(spark, ("A", "x"), ("B", "y")), ["pm25_raw"])
    got = [(r.device_id, r.timestamp.hour, r.pm25_raw) for r in grid.orderBy("device_id", "timestamp").collect()]
    assert got == [("A", 0, 2.0), ("A", 1, None), ("A", 2, None), ("A", 3, 5.0), ("B", 0, 7.0)]


def test_a_moved_sensor_has_a_grid_per_city(spark):
    rows = [("A", T0, 1.0), ("A", T0 + dt.timedelta(hours=2), 3.0)]
    sensors = sensor_table(spark, ("A", "x"), ("A", "y"), ("A", None))
    grid = timeseries.hourly_grid(readings(spark, rows), sensors, ["pm25_raw"])
    got = [(r.city, r.timestamp.hour, r.pm25_raw) for r in grid.orderBy("city", "timestamp").collect()]
    assert got == [(c, h, v) for c in "xy" for h, v in ((0, 1.0), (1, None), (2, 3.0))]


def test_features_are_partitioned_once_by_device_and_month(spark, medium):
    from hazeframe import fixtures as fx
    from hazeframe.learning.dataset import build_dataset

    data = build_dataset(fx.readings(spark, medium), fx.sensors(spark, medium))
    data.collect()
    plan = data._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    above_join = final[: final.index("Join")]
    # By device for the successor of each reading, by device and month for all windows over the grid.
    assert above_join.count("Exchange hashpartitioning(device_id") == 2
    assert above_join.count("Exchange hashpartitioning(device_id#") - above_join.count("_part#") <= 1
    assert above_join.count("Window [") == 2


def test_a_reading_far_away_makes_no_long_rows(spark):
    """Two readings 80 years apart: no row is extended by more than a month, and many tasks share the hours."""
    rows = [("A", dt.datetime(2020, 1, 1), 1.0), ("A", dt.datetime(2100, 1, 1), 2.0)]
    pair = readings(spark, rows), sensor_table(spark, ("A", "x"))
    grid = timeseries.hourly_grid(*pair, ["pm25_raw"])
    hours = int((rows[1][1] - rows[0][1]).total_seconds() // 3600) + 1
    row = grid.agg(F.count("*").alias("n"), F.count_distinct("timestamp").alias("d"), F.sum("pm25_raw").alias("s")).first()
    assert tuple(row) == (hours, hours, 3.0)
    per_task = grid.groupBy(F.spark_partition_id().alias("task")).count()
    assert per_task.count() > 1
    pieces = timeseries.hourly_grid(*pair, ["pm25_raw"], margin=(0, 0)).groupBy(timeseries.PART).count()
    assert pieces.agg(F.max("count"), F.count("*")).first() == (744, 12 * 80 + 1)
    # Months first, then a shuffle, then hours.
    plan = grid._jdf.queryExecution().optimizedPlan().toString()
    hours, shuffle, months = (plan.find(x) for x in ("Generate explode(sequence(_from", "RepartitionByExpression", "Generate explode(transform(sequence("))
    assert 0 <= hours < shuffle < months


def test_margins_change_nothing(spark):
    """Windows within months that overlap equal those over the whole device."""
    rng = np.random.default_rng(9)
    start = dt.datetime(2022, 1, 20)
    hours = sorted(set(rng.integers(0, 24 * 70, 900).tolist()) | {24 * 300, 24 * 300 + 1})
    rows = [(d, start + dt.timedelta(hours=h), float(rng.normal())) for d in "AB" for h in hours]
    pair = readings(spark, rows), sensor_table(spark, ("A", "x"), ("B", "y"))

    def featured(margin):
        grid = timeseries.hourly_grid(*pair, ["pm25_raw"], margin)
        by = timeseries.series_keys(grid)
        full = timeseries.rolling_features(timeseries.lag_features(grid, "pm25_raw"), "pm25_raw")
        full = full.withColumn("next", timeseries.lagged("pm25_raw", -3, by))
        full = timeseries.own_rows(full) if margin else full
        return full.toPandas().sort_values(["device_id", "timestamp"]).reset_index(drop=True)

    plain, cut = featured(None), featured((24, 3))
    assert len(plain) == 2 * (24 * 300 + 2 - hours[0])
    pd.testing.assert_frame_equal(cut[plain.columns], plain, atol=1e-12)


@pytest.mark.parametrize("most", [200_000, 40, 3])
def test_quantiles_of_groups(spark, most):
    rng = np.random.default_rng(4)
    parts = [
        pd.DataFrame({"g": "many", "v": rng.normal(size=4000)}), pd.DataFrame({"g": "ties", "v": rng.integers(0, 9, 3000).astype(float)}),
        pd.DataFrame({"g": "few", "v": [5.0, 1.0]}), pd.DataFrame({"g": "one", "v": [7.0]}), pd.DataFrame({"g": "skew", "v": 10.0 ** rng.uniform(-300, 300, 2000)}),
    ]
    pdf = pd.concat(parts)
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([("none", None), (None, 1.0)], "g string, v double"))
    shares = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {(r.g, r.probability): r.value for r in quantiles.quantiles_by_group(df, ["g"], "v", shares, most).collect()}
    want = {(g, p): own["v"].quantile(p) for g, own in pdf.groupby("g") for p in shares}
    assert set(got) == set(want)
    for key, value in want.items():
        assert got[key] == pytest.approx(value, rel=1e-12), key


@pytest.mark.parametrize("most", [200_000, 10])
def test_robust_z_of_large_groups_equals_that_of_windows(spark, most):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"id": range(900), "city": rng.choice(["x", "y", "z"], 900), "v": rng.normal(size=900).round(1)})
    flat = pd.DataFrame({"id": range(900, 905), "city": "flat", "v": 1.0})
    df = spark.createDataFrame(pd.concat([pdf, flat])).unionByName(spark.createDataFrame([(990, "x", None), (991, "empty", None)], "id long, city string, v double"))
    got = {r.id: r.z for r in timeseries.robust_z_of_groups(df, "v", "z", most=most).collect()}
    want = {r.id: r.z for r in timeseries.robust_z(df, "v", "z").collect()}
    assert got.keys() == want.keys()
    for key, z in want.items():
        assert got[key] == (None if z is None else pytest.approx(z, rel=1e-12)), key
    assert got[900] is None and got[990] is None


def test_autumn_hours_stay_apart(spark):
    rows = [("A", dt.datetime(2022, 10, 30, 0, 10), 1.0), ("A", dt.datetime(2022, 10, 30, 1, 10), 2.0)]
    pair = readings(spark, rows), sensor_table(spark, ("A", "x"))
    assert timeseries.hourly_grid(*pair, ["pm25_raw"]).count() == 2
    assert timeseries.resample(*pair, ["pm25_raw"], "hour").count() == 2
    assert timeseries.resample(*pair, ["pm25_raw"], "day").collect()[0].pm25_raw == 1.5


def test_resample_keeps_empty_steps(spark):
    rows = [("A", dt.datetime(2022, 1, 15), 1.0), ("B", dt.datetime(2022, 4, 2), 5.0), ("A", dt.datetime(2022, 3, 31, 22, 30), 9.0)]
    pair = readings(spark, rows), sensor_table(spark, ("A", "x"), ("B", "x"))
    months = timeseries.resample(*pair, ["pm25_raw"], "month").orderBy("start").collect()
    assert [(r.start, r.pm25_raw) for r in months] == [
        (dt.date(2022, 1, 1), 1.0), (dt.date(2022, 2, 1), None), (dt.date(2022, 3, 1), None), (dt.date(2022, 4, 1), 7.0),
    ]
    assert timeseries.resample(*pair, ["pm25_raw"], "day").count() == 78


def test_windows_equal_pandas_within_each_device(spark):
    rng = np.random.default_rng(3)
    frames = []
    for device in "AB":
        values = rng.normal(20, 5, 60)
        values[rng.random(60) < 0.3] = np.nan
        frames.append(pd.DataFrame({"device_id": device, "timestamp": pd.date_range(T0, periods=60, freq="h"), "v": values}))
    pdf = pd.concat(frames)
    grid = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = timeseries.rolling_features(timeseries.lag_features(grid, "v"), "v").toPandas()
    got = got.sort_values(["device_id", "timestamp"])
    for device, part in pdf.groupby("device_id"):
        ours = got[got["device_id"] == device].reset_index(drop=True)
        v = part["v"].reset_index(drop=True)
        for k in timeseries.LAGS:
            np.testing.assert_allclose(ours[f"lag_{k}h"].astype(float), v.shift(k))
        for w in timeseries.ROLLING_HOURS:
            past = v.shift(1).rolling(w, min_periods=max(1, w // 2))
            np.testing.assert_allclose(ours[f"roll_mean_{w}h"].astype(float), past.mean())
            np.testing.assert_allclose(ours[f"roll_std_{w}h"].astype(float), past.std(), atol=1e-9)
        np.testing.assert_allclose(ours["delta_3h"].astype(float), v - v.shift(3))


# --- anomalies ---


def test_severities(spark):
    days = [("x", dt.date(2022, 1, d), 10.0 + d % 3, 20.0 + d % 3) for d in range(1, 21)]
    days += [
        ("x", dt.date(2022, 2, 1), 200.0, 300.0),
        ("x", dt.date(2022, 2, 2), 25.0, 21.0),
        ("flat", dt.date(2022, 2, 3), 60.0, None),
        ("flat", dt.date(2022, 2, 4), 60.0, None),
        ("flat", dt.date(2022, 2, 5), 5.0, None),
        ("flat", dt.date(2022, 2, 6), 60.0, None),
        (None, dt.date(2022, 2, 7), 900.0, 900.0),
    ]
    daily = spark.createDataFrame(days, "city string, date date, pm25_raw double, pm10_raw double")
    found = anomalies.detect_anomalies(daily)
    got = {(r.city, r.date.day): (r.severity, r.z_pm25 is None) for r in found.where("month(date) = 2").collect()}
    assert got == {
        ("x", 1): ("extreme", False), ("x", 2): ("unusual", False),
        ("flat", 3): ("unhealthy", True), ("flat", 4): ("unhealthy", True), ("flat", 6): ("unhealthy", True),
    }
    assert [r.pm25_raw for r in anomalies.worst_days(found, 2).collect()] == [200.0, 60.0]
    listed = dashboard.anomaly_list(found, ["flat"], dt.date(2022, 2, 4), dt.date(2022, 2, 28))
    assert listed.count() == 2


# --- dashboard ---


def test_period_filter_is_inclusive_in_local_days(spark):
    moments = [dt.datetime(2022, 6, 30, 21, 59), dt.datetime(2022, 6, 30, 22), dt.datetime(2022, 7, 2, 21, 59), dt.datetime(2022, 7, 2, 22)]
    df = readings(spark, [("A", t, 1.0) for t in moments])
    kept = dashboard.filter_period(df, dt.date(2022, 7, 1), dt.date(2022, 7, 2))
    assert sorted(r.timestamp for r in kept.collect()) == moments[1:3]


def test_markers(spark):
    schema = "device_id string, city string, latitude double, longitude double, value double, avg_aqi double"
    rows = [("A", "x", 1.0, 2.0, 20.0, 50.5), ("B", "y", 1.0, 2.0, 10.0, 400.0), ("C", "z", 1.0, 2.0, None, None)]
    got = {r.device_id: r for r in dashboard.map_markers(spark.createDataFrame(rows, schema), "PM").collect()}
    assert [got[d].radius for d in "ABC"] == [20.0, 13.0, 6.0]
    assert [got[d].color for d in "ABC"] == ["#ffff00", "#7e0023", "#999999"]
    assert got["A"].popup == "<b>x</b><br>Device: A<br>PM: 20.0" and got["C"].popup.endswith("(no readings)")
    assert got["B"].tooltip == "y (B)"
    zero = spark.createDataFrame([("A", "x", 1.0, 2.0, 0.0, 1.0)], schema)
    assert dashboard.map_markers(zero, "PM").first().radius == 6.0


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_period_filter_whatever_the_zone_of_the_driver(spark, medium, zone, tmp_path):
    """In a process of its own: the zone of the operating system is read at its start."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    import hazeframe.registry.queries as registered

    code = (
        "from hazeframe.session import get_spark; from hazeframe.registry.queries import QUERIES; import sys;"
        "s = get_spark('zone', 'local[2]', **{'spark.sql.shuffle.partitions': '2', 'spark.local.dir': sys.argv[2]});"
        "print('rows', QUERIES['period_filter'](s, sys.argv[1]).count())"
    )
    root = str(Path(__file__).resolve().parents[1])
    env = os.environ | {"TZ": zone, "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", code, medium, str(tmp_path)], env=env, capture_output=True, text=True, timeout=300)
    assert f"rows {registered.QUERIES['period_filter'](spark, medium).count()}" in done.stdout, done.stderr[-2000:]


def test_numbers_with_a_suffix_are_text(spark):
    df = spark.createDataFrame([("12f",), ("12d",), ("1e3",), (" 7 ",), ("x",), ("Infinity",)], "v string")
    assert [r.n for r in df.select(to_number("v").alias("n")).collect()] == [None, None, 1000.0, 7.0, None, float("inf")]


def test_repeated_place_ids_give_one_sensor_each(spark):
    rows = [("a", T0, 42.0, 19.0), ("b", T0, 43.0, 20.0)]
    measurements = spark.createDataFrame(rows, "device_id string, timestamp timestamp, latitude double, longitude double")
    gazetteer = spark.createDataFrame(
        [(1, "x", "r", "c", 42.0, 19.0), (1, "y", "r", "c", 43.0, 20.0)], "place_id long, name string, admin1 string, cc string, latitude double, longitude double"
    )
    found = fleet.build_sensors(measurements, gazetteer).collect()
    assert sorted((r.device_id, r.city) for r in found) == [("a", "x"), ("b", "y")]
