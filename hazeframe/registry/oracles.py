"""DuckDB SQL for every query that SQL can express, written independently of the Spark operators."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

CHANNELS = [
    "pm25_raw", "pm25_24h_raw", "pm10_raw", "pm10_24h_raw", "no2_raw", "no2_aqi_epa",
    "temp_internal", "humidity_internal", "wind_speed", "pressure",
]
RAW = ["pm25_raw", "pm10_raw", "no2_raw"]

# Fixed values: (upper concentration, lowest index, highest index) of each band.
BANDS = {
    "pm25": [(12.0, 0, 50), (35.4, 51, 100), (55.4, 101, 150), (150.4, 151, 200),
             (250.4, 201, 300), (350.4, 301, 400), (500.4, 401, 500)],
    "pm10": [(54, 0, 50), (154, 51, 100), (254, 101, 150), (354, 151, 200),
             (424, 201, 300), (504, 301, 400), (604, 401, 500)],
    "no2": [(53, 0, 50), (100, 51, 100), (360, 101, 150), (649, 151, 200),
            (1249, 201, 300), (1649, 301, 400), (2049, 401, 500)],
}


def d(number: float) -> str:
    return f"CAST({number} AS DOUBLE)"


def r(expression: str, name: str) -> str:
    return f"round(({expression}) + 1e-10::DOUBLE, 6) AS {name}"


def aqi_sql(value: str, pollutant: str) -> str:
    step = 0.1 if pollutant == "pm25" else 1.0
    scale = d(10 if pollutant == "pm25" else 1)
    cut = f"(floor(({value}) * {scale}) / {scale})"
    cases, low = [], 0.0
    for high, i_low, i_high in BANDS[pollutant]:
        line = f"({d(i_high - i_low)} / ({d(high)} - {d(low)})) * ({cut} - {d(low)}) + {d(i_low)}"
        cases.append(f"WHEN {cut} >= {d(low)} AND {cut} <= {d(high)} THEN round_even({line}, 0)")
        low = round(high + step, 1)
    return f"CASE WHEN {cut} > {d(BANDS[pollutant][-1][0])} THEN {d(500)} {' '.join(cases)} END"


def category_sql(aqi: str) -> str:
    return f"""CASE WHEN {aqi} BETWEEN 0 AND 50 THEN 'Good' WHEN {aqi} BETWEEN 51 AND 100 THEN 'Moderate'
        WHEN {aqi} BETWEEN 101 AND 150 THEN 'Unhealthy for Sensitive Groups'
        WHEN {aqi} BETWEEN 151 AND 200 THEN 'Unhealthy' WHEN {aqi} BETWEEN 201 AND 300 THEN 'Very Unhealthy'
        WHEN {aqi} BETWEEN 301 AND 500 THEN 'Hazardous' END"""


NO2 = """CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 25 * k ELSE k END"""
LOCAL = "((timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Belgrade')"

READINGS = f"""
base AS (SELECT *, ts AS timestamp, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
  ascii(event_type) * 4 + user_id % 4 AS slot FROM events),
readings AS (SELECT event_id, event_type || '-' || (user_id % 4) AS device_id, timestamp,
  {LOCAL} AS local_ts,
  value AS pm25_raw,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE value * {d(0.9)} END AS pm25_24h_raw,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE value * {d(0.8)} END AS pm25_nowcast,
  value * {d(1.4)} + (event_id % 41) - 10 AS pm10_raw,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE value * {d(1.2)} + (event_id % 37) END AS pm10_24h_raw,
  CAST({NO2} AS DOUBLE) AS no2_raw,
  {aqi_sql(f'CAST({NO2} AS DOUBLE)', 'no2')} + event_id % 3 AS no2_aqi_epa,
  CAST(user_id % 30 AS DOUBLE) AS temp_internal,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(event_id % 100 AS DOUBLE) END AS humidity_internal,
  {d(1)} AS wind_speed, CAST(NULL AS DOUBLE) AS pressure,
  {d(42)} + (slot % 40) / {d(10)} AS latitude, {d(19)} + (slot % 30) / {d(10)} AS longitude,
  slot % 7 AS nation_key FROM base),
sensors AS (SELECT DISTINCT device_id, latitude, longitude, n_name AS city, r_name AS region,
  'C' || nation_key AS country_code FROM readings
  JOIN nation ON n_nationkey = nation_key JOIN region ON r_regionkey = n_regionkey),
joined AS (SELECT r.*, s.city, s.region FROM readings r JOIN sensors s USING (device_id))"""

LONG = f"""
long_readings AS (SELECT 'station-' || (o_custkey % 25) AS device_id, o_orderdate AS timestamp,
  ((o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Belgrade') AS local_ts,
  o_totalprice / {d(1000)} AS pm25_raw,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / {d(800)} END AS pm10_raw,
  o_orderkey AS order_id, {d(42)} + (o_custkey % 25) / {d(10)} AS latitude,
  {d(19)} + (o_custkey % 25) / {d(10)} AS longitude, (o_custkey % 25) % 7 AS nation_key FROM orders),
long_joined AS (SELECT l.*, n_name AS city FROM long_readings l JOIN nation ON n_nationkey = nation_key)"""

AQI = f"""
indexes AS (SELECT event_id, device_id, timestamp, local_ts, city,
  {aqi_sql('coalesce(pm25_24h_raw, pm25_raw)', 'pm25')} AS pm25_aqi,
  {aqi_sql('coalesce(pm10_24h_raw, pm10_raw)', 'pm10')} AS pm10_aqi,
  {aqi_sql('no2_raw', 'no2')} AS no2_aqi FROM joined),
topped AS (SELECT *, greatest(pm25_aqi, pm10_aqi, no2_aqi) AS aqi FROM indexes),
aqi AS (SELECT *, CASE WHEN pm25_aqi = aqi THEN 'pm25' WHEN pm10_aqi = aqi THEN 'pm10'
  WHEN no2_aqi = aqi THEN 'no2' END AS dominant_pollutant, {category_sql('aqi')} AS aqi_category FROM topped),
daily_aqi AS (SELECT city, CAST(local_ts AS DATE) AS date, max(aqi) AS aqi, max(pm25_aqi) AS pm25_aqi,
  max(pm10_aqi) AS pm10_aqi, max(no2_aqi) AS no2_aqi, {category_sql('max(aqi)')} AS aqi_category
  FROM aqi GROUP BY ALL)"""

DAYS = """
days AS (SELECT city, CAST(local_ts AS DATE) AS date, avg(pm25_raw) AS pm25_raw, avg(pm10_raw) AS pm10_raw
  FROM joined GROUP BY ALL)"""


def robust(table: str, column: str, output: str) -> str:
    return f"""
med_{column} AS (SELECT city, median({column}) AS med FROM {table} GROUP BY city),
mad_{column} AS (SELECT city, any_value(med) AS med, median(abs({column} - med)) AS mad
  FROM {table} JOIN med_{column} USING (city) GROUP BY city),
{output} AS (SELECT city, date, {d(0.6745)} * ({column} - med) / nullif(mad, 0) AS z
  FROM {table} JOIN mad_{column} USING (city))"""


ANOMALIES = f"""{DAYS}, {robust('days', 'pm25_raw', 'z25')}, {robust('days', 'pm10_raw', 'z10')},
flags AS (SELECT days.*, z25.z AS z_pm25, z10.z AS z_pm10,
  coalesce(abs(z25.z) > 3, false) OR coalesce(abs(z10.z) > 3, false) AS is_statistical,
  coalesce(pm25_raw > {d(55.4)}, false) OR coalesce(pm10_raw > {d(154)}, false) AS is_threshold
  FROM days JOIN z25 USING (city, date) JOIN z10 USING (city, date)),
found AS (SELECT *, CASE WHEN is_statistical AND is_threshold THEN 'extreme'
  WHEN is_threshold THEN 'unhealthy' ELSE 'unusual' END AS severity FROM flags
  WHERE is_statistical OR is_threshold)"""


def grid_sql(columns: list[str]) -> str:
    means = ", ".join(f"avg({c}) AS {c}" for c in columns)
    return f"""
hourly AS (SELECT device_id, city, date_trunc('hour', timestamp) AS timestamp, {means}
  FROM joined GROUP BY ALL),
slots AS (SELECT device_id, city, unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR))
  AS timestamp FROM hourly GROUP BY device_id, city),
grid AS (SELECT slots.*, {', '.join(columns)} FROM slots LEFT JOIN hourly USING (device_id, city, timestamp))"""


LAGS = [1, 2, 3, 6, 12, 24]
W = "OVER (PARTITION BY device_id ORDER BY timestamp"


def lag_sql(column: str) -> list[tuple[str, str]]:
    return [(f"lag({column}, {k}) {W})", f"lag_{k}h") for k in LAGS]


def rolling_sql(column: str) -> list[tuple[str, str]]:
    items = []
    for hours, least in ((3, 1), (24, 12)):
        frame = f"{W} ROWS BETWEEN {hours} PRECEDING AND 1 PRECEDING)"
        for function, name in (("avg", "mean"), ("stddev_samp", "std")):
            value = f"CASE WHEN count({column}) {frame} >= {least} THEN {function}({column}) {frame} END"
            items.append((value, f"roll_{name}_{hours}h"))
    return items


GRID_LOCAL = "((timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Belgrade')"
CYCLES = [
    (f"sin(2 * pi() * hour({GRID_LOCAL}) / 24)", "hour_sin"),
    (f"cos(2 * pi() * hour({GRID_LOCAL}) / 24)", "hour_cos"),
    (f"sin(2 * pi() * month({GRID_LOCAL}) / 12)", "month_sin"),
    (f"cos(2 * pi() * month({GRID_LOCAL}) / 12)", "month_cos"),
]
FLAGS = [
    (f"CAST(isodow({GRID_LOCAL}) - 1 AS INTEGER)", "day_of_week"),
    (f"CASE WHEN isodow({GRID_LOCAL}) >= 6 THEN 1 ELSE 0 END", "is_weekend"),
    (f"CASE WHEN month({GRID_LOCAL}) IN (10, 11, 12, 1, 2, 3) THEN 1 ELSE 0 END", "is_heating_season"),
]


def plain(items: list[tuple[str, str]]) -> str:
    return ", ".join(f"{e} AS {n}" for e, n in items)


def rounded(items: list[tuple[str, str]]) -> str:
    return ", ".join(r(e, n) for e, n in items)


def dataset_sql(target: str) -> str:
    columns = [target, "no2_raw", "temp_internal", "humidity_internal"]
    return f"""{grid_sql(columns)},
featured AS (SELECT *, {plain(lag_sql(target))}, {plain(rolling_sql(target))},
  lead({target}, 1) {W}) AS target, {plain(CYCLES)}, {plain(FLAGS)} FROM grid),
data AS (SELECT *, {target} - lag_3h AS delta_3h FROM featured
  WHERE {target} IS NOT NULL AND target IS NOT NULL AND lag_1h IS NOT NULL),
split AS (SELECT quantile_cont(epoch_us(timestamp), 0.8) AS cut_us FROM data),
test AS (SELECT data.* FROM data, split WHERE epoch_us(timestamp) > cut_us)"""


FEATURE_DOUBLES = [
    "pm25_raw", "no2_raw", "temp_internal", "humidity_internal", *[f"lag_{k}h" for k in LAGS], "delta_3h",
    "roll_mean_3h", "roll_std_3h", "roll_mean_24h", "roll_std_24h", "hour_sin", "hour_cos", "month_sin",
    "month_cos",
]
FEATURE_FLAGS = ["day_of_week", "is_weekend", "is_heating_season"]


def add(name: str, parts: list[str], select: str) -> None:
    ORACLES[name] = f"WITH {', '.join(parts)} {select}" if parts else select


def rs(columns: list[str]) -> str:
    return ", ".join(r(c, c) for c in columns)


def means(columns: list[str]) -> str:
    return ", ".join(r(f"avg({c})", c) for c in columns)


# --- cleaning and sources -------------------------------------------------------------------

# The columns of the stored table, in order.
STORED = """device_id timestamp pm1_calibrated pm1_raw pm1_number_conc pm25_calibrated pm25_raw pm25_number_conc
pm25_nowcast pm25_nowcast_aqi_epa pm25_24h_calibrated pm25_24h_raw pm25_24h_number_conc pm25_aqi_dwer pm10_calibrated
pm10_raw pm10_number_conc pm10_24h_calibrated pm10_24h_raw pm10_24h_number_conc pm10_aqi_dwer no2_calibrated no2_raw
no2_aqi_epa no2_aqi_dwer o3_raw temp_internal temp_ambient humidity_internal humidity_ambient wind_speed wind_direction
pressure latitude longitude""".split()
HELD = {
    "readings": ["pm25_raw", "pm25_24h_raw", "pm25_nowcast", "pm25_nowcast_aqi_epa", "pm10_raw", "pm10_24h_raw", "no2_raw",
                 "no2_aqi_epa", "temp_internal", "humidity_internal", "wind_speed", "latitude", "longitude"],
    "long_readings": ["pm25_raw", "pm10_raw", "latitude", "longitude"],
}


def conformed(table: str, label: str) -> str:
    values = [r(c, c) if c in HELD[table] else f"CAST(NULL AS DOUBLE) AS {c}" for c in STORED[2:]]
    return f"""SELECT device_id, timestamp, {', '.join(values)}, '{label}' AS source_dataset,
CAST(NULL AS VARCHAR) AS source_file FROM {table}"""


NOWCAST = f"""nowcast AS (SELECT *,
  {aqi_sql('pm25_nowcast', 'pm25')} + event_id % 2 AS pm25_nowcast_aqi_epa FROM readings)"""
add("union_conform", [READINGS, LONG, NOWCAST],
    conformed("readings", "events").replace("FROM readings", "FROM nowcast")
    + " UNION ALL " + conformed("long_readings", "orders"))
add("raw_channel_profile", [READINGS], f"""SELECT CAST(hour(local_ts) AS INTEGER) AS hour, {means(RAW)},
CAST(NULL AS DOUBLE) AS o3_raw FROM joined GROUP BY 1""")
add("coerced_numbers", [], f"""SELECT event_id,
{r("TRY_CAST(CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE)", "number")}
FROM events""")
add("parsed_timestamps", [], """SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts)
WHEN 1 THEN date_trunc('second', ts) WHEN 2 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS parsed FROM events""")

FILLED = ["event_id", "device_id", "timestamp", "pm25_raw", "pm25_24h_raw", "pm25_nowcast",
          "pm10_raw", "pm10_24h_raw", "no2_raw", "no2_aqi_epa", "temp_internal", "humidity_internal"]
COMPLETE = " + ".join(f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in FILLED)
add("dedupe_readings", [READINGS], f"""
SELECT event_id, device_id, date_trunc('hour', timestamp) AS timestamp, {rs(RAW)} FROM readings
QUALIFY row_number() OVER (PARTITION BY device_id, date_trunc('hour', timestamp)
  ORDER BY {COMPLETE} + (CASE WHEN pm25_nowcast IS NULL THEN 0 ELSE 1 END) DESC, event_id) = 1""")
add("stage_counts", [READINGS], """
SELECT count(*) AS n_read, count(*) FILTER (event_id % 50 = 0) AS n_unusable,
  count(*) FILTER (event_id % 50 <> 0) - count(DISTINCT CASE WHEN event_id % 50 <> 0
    THEN device_id || date_trunc('hour', timestamp) END) AS n_duplicates,
  count(DISTINCT CASE WHEN event_id % 50 <> 0 THEN device_id || date_trunc('hour', timestamp) END) AS n_kept
FROM readings""")


def per_column(columns: list[str], select: str) -> str:
    return " UNION ALL ".join(select.replace("@", c) for c in columns)


add("column_completeness", [READINGS], per_column(["event_id", *CHANNELS], f"""
SELECT '@' AS "column", count(*) AS n_rows, count(@) AS n_filled,
{r("(count(*) - count(@)) * 100.0::DOUBLE / count(*)", "missing_pct")} FROM readings"""))
add("missing_share", [READINGS], per_column(CHANNELS, f"""
SELECT '@' AS "column", {r("(count(*) - count(@)) * 100.0::DOUBLE / count(*)", "missing_pct")} FROM readings"""))

KEPT = [c for c in CHANNELS if c != "pressure"]
add("drop_empty", [READINGS], f"SELECT event_id, device_id, timestamp, {rs(KEPT)} FROM readings")

# Both exports; readings of two days are in both, and one in fifty has no time.
EXPORTED = """cells AS (SELECT *, date_trunc('hour', timestamp) AS cut_at, extract(day FROM timestamp) AS day FROM nowcast
  WHERE event_id % 50 <> 0),
doubled AS (SELECT * FROM cells WHERE day <= 16 UNION ALL SELECT * FROM cells WHERE day >= 15)"""
CELLS = " + ".join(f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in ["device_id", "cut_at", *HELD["readings"]])
add("loaded_exports", [READINGS, NOWCAST, EXPORTED], f"""
SELECT device_id, cut_at AS timestamp, CAST(date_trunc('month', cut_at) AS DATE) AS utc_month, {rs(['latitude', 'longitude'])},
  CAST({CELLS} AS INTEGER) AS n_filled, true AS named FROM doubled
QUALIFY row_number() OVER (PARTITION BY device_id, cut_at ORDER BY n_filled DESC) = 1""")
add("loaded_counts", [READINGS, NOWCAST, EXPORTED], """
SELECT r.n AS n_read, r.n - u.n AS n_unusable, u.n - k.n AS n_duplicates, k.n AS n_kept FROM
  (SELECT count(*) + count(*) FILTER (extract(day FROM timestamp) IN (15, 16)) AS n FROM readings) r,
  (SELECT count(*) AS n FROM doubled) u, (SELECT count(*) AS n FROM (SELECT DISTINCT device_id, cut_at FROM cells)) k""")

PERIODS = ", ".join(f"(DATE '{1995 + i // 2}-{1 + 5 * (i % 2):02}-03', DATE '{1995 + i // 2}-{1 + 5 * (i % 2):02}-{3 + 2 * i:02}')" for i in range(10))
add("kept_devices", [LONG, f'periods("start", "end") AS (VALUES {PERIODS})'], """
SELECT "start", "end", count(DISTINCT device_id) AS n, count(DISTINCT CAST(local_ts AS DATE)) AS n_days
FROM periods LEFT JOIN long_joined ON CAST(local_ts AS DATE) BETWEEN "start" AND "end" GROUP BY ALL""")

# --- sensors --------------------------------------------------------------------------------

add("sensor_coordinates", [READINGS], f"SELECT DISTINCT device_id, {rs(['latitude', 'longitude'])} FROM readings")
add("distinct_places", [LONG], f"SELECT DISTINCT device_id, {rs(['latitude', 'longitude'])} FROM long_readings")

NEAREST = f"""
places AS (SELECT CAST(n_nationkey AS BIGINT) AS place_id, n_name AS name, r_name AS admin1,
  'C' || n_nationkey AS cc, {d(42)} + n_nationkey / {d(6)} AS plat,
  {d(19)} + (n_nationkey % 5) / {d(1.5)} AS plon FROM nation JOIN region ON r_regionkey = n_regionkey),
spots AS (SELECT DISTINCT latitude, longitude FROM readings),
measured AS (SELECT *, 2 * {d(6371.0088)} * asin(sqrt(pow(sin(radians(plat - latitude) / 2), 2)
  + cos(radians(latitude)) * cos(radians(plat)) * pow(sin(radians(plon - longitude) / 2), 2))) AS km
  FROM spots, places),
nearest AS (SELECT * FROM measured
  QUALIFY row_number() OVER (PARTITION BY latitude, longitude ORDER BY round(km, 6), place_id) = 1)"""
add("nearest_place", [READINGS, NEAREST], f"""
SELECT {rs(['latitude', 'longitude'])}, name, admin1, cc, place_id, {r('km', 'distance_km')} FROM nearest""")
add("build_sensors", [READINGS, NEAREST], """
SELECT DISTINCT device_id, round(r.latitude + 1e-10::DOUBLE, 6) AS latitude,
  round(r.longitude + 1e-10::DOUBLE, 6) AS longitude, name AS city, admin1 AS region, cc AS country_code
FROM readings r JOIN nearest n ON n.latitude = r.latitude AND n.longitude = r.longitude""")
add("located_readings", [READINGS], f"""
SELECT device_id, timestamp, {rs(['pm25_raw', 'no2_raw'])}, city, region,
CAST(hour(local_ts) AS INTEGER) AS local_hour FROM joined""")

# --- rollups and profiles -------------------------------------------------------------------

add("daily_city_avg", [READINGS], f"SELECT city, CAST(local_ts AS DATE) AS date, {means(CHANNELS)} FROM joined GROUP BY 1, 2")
add("daily_preview", [READINGS], f"""
SELECT city, CAST(local_ts AS DATE) AS date, {means(RAW[:2])} FROM joined GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 5""")
add("monthly_city_avg", [LONG], f"""
SELECT city, strftime(local_ts, '%Y-%m') AS month, {means(RAW[:2])} FROM long_joined GROUP BY 1, 2""")
add("diurnal", [READINGS], f"SELECT CAST(hour(local_ts) AS INTEGER) AS hour, {means(RAW)} FROM joined GROUP BY 1")
add("city_diurnal", [READINGS], f"""
SELECT city, CAST(hour(local_ts) AS INTEGER) AS hour, {means(RAW[:1])} FROM joined GROUP BY 1, 2""")
add("weekly", [READINGS], f"SELECT dayname(local_ts) AS weekday, {means(RAW)} FROM joined GROUP BY 1")
add("seasonal", [LONG], f"SELECT strftime(local_ts, '%Y-%m') AS month, {means(RAW[:2])} FROM long_joined GROUP BY 1")
add("city_ranking", [READINGS], f"SELECT city, {means(RAW)} FROM joined GROUP BY 1")
add("kept_daily_city_avg", [LONG], f"SELECT city, CAST(local_ts AS DATE) AS date, {means(RAW[:2])} FROM long_joined GROUP BY 1, 2")
ORACLES["kept_monthly_city_avg"], ORACLES["kept_seasonal"] = ORACLES["monthly_city_avg"], ORACLES["seasonal"]
add("kept_weekly", [LONG], f"SELECT dayname(local_ts) AS weekday, {means(RAW[:2])} FROM long_joined GROUP BY 1")
add("kept_diurnal", [LONG], f"SELECT CAST(hour(local_ts) AS INTEGER) AS hour, {means(RAW[:2])} FROM long_joined GROUP BY 1")
add("kept_ranking", [LONG], f"SELECT city, {means(RAW[:2])} FROM long_joined GROUP BY 1")
add("city_extremes", [READINGS, "m AS (SELECT city, avg(pm25_raw) AS v FROM joined GROUP BY 1)"], f"""
SELECT (SELECT city FROM m ORDER BY v DESC, city LIMIT 1) AS worst_city, {r('max(v)', 'worst_value')},
  (SELECT city FROM m ORDER BY v, city LIMIT 1) AS best_city, {r('min(v)', 'best_value')},
  {r('max(v) / min(v)', 'ratio')}, count(*) - count(v) AS n_cities_without_value FROM m""")
HOURS = f"""h AS (SELECT CAST(hour(local_ts) AS INTEGER) AS hour, {', '.join(f'avg({c}) AS {c}' for c in RAW)}
  FROM joined GROUP BY 1)"""
add("peak_hour", [READINGS, HOURS], per_column(RAW, f"""
SELECT * FROM (SELECT '@' AS "column", hour AS peak_at, {r('@', 'peak_value')} FROM h ORDER BY @ DESC, hour LIMIT 1)"""))
MONTHS = """months AS (SELECT strftime(local_ts, '%Y-%m') AS month, avg(pm25_raw) AS pm25_raw,
  avg(pm10_raw) AS pm10_raw FROM long_joined GROUP BY 1)"""
add("peak_month", [LONG, MONTHS], per_column(RAW[:2], f"""
SELECT * FROM (SELECT '@' AS "column", month AS peak_at, {r('@', 'peak_value')} FROM months
ORDER BY @ DESC, month LIMIT 1)"""))
add("weekend_contrast", [READINGS, """w AS (SELECT isodow(local_ts) >= 6 AS weekend, isodow(local_ts) AS day,
  avg(pm25_raw) AS v FROM joined GROUP BY 1, 2),
c AS (SELECT avg(v) FILTER (NOT weekend) AS a, avg(v) FILTER (weekend) AS b FROM w)"""], f"""
SELECT {r('a', 'weekday_avg')}, {r('b', 'weekend_avg')}, {r('(a - b) / b * 100', 'diff_pct')} FROM c""")
add("season_contrast", [LONG, MONTHS, """c AS (SELECT
  avg(pm25_raw) FILTER (month[6:7] IN ('11', '12', '01', '02')) AS a,
  avg(pm25_raw) FILTER (month[6:7] IN ('06', '07', '08')) AS b FROM months)"""], f"""
SELECT {r('a', 'winter_avg')}, {r('b', 'summer_avg')}, {r('a / b', 'ratio')} FROM c""")

# --- statistics -----------------------------------------------------------------------------

SKEW = "CASE WHEN count(@) >= 3 THEN CASE WHEN min(@) = max(@) THEN 0 ELSE skewness(@) END END"
add("describe", [READINGS], per_column(CHANNELS, f"""
SELECT '@' AS "column", count(@) AS count, {r('avg(@)', 'mean')}, {r('stddev_samp(@)', 'std')}, {r('min(@)', 'min')},
{r('quantile_cont(@, 0.25)', 'q25')}, {r('quantile_cont(@, 0.5)', 'q50')}, {r('quantile_cont(@, 0.75)', 'q75')},
{r('max(@)', 'max')}, {r('(count(*) - count(@)) * 100.0::DOUBLE / count(*)', 'missing_pct')}, {r(SKEW, 'skew')}
FROM readings"""))
ORACLES["column_quantiles"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {d(p)} AS probability, {r(f'quantile_cont(CAST({c} AS DOUBLE), {p})', 'value')}
    FROM lineitem""".replace(f"{d(p)} AS probability", r(d(p), "probability"))
    for c in ("l_extendedprice", "l_quantity")
    for p in (0.01, 0.25, 0.5, 0.8, 0.999)
)
add("skew", [READINGS], per_column(CHANNELS, f"""SELECT '@' AS "column", {r(SKEW, 'skew')} FROM readings"""))
add("iqr_outliers", [READINGS], per_column(CHANNELS, f"""
SELECT '@' AS "column", {r('''avg(CASE WHEN @ IS NULL THEN NULL
  WHEN @ < q1 - 1.5::DOUBLE * (q3 - q1) OR @ > q3 + 1.5::DOUBLE * (q3 - q1) THEN 100.0::DOUBLE
  ELSE 0 END)''', 'outlier_pct')}
FROM readings, (SELECT quantile_cont(@, 0.25) AS q1, quantile_cont(@, 0.75) AS q3 FROM readings)"""))
add("histogram", [READINGS], per_column([c for c in CHANNELS if c != "pressure"], f"""
SELECT '@' AS "column", CAST(b.i AS INTEGER) AS bin, {r('lo + b.i * (hi - lo) / 40', '"left"')},
{r('lo + (b.i + 1) * (hi - lo) / 40', '"right"')}, coalesce(c.n, 0) AS n, {r('mean', 'mean')}
FROM (SELECT CASE WHEN min(@) = max(@) THEN min(@) - 0.5::DOUBLE ELSE min(@) END AS lo,
  CASE WHEN min(@) = max(@) THEN max(@) + 0.5::DOUBLE ELSE max(@) END AS hi, avg(@) AS mean FROM readings) s
CROSS JOIN range(40) b(i)
LEFT JOIN (SELECT (SELECT count(*) FROM range(1, 40) e(k) WHERE @ >= lo + k * ((hi - lo) / 40)) AS i,
  count(*) AS n FROM readings, (SELECT CASE WHEN min(@) = max(@) THEN min(@) - 0.5::DOUBLE ELSE min(@) END AS lo,
  CASE WHEN min(@) = max(@) THEN max(@) + 0.5::DOUBLE ELSE max(@) END AS hi FROM readings)
  WHERE @ IS NOT NULL GROUP BY 1) c ON c.i = b.i"""))


def corr_sql(a: str, b: str) -> str:
    both = f"FILTER ({a} IS NOT NULL AND {b} IS NOT NULL)"
    varied = f"min({a}) {both} < max({a}) {both} AND min({b}) {both} < max({b}) {both}"
    return f"CASE WHEN {varied} THEN corr({a}, {b}) END"


def pair_rows(pairs: list[tuple[str, str]], target: str = "'{a}' AS col_a, '{b}' AS col_b, ") -> str:
    return " UNION ALL ".join(
        f"SELECT {target.format(a=a, b=b)}"
        f"{'CASE WHEN min(' + a + ') < max(' + a + ') THEN 1.0::DOUBLE END' if a == b else corr_sql(a, b)} AS corr"
        " FROM readings"
        for a, b in pairs
    )


ALL_PAIRS = [(a, b) for a in CHANNELS for b in CHANNELS]
UPPER = [(a, b) for i, a in enumerate(CHANNELS) for b in CHANNELS[i + 1 :]]
add("corr_matrix", [READINGS, f"m AS ({pair_rows(ALL_PAIRS)})"], f"SELECT col_a, col_b, {r('corr', 'corr')} FROM m")
add("strongest_pair", [READINGS, f"m AS ({pair_rows(UPPER)})"], f"""
SELECT col_a, col_b, {r('corr', 'corr')} FROM m WHERE corr IS NOT NULL ORDER BY abs(corr) DESC LIMIT 1""")
add("target_corr", [READINGS, f"m AS ({pair_rows([('pm25_raw', b) for b in CHANNELS if b != 'pm25_raw'])})"], f"""
SELECT col_b AS "column", {r('corr', 'corr')} FROM m""")
add("best_partner", [READINGS, f"m AS ({pair_rows([(a, b) for a, b in ALL_PAIRS if a != b and a in RAW])})"], f"""
SELECT col_a AS target, col_b AS "column", {r('corr', 'corr')} FROM m WHERE corr IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY col_a ORDER BY abs(corr) DESC, col_b) = 1""")
FIT = """fit AS (SELECT regr_count(pm25_raw, humidity_internal) AS n, corr(humidity_internal, pm25_raw) AS corr,
  regr_slope(pm25_raw, humidity_internal) AS slope, regr_intercept(pm25_raw, humidity_internal) AS intercept,
  min(humidity_internal) AS min_x, max(humidity_internal) AS max_x
  FROM readings WHERE humidity_internal IS NOT NULL AND pm25_raw IS NOT NULL)"""
add("linear_fit", [READINGS, FIT], f"""
SELECT CAST(n AS BIGINT) AS n, {r('corr', 'corr')}, CASE WHEN abs(corr) > 0.5 THEN 'strong' WHEN abs(corr) > 0.3 THEN 'moderate'
ELSE 'weak' END AS strength, {rs(['slope', 'intercept', 'min_x', 'max_x'])} FROM fit""")
add("fit_line", [READINGS, FIT], f"""
SELECT CAST(i AS INTEGER) AS i, {r('min_x + i * (max_x - min_x) / 49', 'x')},
{r('slope * (min_x + i * (max_x - min_x) / 49) + intercept', 'y')} FROM fit, range(50) t(i)""")
add("impossible_values", [READINGS], f"""
SELECT count(*) FILTER (pm10_raw < pm25_raw) AS n_bad, count(*) AS n_rows,
{r('count(*) FILTER (pm10_raw < pm25_raw) * 100.0::DOUBLE / count(*)', 'bad_pct')} FROM readings""")

# --- index ----------------------------------------------------------------------------------

IDX = ["pm25_aqi", "pm10_aqi", "no2_aqi", "aqi"]
add("reading_aqi", [READINGS, AQI], f"""
SELECT device_id, timestamp, city, {rs(IDX)}, dominant_pollutant, aqi_category, event_id FROM aqi""")
add("daily_city_aqi", [READINGS, AQI], f"SELECT city, date, {rs(IDX)}, aqi_category FROM daily_aqi")
add("aqi_heatmap", [READINGS, AQI], f"SELECT date, city, {r('max(aqi)', 'aqi')} FROM daily_aqi GROUP BY 1, 2")
add("sampled_pairs", [READINGS], """
SELECT event_id, humidity_internal, pm25_raw FROM readings WHERE humidity_internal IS NOT NULL AND pm25_raw IS NOT NULL
ORDER BY md5(concat_ws(':', '42', event_id::VARCHAR)), event_id LIMIT 5000""")
add("aqi_cross_check", [READINGS, f"""gaps AS (
  SELECT 'pm25 of the nowcast' AS name, abs({aqi_sql('pm25_nowcast', 'pm25')}
    - ({aqi_sql('pm25_nowcast', 'pm25')} + event_id % 2)) AS gap FROM joined
  UNION ALL SELECT 'no2 of the hour', abs({aqi_sql('no2_raw', 'no2')} - no2_aqi_epa) FROM joined)"""], f"""
SELECT name, count(gap) AS n_compared, {r('avg(gap)', 'mae')},
{r('count(*) FILTER (gap <= 1) * 100.0::DOUBLE / count(gap)', 'within_one_pct')}, 'compared' AS status
FROM gaps GROUP BY name""")
add("category_share", [READINGS, AQI], f"""
SELECT aqi_category, count(*) AS n, {r('count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()', 'pct')}
FROM aqi WHERE aqi_category IS NOT NULL GROUP BY 1""")
add("unhealthy_share", [READINGS, AQI], f"""
SELECT {r('''count(*) FILTER (aqi_category NOT IN ('Good', 'Moderate')) * 100.0::DOUBLE / count(aqi_category)''',
'unhealthy_pct')} FROM aqi""")
add("top_dominant", [READINGS, AQI], f"""
SELECT dominant_pollutant, {r('count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()', 'pct')} FROM aqi
WHERE dominant_pollutant IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1""")
add("category_days", [READINGS, AQI], """
SELECT city, aqi_category, count(*) AS n FROM daily_aqi WHERE aqi_category IS NOT NULL GROUP BY 1, 2""")
add("dominant_counts", [READINGS, AQI], """
SELECT city, dominant_pollutant, count(*) AS n FROM aqi WHERE dominant_pollutant IS NOT NULL GROUP BY 1, 2""")
add("value_counts", [READINGS, AQI], "SELECT aqi_category, count(*) AS n FROM aqi GROUP BY 1")

# --- filters, counts, map -------------------------------------------------------------------

PERIOD = "CAST(local_ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'"
CITIES = "city IN ('NATION_1', 'NATION_3', 'NATION_4')"
add("period_filter", [READINGS], f"""
SELECT device_id, timestamp, {rs(RAW)}, city FROM joined WHERE {PERIOD} AND {CITIES}""")
add("headline", [READINGS], f"""
SELECT count(*) AS n_readings, count(DISTINCT device_id) AS n_sensors, min(CAST(local_ts AS DATE)) AS first_day,
max(CAST(local_ts AS DATE)) AS last_day FROM joined WHERE {PERIOD}""")
add("distinct_counts", [READINGS], """
SELECT count(DISTINCT device_id) AS n_device_id, count(DISTINCT city) AS n_city FROM joined""")
add("distinct_values", [READINGS], "SELECT DISTINCT city FROM sensors")
add("time_span", [READINGS], 'SELECT min(timestamp) AS "first", max(timestamp) AS "last" FROM readings')


def summary_sql(column: str) -> str:
    return f"""
summary AS (SELECT s.*, value, n_readings, avg_aqi, max_aqi FROM sensors s
  LEFT JOIN (SELECT device_id, avg({column}) AS value, count({column}) AS n_readings FROM readings GROUP BY 1)
    USING (device_id)
  LEFT JOIN (SELECT device_id, avg(aqi) AS avg_aqi, max(aqi) AS max_aqi FROM aqi GROUP BY 1) USING (device_id))"""


add("sensor_summary", [READINGS, AQI, summary_sql("pm25_raw")], f"""
SELECT device_id, {rs(['latitude', 'longitude'])}, city, region, country_code, {r('value', 'value')}, n_readings,
{rs(['avg_aqi', 'max_aqi'])} FROM summary""")
add("summary_table", [READINGS, AQI, summary_sql("pm10_raw")], f"""
SELECT device_id, city, {r('value', 'pm10')}, n_readings, {rs(['avg_aqi', 'max_aqi'])} FROM summary""")
add("map_markers", [READINGS, AQI, summary_sql("pm25_raw")], f"""
SELECT device_id, {rs(['latitude', 'longitude'])},
{r('CASE WHEN value IS NULL THEN 6 ELSE 6 + 14 * value / (SELECT max(value) FROM summary) END', 'radius')},
CASE WHEN avg_aqi IS NULL THEN '#999999' WHEN avg_aqi <= 50 THEN '#00e400' WHEN avg_aqi <= 100 THEN '#ffff00'
  WHEN avg_aqi <= 150 THEN '#ff7e00' WHEN avg_aqi <= 200 THEN '#ff0000' WHEN avg_aqi <= 300 THEN '#8f3f97'
  ELSE '#7e0023' END AS color,
'<b>' || city || '</b><br>Device: ' || device_id || '<br>' || CASE WHEN value IS NULL THEN '(no readings)'
  ELSE 'PM2.5 [ug/m3]: ' || printf('%.1f', round_even(value, 1)) END AS popup,
city || ' (' || device_id || ')' AS tooltip FROM summary""")

# --- time series ----------------------------------------------------------------------------

add("hourly_grid", [READINGS, grid_sql(["pm25_raw", "no2_raw"])], f"""
SELECT device_id, city, timestamp, {rs(['pm25_raw', 'no2_raw'])} FROM grid""")
add("resample_hour", [READINGS, """m AS (SELECT city, date_trunc('hour', timestamp) AS start, avg(pm25_raw) AS pm25_raw
  FROM joined GROUP BY 1, 2),
slots AS (SELECT city, unnest(generate_series(min(start), max(start), INTERVAL 1 HOUR)) AS start FROM m GROUP BY 1)"""],
f"SELECT city, start, {r('pm25_raw', 'pm25_raw')} FROM slots LEFT JOIN m USING (city, start)")
add("resample_day", [LONG, """m AS (SELECT city, CAST(local_ts AS DATE) AS start, avg(pm25_raw) AS pm25_raw
  FROM long_joined GROUP BY 1, 2),
slots AS (SELECT city, CAST(unnest(generate_series(min(start), max(start), INTERVAL 1 DAY)) AS DATE) AS start
  FROM m GROUP BY 1)"""],
f"SELECT city, start, {r('pm25_raw', 'pm25_raw')} FROM slots LEFT JOIN m USING (city, start)")
add("resample_month", [LONG, """m AS (SELECT city, CAST(date_trunc('month', local_ts) AS DATE) AS start,
  avg(pm25_raw) AS pm25_raw, avg(pm10_raw) AS pm10_raw FROM long_joined GROUP BY 1, 2),
slots AS (SELECT city, CAST(unnest(generate_series(min(start), max(start), INTERVAL 1 MONTH)) AS DATE) AS start
  FROM m GROUP BY 1)"""],
f"SELECT city, start, {rs(['pm25_raw', 'pm10_raw'])} FROM slots LEFT JOIN m USING (city, start)")
ONE = grid_sql(["pm25_raw"])
add("lag_features", [READINGS, ONE], f"""
SELECT device_id, city, timestamp, {r('pm25_raw', 'pm25_raw')}, {rounded(lag_sql('pm25_raw'))},
{r(f'pm25_raw - lag(pm25_raw, 3) {W})', 'delta_3h')}, {r(f'lead(pm25_raw, 1) {W})', 'target')} FROM grid""")
add("rolling_features", [READINGS, ONE], f"""
SELECT device_id, city, timestamp, {r('pm25_raw', 'pm25_raw')}, {rounded(rolling_sql('pm25_raw'))} FROM grid""")
add("calendar_features", [LONG], f"SELECT order_id, timestamp, {rounded(CYCLES)}, {plain(FLAGS)} FROM long_readings")
add("calendar_fields", [READINGS], """
SELECT event_id, dayname(local_ts) AS weekday, strftime(local_ts, '%Y-%m') AS month, CAST(local_ts AS DATE) AS date,
CAST(hour(local_ts) AS INTEGER) AS hour, strftime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM readings""")

# --- anomalies ------------------------------------------------------------------------------

DAY_VALUES = ["pm25_raw", "pm10_raw"]
add("robust_z", [READINGS, DAYS, robust("days", "pm25_raw", "z25")], f"""
SELECT days.city, days.date, {rs(DAY_VALUES)}, {r('z', 'z_pm25')} FROM days JOIN z25 USING (city, date)""")
add("reading_robust_z", [READINGS, """middle AS (SELECT city, median(no2_raw) AS med FROM joined GROUP BY city),
sizes AS (SELECT city, any_value(med) AS med, median(abs(no2_raw - med)) AS mad FROM joined JOIN middle USING (city) GROUP BY city)"""], f"""
SELECT event_id, city, {r(f"{d(0.6745)} * (no2_raw - med) / nullif(mad, 0)", 'z_no2')} FROM joined JOIN sizes USING (city)""")
add("city_quantiles", [READINGS], " UNION ALL ".join(f"""
SELECT city, {r(d(p), 'probability')}, {r(f'quantile_cont(no2_raw, {p})', 'value')} FROM joined GROUP BY city"""
    for p in (0.05, 0.25, 0.5, 0.75, 0.99)))
add("detected_anomalies", [READINGS, ANOMALIES], f"""
SELECT city, date, {rs([*DAY_VALUES, 'z_pm25', 'z_pm10'])}, is_statistical, is_threshold, severity FROM found""")
TENTHS = ", ".join(f"round(round_even({c}, 1) + 1e-10::DOUBLE, 6) AS {c}" for c in DAY_VALUES)
add("worst_days", [READINGS, ANOMALIES], f"""
SELECT city, date, {TENTHS}, severity FROM (SELECT * FROM found ORDER BY pm25_raw DESC, city, date LIMIT 10)""")
add("anomaly_list", [READINGS, ANOMALIES], f"""
SELECT city, date, {TENTHS}, severity FROM found
WHERE {CITIES} AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'""")
add("severity_counts", [READINGS, ANOMALIES], "SELECT severity, count(*) AS n FROM found GROUP BY 1")

add("anomalies_per_city", [READINGS, ANOMALIES], "SELECT city, count(*) AS n FROM found GROUP BY 1")

# --- learning -------------------------------------------------------------------------------

DATA = dataset_sql("pm25_raw")
add("feature_matrix", [READINGS, DATA], f"""
SELECT timestamp, device_id, city, {rs(FEATURE_DOUBLES)}, {', '.join(FEATURE_FLAGS)}, {r('target', 'target')} FROM data""")
add("feature_overview", [READINGS, dataset_sql("pm10_raw")], """
SELECT count(*) AS n_rows, count(DISTINCT device_id) AS n_devices, min(timestamp) AS "first",
max(timestamp) AS "last" FROM data""")
ALL_FEATURES = [*FEATURE_DOUBLES, *FEATURE_FLAGS]
add("missing_features", [READINGS, DATA], f"""
SELECT {r('(' + ' + '.join(f"avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END)" for c in ALL_FEATURES)
+ f') * 100 / {len(ALL_FEATURES)}', 'missing_pct')} FROM data""")
add("time_split", [READINGS, DATA], """
SELECT CASE WHEN epoch_us(timestamp) <= cut_us THEN 'train' ELSE 'test' END AS part, count(*) AS n,
min(timestamp) AS "first", max(timestamp) AS "last" FROM data, split GROUP BY 1""")
add("persistence_metrics", [READINGS, DATA], f"""
SELECT {r('avg(abs(target - pm25_raw))', 'mae')}, {r('sqrt(avg((target - pm25_raw) ** 2))', 'rmse')},
{r('1 - sum((target - pm25_raw) ** 2) / nullif(var_pop(target) * count(*), 0)', 'r2')} FROM test""")
add("prediction_long", [READINGS, DATA], f"""
SELECT timestamp, 'actual' AS series, {r('target', 'value')} FROM test WHERE device_id = 'view-1'
UNION ALL SELECT timestamp, 'predicted', {r('pm25_raw', 'value')} FROM test WHERE device_id = 'view-1'""")
add("persistence_by_sensor", [READINGS, DATA], f"""
SELECT 'pm25_raw' AS target, city, device_id, {r('avg(abs(target - pm25_raw))', 'mae')}, count(*) AS n_hours
FROM test GROUP BY city, device_id""")
add("prediction_choices", [READINGS, DATA], f"SELECT DISTINCT city, device_id FROM test WHERE {CITIES}")
THOUSANDTHS = [
    ("avg(abs(target - pm25_raw))", "mae"),
    ("sqrt(avg((target - pm25_raw) ** 2))", "rmse"),
    ("1 - sum((target - pm25_raw) ** 2) / nullif(var_pop(target) * count(*), 0)", "r2"),
    (d(0), "train_seconds"),
]
add("persistence_table", [READINGS, DATA], f"""
SELECT 'Persistence (baseline)' AS model, {rounded([(f"round_even({e}, 3)", n) for e, n in THOUSANDTHS])} FROM test""")

# --- what the models see --------------------------------------------------------------------

TRAIN = f"{DATA}, train AS (SELECT data.* FROM data, split WHERE epoch_us(timestamp) <= cut_us)"
MEDIANS = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in ALL_FEATURES)
FILLED_ROWS = f"""{TRAIN}, medians AS (SELECT {MEDIANS} FROM train),
filled AS (SELECT device_id, timestamp, {', '.join(f'coalesce(CAST(t.{c} AS DOUBLE), m.{c}) AS {c}' for c in ALL_FEATURES)}
  FROM train t, medians m),
moments AS (SELECT {', '.join(f'avg({c}) AS mean_{c}, stddev_samp({c}) AS sd_{c}' for c in ALL_FEATURES)} FROM filled)"""
add("train_medians", [READINGS, TRAIN], per_column(ALL_FEATURES, f"""
SELECT '@' AS "column", {r('quantile_cont(CAST(@ AS DOUBLE), 0.5)', 'value')} FROM train"""))
add("standardised_features", [READINGS, FILLED_ROWS], f"""SELECT device_id, timestamp,
{rounded([(f'coalesce(({c} - mean_{c}) / nullif(sd_{c}, 0), 0)', c) for c in ALL_FEATURES])} FROM filled, moments""")
# Two weights in units of the sample deviation, from the normal equations divided by n - 1; the penalty is 1.
TWO = f"""{TRAIN},
sums AS (SELECT 1 + {d(1)} / count(*) AS a, corr(pm25_raw, lag_1h) AS b, avg(target) AS mean,
  covar_samp(target, pm25_raw) / stddev_samp(pm25_raw) AS c1, covar_samp(target, lag_1h) / stddev_samp(lag_1h) AS c2 FROM train)"""
add("ridge_coefficients", [READINGS, TWO], f"""
SELECT 'pm25_raw' AS term, {r('(a * c1 - b * c2) / (a * a - b * b)', 'weight')} FROM sums
UNION ALL SELECT 'lag_1h', {r('(a * c2 - b * c1) / (a * a - b * b)', 'weight')} FROM sums
UNION ALL SELECT 'intercept', {r('mean', 'weight')} FROM sums""")


def truth(target: str) -> str:
    return f"""(WITH {READINGS}, {dataset_sql(target)} SELECT device_id, city, timestamp, {r('target', 'actual')},
'{target}' AS target FROM test)"""


ORACLES["held_out_truth"] = f"SELECT * FROM {truth('pm25_raw')} UNION ALL SELECT * FROM {truth('pm10_raw')}"
