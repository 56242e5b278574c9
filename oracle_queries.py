"""For each registered query the SQL that gives the same rows on the same tables.

The statements say what a query means, not how it is run: joins are written out row by row here
where the engine side aggregates first, and duplicates are a UNION ALL.
"""

from __future__ import annotations

# One record per event, silver names. Both halves of a delivery carry the same id.
_RECORDS = """
source_rows AS (
  SELECT e.*, c.c_name, c.c_mktsegment, n.n_nationkey, n.n_name,
         CAST(regexp_extract(e.props, '"k": ([0-9]+)', 1) AS INTEGER) AS k
  FROM events e, customer c, nation n
  WHERE e.user_id = c.c_custkey AND c.c_nationkey = n.n_nationkey
),
once AS (
  SELECT
    k,
    concat('A-', CAST(event_id AS VARCHAR)) AS id,
    strftime(ts, '%d-%m-%Y') AS situation_text,
    CAST(ts AS DATE) AS situation_date,
    event_type AS source,
    CASE event_type WHEN 'error' THEN 4 WHEN 'purchase' THEN 3 WHEN 'click' THEN 2 WHEN 'view' THEN 1 END AS severity,
    CASE WHEN k % 25 <> 24 THEN ts END AS start_time,
    ts + to_minutes(CAST(k AS BIGINT)) AS end_time,
    25 + k / CAST(4 AS DOUBLE) AS start_lat,
    CAST(-120 + user_id % 60 AS DOUBLE) AS start_lng,
    CAST(NULL AS DOUBLE) AS end_lat,
    CAST(NULL AS DOUBLE) AS end_lng,
    value AS distance_mi,
    props AS description,
    c_name AS street,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS city,
    n_name || '/' || c_mktsegment AS county,
    CASE WHEN n_nationkey <> 0 THEN n_name END AS state,
    lpad(CAST(user_id AS VARCHAR), 5, '0') AS zipcode,
    'US' AS country,
    CAST(NULL AS VARCHAR) AS timezone,
    CAST(NULL AS VARCHAR) AS airport_code,
    k % 19 = 0 AS amenity, k % 17 = 0 AS bump, k % 13 = 0 AS crossing, k % 23 = 0 AS give_way,
    k % 5 = 0 AS junction, k % 29 = 0 AS no_exit, k % 11 = 0 AS railway, k % 7 = 0 AS roundabout,
    k % 31 = 0 AS station, k % 3 = 0 AS stop, k % 37 = 0 AS traffic_calming,
    k % 2 = 0 AS traffic_signal, false AS turning_loop,
    CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'Day' ELSE 'Night' END AS sunrise_sunset,
    CASE WHEN hour(ts) BETWEEN 5 AND 18 THEN 'Day' ELSE 'Night' END AS civil_twilight,
    CASE WHEN hour(ts) BETWEEN 5 AND 19 THEN 'Day' ELSE 'Night' END AS nautical_twilight,
    CASE WHEN hour(ts) BETWEEN 4 AND 20 THEN 'Day' ELSE 'Night' END AS astronomical_twilight,
    date_trunc('hour', ts) AS weather_timestamp,
    CASE WHEN k % 10 <> 9 THEN value END AS temperature_f,
    CASE WHEN k % 4 <> 3 THEN value - 5 END AS wind_chill_f,
    CAST(k AS DOUBLE) AS humidity_pct,
    29 + k / CAST(100 AS DOUBLE) AS pressure_in,
    CASE WHEN k % 20 <> 13 THEN k / CAST(10 AS DOUBLE) END AS visibility_mi,
    CASE k % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'E' WHEN 2 THEN 'S' ELSE 'W' END AS wind_direction,
    CAST(user_id % 40 AS DOUBLE) AS wind_speed_mph,
    CASE WHEN k % 6 <> 5 THEN (k % 6) / CAST(10 AS DOUBLE) END AS precipitation_in,
    CASE k % 6 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Rain' WHEN 2 THEN 'Snow' WHEN 3 THEN 'Fog' WHEN 4 THEN 'Cloudy' END AS weather_condition
  FROM source_rows
),
records AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE k < 2)
"""


def _on_records(body: str) -> str:
    return f"WITH {_RECORDS.strip()}{body}"


def _stamp(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f') AS {col}"


def _day(expression: str, name: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d') AS {name}"


_TEMPERATURE = """CASE WHEN temperature_f < 32 THEN 'Freezing' WHEN temperature_f <= 50 THEN 'Cold'
  WHEN temperature_f <= 70 THEN 'Moderate' WHEN temperature_f <= 85 THEN 'Warm'
  WHEN temperature_f IS NOT NULL THEN 'Hot' END"""
_VISIBILITY = """CASE WHEN visibility_mi < 1 THEN 'Poor' WHEN visibility_mi <= 5 THEN 'Moderate'
  WHEN visibility_mi IS NOT NULL THEN 'Good' END"""

# Half-up rounding of a percentage in whole numbers, free of binary fractions.
_SHARE = "CAST((n * 20000 + total) // (2 * total) AS DOUBLE) / 100"

_FLAG_COUNTS = {
    "traffic_signal": "traffic_signal_accidents",
    "stop": "stop_sign_accidents",
    "junction": "junction_accidents",
    "roundabout": "roundabout_accidents",
    "railway": "railway_accidents",
    "crossing": "crossing_accidents",
}

_ACCIDENT_SELECT = f"""id, {_day('situation_date', 'situation_date')}, source, severity,
  {_stamp('start_time')}, {_stamp('end_time')}, start_lat, start_lng, end_lat, end_lng, distance_mi,
  description, street, city, county, state, zipcode, country, timezone, airport_code, amenity, bump,
  crossing, give_way, junction, no_exit, railway, roundabout, station, stop, traffic_calming,
  traffic_signal, turning_loop, sunrise_sunset, civil_twilight, nautical_twilight, astronomical_twilight"""
_WEATHER_SELECT = f"""id, {_day('situation_date', 'situation_date')}, {_stamp('weather_timestamp')},
  temperature_f, wind_chill_f, humidity_pct, pressure_in, visibility_mi, wind_direction,
  wind_speed_mph, precipitation_in, weather_condition"""

_CONDITION = """
SELECT w.weather_condition AS "Weather_Condition", count(DISTINCT a.id) AS accident_count,
       round(avg(a.severity), 6) AS avg_severity
FROM {a} a JOIN {w} w USING (id)
WHERE w.weather_condition IS NOT NULL
GROUP BY ALL"""
_IMPACT = f"""
SELECT {_TEMPERATURE} AS temperature_range, {_VISIBILITY} AS visibility_condition,
       count(DISTINCT a.id) AS accident_count, round(avg(a.severity), 6) AS avg_severity,
       round(avg(w.wind_speed_mph), 6) AS avg_wind_speed
FROM (SELECT id, severity FROM {{a}}) a
JOIN (SELECT id, temperature_f, visibility_mi, wind_speed_mph FROM {{w}}) w USING (id)
WHERE temperature_f IS NOT NULL AND visibility_mi IS NOT NULL
GROUP BY ALL"""

_FLAGS = ["traffic_signal", "stop", "junction", "bump", "roundabout", "railway", "crossing"]
_TWILIGHT = ["sunrise_sunset", "civil_twilight", "nautical_twilight", "astronomical_twilight"]
_READINGS = {
    "temperature": "temperature_f",
    "humidity": "humidity_pct",
    "visibility": "visibility_mi",
    "wind_chill": "wind_chill_f",
    "precipitation": "precipitation_in",
    "wind_speed": "wind_speed_mph",
}
_FLAG_INTS = ", ".join(
    [f"CASE WHEN {c} THEN 1 ELSE 0 END AS {c}" for c in _FLAGS]
    + [f"CASE WHEN {c} = 'Day' THEN 1 ELSE 0 END AS {c}" for c in _TWILIGHT]
)
_FILLED = ", ".join(f"round(coalesce({c}, avg({c}) OVER ()), 6) AS {out}" for out, c in _READINGS.items())
_CALENDAR = """CAST(hour(start_time) AS INTEGER) AS hour,
  CAST(dayofweek(start_time) + 1 AS INTEGER) AS day_of_week, CAST(month(start_time) AS INTEGER) AS month,
  CASE WHEN hour(start_time) IN (7, 8, 9, 17, 18, 19) THEN 1 ELSE 0 END AS is_rush_hour,
  CASE WHEN dayofweek(start_time) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend"""
_FEATURES = f"""id, severity, {_stamp('start_time')}, round(start_lng, 6) AS start_lng,
  round(start_lat, 6) AS start_lat, coalesce(state, 'Unknown') AS state, coalesce(city, 'Unknown') AS city,
  {_FLAG_INTS}, {_FILLED}, coalesce(weather_condition, 'Unknown') AS weather_condition, {_CALENDAR},
  CASE WHEN severity >= 3 THEN 1 ELSE 0 END AS severity_binary"""

_ORDERS = f"""o_orderkey, o_custkey, strftime(o_orderdate, '%d-%m-%Y') AS situation_date, o_totalprice
FROM orders"""

_CORRELATED = ["temperature_f", "humidity_pct", "visibility_mi", "wind_speed_mph", "precipitation_in"]

_CONTINGENCY = """
cells AS (
  SELECT column_name, value, severity, count(*) AS n
  FROM (SELECT a.severity, unnest([{'column_name': 'weather_condition', 'value': w.weather_condition},
                                   {'column_name': 'wind_direction', 'value': w.wind_direction}], recursive := true)
        FROM records a JOIN records w USING (id))
  WHERE value IS NOT NULL AND severity IS NOT NULL GROUP BY ALL
),
expected AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY column_name, value) AS DOUBLE) * sum(n) OVER (PARTITION BY column_name, severity)
              / sum(n) OVER (PARTITION BY column_name) AS expected,
         CAST(sum(n) OVER (PARTITION BY column_name) AS BIGINT) AS total
  FROM cells
)"""

_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
_WIDTHS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6}

_QUALITY = [
    ("not_null", "Severity", "severity IS NULL"),
    ("not_null", "Start_Time", "start_time IS NULL"),
    ("not_null", "State", "state IS NULL"),
    ("not_null", "City", "city IS NULL"),
    ("not_null", "Temperature(F)", "temperature_f IS NULL"),
    ("not_null", "Weather_Condition", "weather_condition IS NULL"),
    ("in_range", "Severity", "severity < 1 OR severity > 3"),
    ("in_range", "Visibility(mi)", "visibility_mi < 0 OR visibility_mi > 9"),
    ("parsable_date", "situation_date", "try_strptime(situation_text, '%d-%m-%Y') IS NULL"),
]

_RULE = """,
ruled AS (
  SELECT CAST(severity >= 3 AS INTEGER) AS label, CAST(coalesce(temperature_f > 60, false) AS INTEGER) AS prediction
  FROM records WHERE severity IS NOT NULL
)"""

ORACLE_SQL = {
    "mart_daily": _on_records(f"""
SELECT {_day('CAST(start_time AS DATE)', 'accident_date')}, count(DISTINCT id) AS accident_count
FROM records GROUP BY 1"""),
    "mart_severity": _on_records(f""",
counts AS (SELECT severity, count(DISTINCT id) AS n FROM records WHERE severity IS NOT NULL GROUP BY severity),
whole AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM counts)
SELECT severity AS "Severity", n AS accident_count, {_SHARE} AS percentage FROM counts, whole"""),
    "mart_location": _on_records("""
SELECT state AS "State", city AS "City", count(DISTINCT id) AS accident_count
FROM records WHERE state IS NOT NULL AND city IS NOT NULL
GROUP BY ALL ORDER BY 3 DESC, 1, 2 LIMIT 50"""),
    "mart_time_patterns": _on_records("""
SELECT CAST(hour(start_time) AS INTEGER) AS hour_of_day,
       CAST(dayofweek(start_time) + 1 AS INTEGER) AS day_of_week, count(DISTINCT id) AS accident_count
FROM records WHERE start_time IS NOT NULL GROUP BY 1, 2"""),
    "mart_infrastructure": _on_records("""
SELECT count(*) FILTER (traffic_signal) AS traffic_signal_accidents,
       count(*) FILTER (stop) AS stop_sign_accidents,
       count(*) FILTER (junction) AS junction_accidents,
       count(*) FILTER (roundabout) AS roundabout_accidents,
       count(*) FILTER (railway) AS railway_accidents,
       count(*) FILTER (crossing) AS crossing_accidents,
       count(DISTINCT id) AS total_accidents
FROM records"""),
    "mart_weather_condition": _on_records(_CONDITION.format(a="records", w="records")),
    "mart_weather_impact": _on_records(_IMPACT.format(a="records", w="records")),
    "mart_weather_condition_dedupe": _on_records(_CONDITION.format(a="once", w="once")),
    "mart_weather_impact_dedupe": _on_records(_IMPACT.format(a="once", w="once")),
    "marts_one_pass": _on_records(f"""
SELECT 'daily' AS mart, {_day('CAST(start_time AS DATE)', 'accident_date')}, CAST(NULL AS INTEGER) AS "Severity",
       CAST(NULL AS VARCHAR) AS "State", CAST(NULL AS VARCHAR) AS "City", CAST(NULL AS INTEGER) AS hour_of_day,
       CAST(NULL AS INTEGER) AS day_of_week, count(DISTINCT id) AS accident_count
FROM records GROUP BY 2
UNION ALL
SELECT 'severity', NULL, severity, NULL, NULL, NULL, NULL, count(DISTINCT id)
FROM records WHERE severity IS NOT NULL GROUP BY severity
UNION ALL
SELECT 'location', NULL, NULL, state, city, NULL, NULL, count(DISTINCT id)
FROM records WHERE state IS NOT NULL AND city IS NOT NULL GROUP BY state, city
UNION ALL
SELECT 'time_patterns', NULL, NULL, NULL, NULL, CAST(hour(start_time) AS INTEGER),
       CAST(dayofweek(start_time) + 1 AS INTEGER), count(DISTINCT id)
FROM records WHERE start_time IS NOT NULL GROUP BY hour(start_time), dayofweek(start_time)"""),
    "seasonal_counts": _on_records("""
SELECT CASE WHEN month(start_time) IN (12, 1, 2) THEN 'Winter' WHEN month(start_time) <= 5 THEN 'Spring'
            WHEN month(start_time) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season,
       count(DISTINCT id) AS accident_count
FROM records WHERE start_time IS NOT NULL GROUP BY 1"""),
    "weather_severity_corr": _on_records("\nUNION ALL".join(
        f"""
SELECT '{c}' AS column_name, round(corr(CAST(a.severity AS DOUBLE), w.{c}), 6) AS correlation
FROM records a JOIN records w USING (id)""" for c in _CORRELATED)),
    "condition_severity_table": _on_records(f",{_CONTINGENCY} SELECT column_name, value, severity, n, round(expected, 6) AS expected FROM expected"),
    "condition_association": _on_records(f""",{_CONTINGENCY}
SELECT column_name, any_value(total) AS rows, count(DISTINCT value) AS x_kinds, count(DISTINCT severity) AS y_kinds,
       (x_kinds - 1) * (y_kinds - 1) AS degrees, round(sum(CAST(n AS DOUBLE) * n / expected) - any_value(total), 6) AS chi_square,
       round(sqrt((sum(CAST(n AS DOUBLE) * n / expected) - any_value(total)) / (any_value(total) * (least(x_kinds, y_kinds) - 1))), 6) AS cramers_v
FROM expected GROUP BY column_name"""),
    "weather_rank_corr": _on_records("\nUNION ALL".join(
        f"""
SELECT '{c}' AS column_name, count(*) AS rows, round(corr(x, y), 6) AS correlation
FROM (SELECT rank() OVER (ORDER BY w.{c}) + (count(*) OVER (PARTITION BY w.{c}) - 1) / CAST(2 AS DOUBLE) AS x,
             rank() OVER (ORDER BY a.severity) + (count(*) OVER (PARTITION BY a.severity) - 1) / CAST(2 AS DOUBLE) AS y
      FROM records a JOIN records w USING (id) WHERE w.{c} IS NOT NULL AND a.severity IS NOT NULL)""" for c in _CORRELATED)),
    "silver_versions": _on_records(f"""
SELECT CAST(1 AS INTEGER) AS version, id, {_day('situation_date', 'situation_date')}, severity FROM records WHERE severity IS NOT NULL
UNION ALL SELECT CAST(2 AS INTEGER), id, {_day('situation_date', 'situation_date')}, severity FROM records"""),
    "mart_copy_accidents": _on_records(f"\nSELECT {_ACCIDENT_SELECT} FROM records"),
    "mart_copy_weather": _on_records(f"\nSELECT {_WEATHER_SELECT} FROM records"),
    "served_marts": _on_records("""
SELECT 'gold_top_accidents_by_day' AS table_name, 2 AS column_count,
       (SELECT count(*) FROM (SELECT DISTINCT CAST(start_time AS DATE) FROM records)) AS row_count
UNION ALL SELECT 'gold_accidents_by_severity', 3, (SELECT count(DISTINCT severity) FROM records)
UNION ALL SELECT 'gold_accidents_by_location', 3, (SELECT least(50, count(*)) FROM
  (SELECT DISTINCT state, city FROM records WHERE state IS NOT NULL AND city IS NOT NULL))
UNION ALL SELECT 'gold_accidents_by_weather', 3, (SELECT count(DISTINCT weather_condition) FROM records)
UNION ALL SELECT 'gold_accidents_time_patterns', 3, (SELECT count(*) FROM
  (SELECT DISTINCT hour(start_time), dayofweek(start_time) FROM records WHERE start_time IS NOT NULL))
UNION ALL SELECT 'gold_road_infrastructure_summary', 7, 1
UNION ALL SELECT 'gold_weather_impact_analysis', 5, (SELECT count(*) FROM (""" + f"""
  SELECT DISTINCT {_TEMPERATURE}, {_VISIBILITY} FROM records
  WHERE temperature_f IS NOT NULL AND visibility_mi IS NOT NULL))
UNION ALL SELECT 'gold_accidents', 37, (SELECT count(*) FROM records)
UNION ALL SELECT 'gold_weather', 12, (SELECT count(*) FROM records)"""),
    "raw_csv_roundtrip": _on_records(f"""
SELECT id, situation_text AS situation_date, severity, {_stamp('start_time')}, temperature_f, description,
       stop, 0 AS bad_fields FROM records"""),
    "snapshot_merge": f"SELECT {_ORDERS}",
    "snapshot_delta": f"SELECT {_ORDERS} WHERE o_orderdate < TIMESTAMP '1999-01-01'",
    "feeds_same_day": """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 <> 0 THEN '31-12-2001' END AS situation_date, o_totalprice
FROM orders""",
    "feeds_late": f"SELECT {_ORDERS}",
    "raw_csv_bad_rows": """
SELECT 'O-' || o_orderkey AS id, CAST(o_orderkey % 4 + 1 AS INTEGER) AS severity,
       CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS description,
       CASE o_orderkey % 10 WHEN 0 THEN 'O-' || o_orderkey || ',' || (o_orderkey % 4 + 1)
            WHEN 1 THEN 'O-' || o_orderkey || ',' || (o_orderkey % 4 + 1) || ',' || o_orderpriority || ',more' END AS bad_row
FROM orders""",
    "page_union": "SELECT o_orderpriority, o_custkey, o_orderkey FROM orders",
    "confusion_by_rule": _on_records(f"{_RULE} SELECT label, prediction, count(*) AS n FROM ruled GROUP BY ALL"),
    "metrics_by_rule": _on_records(f"""{_RULE},
per_class AS (
  SELECT c, count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS predicted,
         count(*) FILTER (label = c AND prediction = c) AS hit
  FROM ruled, (VALUES (0), (1)) AS classes(c) GROUP BY c
)
SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(hit) / sum(support), 6) AS accuracy,
       round(sum(coalesce(2.0 * hit / nullif(support + predicted, 0), 0) * support) / sum(support), 6) AS f1
FROM per_class"""),
    "top_by_rule": _on_records("""
SELECT id, severity, CAST(coalesce(severity, 0) >= 3 AS INTEGER) AS severity_binary,
       CASE WHEN temperature_f > 60 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
       round(coalesce(temperature_f, 0) / 1000, 6) AS probability_high
FROM records
ORDER BY prediction DESC, coalesce(temperature_f, 0) / 1000 DESC, id LIMIT 20"""),
    "stream_versions": _on_records(f"""
SELECT id, CASE WHEN severity IS NULL THEN {_day('situation_date', 'd').rpartition(' AS ')[0]} ELSE '2024-12-31' END AS situation_date,
       5 - severity AS severity
FROM once"""),
    "merge_feeds": f"""SELECT {_ORDERS} WHERE o_orderdate < TIMESTAMP '1997-01-01'
UNION ALL SELECT {_ORDERS} WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
UNION ALL SELECT {_ORDERS} WHERE o_orderdate >= TIMESTAMP '1999-01-01'""",
    "latest_situation_date": f"SELECT {_day('max(o_orderdate)', 'latest_date')} FROM orders",
    "dedupe_latest": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate, o_orderpriority
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "split_accidents": _on_records(f"\nSELECT {_ACCIDENT_SELECT} FROM records"),
    "split_weather": _on_records(f"\nSELECT {_WEATHER_SELECT} FROM records"),
    "calendar_partitions": """
SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS situation_date,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day
FROM orders""",
    "silver_roundtrip": _on_records(f"""
SELECT id, {_day('situation_date', 'situation_date')}, temperature_f, weather_condition,
       CAST(year(situation_date) AS INTEGER) AS year, CAST(month(situation_date) AS INTEGER) AS month,
       CAST(day(situation_date) AS INTEGER) AS day
FROM records"""),
    "silver_incremental": _on_records(f""",
versions AS (
  SELECT id, CASE WHEN situation_date > DATE '2024-01-10' OR k <> 50 THEN situation_date END AS d, severity, temperature_f
  FROM once
  UNION ALL SELECT id, DATE '2024-01-15', 1, temperature_f FROM once
  WHERE situation_date <= DATE '2024-01-10' AND severity = 3
  UNION ALL SELECT id, DATE '2024-01-25', 2, temperature_f FROM once WHERE situation_date = DATE '2024-01-03'
)
SELECT id, {_day('d', 'situation_date')}, severity, temperature_f FROM versions
QUALIFY row_number() OVER (PARTITION BY id ORDER BY d DESC NULLS LAST) = 1"""),
    "marts_incremental": _on_records(f""",
versions AS (
  SELECT CASE WHEN situation_date > DATE '2024-01-10' OR k <> 50 THEN situation_date END AS d, * FROM once
  UNION ALL SELECT DATE '2024-01-15', * REPLACE (1 AS severity) FROM once
  WHERE situation_date <= DATE '2024-01-10' AND severity = 3
  UNION ALL SELECT DATE '2024-01-25', * REPLACE (2 AS severity) FROM once WHERE situation_date = DATE '2024-01-03'
),
newest AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY id ORDER BY d DESC NULLS LAST) = 1),
kept AS (SELECT * FROM newest WHERE d IS NOT NULL),
levels AS (SELECT severity, count(id) AS n FROM kept WHERE severity IS NOT NULL GROUP BY 1),
whole AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM levels),
places AS (
  SELECT state, city, count(id) AS n FROM kept WHERE state IS NOT NULL AND city IS NOT NULL
  GROUP BY 1, 2 ORDER BY n DESC, state, city LIMIT 50
),
bands AS (
  SELECT {_TEMPERATURE} AS t, {_VISIBILITY} AS v, severity, wind_speed_mph FROM kept
  WHERE temperature_f IS NOT NULL AND visibility_mi IS NOT NULL
),
found(mart, k1, k2, accident_count, avg_severity, avg_wind_speed) AS (
  SELECT 'top_accidents_by_day', strftime(start_time, '%Y-%m-%d'), NULL, count(id), NULL, NULL FROM kept GROUP BY 2
  UNION ALL SELECT 'accidents_by_severity', CAST(severity AS VARCHAR), CAST(CAST({_SHARE} AS DOUBLE) AS VARCHAR), n, NULL, NULL
  FROM levels, whole
  UNION ALL SELECT 'accidents_by_location', state, city, n, NULL, NULL FROM places
  UNION ALL SELECT 'accidents_time_patterns', CAST(hour(start_time) AS VARCHAR), CAST(dayofweek(start_time) + 1 AS VARCHAR),
    count(id), NULL, NULL FROM kept WHERE start_time IS NOT NULL GROUP BY 2, 3
  UNION ALL SELECT 'accidents_by_weather', weather_condition, NULL, count(id), round(avg(severity), 6), NULL FROM kept
  WHERE weather_condition IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'weather_impact_analysis', t, v, count(*), round(avg(severity), 6), round(avg(wind_speed_mph), 6)
  FROM bands GROUP BY 2, 3
  UNION ALL SELECT 'accidents', NULL, NULL, count(*), NULL, NULL FROM kept
  UNION ALL SELECT 'weather', NULL, NULL, count(*), NULL, NULL FROM kept
  UNION ALL SELECT 'road_infrastructure_summary', 'total_accidents', NULL, count(id), NULL, NULL FROM kept
""" + "".join(f"""
  UNION ALL SELECT 'road_infrastructure_summary', '{out}', NULL, count(*) FILTER ({col}), NULL, NULL FROM kept"""
        for col, out in _FLAG_COUNTS.items()) + """
)
SELECT mart, k1, k2, accident_count, CAST(avg_severity AS DOUBLE) AS avg_severity,
       CAST(avg_wind_speed AS DOUBLE) AS avg_wind_speed FROM found"""),
    "silver_days": _on_records(f"""
SELECT {_day('situation_date', 'situation_date')}, count(DISTINCT id) AS accident_count
FROM records WHERE situation_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19' GROUP BY 1"""),
    "silver_rejects": _on_records("""
SELECT id, severity, CAST(NULL AS VARCHAR) AS situation_date FROM records WHERE start_time IS NULL"""),
    "quality_report": _on_records("\nUNION ALL".join(
        f"""
SELECT '{rule}' AS rule, '{column}' AS column_name, count(*) FILTER ({bad}) AS violations FROM records"""
        for rule, column, bad in _QUALITY) + """
UNION ALL
SELECT 'unique_id', 'ID', count(id) - count(DISTINCT id) FROM records"""),
    "rename_select": _on_records(f"""
SELECT id, {_stamp('start_time')}, city, {', '.join(f'{c} AS {out}' for out, c in _READINGS.items())}
FROM records"""),
    "not_null": _on_records("""
SELECT id, state, city FROM records WHERE state IS NOT NULL AND city IS NOT NULL"""),
    "band_temperature": _on_records(f"""
SELECT id, temperature_f, {_TEMPERATURE} AS temperature_range FROM records"""),
    "band_visibility": _on_records(f"""
SELECT id, visibility_mi, coalesce({_VISIBILITY}, 'Unknown') AS visibility_condition FROM records"""),
    "flags_to_int": _on_records(f"\nSELECT id, {_FLAG_INTS} FROM records"),
    "time_features": _on_records(f"\nSELECT id, {_stamp('start_time')}, {_CALENDAR} FROM records"),
    "severity_binary": _on_records("""
SELECT id, severity, CASE WHEN severity >= 3 THEN 1 ELSE 0 END AS severity_binary FROM records"""),
    "fill_unknown": _on_records("""
SELECT id, coalesce(weather_condition, 'Unknown') AS weather_condition, coalesce(state, 'Unknown') AS state,
       coalesce(city, 'Unknown') AS city FROM records"""),
    "mean_impute": _on_records(f"\nSELECT id, {_FILLED} FROM records"),
    "join_halves": _on_records("""
SELECT a.id, a.severity, a.state, w.temperature_f, w.weather_condition FROM records a JOIN once w USING (id)"""),
    "collapse_copies": _on_records("""
SELECT id, severity, city, CAST(count(*) AS DOUBLE) AS copies FROM records GROUP BY ALL"""),
    "band_join_summary": """
SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity <= 25 THEN 'medium'
            WHEN l_quantity <= 40 THEN 'large' ELSE 'bulk' END AS quantity_band,
       l_returnflag, count(DISTINCT o_orderkey) AS order_count, round(avg(o_totalprice), 6) AS avg_price,
       round(avg(l_quantity), 6) AS avg_quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "daily_distinct_orders": f"""
SELECT {_day('o_orderdate', 'order_date')}, count(DISTINCT o_custkey) AS customer_count FROM orders GROUP BY 1""",
    "share_by_priority": f"""
WITH counts AS (SELECT o_orderpriority, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1),
whole AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM counts)
SELECT o_orderpriority, n AS order_count, {_SHARE} AS percentage FROM counts, whole""",
    "topk_nation_segment": """
SELECT n_name, c_mktsegment, count(DISTINCT c_custkey) AS customer_count
FROM customer JOIN nation ON n_nationkey = c_nationkey
GROUP BY ALL ORDER BY 3 DESC, 1, 2 LIMIT 50""",
    "heatmap_month_dow": """
SELECT CAST(month(o_orderdate) AS INTEGER) AS month, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
       count(DISTINCT o_custkey) AS customer_count
FROM orders GROUP BY 1, 2""",
    "flag_counts_lineitem": """
SELECT count(*) FILTER (l_returnflag = 'R') AS returned_lines, count(*) FILTER (l_linestatus = 'O') AS open_lines,
       count(*) FILTER (l_discount > 0.05) AS discounted_lines, count(DISTINCT l_orderkey) AS total_orders
FROM lineitem""",
    "catalog_tables": "\nUNION ALL ".join(
        f"SELECT 'driver_{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, {_WIDTHS[t]} AS column_count"
        for t in _TABLES),
    "describe_orders": """
SELECT 'driver_orders' AS table_name, (SELECT count(*) FROM orders) AS row_count, 6 AS column_count,
       position, "column", type, true AS nullable
FROM (VALUES (1, 'o_orderkey', 'bigint'), (2, 'o_custkey', 'bigint'), (3, 'o_orderstatus', 'string'),
             (4, 'o_totalprice', 'double'), (5, 'o_orderdate', 'timestamp_ntz'), (6, 'o_orderpriority', 'string'))
     AS t(position, "column", type)""",
    "source_view_sql": _on_records("""
SELECT a.county, w.wind_direction, max(w.wind_speed_mph) AS max_wind, count(DISTINCT a.id) AS accident_count
FROM records a JOIN records w ON a.id = w.id WHERE a.stop AND w.humidity_pct >= 40 GROUP BY ALL"""),
    "sort_orders": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC",
    "page_customers": "SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey DESC LIMIT 25 OFFSET 40",
    "page_deep": """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC LIMIT 500 OFFSET 4000""",
    "page_info": """
SELECT count(*) AS total_rows, greatest(0, least(25, count(*) - 40)) AS returned_rows,
       CAST(40 AS BIGINT) AS "offset", CAST(25 AS BIGINT) AS "limit", count(*) > 65 AS has_more
FROM customer""",
    "search_parts": """
SELECT * FROM part
WHERE contains(lower(p_name), 'brand#1') OR contains(lower(p_brand), 'brand#1') OR contains(lower(p_type), 'brand#1')""",
    "feature_table": _on_records(f""",
joined AS (
  SELECT a.id, a.severity, a.start_time, a.start_lng, a.start_lat, a.state, a.city,
         {', '.join(f'a.{c}' for c in _FLAGS + _TWILIGHT)},
         {', '.join(f'w.{c}' for c in _READINGS.values())}, w.weather_condition
  FROM records a JOIN records w USING (id)
),
features AS (SELECT {_FEATURES} FROM joined)
SELECT *, CAST(count(*) AS DOUBLE) AS copies FROM features GROUP BY ALL"""),
    "feature_rows": _on_records(f"\nSELECT {_FEATURES} FROM records"),
    "train_test_split": _on_records("""
SELECT id, severity, CASE WHEN CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split
FROM records"""),
    "category_index": _on_records(""",
labels AS (
  SELECT 'state' AS category, coalesce(state, 'Unknown') AS label FROM records
  UNION ALL SELECT 'weather_condition', coalesce(weather_condition, 'Unknown') FROM records
)
SELECT category, label, count(*) AS n,
       CAST(row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, label) - 1 AS INTEGER) AS "index"
FROM labels GROUP BY category, label"""),
    "assemble_scale": _on_records(""",
filled AS (
  SELECT id, start_lat, coalesce(temperature_f, avg(temperature_f) OVER ()) AS temperature,
         coalesce(hour(start_time), -1) AS hr, coalesce(state, 'Unknown') AS state,
         coalesce(weather_condition, 'Unknown') AS condition
  FROM records
),
state_index AS (SELECT state, row_number() OVER (ORDER BY count(*) DESC, state) - 1 AS i FROM filled GROUP BY state),
condition_index AS (
  SELECT condition, row_number() OVER (ORDER BY count(*) DESC, condition) - 1 AS i FROM filled GROUP BY condition
)
SELECT id, round(start_lat / stddev_samp(start_lat) OVER (), 6) AS scaled_lat,
       round(temperature / stddev_samp(temperature) OVER (), 6) AS scaled_temperature,
       round(hr / stddev_samp(hr) OVER (), 6) AS scaled_hour,
       CAST(24 + (SELECT count(*) FROM state_index) + (SELECT count(*) FROM condition_index) AS INTEGER) AS slots,
       CAST(s.i AS INTEGER) AS state_slot, CAST(c.i AS INTEGER) AS weather_slot
FROM filled JOIN state_index s USING (state) JOIN condition_index c USING (condition)"""),
    "stream_ingest": _on_records(f"""
SELECT id, {_day('situation_date', 'situation_date')}, severity, {_stamp('start_time')}, city, temperature_f
FROM once"""),
    "stream_daily_counts": _on_records(f"""
SELECT {_day('CAST(start_time AS DATE)', 'accident_date')}, count(DISTINCT id) AS accident_count
FROM records WHERE start_time IS NOT NULL GROUP BY 1"""),
    "stream_daily_closed": _on_records(f"""
SELECT {_day('CAST(start_time AS DATE)', 'accident_date')}, count(DISTINCT id) AS accident_count
FROM records
WHERE CAST(start_time AS DATE) + INTERVAL 1 DAY <= (SELECT max(start_time) FROM records) - INTERVAL 1 DAY
GROUP BY 1"""),
}

for _name in ("mart_weather_condition", "mart_weather_impact"):
    ORACLE_SQL[f"{_name}_wide"] = ORACLE_SQL[f"{_name}_dedupe"]
