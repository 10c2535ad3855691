"""Latest and recent rows, series, key lists, station views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.standins import (
    AS_OF, HYDRO, HYDRO_STATIONS, PREDICTIONS, RAW_ALERTS, SYNOP, WEATHER_STATIONS, check,
    events, hydro, levels, predictions, stations, synop, table, zoned, zoneless)
from tidewarden.functions.text import fold_polish, logical_key, station_label
from tidewarden.functions.times import clock_text
from tidewarden.operators.joins import named
from tidewarden.operators.recent import (
    latest_per_key, recent_lags, recent_rows)
from tidewarden.operators.series import (
    bucket_means, key_list, last_seen, series_summary, trailing_series, warnings_of)
from tidewarden.plans import board, views
from tidewarden.plans import forecast as plans
from tidewarden.plans.rollups import rolled_means, rolled_summary, update_rollup
from tidewarden.schemas import HYDRO_MEASUREMENTS, HYDRO_PREDICTIONS, SYNOP_MEASUREMENTS
from tidewarden.session import shared_folder
from tidewarden.sources.latest import (
    last_seen_of_table, latest_of_table, read_latest, update_latest)
from tidewarden.sources.stations import build_stations, combined_stations, write_stations
from tidewarden.sources.tables import create_tables, insert_absent, touched_days

NOW = f"TIMESTAMP '{AS_OF}'"
LAST_DAY = f"BETWEEN {NOW} - INTERVAL 24 HOUR AND {NOW}"
AROUND_NOW = f"BETWEEN {NOW} - INTERVAL 24 HOUR AND {NOW} + INTERVAL 4 HOUR"


def _synop(spark, sf_dir):
    return synop(events(spark, sf_dir))


def _hydro(spark, sf_dir):
    return hydro(events(spark, sf_dir))


def _predictions(spark, sf_dir):
    return predictions(events(spark, sf_dir))


@check(f"""
WITH {SYNOP}
SELECT DISTINCT ON (station_id) * EXCLUDE (ingestion_timestamp) FROM synop
WHERE measurement_timestamp <= {NOW} ORDER BY station_id, measurement_timestamp DESC""")
def latest_weather(spark, sf_dir):
    return views.latest_weather(_synop(spark, sf_dir), AS_OF)


@check(f"""
WITH {HYDRO}
SELECT DISTINCT ON (gauge_id) * EXCLUDE (ingestion_timestamp) FROM hydro
WHERE measurement_timestamp <= {NOW} ORDER BY gauge_id, measurement_timestamp DESC""")
def latest_hydro(spark, sf_dir):
    return views.latest_hydro(_hydro(spark, sf_dir), AS_OF)


@check("""
SELECT DISTINCT ON (user_id) user_id, event_id, event_type, props, ts FROM events
ORDER BY user_id, ts DESC""")
def latest_text(spark, sf_dir):
    """Latest rows with text columns, by rank instead of by hash aggregate."""
    return latest_per_key(events(spark, sf_dir), "user_id", "ts",
                          ["event_id", "event_type", "props"])


@check(f"""
WITH {SYNOP}
SELECT DISTINCT station_id FROM synop WHERE measurement_timestamp <= {NOW}
ORDER BY station_id LIMIT 100""")
def weather_stations(spark, sf_dir):
    return views.weather_stations(_synop(spark, sf_dir), AS_OF, 100)


@check(f"""
WITH {HYDRO}
SELECT DISTINCT gauge_id FROM hydro WHERE measurement_timestamp <= {NOW}
ORDER BY gauge_id LIMIT 100""")
def hydro_gauges(spark, sf_dir):
    return views.hydro_gauges(levels(events(spark, sf_dir)), AS_OF, 100)


@check(f"""
WITH {PREDICTIONS}
SELECT DISTINCT gauge_id FROM predictions WHERE prediction_timestamp {AROUND_NOW}
ORDER BY gauge_id LIMIT 100""")
def forecast_gauges(spark, sf_dir):
    return views.forecast_gauges(_predictions(spark, sf_dir), AS_OF, 100)


@check("SELECT DISTINCT event_type FROM events WHERE ts <= "
       f"{NOW} ORDER BY event_type LIMIT 3")
def first_keys(spark, sf_dir):
    return key_list(events(spark, sf_dir), "event_type", "ts", AS_OF, 3)


_MEANS = f"""
WITH {SYNOP}
SELECT station_id, date_trunc('minute', measurement_timestamp) AS measurement_timestamp,
       avg(temperature) AS temperature, avg(humidity) AS humidity,
       avg(pressure_hpa) AS pressure_hpa, avg(wind_speed) AS wind_speed
FROM synop WHERE measurement_timestamp {LAST_DAY}"""


@check(_MEANS + " GROUP BY ALL")
def weather_series(spark, sf_dir):
    """Minute means of all stations."""
    return views.weather_series(_synop(spark, sf_dir), as_of=AS_OF)


@check(_MEANS + " AND station_id = 'IMGW_7' GROUP BY ALL")
def weather_series_of_station(spark, sf_dir):
    return views.weather_series(_synop(spark, sf_dir), "IMGW_7", AS_OF)


@check(f"""
SELECT event_type, date_trunc('hour', ts) AS bucket,
       round(avg(value), 9) AS value, round(avg(user_id), 9) AS user_id
FROM events WHERE ts {LAST_DAY} GROUP BY ALL""")
def hour_means(spark, sf_dir):
    """Means over busy buckets."""
    means = bucket_means(events(spark, sf_dir), "event_type", "ts", ["value", "user_id"], "hour",
                         AS_OF)
    return means.select("event_type", "bucket", F.round("value", 9).alias("value"),
                        F.round("user_id", 9).alias("user_id"))


@check(f"""
WITH {SYNOP}
SELECT station_id, max(measurement_timestamp) AS last_ts FROM synop
WHERE measurement_timestamp <= {NOW} GROUP BY station_id""")
def last_weather(spark, sf_dir):
    return last_seen(_synop(spark, sf_dir), "station_id", "measurement_timestamp", AS_OF)


@check(f"""
WITH {HYDRO}
SELECT gauge_id, max(measurement_timestamp) AS last_ts FROM hydro
WHERE measurement_timestamp <= {NOW} AND gauge_id = 'H_7' GROUP BY gauge_id""")
def last_hydro(spark, sf_dir):
    return last_seen(levels(events(spark, sf_dir)), "gauge_id", "measurement_timestamp", AS_OF, "H_7")


_SERIES = f"""
WITH {HYDRO}
SELECT gauge_id, measurement_timestamp, water_level_cm, flow_m3s, is_warning
FROM hydro WHERE measurement_timestamp {LAST_DAY} """


@check(_SERIES)
def hydro_series(spark, sf_dir):
    return views.hydro_series(_hydro(spark, sf_dir), as_of=AS_OF)


@check(_SERIES + "AND gauge_id = 'H_7' ORDER BY measurement_timestamp LIMIT 1000")
def hydro_series_of_gauge(spark, sf_dir):
    return views.hydro_series(_hydro(spark, sf_dir), "H_7", AS_OF, limit=1000)


@check(f"""
SELECT event_type, ts, value FROM events
WHERE event_type = 'error' AND ts {LAST_DAY} ORDER BY ts LIMIT 1000""")
def measured_series(spark, sf_dir):
    """The oldest rows of a busy key."""
    return trailing_series(events(spark, sf_dir), "event_type", "ts", ["value"], AS_OF,
                           only="error", limit=1000)


@check(f"""
WITH {PREDICTIONS}
SELECT gauge_id, prediction_timestamp, predicted_water_level, horizon_hours FROM predictions
WHERE gauge_id = 'H_7' AND prediction_timestamp {AROUND_NOW}
ORDER BY prediction_timestamp LIMIT 1000""")
def forecast_series(spark, sf_dir):
    return trailing_series(
        _predictions(spark, sf_dir), "gauge_id", "prediction_timestamp",
        ["predicted_water_level", "horizon_hours"], AS_OF, ahead=views.FORECAST_AHEAD, only="H_7",
        limit=1000)


@check(f"""
WITH {HYDRO}
SELECT gauge_id, count(*) AS readings, max(measurement_timestamp) AS last_ts,
       bool_or(flow_m3s IS NOT NULL) AS has_flow_m3s,
       strftime(max(measurement_timestamp), '%H:%M UTC') AS last_clock
FROM hydro WHERE measurement_timestamp {LAST_DAY} GROUP BY gauge_id""")
def summary_of_series(spark, sf_dir):
    series = views.hydro_series(_hydro(spark, sf_dir), as_of=AS_OF)
    return series_summary(series, "gauge_id", "measurement_timestamp", ["flow_m3s"])


@check(f"""
WITH {HYDRO}
SELECT gauge_id, count(*) FILTER (measurement_timestamp {LAST_DAY}) AS readings,
       max(measurement_timestamp) AS last_ts,
       count(*) FILTER (measurement_timestamp {LAST_DAY}) = 0 AS series_empty
FROM hydro WHERE measurement_timestamp <= {NOW} GROUP BY gauge_id""")
def series_or_last_seen(spark, sf_dir):
    rows = _hydro(spark, sf_dir)
    series = views.hydro_series(rows, as_of=AS_OF)
    return views.series_or_last_seen(rows, "gauge_id", series, AS_OF)


@check(f"""
WITH {HYDRO}
SELECT gauge_id, measurement_timestamp, water_level_cm FROM hydro
WHERE is_warning AND measurement_timestamp {LAST_DAY}""")
def warning_points(spark, sf_dir):
    series = views.hydro_series(_hydro(spark, sf_dir), as_of=AS_OF)
    return warnings_of(series).select("gauge_id", "measurement_timestamp", "water_level_cm")


@check(f"""
WITH {HYDRO}
SELECT gauge_id, measurement_timestamp, water_level_cm FROM (
  SELECT *, row_number() OVER (PARTITION BY gauge_id ORDER BY measurement_timestamp DESC) AS rn
  FROM hydro) WHERE rn <= 3""")
def recent_three(spark, sf_dir):
    return recent_rows(levels(events(spark, sf_dir)), "gauge_id", "measurement_timestamp",
                       3).drop("rank")


@check(f"""
WITH {HYDRO},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY gauge_id ORDER BY measurement_timestamp DESC) AS rn
  FROM hydro)
SELECT gauge_id, max(measurement_timestamp) AS measurement_timestamp,
       max(water_level_cm) FILTER (rn = 1) AS lag_0, max(water_level_cm) FILTER (rn = 2) AS lag_1,
       max(water_level_cm) FILTER (rn = 3) AS lag_2
FROM ranked WHERE rn <= 3 GROUP BY gauge_id HAVING count(water_level_cm) = 3""")
def recent_levels(spark, sf_dir):
    return recent_lags(levels(events(spark, sf_dir)), "gauge_id", "measurement_timestamp",
                       "water_level_cm")


@check(f"""
WITH {HYDRO}
SELECT gauge_id, measurement_timestamp, water_level_cm FROM (
  SELECT *, row_number() OVER (PARTITION BY gauge_id ORDER BY measurement_timestamp DESC) AS rn
  FROM hydro) WHERE rn <= 3""")
def recent_three_of_table(spark, sf_dir):
    """The same from the latest rows kept beside a history table, after batches out of order."""
    rows = zoned(_hydro(spark, sf_dir))
    root = shared_folder(spark, "latest")
    late = F.col("measurement_timestamp") >= "2024-01-15"
    for part in (rows.filter(late), rows.filter(~late), rows.filter(late)):
        update_latest(part, root, HYDRO_MEASUREMENTS)
    return zoneless(read_latest(spark, root, HYDRO_MEASUREMENTS).select(
        "gauge_id", "measurement_timestamp", "water_level_cm"))


# Every fifth key fell silent before the tenth, every seventh has been dead for most of the time;
# the readings after the instant asked for are in the future for it.
_SILENT = "(user_id % 5 <> 0 OR ts < TIMESTAMP '2024-01-10') AND (user_id % 7 <> 0 OR ts < TIMESTAMP '2024-01-03')"


def _stored(spark, rows, spec):
    """The rows stored in two batches, the older one last, with the latest rows kept."""
    root = shared_folder(spark, "stored")
    create_tables(spark, root, [spec])
    rows = zoned(rows)
    newer = F.col("measurement_timestamp") >= "2024-01-15"
    for part in (rows.filter(newer), rows.filter(~newer)):
        insert_absent(part, root, spec)
        update_latest(part, root, spec)
    return root


@check(f"""
WITH {SYNOP.replace("FROM events", f"FROM events WHERE {_SILENT}")}
SELECT DISTINCT ON (station_id) * FROM synop
WHERE measurement_timestamp <= {NOW} ORDER BY station_id, measurement_timestamp DESC""")
def latest_weather_of_table(spark, sf_dir):
    """Stations whose kept rows are in the future or that fell silent long ago."""
    root = _stored(spark, synop(events(spark, sf_dir).filter(_SILENT)), SYNOP_MEASUREMENTS)
    return zoneless(latest_of_table(spark, root, SYNOP_MEASUREMENTS, AS_OF))


@check(f"""
WITH {HYDRO.replace("FROM events", f"FROM events WHERE {_SILENT}")}, {HYDRO_STATIONS}
SELECT gauge_id, max(measurement_timestamp) AS last_ts FROM hydro
WHERE measurement_timestamp <= {NOW} AND measurement_timestamp >= TIMESTAMP '2024-01-05'
AND gauge_id IN (SELECT id FROM hydro_stations) GROUP BY gauge_id""")
def last_seen_of_stations(spark, sf_dir):
    """Gauges of the dictionary, some without any reading since the oldest day asked for."""
    root = _stored(spark, hydro(events(spark, sf_dir).filter(_SILENT)), HYDRO_MEASUREMENTS)
    return zoneless(last_seen_of_table(
        spark, root, HYDRO_MEASUREMENTS, AS_OF, stations(spark, sf_dir, "hydro").select("id"),
        oldest=date(2024, 1, 5)))


def _rolled(spark, sf_dir):
    """Weather stored in two batches, of which the second is repeated, with its minute rollups."""
    root = shared_folder(spark, "rollup")
    create_tables(spark, root, [SYNOP_MEASUREMENTS])
    rows = zoned(_synop(spark, sf_dir))
    late = F.second("measurement_timestamp") % 3 == 0
    for part in (rows.filter(~late), rows.filter(late), rows.filter(late)):
        insert_absent(part, root, SYNOP_MEASUREMENTS)
        update_rollup(spark, root, SYNOP_MEASUREMENTS, touched_days(part, SYNOP_MEASUREMENTS))
    return root


@check(f"""
WITH {SYNOP}
SELECT station_id, date_trunc('minute', measurement_timestamp) AS measurement_timestamp,
       avg(temperature) AS temperature, avg(humidity) AS humidity,
       avg(pressure_hpa) AS pressure_hpa, avg(wind_speed) AS wind_speed
FROM synop WHERE measurement_timestamp {LAST_DAY} GROUP BY ALL""")
def weather_series_rollup(spark, sf_dir):
    return zoneless(rolled_means(spark, _rolled(spark, sf_dir), SYNOP_MEASUREMENTS, AS_OF))


@check(f"""
WITH {SYNOP}
SELECT station_id, count(*) AS readings, max(measurement_timestamp) AS last_ts,
       count(temperature) > 0 AS has_temperature, count(humidity) > 0 AS has_humidity,
       count(pressure_hpa) > 0 AS has_pressure_hpa, count(wind_speed) > 0 AS has_wind_speed
FROM synop GROUP BY station_id""")
def summary_of_rollup(spark, sf_dir):
    return zoneless(rolled_summary(spark, _rolled(spark, sf_dir), SYNOP_MEASUREMENTS))


@check(f"""
WITH {HYDRO}
SELECT gauge_id, measurement_timestamp, water_level_cm FROM hydro ORDER BY measurement_timestamp
""")
def level_history(spark, sf_dir):
    return plans.level_history(levels(events(spark, sf_dir)))


@check(f"""
WITH {PREDICTIONS}
SELECT gauge_id, prediction_timestamp, predicted_water_level, horizon_hours FROM predictions""")
def predictions_export(spark, sf_dir):
    """All predictions through a CSV file."""
    path = shared_folder(spark, "predictions-csv")
    plans.export_predictions(_predictions(spark, sf_dir), path)
    back = spark.read.option("header", True).schema(HYDRO_PREDICTIONS.schema).csv(path)
    return zoneless(back.drop("created_at"))


def _overview(spark, sf_dir):
    listed = (stations(spark, sf_dir, "weather")
              .unionByName(stations(spark, sf_dir, "hydro")))
    return listed, views.station_overview(
        listed, views.latest_weather(_synop(spark, sf_dir), AS_OF),
        views.latest_hydro(_hydro(spark, sf_dir), AS_OF))


def _number(column: str, digits: int, unit: str) -> str:
    return f"coalesce(printf('%.{digits}f', {column}::DOUBLE) || '{unit}', '—')"


_OVERVIEW = f"""
{SYNOP}, {HYDRO}, {WEATHER_STATIONS}, {HYDRO_STATIONS},
latest_weather AS (
  SELECT DISTINCT ON (station_id) * FROM synop
  WHERE measurement_timestamp <= {NOW} ORDER BY station_id, measurement_timestamp DESC),
latest_hydro AS (
  SELECT DISTINCT ON (gauge_id) * FROM hydro
  WHERE measurement_timestamp <= {NOW} ORDER BY gauge_id, measurement_timestamp DESC),
overview AS (
  SELECT id, type, name, lat, lon, temperature, humidity, pressure_hpa, wind_speed,
         CAST(NULL AS INTEGER) AS water_level_cm, CAST(NULL AS DOUBLE) AS flow_m3s,
         CAST(NULL AS BOOLEAN) AS is_warning, 'Stacja pogodowa' AS category,
         CASE WHEN station_id IS NULL THEN 'Stacja pogodowa'
              ELSE '🌡 ' || {_number('temperature', 1, '°C')}
                   || '  💧 ' || {_number('humidity', 0, '%')}
                   || '  🔵 ' || {_number('pressure_hpa', 1, ' hPa')}
                   || '  💨 ' || {_number('wind_speed', 1, ' m/s')} END AS tooltip
  FROM weather_stations LEFT JOIN latest_weather ON id = station_id
  UNION ALL
  SELECT id, type, name, lat, lon, NULL, NULL, NULL, NULL, water_level_cm, flow_m3s,
         is_warning, 'Stacja hydrologiczna',
         CASE WHEN gauge_id IS NULL THEN 'Stacja hydrologiczna'
              ELSE '💧 Poziom: ' || {_number('water_level_cm', 0, ' cm')}
                   || '  🌊 Przepływ: ' || {_number('flow_m3s', 2, ' m³/s')}
                   || CASE WHEN is_warning THEN '  ⚠️ OSTRZEŻENIE' ELSE '' END END
  FROM hydro_stations LEFT JOIN latest_hydro ON id = gauge_id)"""


@check(f"WITH {_OVERVIEW} SELECT * FROM overview")
def station_overview(spark, sf_dir):
    return _overview(spark, sf_dir)[1]


@check(f"""
WITH {_OVERVIEW}, {RAW_ALERTS},
alert_points AS (
  SELECT a.*, coalesce(s.name, a.station_id) AS name,
         CASE severity WHEN 'Yellow' THEN 'Żółty' WHEN 'Orange' THEN 'Pomarańczowy'
              WHEN 'Red' THEN 'Czerwony' ELSE coalesce(severity, '?') END AS level,
         CASE alert_type WHEN 'storm' THEN 'Burza' WHEN 'flood' THEN 'Powódź'
              ELSE alert_type END AS kind
  FROM current_alerts a LEFT JOIN weather_stations s ON a.station_id = s.id
  WHERE a.lat IS NOT NULL AND a.lon IS NOT NULL),
layer AS (
  SELECT lat, lon, name, tooltip, category, 7 AS size FROM overview
  UNION ALL
  SELECT lat, lon, name,
         '⚠️ ' || kind || ' [' || level || ']  ' || coalesce(msg, '')
           || coalesce('  📊 Wartość: ' || CAST(value AS VARCHAR), ''),
         'Alert ' || level, 18 FROM alert_points)
SELECT *, CASE category
    WHEN 'Stacja pogodowa' THEN '#3B82F6' WHEN 'Stacja hydrologiczna' THEN '#10B981'
    WHEN 'Alert Żółty' THEN '#F59E0B' WHEN 'Alert Pomarańczowy' THEN '#F97316'
    WHEN 'Alert Czerwony' THEN '#EF4444' END AS color
FROM layer""")
def map_layer(spark, sf_dir):
    from checks.alerts import alert_messages
    listed, overview = _overview(spark, sf_dir)
    alerts = board.current_alerts(alert_messages(events(spark, sf_dir)))
    return views.map_layer(overview, alerts, listed)


@check(f"""
WITH {HYDRO}, {PREDICTIONS}
SELECT gauge_id, 'Pomiar rzeczywisty' AS series, measurement_timestamp AS ts,
       CAST(water_level_cm AS DOUBLE) AS level, CAST(NULL AS INTEGER) AS horizon_hours
FROM hydro WHERE measurement_timestamp {LAST_DAY}
UNION ALL
SELECT gauge_id, 'Predykcja ML', prediction_timestamp, predicted_water_level, horizon_hours
FROM predictions WHERE prediction_timestamp {AROUND_NOW}""")
def forecast_overlay(spark, sf_dir):
    return views.forecast_overlay(_hydro(spark, sf_dir), _predictions(spark, sf_dir),
                                  as_of=AS_OF)


@check(f"""
WITH {PREDICTIONS}
SELECT gauge_id, list_sort(list(DISTINCT horizon_hours))[1] AS shortest,
       list_sort(list(DISTINCT horizon_hours))[-1] AS longest,
       len(list(DISTINCT horizon_hours)) AS horizons
FROM predictions GROUP BY gauge_id""")
def forecast_horizons(spark, sf_dir):
    found = views.forecast_horizons(_predictions(spark, sf_dir))
    return found.select("gauge_id", F.element_at("horizons", 1).alias("shortest"),
                        F.element_at("horizons", -1).alias("longest"),
                        F.size("horizons").cast("long").alias("horizons"))


@check(f"""
WITH {WEATHER_STATIONS}, {SYNOP}
SELECT DISTINCT station_id, coalesce(name, station_id) AS name,
       CASE WHEN name IS NULL THEN station_id ELSE name || ' (' || station_id || ')' END AS label
FROM synop LEFT JOIN weather_stations ON station_id = id""")
def station_names(spark, sf_dir):
    seen = _synop(spark, sf_dir).select("station_id").distinct()
    return (named(seen, stations(spark, sf_dir, "weather"), "station_id")
            .withColumn("label", station_label(F.col("station_id"), F.col("name"))))


@check("""
SELECT 'H_' || c_custkey AS id, c_nationkey / 4.0::DOUBLE AS lat,
       CAST(c_custkey % 50 AS DOUBLE) AS lon,
       'Lodz Zabiniec ' || c_name || ' (' || c_mktsegment || ')' AS name, 'hydro' AS type
FROM customer WHERE c_nationkey <> 0 AND c_custkey % 50 <> 0
UNION ALL
SELECT 'IMGW_' || s_suppkey, s_nationkey / 4.0::DOUBLE, 14.5::DOUBLE, s_name, 'weather'
FROM supplier""")
def station_dictionary(spark, sf_dir):
    """Gauge dictionary built from raw records, written, read and combined with the weather one;
    a third file that does not exist is skipped."""
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id_stacji"),
        F.concat(F.lit("Łódź Żabiniec "), F.col("c_name")).alias("stacja"),
        F.col("c_mktsegment").alias("rzeka"),
        F.when(F.col("c_nationkey") != 0, (F.col("c_nationkey") / 4.0).cast("string"))
        .otherwise("").alias("lat"),
        F.when(F.col("c_custkey") % 50 != 0, (F.col("c_custkey") % 50).cast("string"))
        .alias("lon"))
    weather = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("IMGW_"), F.col("s_suppkey").cast("string")).alias("id"),
        (F.col("s_nationkey") / 4.0).alias("lat"), F.lit(14.5).alias("lon"),
        F.col("s_name").alias("name"))
    root = shared_folder(spark, "stations")
    write_stations(build_stations(raw), f"{root}/hydro")
    write_stations(weather, f"{root}/weather")
    return combined_stations(spark, {"weather": f"{root}/weather", "hydro": f"{root}/hydro",
                                     "snow": f"{root}/snow"})


@check("""
SELECT event_id, event_type || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS key,
       strftime(ts, '%H:%M UTC') AS clock, event_type || ' zazolc gesla jazn ZOLW' AS folded
FROM events""")
def reading_texts(spark, sf_dir):
    """Logical key, clock text and letter folding of every reading."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    polish = F.concat(F.col("event_type"), F.lit(" zażółć gęślą jaźń ŻÓŁW"))
    return events(spark, sf_dir).select(
        "event_id", logical_key(F.col("event_type"), iso).alias("key"),
        clock_text(F.col("ts")).alias("clock"), fold_polish(polish).alias("folded"))
