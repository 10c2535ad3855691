"""The statements of a dashboard and a scoring job as table functions in SQL.

Each is a temporary function over the tables that ``register_tables`` makes known, with named
parameters: ``SELECT * FROM hydro_series(gauge => 'H_7', as_of => now())``. Times and spans also bound
the tables' days, so only the folders of these are opened. ``days`` bounds how far back the newest
rows are looked for; without it all days are.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_NOW = "as_of TIMESTAMP DEFAULT now()"
_SPAN = f"{_NOW}, hours INT DEFAULT 24"
_DAYS = f"{_NOW}, days INT DEFAULT NULL"
_FORECAST_SPAN = f"{_SPAN}, hours_ahead INT DEFAULT 4"


def _past(ts: str) -> str:
    return (f"{ts} <= as_of AND day <= to_date(as_of) "
            f"AND (days IS NULL OR day >= date_sub(to_date(as_of), days))")


def _within(ts: str, ahead: str = "0") -> str:
    low, high = "as_of - make_dt_interval(0, hours)", f"as_of + make_dt_interval(0, {ahead})"
    return f"{ts} BETWEEN {low} AND {high} AND day BETWEEN to_date({low}) AND to_date({high})"


def _newest(table: str, key: str, columns: str) -> str:
    return f"""
SELECT {key}, newest.* FROM (
  SELECT {key}, max_by(struct({columns}, measurement_timestamp), measurement_timestamp) AS newest
  FROM {table} WHERE {_past("measurement_timestamp")} GROUP BY {key})"""


def _first(table: str, key: str, span: str) -> str:
    """The first hundred keys: the length of the list that users choose from."""
    return f"SELECT DISTINCT {key} FROM {table} WHERE {span} ORDER BY {key} LIMIT 100"


def _oldest(table: str, key: str, ts: str, value: str, columns: str, span: str) -> str:
    """The rows of one key in time order, at most ``most`` of them, the oldest."""
    return f"""
SELECT {ts}, {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {ts}) AS place
  FROM {table} WHERE {key} = {value} AND {span}) WHERE place <= most ORDER BY {ts}"""


#: Name: parameters, columns of the result, statement.
STATEMENTS = {
    "latest_weather": (
        _DAYS, "station_id STRING, temperature DOUBLE, humidity INT, pressure_hpa DOUBLE, "
               "wind_speed DOUBLE, measurement_timestamp TIMESTAMP",
        _newest("synop_measurements", "station_id",
                "temperature, humidity, pressure_hpa, wind_speed")),
    "latest_hydro": (
        _DAYS, "gauge_id STRING, water_level_cm INT, flow_m3s DOUBLE, is_warning BOOLEAN, "
               "measurement_timestamp TIMESTAMP",
        _newest("hydro_measurements", "gauge_id", "water_level_cm, flow_m3s, is_warning")),
    "weather_stations": (
        _DAYS, "station_id STRING",
        _first("synop_measurements", "station_id", _past("measurement_timestamp"))),
    "weather_series": (
        f"station STRING, {_SPAN}", "measurement_timestamp TIMESTAMP, temperature DOUBLE, "
        "humidity DOUBLE, pressure_hpa DOUBLE, wind_speed DOUBLE", f"""
SELECT date_trunc('minute', measurement_timestamp) AS ts_min, avg(temperature), avg(humidity),
       avg(pressure_hpa), avg(wind_speed)
FROM synop_measurements WHERE station_id = station AND {_within("measurement_timestamp")}
GROUP BY date_trunc('minute', measurement_timestamp) ORDER BY ts_min"""),
    "last_weather": (
        f"station STRING, {_DAYS}", "last_ts TIMESTAMP", f"""
SELECT max(measurement_timestamp) FROM synop_measurements
WHERE station_id = station AND {_past("measurement_timestamp")}"""),
    "hydro_gauges": (
        _DAYS, "gauge_id STRING",
        _first("hydro_measurements", "gauge_id", _past("measurement_timestamp"))),
    "hydro_series": (
        f"gauge STRING, {_SPAN}, most INT DEFAULT 1000", "measurement_timestamp TIMESTAMP, "
        "water_level_cm INT, flow_m3s DOUBLE, is_warning BOOLEAN",
        _oldest("hydro_measurements", "gauge_id", "measurement_timestamp", "gauge",
                "water_level_cm, flow_m3s, is_warning", _within("measurement_timestamp"))),
    "last_hydro": (
        f"gauge STRING, {_DAYS}", "last_ts TIMESTAMP", f"""
SELECT max(measurement_timestamp) FROM hydro_measurements
WHERE gauge_id = gauge AND {_past("measurement_timestamp")}"""),
    "forecast_gauges": (
        _FORECAST_SPAN, "gauge_id STRING",
        _first("hydro_predictions", "gauge_id", _within("prediction_timestamp", "hours_ahead"))),
    "measured_series": (
        f"gauge STRING, {_SPAN}, most INT DEFAULT 1000",
        "measurement_timestamp TIMESTAMP, water_level_cm INT",
        _oldest("hydro_measurements", "gauge_id", "measurement_timestamp", "gauge",
                "water_level_cm", _within("measurement_timestamp"))),
    "forecast_series": (
        f"gauge STRING, {_FORECAST_SPAN}, most INT DEFAULT 1000",
        "prediction_timestamp TIMESTAMP, predicted_water_level DOUBLE, horizon_hours INT",
        _oldest("hydro_predictions", "gauge_id", "prediction_timestamp", "gauge",
                "predicted_water_level, horizon_hours",
                _within("prediction_timestamp", "hours_ahead"))),
    "recent_levels": (
        "rows INT DEFAULT 3", "gauge_id STRING, measurement_timestamp TIMESTAMP, "
        "water_level_cm INT", """
SELECT gauge_id, measurement_timestamp, water_level_cm FROM (
  SELECT *, row_number() OVER (PARTITION BY gauge_id ORDER BY measurement_timestamp DESC) AS place
  FROM hydro_measurements) WHERE place <= rows"""),
    "level_history": (
        "", "gauge_id STRING, measurement_timestamp TIMESTAMP, water_level_cm INT", """
SELECT gauge_id, measurement_timestamp, water_level_cm FROM hydro_measurements
ORDER BY measurement_timestamp"""),
    "all_predictions": (
        "", "gauge_id STRING, prediction_timestamp TIMESTAMP, predicted_water_level DOUBLE, "
            "horizon_hours INT, created_at TIMESTAMP", """
SELECT gauge_id, prediction_timestamp, predicted_water_level, horizon_hours, created_at
FROM hydro_predictions"""),
}


def register_statements(spark: SparkSession) -> None:
    """Makes the statements known to SQL, over the tables that are known then."""
    for name, (parameters, columns, statement) in STATEMENTS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) "
                  f"RETURNS TABLE ({columns}) RETURN {statement}")
