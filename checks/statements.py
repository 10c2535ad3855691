"""The statements as table functions in SQL, over the given tables under the history tables' names."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.standins import (
    AS_OF, HYDRO, ORACLES, PREDICTIONS, QUERIES, SYNOP, events, hydro, predictions, synop, zoned,
    zoneless)
from tidewarden.sources.statements import register_statements

_TIME = "measurement_timestamp"
_AT = f"TIMESTAMP '{AS_OF}'"
_DAY = f"BETWEEN {_AT} - INTERVAL 24 HOUR AND {_AT}"
_AHEAD = f"BETWEEN {_AT} - INTERVAL 24 HOUR AND {_AT} + INTERVAL 4 HOUR"

#: Name: the call, and SQL of its rows.
_CALLS = {
    "latest_weather": (f"as_of => {_AT}", f"""
WITH {SYNOP} SELECT DISTINCT ON (station_id) * EXCLUDE (ingestion_timestamp) FROM synop
WHERE {_TIME} <= {_AT} ORDER BY station_id, {_TIME} DESC"""),
    "latest_hydro": (f"as_of => {_AT}, days => 6", f"""
WITH {HYDRO} SELECT DISTINCT ON (gauge_id) * EXCLUDE (ingestion_timestamp) FROM hydro
WHERE {_TIME} <= {_AT} AND {_TIME} >= TIMESTAMP '2024-01-14' ORDER BY gauge_id, {_TIME} DESC"""),
    "weather_stations": (f"as_of => {_AT}", f"""
WITH {SYNOP} SELECT DISTINCT station_id FROM synop WHERE {_TIME} <= {_AT}
ORDER BY station_id LIMIT 100"""),
    "weather_series": (f"station => 'IMGW_7', as_of => {_AT}", f"""
WITH {SYNOP} SELECT date_trunc('minute', {_TIME}) AS {_TIME}, avg(temperature) AS temperature,
  avg(humidity) AS humidity, avg(pressure_hpa) AS pressure_hpa, avg(wind_speed) AS wind_speed
FROM synop WHERE station_id = 'IMGW_7' AND {_TIME} {_DAY} GROUP BY 1"""),
    "last_weather": (f"station => 'IMGW_7', as_of => {_AT}", f"""
WITH {SYNOP} SELECT max({_TIME}) AS last_ts FROM synop
WHERE station_id = 'IMGW_7' AND {_TIME} <= {_AT}"""),
    "hydro_gauges": (f"as_of => {_AT}", f"""
WITH {HYDRO} SELECT DISTINCT gauge_id FROM hydro WHERE {_TIME} <= {_AT}
ORDER BY gauge_id LIMIT 100"""),
    "hydro_series": (f"gauge => 'H_7', as_of => {_AT}, hours => 48", f"""
WITH {HYDRO} SELECT {_TIME}, water_level_cm, flow_m3s, is_warning FROM hydro
WHERE gauge_id = 'H_7' AND {_TIME} BETWEEN {_AT} - INTERVAL 48 HOUR AND {_AT}"""),
    "last_hydro": (f"gauge => 'H_7', as_of => {_AT}", f"""
WITH {HYDRO} SELECT max({_TIME}) AS last_ts FROM hydro
WHERE gauge_id = 'H_7' AND {_TIME} <= {_AT}"""),
    "forecast_gauges": (f"as_of => {_AT}", f"""
WITH {PREDICTIONS} SELECT DISTINCT gauge_id FROM predictions
WHERE prediction_timestamp {_AHEAD} ORDER BY gauge_id LIMIT 100"""),
    "measured_series": (f"gauge => 'H_7', as_of => {_AT}, most => 2", f"""
WITH {HYDRO} SELECT {_TIME}, water_level_cm FROM hydro
WHERE gauge_id = 'H_7' AND {_TIME} {_DAY} ORDER BY {_TIME} LIMIT 2"""),
    "forecast_series": (f"gauge => 'H_7', as_of => {_AT}", f"""
WITH {PREDICTIONS} SELECT prediction_timestamp, predicted_water_level, horizon_hours
FROM predictions WHERE gauge_id = 'H_7' AND prediction_timestamp {_AHEAD}"""),
    "recent_levels": ("", f"""
WITH {HYDRO} SELECT gauge_id, {_TIME}, water_level_cm FROM (
  SELECT *, row_number() OVER (PARTITION BY gauge_id ORDER BY {_TIME} DESC) AS place FROM hydro)
WHERE place <= 3"""),
    "level_history": ("", f"WITH {HYDRO} SELECT gauge_id, {_TIME}, water_level_cm FROM hydro"),
    "all_predictions": ("", f"WITH {PREDICTIONS} SELECT * FROM predictions"),
}


def _registered(name: str, arguments: str):
    def query(spark, sf_dir):
        rows = events(spark, sf_dir)
        for table, made, time in (("synop", synop(rows), _TIME), ("hydro", hydro(rows), _TIME)):
            zoned(made).withColumn("day", F.to_date(time)).createOrReplaceTempView(
                f"{table}_measurements")
        zoned(predictions(rows)).withColumn("day", F.to_date("prediction_timestamp")) \
            .createOrReplaceTempView("hydro_predictions")
        register_statements(spark)
        return zoneless(spark.sql(f"SELECT * FROM {name}({arguments})"))
    query.__name__ = f"statement_{name}"
    return query


for _name, (_arguments, _sql) in _CALLS.items():
    QUERIES[f"statement_{_name}"] = _registered(_name, _arguments)
    ORACLES[f"statement_{_name}"] = _sql
