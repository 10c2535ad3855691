"""The stored tables under SQL: the statements a dashboard or a scoring job would send."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewarden.schemas import HYDRO_MEASUREMENTS, HYDRO_PREDICTIONS, SYNOP_MEASUREMENTS
from tidewarden.sources.statements import STATEMENTS, register_statements
from tidewarden.sources.tables import create_tables, insert_absent, register_tables

DAY = "INTERVAL '24 hours'"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Readings every 6 hours, two keys each: 95 hours ago to 19 hours ahead, of which the last
    day holds those 23, 17, 11 and 5 hours ago and the next 4 hours the one in an hour."""
    root = str(tmp_path_factory.mktemp("tables"))
    create_tables(spark, root)
    steps = spark.range(20).withColumn("at", F.expr(
        "now() - INTERVAL '95 hours' + make_dt_interval(0, 6 * cast(id AS int))"))
    both = steps.crossJoin(spark.createDataFrame([("a",), ("b",)], "key string"))
    at = F.col("at")
    insert_absent(both.select(
        F.col("key").alias("gauge_id"), at.alias("measurement_timestamp"),
        F.col("id").cast("int").alias("water_level_cm"), F.lit(1.5).alias("flow_m3s"),
        F.lit(False).alias("is_warning"), at.alias("ingestion_timestamp")),
        root, HYDRO_MEASUREMENTS)
    insert_absent(both.select(
        F.col("key").alias("station_id"), at.alias("measurement_timestamp"),
        F.lit(20.0).alias("temperature"), F.lit(50).alias("humidity"),
        F.lit(1000.0).alias("pressure_hpa"), F.lit(3.0).alias("wind_speed"),
        at.alias("ingestion_timestamp")), root, SYNOP_MEASUREMENTS)
    insert_absent(both.select(
        F.col("key").alias("gauge_id"), at.alias("prediction_timestamp"),
        F.lit(5.0).alias("predicted_water_level"), F.lit(2).alias("horizon_hours"),
        at.alias("created_at")), root, HYDRO_PREDICTIONS, ["created_at"])
    register_tables(spark, root)
    return root


@pytest.mark.parametrize("statement, rows", [
    ("""SELECT station_id, max_by(struct(temperature, humidity, measurement_timestamp),
               measurement_timestamp) AS newest
        FROM synop_measurements WHERE measurement_timestamp <= now() GROUP BY station_id""", 2),
    ("""SELECT DISTINCT station_id FROM synop_measurements
        WHERE measurement_timestamp <= now() ORDER BY station_id LIMIT 100""", 2),
    (f"""SELECT date_trunc('minute', measurement_timestamp) AS ts_min, avg(temperature),
                avg(humidity), avg(pressure_hpa), avg(wind_speed)
         FROM synop_measurements
         WHERE station_id = :id AND measurement_timestamp >= now() - {DAY}
           AND measurement_timestamp <= now()
         GROUP BY date_trunc('minute', measurement_timestamp) ORDER BY ts_min""", 4),
    ("""SELECT max(measurement_timestamp) AS last_ts FROM synop_measurements
        WHERE station_id = :id AND measurement_timestamp <= now()""", 1),
    (f"""SELECT measurement_timestamp, water_level_cm, flow_m3s, is_warning
         FROM hydro_measurements
         WHERE gauge_id = :id AND measurement_timestamp >= now() - {DAY}
           AND measurement_timestamp <= now() ORDER BY measurement_timestamp LIMIT 1000""", 4),
    (f"""SELECT prediction_timestamp, predicted_water_level, horizon_hours
         FROM hydro_predictions
         WHERE gauge_id = :id AND prediction_timestamp >= now() - {DAY}
           AND prediction_timestamp <= now() + INTERVAL '4 hours'
         ORDER BY prediction_timestamp LIMIT 1000""", 5),
    ("""SELECT gauge_id, measurement_timestamp, water_level_cm
        FROM (SELECT *, row_number() OVER (PARTITION BY gauge_id
                ORDER BY measurement_timestamp DESC) AS rn FROM hydro_measurements) t
        WHERE rn <= 3""", 6),
    ("""SELECT gauge_id, measurement_timestamp, water_level_cm FROM hydro_measurements
        ORDER BY measurement_timestamp""", 40),
    ("SELECT * FROM hydro_predictions", 40),
    ("SELECT * FROM alerts_history", 0),
])
def test_statement(spark, tables, statement, rows):
    args = {"id": "a"} if ":id" in statement else {}
    assert spark.sql(statement, args).count() == rows


CALLS = {
    "latest_weather": "days => 2", "latest_hydro": "days => 2", "weather_stations": "days => 2",
    "weather_series": "station => 'a'", "last_weather": "station => 'a', days => 2",
    "hydro_gauges": "days => 2", "hydro_series": "gauge => 'a'", "last_hydro": "gauge => 'a', days => 2",
    "forecast_gauges": "hours => 24, hours_ahead => 4", "measured_series": "gauge => 'a', most => 3",
    "forecast_series": "gauge => 'a'", "recent_levels": "rows => 2", "level_history": "",
    "all_predictions": ""}


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_table_functions(spark, tables, name):
    """Rows over the stored tables, and days of which folders are opened."""
    register_statements(spark)
    rows = spark.sql(f"SELECT * FROM {name}({CALLS[name]})")
    counts = {"weather_series": 4, "last_weather": 1, "hydro_series": 4, "last_hydro": 1,
              "measured_series": 3, "forecast_series": 5, "recent_levels": 4, "level_history": 40,
              "all_predictions": 40}
    assert rows.count() == counts.get(name, 2)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    bounded = "day#" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert bounded == (name not in ("recent_levels", "level_history", "all_predictions"))


def test_newest_rows_within_the_days_asked_for(spark, tables):
    register_statements(spark)
    shown = "SELECT gauge_id, water_level_cm FROM latest_hydro(as_of => now() - INTERVAL '{}', days => {})"
    # 40 hours ago the newest reading was the one 41 hours ago, number 9.
    assert {tuple(r) for r in spark.sql(shown.format("40 hours", 1)).collect()} == {("a", 9), ("b", 9)}
    assert spark.sql(shown.format("200 hours", 1)).count() == 0
