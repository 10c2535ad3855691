"""What the map, the series pages and the forecast page show."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.functions.text import (
    ALERT_TYPE_LABELS, SEVERITY_LABELS, looked_up, number_text, optional)
from tidewarden.functions.times import Instant, up_to
from tidewarden.operators.joins import named
from tidewarden.operators.recent import latest_per_key
from tidewarden.operators.series import (
    DAY, bucket_means, key_list, last_seen, ordered_set, series_summary, trailing_series)

WEATHER_COLUMNS = ("temperature", "humidity", "pressure_hpa", "wind_speed")
HYDRO_COLUMNS = ("water_level_cm", "flow_m3s", "is_warning")
TIME = "measurement_timestamp"
FORECAST_AHEAD = timedelta(hours=4)

# Categories, colours, sizes and texts of the map.
WEATHER_CATEGORY = "Stacja pogodowa"
HYDRO_CATEGORY = "Stacja hydrologiczna"
CATEGORY_COLORS = {
    "Stacja pogodowa": "#3B82F6", "Stacja hydrologiczna": "#10B981", "Alert Żółty": "#F59E0B",
    "Alert Pomarańczowy": "#F97316", "Alert Czerwony": "#EF4444"}
STATION_SIZE, ALERT_SIZE = 7, 18
WEATHER_TIP = "🌡 %s  💧 %s  🔵 %s  💨 %s"
HYDRO_TIP = "💧 Poziom: %s  🌊 Przepływ: %s%s"
WARNING_TIP = "  ⚠️ OSTRZEŻENIE"
ALERT_TIP = "⚠️ %s [%s]  %s%s"
VALUE_TIP = "  📊 Wartość: "
UNKNOWN = "?"
MEASURED, PREDICTED = "Pomiar rzeczywisty", "Predykcja ML"


def latest_weather(synop: DataFrame, as_of: Instant = None) -> DataFrame:
    """Newest reading per weather station that is not in the future."""
    return latest_per_key(up_to(synop, TIME, as_of), "station_id", TIME, WEATHER_COLUMNS)


def latest_hydro(hydro: DataFrame, as_of: Instant = None) -> DataFrame:
    return latest_per_key(up_to(hydro, TIME, as_of), "gauge_id", TIME, HYDRO_COLUMNS)


def station_overview(stations: DataFrame, weather: DataFrame, hydro: DataFrame) -> DataFrame:
    """Every station with its latest readings, category and tooltip.

    ``weather`` and ``hydro`` hold one row per station. Stations without a reading stay.
    """
    weather = weather.select(F.lit("weather").alias("type"), F.col("station_id").alias("id"),
                             *WEATHER_COLUMNS, F.lit(True).alias("_weather"))
    hydro = hydro.select(F.lit("hydro").alias("type"), F.col("gauge_id").alias("id"),
                         *HYDRO_COLUMNS, F.lit(True).alias("_hydro"))
    joined = stations.join(weather, ["type", "id"], "left").join(hydro, ["type", "id"], "left")
    category = (F.when(F.col("type") == "weather", WEATHER_CATEGORY).otherwise(HYDRO_CATEGORY))
    weather_tip = F.format_string(
        WEATHER_TIP, number_text(F.col("temperature"), 1, "°C"),
        number_text(F.col("humidity"), 0, "%"), number_text(F.col("pressure_hpa"), 1, " hPa"),
        number_text(F.col("wind_speed"), 1, " m/s"))
    hydro_tip = F.format_string(
        HYDRO_TIP, number_text(F.col("water_level_cm"), 0, " cm"),
        number_text(F.col("flow_m3s"), 2, " m³/s"),
        F.when(F.col("is_warning"), WARNING_TIP).otherwise(""))
    tip = F.when(F.col("_weather"), weather_tip).when(F.col("_hydro"), hydro_tip)
    return joined.select(
        "id", "type", F.coalesce("name", "id").alias("name"), "lat", "lon",
        *WEATHER_COLUMNS, *HYDRO_COLUMNS, category.alias("category"),
        F.coalesce(tip, category).alias("tooltip"))


def map_layer(overview: DataFrame, alerts: DataFrame, stations: DataFrame) -> DataFrame:
    """Map points: all stations, and all alerts that have coordinates."""
    level = F.coalesce("severity", F.lit(UNKNOWN))
    level_label = looked_up(level, SEVERITY_LABELS, level)
    type_label = looked_up(F.col("alert_type"), ALERT_TYPE_LABELS,
                           F.coalesce("alert_type", F.lit(UNKNOWN)))
    tip = F.format_string(ALERT_TIP, type_label, level_label, F.coalesce("msg", F.lit("")),
                          optional(VALUE_TIP, F.col("value")))
    placed = alerts.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    points = named(placed, stations, "station_id").select(
        "lat", "lon", F.coalesce("name", F.lit(UNKNOWN)).alias("name"), tip.alias("tooltip"),
        F.concat(F.lit("Alert "), level_label).alias("category"),
        F.lit(ALERT_SIZE).alias("size"))
    layer = (overview.select("lat", "lon", "name", "tooltip", "category",
                             F.lit(STATION_SIZE).alias("size")).unionByName(points))
    return layer.withColumn("color", looked_up(
        F.col("category"), CATEGORY_COLORS, F.lit(None).cast("string")))


def weather_stations(synop: DataFrame, as_of: Instant = None, limit: int | None = None) -> DataFrame:
    return key_list(synop, "station_id", TIME, as_of, limit)


def hydro_gauges(hydro: DataFrame, as_of: Instant = None, limit: int | None = None) -> DataFrame:
    return key_list(hydro, "gauge_id", TIME, as_of, limit)


def forecast_gauges(predictions: DataFrame, as_of: Instant = None, limit: int | None = None,
                    back: timedelta = DAY, ahead: timedelta = FORECAST_AHEAD) -> DataFrame:
    """Gauges that have forecasts around now."""
    return key_list(predictions, "gauge_id", "prediction_timestamp", as_of, limit, back, ahead)


def weather_series(synop: DataFrame, station: str | None = None, as_of: Instant = None,
                   back: timedelta = DAY) -> DataFrame:
    """Minute means of the weather metrics over the trailing span, in time order."""
    means = bucket_means(synop, "station_id", TIME, WEATHER_COLUMNS, "minute", as_of, back,
                         station)
    return means.withColumnRenamed("bucket", TIME).orderBy("station_id", TIME)


def hydro_series(hydro: DataFrame, gauge: str | None = None, as_of: Instant = None,
                 back: timedelta = DAY, limit: int | None = None) -> DataFrame:
    """Level, flow and warning flag over the trailing span; of one gauge the oldest ``limit``."""
    return trailing_series(hydro, "gauge_id", TIME, HYDRO_COLUMNS, as_of, back, only=gauge,
                           limit=limit)


def series_or_last_seen(readings: DataFrame, key: str, series: DataFrame,
                        as_of: Instant = None, only=None) -> DataFrame:
    """Per key: rows in the series and their newest time, or the newest time of all past rows
    where the series is empty."""
    shown = series_summary(series, key, TIME)
    seen = last_seen(readings, key, TIME, as_of, only)
    return (seen.join(shown.withColumnRenamed("last_ts", "_shown_ts"), key, "left")
            .select(key, F.coalesce("readings", F.lit(0)).alias("readings"),
                    F.coalesce("_shown_ts", "last_ts").alias("last_ts"),
                    F.col("readings").isNull().alias("series_empty")))


def forecast_overlay(hydro: DataFrame, predictions: DataFrame, gauge: str | None = None,
                     as_of: Instant = None, back: timedelta = DAY,
                     ahead: timedelta = FORECAST_AHEAD, limit: int | None = None) -> DataFrame:
    """Measured and predicted levels on one time axis.

    Measurements end at ``as_of``, predictions ``ahead`` later. Of one gauge, ``limit`` keeps the
    oldest of each.
    """
    measured = trailing_series(hydro, "gauge_id", TIME, ["water_level_cm"], as_of, back,
                               only=gauge, limit=limit)
    predicted = trailing_series(
        predictions, "gauge_id", "prediction_timestamp",
        ["predicted_water_level", "horizon_hours"], as_of, back, ahead, gauge, limit)
    return measured.select(
        "gauge_id", F.lit(MEASURED).alias("series"), F.col(TIME).alias("ts"),
        F.col("water_level_cm").cast("double").alias("level"),
        F.lit(None).cast("int").alias("horizon_hours"),
    ).unionByName(predicted.select(
        "gauge_id", F.lit(PREDICTED).alias("series"), F.col("prediction_timestamp").alias("ts"),
        F.col("predicted_water_level").alias("level"), "horizon_hours"))


def forecast_horizons(predictions: DataFrame) -> DataFrame:
    """The sorted horizons each gauge has predictions for."""
    return predictions.groupBy("gauge_id").agg(
        ordered_set("horizon_hours").alias("horizons"))
