"""Level models per gauge and forecasts from the latest readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.functions.times import Instant, instant
from tidewarden.operators.features import lag_lead
from tidewarden.operators.recent import recent_lags
from tidewarden.operators.regression import predicted, regression_stats, solved
from tidewarden.schemas import HYDRO_PREDICTIONS, MODEL
from tidewarden.sources.folders import children, remove

LAGS = ("lag_0", "lag_1", "lag_2")
# Horizons count rows ahead in the training series and hours ahead in the forecast.
HORIZONS = (2, 3)
MIN_HISTORY = 15
MIN_COMPLETE = 5


def level_history(hydro: DataFrame) -> DataFrame:
    """All levels in time order."""
    return hydro.select("gauge_id", "measurement_timestamp", "water_level_cm").orderBy(
        "measurement_timestamp", "gauge_id")


def level_stats(history: DataFrame, gauge: str = "gauge_id", ts: str = "measurement_timestamp",
                level: str = "water_level_cm", min_complete: int = MIN_COMPLETE,
                part: str | None = "day") -> DataFrame:
    features = lag_lead(history, gauge, ts, level, len(LAGS), HORIZONS, part)
    return regression_stats(features, gauge, LAGS, [f"lead_{h}" for h in HORIZONS], min_complete)


def train_level_models(history: DataFrame, gauge: str = "gauge_id",
                       ts: str = "measurement_timestamp", level: str = "water_level_cm",
                       min_history: int = MIN_HISTORY, min_complete: int = MIN_COMPLETE,
                       part: str | None = "day") -> DataFrame:
    """Coefficients per gauge and horizon; none at all while the history is too short."""
    readings = history.select(gauge).limit(min_history).agg(F.count(F.lit(1)).alias("n")).scalar()
    stats = level_stats(history, gauge, ts, level, min_complete, part).filter(
        readings >= min_history)
    return (solved(stats, gauge, LAGS, {f"lead_{h}": h for h in HORIZONS})
            .withColumnRenamed(gauge, "gauge_id"))


# A training run's rows, with the run as partition.
_STORED = T.StructType([*MODEL.fields, T.StructField("trained_at", T.StringType())])


def create_model_store(spark: SparkSession, path: str) -> None:
    """Creates an empty store if there is none."""
    (spark.createDataFrame([], _STORED).write.mode("ignore")
     .partitionBy("trained_at").parquet(path))


def _runs(spark: SparkSession, path: str) -> list[str]:
    """The stored runs' folders, oldest first; one without its commit mark is being written, or was
    copied in part, and doesn't count."""
    return [name for name in children(spark, path) if name.startswith("trained_at=")
            and "_SUCCESS" in children(spark, f"{path}/{name}")]


def save_models(models: DataFrame, path: str, as_of: Instant = None) -> bool:
    """Stores one training run, which replaces all earlier models; an empty run is not kept.

    A run that is repeated for the same second replaces itself. The run before stays until the next,
    so a failed write leaves it readable; older ones are removed.
    """
    spark = models.sparkSession
    at = spark.range(1).select(F.date_format(instant(as_of), "yyyyMMddHHmmss")).first()[0]
    models = models.select(*MODEL.names).persist()
    try:
        if models.isEmpty():
            return False
        models.write.mode("overwrite").parquet(f"{path}/trained_at={at}")
        for name in _runs(spark, path)[:-2]:
            remove(spark, f"{path}/{name}")
        return True
    finally:
        models.unpersist()


def load_models(spark: SparkSession, path: str) -> DataFrame:
    """Models of the latest training run, the only one that is opened; none if there was no run
    yet."""
    runs = _runs(spark, path)
    if not runs:
        return spark.createDataFrame([], MODEL)
    return spark.read.schema(MODEL).parquet(f"{path}/{runs[-1]}")


def forecast_levels(history: DataFrame, models: DataFrame, gauge: str = "gauge_id",
                    ts: str = "measurement_timestamp", level: str = "water_level_cm",
                    as_of: Instant = None) -> DataFrame:
    """One prediction per gauge and horizon, for gauges with a model and three latest levels."""
    lags = (recent_lags(history, gauge, ts, level, len(LAGS))
            .withColumnRenamed(gauge, "gauge_id"))
    at = F.col(ts) + F.make_dt_interval(hours=F.col("horizon"))
    return (lags.join(models, "gauge_id")
            .select("gauge_id", at.alias("prediction_timestamp"),
                    predicted(LAGS).alias("predicted_water_level"),
                    F.col("horizon").alias("horizon_hours"),
                    instant(as_of).alias("created_at"))
            .select(*HYDRO_PREDICTIONS.schema.names))


def export_predictions(predictions: DataFrame, path: str) -> DataFrame:
    """Writes the whole table as CSV with a header and returns the four columns shown.

    Times are written as plain text, which keeps their microseconds.
    """
    times = {f.name: F.col(f.name).cast("string") for f in predictions.schema.fields
             if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    predictions.withColumns(times).write.mode("overwrite").option("header", True).csv(path)
    return predictions.select("gauge_id", "prediction_timestamp", "predicted_water_level",
                              "horizon_hours")
