"""Lag and lead features, level models, forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.standins import (
    AS_OF, HYDRO, check, events, events_stream, hydro, levels, messages, zoned, zoneless)
from tidewarden.operators.features import lag_lead
from tidewarden.plans import forecast as plans
from tidewarden.plans.training import models_from_days, read_days_of_levels, update_days
from tidewarden.schemas import HYDRO_MEASUREMENTS, HYDRO_PREDICTIONS
from tidewarden.session import shared_folder
from tidewarden.sources.tables import create_tables, insert_absent, read_table
from tidewarden.streaming.jobs import start_history_job, start_scoring_job


def _levels(spark, sf_dir):
    return levels(events(spark, sf_dir))


def _features_sql(source: str, key: str, ts: str, value: str) -> str:
    return f"""
  SELECT {key}, {ts}, {value} AS lag_0, lag({value}, 1) OVER w AS lag_1,
         lag({value}, 2) OVER w AS lag_2, lead({value}, 2) OVER w AS lead_2,
         lead({value}, 3) OVER w AS lead_3
  FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY {ts})"""


@check(f"WITH {HYDRO} {_features_sql('hydro', 'gauge_id', 'measurement_timestamp', 'water_level_cm')}")
def lag_lead_features(spark, sf_dir):
    """Few readings per gauge and day: most rows are slice edges."""
    return lag_lead(_levels(spark, sf_dir), "gauge_id", "measurement_timestamp", "water_level_cm")


@check(_features_sql("events", "event_type", "ts", "value"))
def lag_lead_busy_keys(spark, sf_dir):
    """Many readings per key and day: most rows are settled within their slice."""
    return lag_lead(events(spark, sf_dir), "event_type", "ts", "value")


@check(_features_sql("events", "event_type", "ts", "value"))
def lag_lead_hour_slices(spark, sf_dir):
    return lag_lead(events(spark, sf_dir), "event_type", "ts", "value", part="hour")


_X = ("lag_0", "lag_1", "lag_2")
_Y = ("lead_2", "lead_3")
_COVARIANCES = ", ".join(
    f"covar_pop({a}, {b}) AS cov_{a}_{b}" for i, a in enumerate(_X) for b in (*_X[i:], *_Y))
_MEANS = ", ".join(f"avg({c}) AS mean_{c}" for c in (*_X, *_Y))
_STATS = f"""
features AS ({_features_sql('hydro', 'gauge_id', 'measurement_timestamp', 'water_level_cm')}),
stats AS (
  SELECT gauge_id, count(*) AS n, {_MEANS}, {_COVARIANCES}
  FROM features
  WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lead_2 IS NOT NULL AND lead_3 IS NOT NULL
  GROUP BY gauge_id HAVING count(*) >= 5)"""
_STAT_NAMES = [f"mean_{c}" for c in (*_X, *_Y)] + [
    f"cov_{a}_{b}" for i, a in enumerate(_X) for b in (*_X[i:], *_Y)]


def _whole(name: str) -> str:
    """Levels are whole numbers, so a mean times n and a covariance times n squared are, too: they
    compare exactly, where rounded fractions could fall on either side of a half."""
    return f"round({name} * n)" if name.startswith("mean") else f"round({name} * n * n)"


@check(f"""
WITH {HYDRO}, {_STATS}
SELECT gauge_id, n, {', '.join(f'{_whole(c)} AS {c}' for c in _STAT_NAMES)} FROM stats""")
def ols_stats(spark, sf_dir):
    stats = plans.level_stats(_levels(spark, sf_dir))
    return stats.select("gauge_id", "n", *[F.expr(_whole(c)).alias(c) for c in _STAT_NAMES])


def _cramer(horizon: int) -> str:
    """Cramer's rule for the 3 x 3 normal equations of one target."""
    def c(a, b):
        return f"cov_{_X[min(a, b)]}_{_X[max(a, b)]}"

    def det(m):
        return (f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]})"
                f" - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]})"
                f" + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))")

    matrix = [[c(i, j) for j in range(3)] for i in range(3)]
    slopes = []
    for k in range(3):
        replaced = [[f"cov_{_X[i]}_lead_{horizon}" if j == k else matrix[i][j]
                     for j in range(3)] for i in range(3)]
        slopes.append(f"{det(replaced)} / {det(matrix)} AS b{k}")
    return f"""
  SELECT gauge_id, {horizon} AS horizon, n, {', '.join(slopes)}, mean_lead_{horizon} AS y,
         mean_lag_0 AS x0, mean_lag_1 AS x1, mean_lag_2 AS x2 FROM stats"""


_MODELS = f"""
WITH {HYDRO}, {_STATS},
slopes AS ({_cramer(2)} UNION ALL {_cramer(3)}),
models AS (SELECT gauge_id, CAST(horizon AS INTEGER) AS horizon,
                  y - b0 * x0 - b1 * x1 - b2 * x2 AS intercept, b0, b1, b2, n FROM slopes)"""
_ROUNDED = ("intercept", "b0", "b1", "b2")


def _rounded(models):
    return models.select("gauge_id", "horizon", "n",
                         *[F.round(c, 6).alias(c) for c in _ROUNDED])


_ROUNDED_SQL = (f"{_MODELS} SELECT gauge_id, horizon, n, "
                f"{', '.join(f'round({c}, 6) AS {c}' for c in _ROUNDED)} FROM models")


@check(_ROUNDED_SQL)
def level_models(spark, sf_dir):
    return _rounded(plans.train_level_models(_levels(spark, sf_dir)))


@check(_ROUNDED_SQL)
def level_models_from_days(spark, sf_dir):
    """Readings stored in two parts, the second late for all days; the statistics of each part's days
    are renewed, and training reads these alone."""
    root = shared_folder(spark, "training")
    rows = zoned(hydro(events(spark, sf_dir)))
    create_tables(spark, root, [HYDRO_MEASUREMENTS])
    late = F.minute("measurement_timestamp") % 5 == 0
    for part in (rows.filter(~late), rows.filter(late)):
        insert_absent(part, root, HYDRO_MEASUREMENTS)
        days = part.select(F.to_date("measurement_timestamp").alias("day")).distinct().collect()
        update_days(spark, root, [d.day for d in days])
    return _rounded(models_from_days(read_days_of_levels(spark, root)))


@check(_ROUNDED_SQL)
def model_store(spark, sf_dir):
    """Two training runs saved: the later one is what counts; an empty run changes nothing."""
    history = _levels(spark, sf_dir)
    path = shared_folder(spark, "models")
    models = plans.train_level_models(history)
    plans.save_models(models.withColumn("b0", F.lit(0.0)), path, "2024-01-19 00:00:00")
    for _ in range(2):  # a repeat replaces its run
        plans.save_models(models, path, AS_OF)
    plans.save_models(models.limit(0), path, "2024-01-21 00:00:00")
    return _rounded(plans.load_models(spark, path))


_FORECAST = f"""{_MODELS},
recent AS (
  SELECT gauge_id, max(measurement_timestamp) AS ts,
         max(water_level_cm) FILTER (rn = 1) AS l0, max(water_level_cm) FILTER (rn = 2) AS l1,
         max(water_level_cm) FILTER (rn = 3) AS l2
  FROM (SELECT *, row_number() OVER (PARTITION BY gauge_id
                                     ORDER BY measurement_timestamp DESC) AS rn FROM hydro)
  WHERE rn <= 3 GROUP BY gauge_id HAVING count(*) = 3)
SELECT gauge_id, ts + to_hours(horizon) AS prediction_timestamp,
       round(greatest(0, intercept + b0 * l0 + b1 * l1 + b2 * l2), 4) AS predicted_water_level,
       horizon AS horizon_hours
FROM recent JOIN models USING (gauge_id)"""


@check(_FORECAST)
def level_forecast(spark, sf_dir):
    history = _levels(spark, sf_dir)
    forecast = plans.forecast_levels(history, plans.train_level_models(history))
    return _shown(forecast)


def _shown(forecast):
    return zoneless(forecast.select(
        "gauge_id", "prediction_timestamp",
        F.round("predicted_water_level", 4).alias("predicted_water_level"), "horizon_hours"))


@check(_FORECAST)
def scoring_job(spark, sf_dir):
    """Hydro messages stored, then a scoring cycle that trains, forecasts and stores."""
    root = shared_folder(spark, "scoring")
    rows = events_stream(spark, sf_dir)
    sent = messages(rows, hydro(rows), "hydro", "gauge_id")
    start_history_job(sent, root, f"{root}/history-checkpoint", ("hydro",),
                      once=True).awaitTermination()
    start_scoring_job(sent, root, f"{root}/models", f"{root}/scoring-checkpoint",
                      once=True, as_of=AS_OF).awaitTermination()
    return _shown(read_table(spark, root, HYDRO_PREDICTIONS))
