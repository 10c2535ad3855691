from __future__ import annotations

import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewarden.operators.features import lag_lead
from tidewarden.operators.recent import recent_lags
from tidewarden.operators.series import series_summary
from tidewarden.plans.forecast import (
    export_predictions, forecast_levels, load_models, save_models, train_level_models)
from tidewarden.plans.views import forecast_horizons, forecast_overlay, hydro_series
from tidewarden.schemas import HYDRO_MEASUREMENTS, HYDRO_PREDICTIONS, MODEL
from tidewarden.sources.latest import read_latest, update_latest
from tidewarden.sources.tables import create_tables, insert_absent, read_table
from tidewarden.streaming.jobs import score


def history(spark, levels, step=3600):
    """Gauge -> list of levels, one per step."""
    rows = [(g, 1_700_000_000 + i * step, v) for g, vs in levels.items()
            for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "gauge_id string, s long, water_level_cm int").select(
        "gauge_id", F.timestamp_seconds("s").alias("measurement_timestamp"), "water_level_cm")


def reference_fit(levels, horizon):
    """Centred least squares over the complete rows of one gauge."""
    rows = [(levels[i], levels[i - 1], levels[i - 2], levels[i + horizon])
            for i in range(2, len(levels) - 3)
            if None not in (levels[i - 2:i + 1] + [levels[i + 2], levels[i + 3]])]
    data = np.array(rows, dtype=float)
    x, y = data[:, :3], data[:, 3]
    beta = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)[0]
    return beta, y.mean() - x.mean(0) @ beta


@pytest.mark.parametrize("part", ["hour", "day", "month"])
def test_sliced_features_equal_the_plain_window(spark, part):
    random.seed(7)
    rows, second = [], 1_700_000_000
    for i in range(3000):
        # Long gaps leave empty slices and slices of a single row.
        second += random.choice([60, 60, 60, 600, 7200, 200_000 if i % 50 == 0 else 60])
        rows.append((random.choice("aaab"), second, None if i % 17 == 0 else i * 7 % 101))
    df = spark.createDataFrame(rows, "key string, s long, value int").withColumn(
        "ts", F.timestamp_seconds("s"))
    sliced = lag_lead(df, "key", "ts", "value", part=part)
    plain = lag_lead(df, "key", "ts", "value", part=None)
    assert sliced.count() == 3000
    assert sliced.exceptAll(plain).isEmpty() and plain.exceptAll(sliced).isEmpty()


def test_models_equal_least_squares(spark):
    random.seed(1)
    levels = {f"g{k}": [random.randint(0, 300) for _ in range(random.randint(12, 90))]
              for k in range(40)}
    levels["slow"] = [200 + round(30 * np.sin(i / 40)) + random.randint(-1, 1)
                      for i in range(400)]
    levels["gaps"] = [None if i % 9 == 0 else random.randint(0, 300) for i in range(80)]
    models = train_level_models(history(spark, levels)).collect()
    assert len(models) == 2 * len(levels)
    for row in models:
        beta, intercept = reference_fit(levels[row.gauge_id], row.horizon)
        assert np.allclose([row.b0, row.b1, row.b2, row.intercept], [*beta, intercept],
                           rtol=1e-8, atol=1e-8)


def test_rank_deficient_fits_have_minimum_norm(spark):
    levels = {"ramp": list(range(100, 140)), "flat": [100] * 15}
    rows = {(r.gauge_id, r.horizon): r for r in train_level_models(history(spark, levels))
            .collect()}
    flat = rows["flat", 2]
    assert (flat.b0, flat.b1, flat.b2, flat.intercept) == (0.0, 0.0, 0.0, 100.0)
    for horizon in (2, 3):
        beta, intercept = reference_fit(levels["ramp"], horizon)
        row = rows["ramp", horizon]
        assert np.allclose([row.b0, row.b1, row.b2, row.intercept], [*beta, intercept])


def test_training_gates(spark):
    filler = {"z": list(range(0, 60, 3))}
    nine, ten = [3, 1, 4, 1, 5, 9, 2, 6, 5], [3, 1, 4, 1, 5, 9, 2, 6, 5, 3]
    trained = train_level_models(history(spark, {"nine": nine, "ten": ten, **filler}))
    rows = {r.gauge_id: r.n for r in trained.collect()}
    assert rows["ten"] == 5 and "nine" not in rows
    assert train_level_models(history(spark, {"a": ten, "b": [1, 2, 3, 4]})).count() == 0
    assert train_level_models(history(spark, {"a": ten, "b": [1, 2, 3, 4, 5]})).count() == 2


def models_of(spark, *rows):
    return spark.createDataFrame(rows, MODEL)


def test_forecast(spark):
    levels = history(spark, {"a": [10, 20, 30, 40], "short": [1, 2], "hole": [5, None, 7],
                             "unmodelled": [1, 2, 3], "low": [1, 1, 1]})
    models = models_of(
        spark, ("a", 2, 1.0, 1.0, 0.5, 0.0, 9), ("a", 3, 0.0, 0.0, 0.0, 2.0, 9),
        ("short", 2, 0.0, 1.0, 0.0, 0.0, 9), ("hole", 2, 0.0, 1.0, 0.0, 0.0, 9),
        ("low", 2, -4.5, 1.0, 0.0, 0.0, 9))
    rows = forecast_levels(levels, models).collect()
    got = {(r.gauge_id, r.horizon_hours): (r.predicted_water_level, r.prediction_timestamp)
           for r in rows}
    last = levels.filter("gauge_id = 'a'").agg(F.max("measurement_timestamp")).first()[0]
    assert {k: v[0] for k, v in got.items()} == {("a", 2): 56.0, ("a", 3): 40.0, ("low", 2): 0.0}
    assert (got["a", 2][1] - last).total_seconds() == 7200
    assert (got["a", 3][1] - last).total_seconds() == 10800


def test_recent_lags_need_all_rows(spark):
    rows = recent_lags(history(spark, {"a": [1, 2, 3, 4], "b": [1, 2], "c": [None, 2, 3]}),
                       "gauge_id", "measurement_timestamp", "water_level_cm").collect()
    assert [(r.gauge_id, r.lag_0, r.lag_1, r.lag_2) for r in rows] == [("a", 4, 3, 2)]


def test_model_store(spark, tmp_path):
    path = str(tmp_path / "models")
    assert load_models(spark, path).count() == 0
    first = models_of(spark, ("a", 2, 0.0, 1.0, 0.0, 0.0, 9), ("b", 2, 0.0, 1.0, 0.0, 0.0, 9))
    assert save_models(first, path, "2026-01-01 00:00:00")
    assert save_models(first.filter("gauge_id = 'a'"), path, "2026-01-02 00:00:00")
    assert not save_models(first.limit(0), path, "2026-01-03 00:00:00")
    assert [r.gauge_id for r in load_models(spark, path).collect()] == ["a"]
    # A repeat of a run replaces it, and older runs go.
    assert save_models(first, path, "2026-01-02 00:00:00")
    assert load_models(spark, path).count() == 2
    assert save_models(first, path, "2026-01-04 00:00:00")
    assert len(list((tmp_path / "models").glob("trained_at=*"))) == 2
    # A run that is being written, or was copied in part, doesn't count.
    broken = tmp_path / "models" / "trained_at=20260105000000"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("no Parquet yet")
    assert load_models(spark, path).count() == 2


def test_scoring_keeps_the_first_forecast(spark, tmp_path):
    root, models = str(tmp_path), str(tmp_path / "models")
    create_tables(spark, root)
    random.seed(3)
    levels = history(spark, {"a": [random.randint(0, 99) for _ in range(30)]})
    rows = levels.select(
        "*", F.lit(None).cast("double").alias("flow_m3s"), F.lit(False).alias("is_warning"),
        F.col("measurement_timestamp").alias("ingestion_timestamp"))
    insert_absent(rows, root, HYDRO_MEASUREMENTS)
    assert score(spark, root, models, 1, as_of="2026-01-01 00:00:00") == 1
    stored = read_table(spark, root, HYDRO_PREDICTIONS)
    before = stored.collect()
    assert {r.horizon_hours for r in before} == {2, 3}
    assert score(spark, root, models, 6, as_of="2026-01-02 00:00:00") == 0
    assert sorted(read_table(spark, root, HYDRO_PREDICTIONS).collect()) == sorted(before)


def test_overlay_and_export(spark, tmp_path):
    levels = history(spark, {"a": [1, 2, 3]})
    now = levels.agg(F.max("measurement_timestamp")).first()[0]
    made = spark.createDataFrame(
        [("a", 2, 5.0, 2), ("a", 4, 6.0, 3), ("a", 5, 7.0, 3), ("a", -25, 8.0, 2)],
        "gauge_id string, h int, predicted_water_level double, horizon_hours int").select(
        "gauge_id", (F.lit(now) + F.make_dt_interval(hours="h")).alias("prediction_timestamp"),
        "predicted_water_level", "horizon_hours", F.lit(now).alias("created_at"))
    rows = forecast_overlay(levels, made, as_of=F.lit(now)).collect()
    assert sorted((r.series, r.level) for r in rows) == [
        ("Pomiar rzeczywisty", 1.0), ("Pomiar rzeczywisty", 2.0), ("Pomiar rzeczywisty", 3.0),
        ("Predykcja ML", 5.0), ("Predykcja ML", 6.0)]
    assert forecast_horizons(made).first().horizons == [2, 3]
    shown = export_predictions(made, str(tmp_path / "csv"))
    assert shown.columns == ["gauge_id", "prediction_timestamp", "predicted_water_level",
                             "horizon_hours"]
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == made.columns and back.count() == 4


def test_latest_rows_of_silent_and_late_stations(spark, tmp_path):
    """Batches out of order, repeats, gauges that fell silent: always the newest rows of each."""
    def batch(*rows):
        return spark.createDataFrame([(g, datetime(2026, 1, d, h), v, None, False,
                                       datetime(2026, 2, 1)) for g, d, h, v in rows],
                                     HYDRO_MEASUREMENTS.schema)

    def latest():
        return sorted((r.gauge_id, r.measurement_timestamp.day, r.measurement_timestamp.hour,
                       r.water_level_cm)
                      for r in read_latest(spark, root, HYDRO_MEASUREMENTS).collect())

    root = str(tmp_path)
    assert latest() == []
    first = batch(("a", 5, 1, 1), ("a", 5, 2, 2), ("silent", 1, 0, 9))
    for _ in range(2):
        update_latest(first, root, HYDRO_MEASUREMENTS)
    update_latest(batch(("a", 6, 1, 3), ("a", 6, 2, 4), ("a", 5, 2, 77), ("a", 2, 0, 8)), root,
                  HYDRO_MEASUREMENTS)
    update_latest(batch(("a", 4, 0, 5), ("b", 4, 0, 6)), root, HYDRO_MEASUREMENTS)
    assert latest() == [("a", 5, 2, 2), ("a", 6, 1, 3), ("a", 6, 2, 4), ("b", 4, 0, 6),
                        ("silent", 1, 0, 9)]
    assert len(list((tmp_path / "hydro_measurements_latest").iterdir())) == 2


def test_a_long_series_is_whole(spark):
    now = F.lit("2026-01-02 00:00:00").cast("timestamp")
    minutes = spark.range(1440).select(
        F.lit("g").alias("gauge_id"),
        (now - F.make_dt_interval(mins=F.col("id").cast("int") + 1)).alias("measurement_timestamp"),
        F.lit(1).alias("water_level_cm"), F.lit(1.0).alias("flow_m3s"),
        F.lit(True).alias("is_warning"))
    series = hydro_series(minutes, as_of="2026-01-02 00:00:00")
    row = series_summary(series, "gauge_id", "measurement_timestamp").first()
    assert (row.readings, row.last_clock) == (1440, "23:59 UTC")
    assert hydro_series(minutes, "g", "2026-01-02 00:00:00", limit=1000).count() == 1000
    with pytest.raises(ValueError):
        hydro_series(minutes, limit=1000)
