"""Training from day statistics against training on the history."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewarden.plans import training
from tidewarden.plans.forecast import level_stats, train_level_models
from tidewarden.schemas import HYDRO_MEASUREMENTS
from tidewarden.sources.tables import create_tables, insert_absent, table_path, touched_days

NOON = 1_700_049_600  # 2023-11-15 12:00 UTC


def readings(spark, rows):
    """(gauge, seconds, level) as rows of the history table."""
    return spark.createDataFrame(rows, "gauge_id string, s long, water_level_cm int").select(
        "gauge_id", F.timestamp_seconds("s").alias("measurement_timestamp"), "water_level_cm",
        F.lit(None).cast("double").alias("flow_m3s"), F.lit(False).alias("is_warning"),
        F.timestamp_seconds("s").alias("ingestion_timestamp"))


def some_rows(seed, gauges=12, per_gauge=200, longest=40_000):
    chance = random.Random(seed)
    rows = []
    for g in range(gauges):
        second = NOON + chance.randrange(5000)
        for _ in range(per_gauge):
            # Days of one, several and many readings, and days without any.
            second += chance.choice([600, 600, 600, 3600, chance.randrange(1, longest), 90_000])
            rows.append((f"H_{g}", second, None if chance.random() < 0.05 else chance.randrange(300)))
    return rows


def coefficients(models):
    return {(r.gauge_id, r.horizon): [r.n, r.intercept, r.b0, r.b1, r.b2] for r in models.collect()}


def same_models(a, b):
    assert set(a) == set(b) and a
    for key, row in a.items():
        assert np.allclose(row, b[key], rtol=1e-9, atol=1e-9), key


@pytest.mark.parametrize("seed, longest", [(1, 40_000), (2, 400), (3, 200_000)])
def test_models_equal_those_of_the_history(spark, seed, longest):
    history = readings(spark, some_rows(seed, longest=longest))
    days = training.day_statistics(history)
    same_models(coefficients(training.models_from_days(days)),
                coefficients(train_level_models(history)))


def test_statistics_far_from_zero_keep_their_digits(spark):
    """Levels of millions that differ by units: sums of squares would lose them."""
    chance = random.Random(4)
    rows = [("H", NOON + 600 * i, 1_000_000_000 + chance.randrange(4)) for i in range(3000)]
    history = readings(spark, rows)
    merged = training.stats_from_days(training.day_statistics(history)).first()
    whole = level_stats(history).first()
    assert merged.n == whole.n
    for name in whole.asDict():
        if name.startswith("cov"):
            assert merged[name] == pytest.approx(whole[name], rel=1e-6, abs=1e-6)


def test_gates(spark):
    ten = [("ten", NOON + 40_000 * i, (i * 7) % 11) for i in range(10)]
    few = [("few", NOON + 40_000 * i, i) for i in range(4)]
    days = training.day_statistics(readings(spark, ten + few))
    assert training.models_from_days(days).count() == 0  # 14 readings
    days = training.day_statistics(readings(spark, [*ten, *few, ("few", NOON + 900_000, 5)]))
    assert {r.gauge_id: r.n for r in training.models_from_days(days).collect()} == {"ten": 5}
    assert training.models_from_days(days.limit(0)).count() == 0


def files_of(root):
    base = f"{table_path(root, HYDRO_MEASUREMENTS)}_days"
    return {day: sorted(os.listdir(f"{base}/{day}")) for day in os.listdir(base)
            if day.startswith("day=")}


def test_a_late_reading_changes_its_day_alone(spark, tmp_path):
    root = str(tmp_path / "tables")
    create_tables(spark, root, [HYDRO_MEASUREMENTS])
    rows = some_rows(5)

    def store(part):
        frame = readings(spark, part)
        insert_absent(frame, root, HYDRO_MEASUREMENTS)
        training.update_days(spark, root, touched_days(frame, HYDRO_MEASUREMENTS))

    store(rows)
    before = files_of(root)
    # A gauge's first reading of a day: cases of the day before reach to it.
    late = ("H_3", NOON + 43_200 + 86_400 * 4 + 1, 77)
    store([late])
    after = files_of(root)
    assert [day for day in after if after[day] != before.get(day)] == ["day=2023-11-20"]
    same_models(
        coefficients(training.models_from_days(training.read_days_of_levels(spark, root))),
        coefficients(train_level_models(readings(spark, [*rows, late]))))
    # Repeated batches change nothing.
    store([late])
    assert training.read_days_of_levels(spark, root).agg(F.sum("readings")).first()[0] == len(rows) + 1


def test_training_reads_the_statistics_alone(spark, tmp_path):
    root = str(tmp_path / "tables")
    create_tables(spark, root, [HYDRO_MEASUREMENTS])
    insert_absent(readings(spark, some_rows(6)), root, HYDRO_MEASUREMENTS)
    training.complete_days(spark, root)  # a table of before they were kept
    days = training.read_days_of_levels(spark, root)
    assert days.inputFiles() and all("_days/" in f for f in days.inputFiles())
    models = training.models_from_days(days)
    assert all("_days/" in f for f in models.inputFiles())
    known = files_of(root)
    training.complete_days(spark, root)
    assert files_of(root) == known
