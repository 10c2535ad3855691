"""Minute rollups against means of the rows; reasons per field of raw records."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewarden.operators.normalize import reject_reasons
from tidewarden.plans.rollups import (
    complete_rollup, read_rollup, rolled_means, rolled_summary, update_rollup)
from tidewarden.plans.views import weather_series
from tidewarden.schemas import SYNOP_MEASUREMENTS as SPEC
from tidewarden.sources.tables import create_tables, insert_absent, read_table, touched_days

START = datetime(2026, 6, 9, 10)


def readings(spark, seed, count=400):
    chance = random.Random(seed)
    rows = {(f"s{chance.randrange(3)}", chance.randrange(40 * 3600)) for _ in range(count)}
    return spark.createDataFrame(
        [(s, START + timedelta(seconds=t), chance.choice([None, 1.5, 20.25]), chance.choice([None, 50, 60]),
          1000.0 + chance.randrange(9), None) for s, t in sorted(rows)],
        "station_id string, measurement_timestamp timestamp, temperature double, humidity int, "
        "pressure_hpa double, wind_speed double").withColumn(
            "ingestion_timestamp", F.col("measurement_timestamp"))


def store(spark, root, rows):
    create_tables(spark, root, [SPEC])
    insert_absent(rows, root, SPEC)
    update_rollup(spark, root, SPEC, touched_days(rows, SPEC))


@pytest.mark.parametrize("hour, minute, second", [(10, 0, 0), (10, 0, 30), (0, 0, 0), (23, 59, 59)])
def test_rolled_means_equal_those_of_the_rows(spark, tmp_path, hour, minute, second):
    root, rows = str(tmp_path), readings(spark, 1)
    store(spark, root, rows)
    as_of = datetime(2026, 6, 10, hour, minute, second) + timedelta(days=hour < 1)
    for back in (timedelta(hours=24), timedelta(seconds=90)):
        got = rolled_means(spark, root, SPEC, as_of, back)
        expected = weather_series(read_table(spark, root, SPEC), None, as_of, back)
        assert sorted(got.select(*expected.columns).collect(), key=str) == sorted(expected.collect(), key=str)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    root, rows = str(tmp_path), readings(spark, 2)
    late = F.minute("measurement_timestamp") % 4 == 0
    store(spark, root, rows.filter(~late))
    for _ in range(2):
        store(spark, root, rows.filter(late))
    kept = sorted(read_rollup(spark, root, SPEC).collect(), key=str)
    store(spark, str(tmp_path / "once"), rows)
    assert kept == sorted(read_rollup(spark, str(tmp_path / "once"), SPEC).collect(), key=str)
    summary = {r.station_id: r for r in rolled_summary(spark, root, SPEC).collect()}
    assert sum(r.readings for r in summary.values()) == rows.count()
    assert all(r.has_temperature and not r.has_wind_speed for r in summary.values())


def test_older_tables_get_their_rollup(spark, tmp_path):
    root, rows = str(tmp_path), readings(spark, 3)
    create_tables(spark, root, [SPEC])
    assert read_rollup(spark, root, SPEC).count() == 0
    insert_absent(rows, root, SPEC)
    complete_rollup(spark, root, SPEC)
    assert read_rollup(spark, root, SPEC).agg(F.sum("readings")).first()[0] == rows.count()


def reasons(spark, *texts):
    fields = {"id": ("string", True), "level": ("int", True), "flow": ("double", False)}
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    found = [[] for _ in texts]
    for r in reject_reasons(rows, "text", fields).collect():
        found[r.i].append((r.field, r.reason))
    return found


def test_absent_null_and_mistyped_are_told_apart(spark):
    good = {"id": "a", "level": "7", "flow": "1.5"}
    given = [good, {"id": "a", "level": 7}, {"level": "7"}, {"id": None, "level": None, "flow": None},
             {"id": "a", "level": "x", "flow": "y"}, {"id": "a", "level": {}, "flow": [1]},
             {"id": ["a"], "level": "7.5"}, {"id": 5, "level": "7", "flow": 2}, {}]
    assert reasons(spark, *map(json.dumps, given)) == [
        [], [], [("id", "absent")], [("id", "null"), ("level", "null")],
        [("level", "mistyped"), ("flow", "mistyped")], [("level", "mistyped"), ("flow", "mistyped")],
        [("id", "mistyped"), ("level", "mistyped")], [], [("id", "absent"), ("level", "absent")]]


def test_text_that_is_no_object_is_broken(spark):
    assert reasons(spark, "", "{", "[]", "null", "7", '"x"', None, '{"id": "a"') == [[(None, "broken")]] * 8
