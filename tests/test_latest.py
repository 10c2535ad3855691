"""Latest rows of a time, from as few days as hold them."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewarden.schemas import HYDRO_MEASUREMENTS as SPEC
from tidewarden.sources import latest
from tidewarden.sources.tables import create_tables, insert_absent, read_folders

FIRST = datetime(2026, 6, 1)


def rows_of(spark, readings):
    """(gauge, hours since the first day, level) as rows of the table."""
    return spark.createDataFrame(
        [(g, FIRST + timedelta(hours=h), v) for g, h, v in readings],
        "gauge_id string, measurement_timestamp timestamp, water_level_cm int").withColumns({
            "flow_m3s": F.lit(None).cast("double"), "is_warning": F.lit(False),
            "ingestion_timestamp": F.col("measurement_timestamp")}).select(*SPEC.schema.names)


def stored(spark, root, readings, keep_latest=True):
    create_tables(spark, root, [SPEC])
    rows = rows_of(spark, readings)
    insert_absent(rows, root, SPEC)
    if keep_latest:
        latest.update_latest(rows, root, SPEC)


@pytest.fixture
def opened(monkeypatch):
    """The days of which folders were opened, in order."""
    days = []

    def counted(spark, root, spec, wanted):
        days.append(list(wanted))
        return read_folders(spark, root, spec, wanted)

    monkeypatch.setattr(latest, "read_folders", counted)
    return days


def found(spark, root, day, hour=12, **options):
    return {r.gauge_id: r.water_level_cm for r in latest.latest_of_table(
        spark, root, SPEC, datetime(2026, 6, day, hour), **options).collect()}


READINGS = [("ok", 24 * d + 3, d) for d in range(20)] + [
    ("silent", 30, 7), *[("ahead", 24 * d, 100 + d) for d in (2, 17, 18, 19)], ("late", 24 * 19, 1)]


def test_kept_rows_answer_alone(spark, tmp_path, opened):
    stored(spark, str(tmp_path), READINGS)
    assert found(spark, str(tmp_path), 25) == {"ok": 19, "silent": 7, "ahead": 119, "late": 1}
    assert opened == []


def test_days_are_opened_back_to_the_last_key(spark, tmp_path, opened):
    stored(spark, str(tmp_path), READINGS)
    # The three kept rows of ok, ahead and late are later; ahead's last one by then is 13 days old.
    keys = spark.createDataFrame([("ok",), ("ahead",), ("silent",)], "id string")
    assert found(spark, str(tmp_path), 16, keys=keys) == {"ok": 15, "silent": 7, "ahead": 102}
    # One day settles ok, then two, four and eight for ahead.
    assert [len(days) for days in opened] == [1, 2, 4, 8]
    assert opened[0] == [date(2026, 6, 16)] and max(opened[-1]) == date(2026, 6, 9)


def test_oldest_day_ends_the_search(spark, tmp_path, opened):
    stored(spark, str(tmp_path), READINGS)
    assert found(spark, str(tmp_path), 16, oldest=date(2026, 6, 10)) == {"ok": 15}
    assert min(day for days in opened for day in days) == date(2026, 6, 10)


def test_instant_before_everything(spark, tmp_path, opened):
    stored(spark, str(tmp_path), READINGS)
    assert found(spark, str(tmp_path), 1, 1) == {}
    assert found(spark, str(tmp_path / "none"), 16) == {}


@pytest.mark.parametrize("keep_latest", [True, False])
def test_random_tables(spark, tmp_path, keep_latest):
    chance = random.Random(3)
    readings = {(f"g{chance.randrange(12)}", chance.randrange(24 * 25)) for _ in range(150)}
    readings = [(g, h, i) for i, (g, h) in enumerate(sorted(readings))]
    stored(spark, str(tmp_path), readings, keep_latest)
    for day in (3, 14, 26):
        expected = {}
        for g, h, v in sorted(readings, key=lambda r: r[1]):
            if FIRST + timedelta(hours=h) <= datetime(2026, 6, day, 12):
                expected[g] = v
        assert found(spark, str(tmp_path), day) == expected
        seen = latest.last_seen_of_table(spark, str(tmp_path), SPEC, datetime(2026, 6, day, 12))
        assert {r.gauge_id for r in seen.collect()} == set(expected)
