"""Open windows and late rows of a running window job."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from test_streams import STATIONS, messages, reading
from tidewarden.plans.alerts import storm_alerts, synop_readings
from tidewarden.sources.messages import folder_writer, landed_stream
from tidewarden.streaming import watch
from tidewarden.streaming.jobs import start_alert_job


def run(spark, landed, root, panes=False):
    stations = spark.createDataFrame([("IMGW_1", 52.0, 21.0, "Warszawa")], STATIONS)
    found = storm_alerts(synop_readings(landed_stream(spark, landed)), stations, panes=panes)
    start_alert_job(found, folder_writer(f"{root}/alerts"), f"{root}/check", once=True).awaitTermination()


@pytest.mark.parametrize("panes", [False, True])
def test_open_windows_are_those_past_the_watermark(spark, land, tmp_path, panes):
    landed = land(messages(spark, reading("10:00", 1000.0, 5.0), reading("14:10", 990.0, 7.0),
                           reading("14:50", 980.0, 6.0)))
    run(spark, landed, tmp_path, panes)
    held = watch.open_windows(spark, f"{tmp_path}/check", "station_id", ("wind_speed",))
    rows = {r.window_start.hour: r for r in held.collect()}
    # The watermark is 13:50. The pane from 14:00 is not closed, so no window has it yet.
    if panes:
        assert rows == {}
        return
    assert sorted(rows) == [12, 13, 14]
    assert all((r.first_value, r.last_value, r.max_wind_speed) == (990.0, 980.0, 7.0)
               for r in rows.values())
    assert rows[12].first_time == datetime(2026, 6, 9, 14, 10) and rows[12].station_id == "IMGW_1"


def test_late_rows_are_counted(spark, land, tmp_path):
    listener = watch.StateWatch(spark, str(tmp_path / "rows"))
    spark.streams.addListener(listener)
    try:
        landed = land(messages(spark, reading("10:00"), reading("20:00")))
        run(spark, landed, tmp_path)
        land(messages(spark, reading("05:00"), reading("06:00"), reading("20:30"), start=2))
        run(spark, landed, tmp_path)
        assert listener.wait(2, 60)
    finally:
        spark.streams.removeListener(listener)
    counted = {r.operator: r.dropped for r in watch.late_rows(spark, str(tmp_path / "rows")).groupBy(
        "operator").agg(F.sum("dropped").alias("dropped")).collect()}
    assert counted == {"dedupe": 2, "stateStoreSave": 0}
