from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewarden.operators.windows import sliding_extremes
from tidewarden.plans.alerts import (
    FLOOD, STORM, contract_violations, flood_alerts, hydro_readings, storm_alerts,
    synop_readings)
from tidewarden.plans.board import alert_board, alert_total, current_alerts, new_alerts
from tidewarden.plans.views import map_layer
from tidewarden.schemas import ALERT
from tidewarden.sources.messages import decoded, keyed_json

AS_OF = "2026-06-09 20:00:00"
STATIONS = "id string, lat double, lon double, name string, type string"


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame([("IMGW_1", 52.0, 21.0, "Warszawa", "weather"),
                                  ("H_1", 50.0, 19.0, "Krakow", "hydro")], STATIONS)


def synop(spark, *rows):
    """Readings of one station: (hour text, pressure, wind)."""
    return spark.createDataFrame(
        [("IMGW_1", f"2026-06-09T{t}Z", p, w) for t, p, w in rows],
        "station_id string, measurement_timestamp string, pressure_hpa double, wind_speed double"
    ).withColumn("event_time", F.try_to_timestamp("measurement_timestamp"))


def hydro(spark, *rows, gauge="H_1"):
    return spark.createDataFrame(
        [(gauge, f"2026-06-09T{t}Z", v) for t, v in rows],
        "gauge_id string, measurement_timestamp string, water_level_cm int"
    ).withColumn("event_time", F.try_to_timestamp("measurement_timestamp"))


def at(alerts, hour):
    """The alert of the window that starts at an hour, if there is one."""
    rows = alerts.filter(F.col("alert_id").endswith(f"20260609{hour}")).collect()
    assert len(rows) <= 1
    return rows[0] if rows else None


@pytest.mark.parametrize("drop, severity", [
    (2.9, None), (3.0, "Yellow"), (5.9, "Yellow"), (6.0, "Orange"), (9.0, "Red")])
def test_pressure_levels(spark, stations, drop, severity):
    alerts = storm_alerts(synop(spark, ("18:00:00", 100.0, None), ("19:30:00", 100.0 - drop, 1.0)),
                          stations, as_of=AS_OF)
    row = at(alerts, "18")
    assert (row and row.severity) == severity
    if row:
        assert row.alert_id == "STORM_IMGW_1_2026060918"
        assert row.msg == f"Spadek ciśnienia {drop} hPa/3h — ryzyko wichury"
        assert (row.value, row.lat, row.lon) == (drop, 52.0, 21.0)
        assert row.event_timestamp == "2026-06-09T20:00:00Z"
        assert row.expires == "2026-06-10T08:00:00Z"


def test_wind_alone_fires_on_a_single_reading_in_three_windows(spark, stations):
    alerts = storm_alerts(synop(spark, ("10:00:00", 1000.0, 25.0)), stations).collect()
    assert sorted(r.alert_id[-2:] for r in alerts) == ["08", "09", "10"]
    assert {(r.severity, r.msg, r.value) for r in alerts} == {
        ("Red", "Silny wiatr 25.0 m/s — ryzyko wichury", 25.0)}


def test_message_tells_the_drop_though_wind_sets_the_severity(spark, stations):
    row = at(storm_alerts(synop(spark, ("18:00:00", 1003.5, 26.0), ("18:30:00", 1000.0, 2.0)),
                          stations), "18")
    assert (row.severity, row.value) == ("Red", 3.5)
    assert row.msg.startswith("Spadek ciśnienia 3.5 hPa")


@pytest.mark.parametrize("rise, severity", [
    (29, None), (30, "Yellow"), (60, "Orange"), (100, "Red"), (-200, None)])
def test_level_rise(spark, stations, rise, severity):
    alerts = flood_alerts(hydro(spark, ("12:00:00", 245), ("17:00:00", 245 + rise)), stations,
                          as_of=AS_OF)
    row = at(alerts, "12")
    assert (row and row.severity) == severity
    if row:
        assert row.msg == (f"Wzrost poziomu wody {rise} cm/6h — ryzyko podtopienia "
                           f"(poziom {245 + rise} cm)")
        assert row.value == float(rise) and row.expires == "2026-06-10T20:00:00Z"


def test_unknown_station_keeps_its_alert(spark, stations):
    row = flood_alerts(hydro(spark, ("12:00:00", 0), ("12:30:00", 50), gauge="H_9"),
                       stations).first()
    assert (row.station_id, row.lat, row.lon) == ("H_9", None, None)


def test_readings_from_messages(spark):
    bodies = [b'{"station_id":"a","measurement_timestamp":"2026-06-09T10:00:00Z",'
              b'"pressure_hpa":1000.5,"wind_speed":3.0}',
              b'{"station_id":"b","measurement_timestamp":"2026-06-09T10:00:00Z",'
              b'"pressure_hpa":null,"wind_speed":30.0}',
              b'{"station_id":"c","measurement_timestamp":"soon","pressure_hpa":1000.5}',
              b'junk', b'[1]', b'\xff\xfe', None]
    messages = spark.createDataFrame([(b,) for b in bodies], "value binary")
    assert [r.station_id for r in synop_readings(messages).collect()] == ["a"]
    level = spark.createDataFrame(
        [(b'{"gauge_id":"g","measurement_timestamp":"2026-06-09T10:00:00Z",'
          b'"water_level_cm":5}',)], "value binary")
    assert hydro_readings(level).first().water_level_cm == 5


def test_invalid_utf8_is_replaced_not_lost(spark):
    messages = spark.createDataFrame([(b'{"alert_id":"a","msg":"x\xff"}',)], "value binary")
    assert decoded(messages, ALERT, ["alert_id"]).first().msg == "x�"


def test_panes_equal_plain_windows(spark):
    rows = spark.range(5000).select(
        (F.col("id") % 7).alias("key"), (F.xxhash64("id") % 1000).alias("value"),
        F.timestamp_seconds(F.lit(1.7e9) + F.col("id") * 97).alias("ts"))
    args = (["key"], "ts", "value", FLOOD.size, FLOOD.slide, ["value"])
    plain = sliding_extremes(rows, *args)
    panes = sliding_extremes(rows, *args, panes=True)
    assert plain.exceptAll(panes).isEmpty() and panes.exceptAll(plain).isEmpty()
    with pytest.raises(ValueError):
        sliding_extremes(rows, ["key"], "ts", "value", STORM.size, STORM.size * 2 / 3,
                         panes=True)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 23 * 60), st.integers(0, 400)), min_size=1, max_size=12,
                unique_by=lambda r: r[0]))
def test_flood_properties(spark, stations, readings):
    rows = [(f"{m // 60:02}:{m % 60:02}:00", v) for m, v in readings]
    alerts = flood_alerts(hydro(spark, *rows), stations).collect()
    assert len({r.alert_id for r in alerts}) == len(alerts) <= 6 * len(readings)
    rank = {"Yellow": 1, "Orange": 2, "Red": 3}
    for low in alerts:
        assert low.value >= 30
        for high in alerts:
            assert low.value > high.value or rank[low.severity] <= rank[high.severity]


def board_messages(spark, *alerts):
    return spark.createDataFrame(
        [(i, json.dumps(a).encode() if isinstance(a, (dict, list)) else a)
         for i, a in enumerate(alerts)], "offset long, value binary")


def test_board_keeps_the_last_version_and_sorts_by_text(spark):
    messages = board_messages(
        spark, {"alert_id": "a", "severity": "Yellow", "event_timestamp": "2026-01-01T00:00:00Z"},
        {"alert_id": "b", "event_timestamp": "2026-01-02T00:00:00Z", "alert_type": "flood"},
        {"alert_id": "a", "severity": "Purple", "event_timestamp": "2026-01-03T00:00:00Z",
         "alert_type": "hail", "value": 2.5, "expires": "2026-01-04T00:00:00Z"},
        {"alert_id": "c"}, {"alert_id": ""}, {"severity": "Red"}, b"junk", [1])
    current = current_alerts(messages)
    assert alert_total(current).first().alerts == 3
    rows = alert_board(current).collect()
    assert [r.alert_id for r in rows] == ["a", "b", "c"]
    assert rows[0].asDict() == {
        "alert_id": "a", "severity_label": "Purple", "color": "#888", "type_label": "HAIL",
        "shown_timestamp": "2026-01-03T00:00:00Z", "msg": "brak opisu", "station_id": "?",
        "value": 2.5, "value_text": " | wartość: 2.5",
        "expires_text": " | wygasa: 2026-01-04T00:00:00Z"}
    assert (rows[1].type_label, rows[1].severity_label, rows[2].shown_timestamp) == (
        "Powódź", "?", "?")


def test_board_skips_broken_messages_of_a_key(spark):
    """The last valid version stays, whatever came after it under the same key."""
    alert = {"alert_id": "a", "severity": "Red", "value": 1.5}
    for broken in (b"junk", None, {"severity": "Green"}, {"alert_id": ""}, {"alert_id": None},
                   [{"alert_id": "a"}], b'{"alert_id": "a", "sev'):
        messages = board_messages(spark, {"alert_id": "a"}, alert, broken).withColumn(
            "key", F.lit(b"a"))
        current = current_alerts(messages)
        assert [(r.alert_id, r.severity, r.value) for r in current.collect()] == [
            ("a", "Red", 1.5)], broken
        assert new_alerts(current, current).count() == 0


def test_new_alerts(spark):
    current = current_alerts(board_messages(spark, {"alert_id": "a"}, {"alert_id": "b"}))
    assert new_alerts(current, None).count() == 0
    assert [r.alert_id for r in new_alerts(current, current.filter("alert_id = 'a'")).collect()
            ] == ["b"]


def test_sent_alerts_keep_their_null_fields(spark, stations):
    alerts = flood_alerts(hydro(spark, ("12:00:00", 0), ("12:30:00", 50), gauge="H_9"), stations)
    assert contract_violations(alerts).count() == 0
    sent = keyed_json(alerts, "alert_id").first()
    body = json.loads(sent.value)
    assert body["lat"] is None and body["alert_id"] == sent.key
    assert list(body) == ALERT.names


def test_alert_without_coordinates_is_off_the_map(spark, stations):
    alerts = current_alerts(board_messages(
        spark, {"alert_id": "a", "lat": 1.0}, {"alert_id": "b", "lat": 1.0, "lon": 2.0}))
    overview = stations.select("lat", "lon", "name", F.lit("").alias("tooltip"),
                               F.lit("Stacja pogodowa").alias("category"))
    rows = map_layer(overview, alerts, stations).filter("size = 18").collect()
    assert [(r.name, r.category, r.color, r.tooltip) for r in rows] == [
        ("?", "Alert ?", None, "⚠️ ? [?]  ")]
