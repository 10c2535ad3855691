from __future__ import annotations

import json
import os
import sys
from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewarden.operators.dedup import first_in_stream, first_per_key
from tidewarden.plans.alerts import storm_alerts, synop_readings
from tidewarden.schemas import (
    ALERT, ALERTS_HISTORY, HYDRO_MEASUREMENTS, MESSAGE, RAW_HYDRO, SYNOP_MEASUREMENTS)
from tidewarden.sources.feeds import raw_feed_stream
from tidewarden.sources.messages import (
    decoded, folder_writer, kafka_options, landed_replay, landed_stream)
from tidewarden.sources.tables import create_tables, insert_absent, read_table
from tidewarden.streaming import jobs
from tidewarden.streaming.jobs import start_alert_job, start_history_job, start_ingest_job

STATIONS = "id string, lat double, lon double, name string"


def messages(spark, *rows, topic="synop", start=0):
    """Rows as messages: JSON-able bodies, offsets in order."""
    return spark.createDataFrame(
        [(topic, 0, start + i, None, None, json.dumps(body).encode())
         for i, body in enumerate(rows)], MESSAGE)


def reading(time, pressure=1000.0, wind=30.0, station="IMGW_1", day="09"):
    return {"station_id": station, "measurement_timestamp": f"2026-06-{day}T{time}:00Z",
            "temperature": 1.0, "humidity": 50, "pressure_hpa": pressure, "wind_speed": wind,
            "ingestion_timestamp": f"2026-06-{day}T{time}:30Z"}


def level(time, value, gauge="H_1", ingested="2026-06-09T23:00:00Z"):
    return {"gauge_id": gauge, "measurement_timestamp": f"2026-06-09T{time}:00Z",
            "water_level_cm": value, "flow_m3s": None, "is_warning": False,
            "ingestion_timestamp": ingested}


def run_storm(spark, landed, root, preview=False, **limits):
    stations = spark.createDataFrame([("IMGW_1", 52.0, 21.0, "Warszawa")], STATIONS)
    found = storm_alerts(synop_readings(landed_stream(spark, landed, **limits)), stations)
    job = start_alert_job(found, folder_writer(f"{root}/alerts"), f"{root}/checkpoint",
                          preview=preview, once=True)
    job.awaitTermination()
    sent = decoded(spark.read.parquet(f"{root}/alerts"), ALERT)
    return sorted(r.alert_id[-10:] for r in sent.collect())


def test_windows_come_once_when_the_watermark_passes_them(spark, land, tmp_path, capfd):
    landed = land(messages(spark, reading("10:00"), reading("14:00")))
    # Watermark 13:00: the windows 08-11, 09-12 and 10-13 are closed, an equal end included.
    assert run_storm(spark, landed, tmp_path, preview=True) == [
        "2026060908", "2026060909", "2026060910"]
    assert "STORM_IMGW_1_2026060908" in capfd.readouterr().out
    # Restart from the checkpoint: the later windows follow, the earlier ones do not come again.
    land(messages(spark, reading("23:00"), start=2))
    assert run_storm(spark, landed, tmp_path) == [
        "2026060908", "2026060909", "2026060910", "2026060912", "2026060913", "2026060914"]


def test_panes_update_less_state(spark, land, tmp_path):
    """Readings that trickle in: the same alerts, with about a third of the rows updated."""
    for hour in range(10, 15):
        for start in (0, 20, 40):
            landed = land(messages(spark, *[
                reading(f"{hour}:{start + m:02}", 1000.0 - (hour * m) % 17, (hour * m) % 40, f"IMGW_{m % 3}")
                for m in range(0, 20, 5)], start=hour * 60 + start))
    stations = spark.createDataFrame([("IMGW_1", 52.0, 21.0, "Warszawa")], STATIONS)
    alerts, updated = {}, {}
    for panes in (False, True):
        stream = synop_readings(landed_stream(spark, landed, maxFilesPerTrigger="1"))
        job = start_alert_job(
            storm_alerts(stream, stations, as_of="2026-06-10 00:00:00", panes=panes),
            folder_writer(str(tmp_path / f"alerts-{panes}")), str(tmp_path / f"check-{panes}"), once=True)
        job.awaitTermination()
        alerts[panes] = sorted(r.value for r in spark.read.parquet(str(tmp_path / f"alerts-{panes}")).collect())
        updated[panes] = sum(o["numRowsUpdated"] for p in job.recentProgress for o in p["stateOperators"]
                             if o["operatorName"] == "stateStoreSave")
    assert alerts[True] == alerts[False] and alerts[True]
    assert updated[True] < 0.7 * updated[False]


def test_late_reading_is_dropped(spark, land, tmp_path):
    landed = land(messages(spark, reading("10:00"), reading("20:00")))
    run_storm(spark, landed, tmp_path)
    land(messages(spark, reading("05:00"), start=2))
    assert not any(r.endswith("0905") for r in run_storm(spark, landed, tmp_path))


def test_stream_equals_batch_on_closed_windows(spark, land, tmp_path):
    rows = [reading(f"{h:02}:{m:02}", 1000.0 - (h * 7 + m) % 13, (h * m) % 30, f"IMGW_{h % 3}")
            for h in range(24) for m in range(0, 60, 7)]
    landed = land(messages(spark, *rows))
    streamed = run_storm(spark, landed, tmp_path)
    readings = synop_readings(landed_replay(spark, landed))
    stations = spark.createDataFrame([("IMGW_1", 52.0, 21.0, "Warszawa")], STATIONS)
    # Newest reading 23:56, so windows that start until 19:00 end by the watermark 22:56.
    batch = storm_alerts(readings, stations).filter("right(alert_id, 10) <= '2026060919'")
    assert streamed == sorted(r.alert_id[-10:] for r in batch.collect()) and streamed


def test_history_keeps_the_first_row_and_survives_replay(spark, land, tmp_path):
    root = str(tmp_path / "tables")
    alert = {n: None for n in ALERT.names} | {
        "alert_id": "STORM_IMGW_1_2026060918", "severity": "Red",
        "ingestion_timestamp": "2026-06-09T21:00:00Z"}
    landed = land(
        messages(spark, level("10:00", 5), level("10:00", 9), level("11:00", 6), {"gauge_id": "x"},
                 level("12:00", 3, ingested="2026-06-09T22:00:00Z"), level("12:00", 4,
                 ingested="2026-06-09T21:00:00Z"), topic="hydro")
        .union(messages(spark, reading("10:00"), reading("10:00", station="IMGW_2")))
        .union(messages(spark, alert, {**alert, "severity": "Yellow"}, {**alert, "alert_id": "odd"},
                        topic="alerts")))

    def levels():
        return {str(r.measurement_timestamp)[11:13]: r.water_level_cm
                for r in read_table(spark, root, HYDRO_MEASUREMENTS).collect()}

    for run in range(2):
        stream = landed_stream(spark, landed)
        start_history_job(stream, root, str(tmp_path / f"check-{run}"), once=True
                          ).awaitTermination()
        assert levels() == {"10": 5, "11": 6, "12": 4}
        assert read_table(spark, root, SYNOP_MEASUREMENTS).count() == 2
        stored = read_table(spark, root, ALERTS_HISTORY).collect()
        assert {(r.alert_id, r.severity, str(r.day)[:4]) for r in stored} == {
            ("STORM_IMGW_1_2026060918", "Red", "2026"), ("odd", "Red", "0001")}


def test_insert_absent_counts_and_prunes(spark, tmp_path):
    root = str(tmp_path)
    create_tables(spark, root)
    create_tables(spark, root)
    rows = spark.createDataFrame(
        [("a", "2026-06-09 10:00:00", 1), ("a", "2026-06-09 10:00:00", 2),
         ("a", "2026-06-10 10:00:00", 3), (None, "2026-06-10 10:00:00", 4)],
        "gauge_id string, t string, water_level_cm int").select(
        "gauge_id", F.col("t").cast("timestamp").alias("measurement_timestamp"),
        "water_level_cm", F.lit(None).cast("double").alias("flow_m3s"),
        F.lit(False).alias("is_warning"),
        F.timestamp_seconds("water_level_cm").alias("ingestion_timestamp"))
    assert insert_absent(rows, root, HYDRO_MEASUREMENTS) == 2
    assert insert_absent(rows, root, HYDRO_MEASUREMENTS) == 0
    assert insert_absent(rows.limit(0), root, HYDRO_MEASUREMENTS) == 0
    assert {r.water_level_cm for r in read_table(spark, root, HYDRO_MEASUREMENTS).collect()
            } == {1, 3}


def raw_hydro(spark, *rows):
    return spark.createDataFrame(
        [(g, "s", "r", "50", "19", v, f"2026-06-09 {t}:00", None) for g, t, v in rows], RAW_HYDRO)


def test_ingest_job_publishes_once_and_keeps_rejects(spark, land, tmp_path):
    landed = land(raw_hydro(spark, ("1", "10:00", "5"), ("1", "10:00", "6"), ("2", "10:00", "x")))

    def run(checkpoint):
        raw = spark.readStream.schema(RAW_HYDRO).parquet(landed)
        start_ingest_job(raw, "hydro", folder_writer(str(tmp_path / f"sent-{checkpoint}")),
                         folder_writer(str(tmp_path / f"bad-{checkpoint}")),
                         str(tmp_path / "seen"), str(tmp_path / checkpoint), once=True
                         ).awaitTermination()
        sent = spark.read.parquet(str(tmp_path / f"sent-{checkpoint}"))
        return sorted((r.key, json.loads(r.value)["water_level_cm"]) for r in sent.collect())

    assert run("one") == [("H_1", 5)]
    bad = spark.read.parquet(str(tmp_path / "bad-one")).collect()
    assert [r.reason for r in bad] == ["water_level_cm"]
    land(raw_hydro(spark, ("1", "10:00", "7"), ("1", "11:00", "8")))
    assert run("one") == [("H_1", 5), ("H_1", 8)]
    # A new checkpoint reads everything again, and finds it published.
    assert run("two") == []


def test_history_job_takes_only_its_topics(spark, land, tmp_path, monkeypatch):
    """Messages of other topics are gone before a batch is held, and one topic is held once."""
    taken, held = [], []
    plain = jobs.history_rows

    def rows_of(batch, topic):
        taken.append({r.topic for r in batch.select("topic").distinct().collect()})
        held.append(batch.is_cached)
        return plain(batch, topic)

    monkeypatch.setattr(jobs, "history_rows", rows_of)
    landed = land(messages(spark, level("10:00", 5), topic="hydro").union(
        messages(spark, reading("10:00"))))
    for topics in (("synop",), ("hydro", "synop")):
        start_history_job(landed_stream(spark, landed), str(tmp_path / f"tables-{len(topics)}"),
                          str(tmp_path / f"check-{len(topics)}"), topics, once=True
                          ).awaitTermination()
    assert taken == [{"synop"}, {"hydro", "synop"}, {"hydro", "synop"}]
    assert held == [False, True, True]


@pytest.mark.parametrize("fails", [False, True])
def test_history_job_leaves_nothing_cached(spark, land, tmp_path, fails):
    """Several batches with rejects, and one whose rejects can't be written."""
    landed = land(messages(spark, reading("10:00"), reading("11:00")))
    for start in (2, 4):
        land(messages(spark, reading(f"1{start}:00"), {"station_id": "IMGW_2"}, start=start))

    def refuse(rows, batch_id):
        raise OSError("full")

    def cached():
        return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())

    before = cached()
    job = start_history_job(
        landed_stream(spark, landed, maxFilesPerTrigger=1), str(tmp_path / "tables"),
        str(tmp_path / "check"), ("synop",), once=True,
        write_rejects=refuse if fails else folder_writer(str(tmp_path / "bad")))
    if fails:
        with pytest.raises(StreamingQueryException):
            job.awaitTermination()
    else:
        job.awaitTermination()
        assert spark.read.parquet(str(tmp_path / "bad")).count() == 2
    assert cached() == before


def test_stream_dedup_keeps_one_of_many_copies(spark, tmp_path):
    rows = spark.range(20_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("key"),
        F.timestamp_seconds(F.lit(1.7e9)).alias("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    kept = first_in_stream(stream, ["key"], "ts", timedelta(hours=1))
    (kept.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check"))
     .trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination())
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == out.distinct().count() == 500


def test_first_per_key(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")],
                                 "key string, at int, v string")
    assert {(r.key, r.v) for r in first_per_key(rows, ["key"], ["at"]).collect()} == {
        ("a", "y"), ("b", "z")}


def test_kafka_options():
    assert kafka_options("broker:9092", ["hydro", "synop"], "earliest", "latest") == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "hydro,synop",
        "startingOffsets": "earliest", "endingOffsets": "latest"}


def test_feed_files_are_polls(spark, tmp_path):
    """Landed arrays as a stream: of a repeated reading the earlier poll counts."""
    feed = tmp_path / "feed"
    feed.mkdir()
    for poll, value in enumerate(("5", "6")):
        body = [{"id_stacji": "1", "stacja": "s", "rzeka": "r", "lat": "50", "lon": "19",
                 "stan_wody": value, "stan_wody_data_pomiaru": "2026-06-09 10:00:00",
                 "przeplyw": None}, {"id_stacji": str(poll + 2), "stan_wody": "x",
                                     "stan_wody_data_pomiaru": "2026-06-09 10:00:00"}]
        path = feed / f"{1 - poll}.json"
        path.write_text(json.dumps(body), encoding="utf-8")
        os.utime(path, (1_780_000_000 + poll * 600,) * 2)
    start_ingest_job(
        raw_feed_stream(spark, str(feed), RAW_HYDRO), "hydro", folder_writer(str(tmp_path / "sent")),
        folder_writer(str(tmp_path / "bad")), str(tmp_path / "seen"), str(tmp_path / "check"),
        once=True).awaitTermination()
    sent = [json.loads(r.value) for r in spark.read.parquet(str(tmp_path / "sent")).collect()]
    assert [(m["gauge_id"], m["water_level_cm"], "polled_at" in m) for m in sent] == [
        ("H_1", 5, False)]
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_command_line_lists_the_jobs(capsys):
    from tidewarden.streaming import run
    with pytest.raises(SystemExit):
        sys.argv = ["run", "--help"]
        run.main()
    shown = capsys.readouterr().out
    assert all(job in shown for job in run.CHECKPOINT)
