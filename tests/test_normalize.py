from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidewarden.operators.joins import named
from tidewarden.functions.text import (
    fold_polish, number_text, optional, station_label, zero_padded)
from tidewarden.functions.times import event_time
from tidewarden.operators.normalize import (
    judged_hydro, judged_weather, normalize_hydro, normalize_weather, rejected)
from tidewarden.plans.ingest import ingest
from tidewarden.schemas import RAW_HYDRO, RAW_WEATHER
from tidewarden.sources.feeds import feed_records, raw_feed
from tidewarden.sources.stations import (
    build_stations, combined_stations, read_stations, write_stations)

AS_OF = "2026-06-07 12:05:00"
WEATHER = {
    "id_stacji": "12500", "stacja": "Jelenia Góra", "data_pomiaru": "2026-06-07",
    "godzina_pomiaru": "12", "temperatura": "19.7", "predkosc_wiatru": "4",
    "kierunek_wiatru": "280", "wilgotnosc_wzgledna": "50.4", "suma_opadu": "0.1",
    "cisnienie": "1020.4"}
HYDRO = {
    "id_stacji": "151140030", "stacja": "Przewoźniki", "rzeka": "Skroda", "lat": "51.5",
    "lon": "14.8", "stan_wody": "245", "stan_wody_data_pomiaru": "2026-06-07 12:00:00",
    "przeplyw": "12.5"}


def frame(spark, schema, *records):
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in records], schema)


def weather(spark, **changes):
    return frame(spark, RAW_WEATHER, {**WEATHER, **changes})


def hydro(spark, **changes):
    return frame(spark, RAW_HYDRO, {**HYDRO, **changes})


def test_weather_record(spark):
    row = normalize_weather(weather(spark), AS_OF).first()
    assert row.asDict() == {
        "station_id": "IMGW_12500", "measurement_timestamp": "2026-06-07T12:00:00Z",
        "temperature": 19.7, "humidity": 50, "pressure_hpa": 1020.4, "wind_speed": 4.0,
        "ingestion_timestamp": "2026-06-07T12:05:00Z"}


@pytest.mark.parametrize("hour, text", [("6", "06"), ("16", "16"), ("", "00"), ("123", "123")])
def test_hours_are_padded_but_never_cut(spark, hour, text):
    row = spark.createDataFrame([(hour,)], "h string").select(
        zero_padded(F.col("h")).alias("h")).first()
    assert row.h == text


def test_null_pressure_is_skipped_silently(spark):
    judged = judged_weather(weather(spark, cisnienie=None))
    assert judged.count() == 0


@pytest.mark.parametrize("field, value, named", [
    ("temperatura", None, "temperature"), ("temperatura", "warm", "temperature"),
    ("predkosc_wiatru", "", "wind_speed"), ("cisnienie", "", "pressure_hpa"),
    ("wilgotnosc_wzgledna", "nan", "humidity"), ("id_stacji", None, "station_id"),
    ("godzina_pomiaru", None, "measurement_timestamp")])
def test_bad_weather_field_rejects_the_record(spark, field, value, named):
    raw = weather(spark, **{field: value})
    assert normalize_weather(raw).count() == 0
    row = rejected(judged_weather(raw)).first()
    assert row.reason == named
    assert json.loads(row.record) == {**WEATHER, field: value}


def test_hydro_record(spark):
    row = normalize_hydro(hydro(spark), AS_OF).first()
    assert row.asDict() == {
        "gauge_id": "H_151140030", "measurement_timestamp": "2026-06-07T12:00:00Z",
        "water_level_cm": 245, "flow_m3s": 12.5, "is_warning": False,
        "ingestion_timestamp": "2026-06-07T12:05:00Z"}


def test_hydro_rules(spark):
    raw = frame(spark, RAW_HYDRO,
                {**HYDRO, "id_stacji": "1", "stan_wody": "245.5"},
                {**HYDRO, "id_stacji": "2", "stan_wody": None},
                {**HYDRO, "id_stacji": "3", "przeplyw": None},
                {**HYDRO, "id_stacji": "4", "przeplyw": "b.d."},
                {**HYDRO, "id_stacji": "5", "stan_wody_data_pomiaru": None})
    assert [r.gauge_id for r in normalize_hydro(raw).collect()] == ["H_3"]
    assert normalize_hydro(raw).first().flow_m3s is None
    reasons = {json.loads(r.record)["id_stacji"]: r.reason
               for r in rejected(judged_hydro(raw)).collect()}
    assert reasons == {"1": "water_level_cm", "2": "water_level_cm", "4": "flow_m3s"}


def test_warning_level(spark):
    raw = frame(spark, RAW_HYDRO, HYDRO, {**HYDRO, "stan_wody": "300"})
    flags = [r.is_warning for r in normalize_hydro(raw, warning_level=F.lit(300)).collect()]
    assert flags == [False, True]


def test_first_record_of_a_key_wins_and_seen_keys_stay_out(spark):
    raw = frame(spark, RAW_HYDRO, HYDRO, {**HYDRO, "stan_wody": "999"},
                {**HYDRO, "id_stacji": "7"}).coalesce(1)
    seen = spark.createDataFrame([("H_7", "2026-06-07T12:00:00Z")],
                                 "gauge_id string, measurement_timestamp string")
    result = ingest(raw, "hydro", seen)
    assert [(r.gauge_id, r.water_level_cm) for r in result.new.collect()] == [
        ("H_151140030", 245)]
    assert result.usable.count() == 3


def test_raw_feed_is_an_array_per_file(spark, tmp_path):
    for hour in ("11", "12"):
        records = [{**WEATHER, "godzina_pomiaru": hour}, {**WEATHER, "id_stacji": "9"}]
        (tmp_path / f"{hour}.json").write_text(json.dumps(records), encoding="utf-8")
    raw = raw_feed(spark, str(tmp_path), RAW_WEATHER)
    assert raw.count() == 4
    assert normalize_weather(raw).columns[0] == "station_id"
    new = ingest(raw, "synop").new
    assert new.count() == 3 and "polled_at" not in new.columns


def test_feed_documents_as_text(spark):
    documents = spark.createDataFrame([(json.dumps([WEATHER, WEATHER]),), ("junk",)],
                                      "value string")
    assert feed_records(documents, RAW_WEATHER).count() == 2


def test_numbers_are_rounded_as_they_are_stored(spark):
    values = [0.25, 2.25, 0.125, 1.005, 1.115, 0.285, -0.25, -0.04, 2.5, 1e15, 99.95, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2):
        got = df.select("v", number_text(F.col("v"), digits).alias("t")).collect()
        assert [r.t for r in got] == [f"{r.v:.{digits}f}" for r in got]


def test_one_name_for_an_id_that_is_listed_twice(spark):
    listed = spark.createDataFrame([("a", "old"), ("b", None), ("a", "new")], "id string, name string")
    seen = spark.createDataFrame([("a",), ("b",), ("c",)], "station string")
    got = named(seen, listed, "station").orderBy("station").collect()
    assert [tuple(r) for r in got] == [("a", "new"), ("b", "b"), ("c", "c")]


def test_station_dictionary(spark, tmp_path):
    raw = frame(spark, RAW_HYDRO, {**HYDRO, "stacja": "Żółwin Śródm.", "rzeka": None},
                {**HYDRO, "lat": None}, {**HYDRO, "lon": ""}, {**HYDRO, "lat": "0"}, HYDRO)
    built = build_stations(raw)
    assert [(r.name, r.lat == 0) for r in built.collect()] == [
        ("Zolwin Srodm. ()", False), ("Przewozniki (Skroda)", True), ("Przewozniki (Skroda)", False)]
    numbers = raw.withColumns({c: raw[c].try_cast("double") for c in ("lat", "lon")})
    assert build_stations(numbers).count() == 2  # the number 0 is no coordinate
    write_stations(built, str(tmp_path / "hydro"))
    (tmp_path / "weather.csv").write_text("id,lat,lon\nIMGW_1,x,18.5\n", encoding="utf-8")
    row = read_stations(spark, str(tmp_path / "weather.csv")).first()
    assert (row.lat, row.lon, row.name) == (None, 18.5, None)
    both = combined_stations(spark, {
        "weather": str(tmp_path / "weather.csv"), "hydro": str(tmp_path / "hydro"),
        "snow": str(tmp_path / "snow.csv")})
    assert {(r.id, r.type) for r in both.collect()} == {
        ("IMGW_1", "weather"), ("H_151140030", "hydro")}
    none = combined_stations(spark, {"snow": str(tmp_path / "snow.csv")})
    assert none.count() == 0 and none.columns == ["id", "lat", "lon", "name", "type"]


def test_text_functions(spark):
    row = spark.createDataFrame([(2.25, None, "x", "ŁÓDŹ żółć")],
                                "n double, m double, s string, p string").select(
        number_text(F.col("n"), 1, "%").alias("n"), number_text(F.col("m"), 1, "%").alias("m"),
        optional(" v=", F.col("n")).alias("on"), optional(" v=", F.col("m")).alias("om"),
        fold_polish(F.col("p")).alias("p"), fold_polish(F.lit(None)).alias("empty"),
        station_label(F.col("s"), F.lit("Name")).alias("named"),
        station_label(F.col("s"), F.col("s")).alias("own"),
        station_label(F.col("s"), F.lit(None)).alias("bare"),
        event_time(F.lit("junk")).alias("junk")).first()
    assert row.asDict() == {
        "n": "2.2%", "m": "—", "on": " v=2.25", "om": "", "p": "LODZ zolc", "empty": "",
        "named": "Name (x)", "own": "x", "bare": "x", "junk": None}
