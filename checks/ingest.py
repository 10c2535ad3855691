"""Decoding, normalising, deduplicating and storing readings."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.alerts import alert_messages
from checks.standins import (
    AS_OF, HYDRO, K, PREDICTIONS, RAW_ALERTS, SYNOP, check, events, hydro, landed, messages,
    predictions, synop, with_k, zoneless)
from tidewarden.functions.text import logical_key
from tidewarden.operators.dedup import first_in_stream, first_per_key
from tidewarden.operators.normalize import (
    PLACE, POLLED_AT, judged_hydro, judged_weather, reject_reasons, rejected, usable)
from tidewarden.plans.ingest import ingest, ingest_report, ingest_stream
from tidewarden.plans.views import hydro_series
from tidewarden.schemas import HYDRO as HYDRO_MESSAGE
from tidewarden.schemas import (
    ALERTS_HISTORY, HYDRO_MEASUREMENTS, HYDRO_PREDICTIONS, RAW_WEATHER,
    SYNOP_MEASUREMENTS)
from tidewarden.session import shared_folder
from tidewarden.sources.feeds import feed_records, seen_keys
from tidewarden.sources.messages import decoded, folder_writer
from tidewarden.sources.tables import create_tables, insert_absent, read_days, read_table
from tidewarden.streaming.jobs import start_history_job, start_ingest_job

_PROPS = T.StructType([T.StructField("k", T.IntegerType())])


@check(f"SELECT event_id, {K} AS k FROM events WHERE {K} % 10 <> 0")
def json_decode(spark, sf_dir):
    """Bytes to typed columns; values that are no JSON, or lack the field, are dropped."""
    k = F.col("k")
    text = F.when(k % 20 == 0, F.col("event_type")).when(k % 10 == 0, "[]").otherwise(
        F.col("props"))
    rows = with_k(events(spark, sf_dir)).select("event_id", text.cast("binary").alias("value"))
    return decoded(rows, _PROPS, required=["k"], keep=["event_id"])


def raw_weather(rows):
    """Feed records as text, some of them with gaps or bad numbers."""
    k = F.col("k")
    return with_k(rows).select(
        F.col("user_id").cast("string").alias("id_stacji"),
        F.col("event_type").alias("stacja"),
        F.date_format("ts", "yyyy-MM-dd").alias("data_pomiaru"),
        F.date_format("ts", "H").alias("godzina_pomiaru"),
        F.when(k % 13 != 0, k.cast("string")).alias("temperatura"),
        F.when(k % 17 == 0, "calm").otherwise((k / 4.0).cast("string")).alias("predkosc_wiatru"),
        F.lit("280").alias("kierunek_wiatru"),
        F.concat(k.cast("string"), F.lit(".4")).alias("wilgotnosc_wzgledna"),
        F.lit("0.1").alias("suma_opadu"),
        F.when(k % 19 != 0, F.col("value").cast("string")).alias("cisnienie"))


RAW_WEATHER_SQL = f"""raw_weather AS (
  SELECT 'IMGW_' || user_id AS station_id,
         strftime(ts, '%Y-%m-%dT%H:00:00Z') AS measurement_timestamp,
         CASE WHEN {K} % 13 <> 0 THEN CAST({K} AS DOUBLE) END AS temperature, {K} AS humidity,
         CASE WHEN {K} % 19 <> 0 THEN value END AS pressure_hpa,
         CASE WHEN {K} % 17 <> 0 THEN {K} / 4.0::DOUBLE END AS wind_speed,
         '2024-01-20T00:00:00Z' AS ingestion_timestamp
  FROM events)"""


def raw_hydro(rows, arrival=False):
    """Feed records; with their arrival, if asked for."""
    k = F.col("k")
    came = [F.col("ts").alias(POLLED_AT), (2 * F.col("event_id")).alias(PLACE)] if arrival else []
    return with_k(rows).select(
        *came,
        F.col("user_id").cast("string").alias("id_stacji"),
        F.col("event_type").alias("stacja"), F.lit("Łódź").alias("rzeka"),
        (F.col("user_id") / 4.0).cast("string").alias("lat"), k.cast("string").alias("lon"),
        F.when(k % 13 == 0, F.concat(k.cast("string"), F.lit(".5")))
        .when(k % 17 != 0, k.cast("string")).alias("stan_wody"),
        F.when(k % 19 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("stan_wody_data_pomiaru"),
        F.when(k % 11 == 0, "b.d.").when(k % 7 != 0, (k / 4.0).cast("string"))
        .alias("przeplyw"))


RAW_HYDRO_SQL = f"""raw_hydro AS (
  SELECT 'H_' || user_id AS gauge_id,
         CASE WHEN {K} % 19 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END
           AS measurement_timestamp,
         CASE WHEN {K} % 13 <> 0 AND {K} % 17 <> 0 THEN {K} END AS water_level_cm,
         CASE WHEN {K} % 7 <> 0 THEN {K} / 4.0::DOUBLE END AS flow_m3s,
         {K} % 11 = 0 AS bad_flow, FALSE AS is_warning,
         '2024-01-20T00:00:00Z' AS ingestion_timestamp, ts, event_id
  FROM events)"""


def sent_twice(raw):
    """Each record followed by a copy of the same gauge and time with another level."""
    level = F.posexplode(F.array(F.col("stan_wody"), F.lit("7"))).alias("copy", "stan_wody")
    rows = raw.select(*[c for c in raw.columns if c != "stan_wody"], level)
    return rows.select(*[(F.col(c) + F.col("copy")).alias(c) if c == PLACE else c
                         for c in raw.columns])


@check(f"""
WITH {RAW_WEATHER_SQL}
SELECT * FROM raw_weather
WHERE pressure_hpa IS NOT NULL AND temperature IS NOT NULL AND wind_speed IS NOT NULL""")
def normalize_weather(spark, sf_dir):
    return usable(judged_weather(raw_weather(events(spark, sf_dir)), AS_OF))


@check(f"""
WITH {RAW_WEATHER_SQL}
SELECT station_id AS station,
       concat_ws(', ', CASE WHEN temperature IS NULL THEN 'temperature' END,
                 CASE WHEN wind_speed IS NULL THEN 'wind_speed' END) AS reason
FROM raw_weather
WHERE pressure_hpa IS NOT NULL AND (temperature IS NULL OR wind_speed IS NULL)""")
def reject_weather(spark, sf_dir):
    bad = rejected(judged_weather(raw_weather(events(spark, sf_dir)), AS_OF))
    station = F.concat(F.lit("IMGW_"), F.get_json_object("record", "$.id_stacji"))
    return bad.select(station.alias("station"), "reason")


@check(f"""
WITH {RAW_HYDRO_SQL}
SELECT * EXCLUDE (bad_flow, ts, event_id) FROM raw_hydro
WHERE measurement_timestamp IS NOT NULL AND water_level_cm IS NOT NULL AND NOT bad_flow""")
def normalize_hydro(spark, sf_dir):
    return usable(judged_hydro(raw_hydro(events(spark, sf_dir)), AS_OF))


@check(f"""
WITH {RAW_HYDRO_SQL}
SELECT gauge_id AS gauge,
       concat_ws(', ', CASE WHEN water_level_cm IS NULL THEN 'water_level_cm' END,
                 CASE WHEN bad_flow THEN 'flow_m3s' END) AS reason
FROM raw_hydro
WHERE measurement_timestamp IS NOT NULL AND (water_level_cm IS NULL OR bad_flow)""")
def reject_hydro(spark, sf_dir):
    bad = rejected(judged_hydro(raw_hydro(events(spark, sf_dir)), AS_OF))
    gauge = F.concat(F.lit("H_"), F.get_json_object("record", "$.id_stacji"))
    return bad.select(gauge.alias("gauge"), "reason")


@check(f"""
WITH {RAW_HYDRO_SQL}
SELECT gauge_id, measurement_timestamp, water_level_cm, water_level_cm >= 50 AS is_warning
FROM raw_hydro
WHERE measurement_timestamp IS NOT NULL AND water_level_cm IS NOT NULL AND NOT bad_flow""")
def warning_levels(spark, sf_dir):
    """Warning flag from a level."""
    judged = judged_hydro(raw_hydro(events(spark, sf_dir)), AS_OF, F.lit(50))
    return usable(judged).select("gauge_id", "measurement_timestamp", "water_level_cm",
                                 "is_warning")


@check(f"""
WITH {RAW_WEATHER_SQL}
SELECT * FROM raw_weather
WHERE pressure_hpa IS NOT NULL AND temperature IS NOT NULL AND wind_speed IS NOT NULL""")
def raw_feed_records(spark, sf_dir):
    """Feed documents, arrays of text records, taken apart and normalised."""
    rows = raw_weather(events(spark, sf_dir))
    documents = rows.select(F.to_json(F.array(F.struct(*rows.columns))).alias("value"))
    return usable(judged_weather(feed_records(documents, RAW_WEATHER), AS_OF))


# Parts of a record's text by the remainder of k: a field that is whole, absent, null, of another type.
_LEVELS = ["', \"stan_wody\": \"' || {k} || '\"'", "''", "', \"stan_wody\": null'",
           "', \"stan_wody\": \"b.d.\"'", "', \"stan_wody\": \"' || {k} || '.5\"'",
           "', \"stan_wody\": ' || {k}", "', \"stan_wody\": {{\"cm\": 1}}'", "', \"stan_wody\": [7]'"]
_FLOWS = ["''", "', \"przeplyw\": null'", "', \"przeplyw\": \"1.25\"'", "', \"przeplyw\": \"-\"'",
          "', \"przeplyw\": 2.5'"]
_TIMES = ["', \"stan_wody_data_pomiaru\": \"2024-01-01 10:00:00\"'", "''",
          "', \"stan_wody_data_pomiaru\": null'"]


def _record_sql(k):
    def chosen(parts):
        cases = " ".join(f"WHEN {i} THEN {part.format(k=k)}" for i, part in enumerate(parts))
        return f"CASE CAST(floor({k} / {len(parts)}) AS INT) % {len(parts)} {cases} END"

    def first(parts):
        cases = " ".join(f"WHEN {i} THEN {part.format(k=k)}" for i, part in enumerate(parts))
        return f"CASE {k} % {len(parts)} {cases} END"

    return (f"CASE WHEN {k} % 17 = 0 THEN '[]' WHEN {k} % 13 = 0 THEN '{{\"id_stacji\"' ELSE "
            f"'{{\"id_stacji\": \"' || user_id || '\"' || {first(_LEVELS)} || {chosen(_FLOWS)} "
            f"|| {first(_TIMES)} || '}}' END")


def _reason_sql(field, required, fits):
    missing = "'absent'" if required else "NULL"
    null = "'null'" if required else "NULL"
    return f"""
  SELECT event_id, '{field}' AS field,
         CASE WHEN json_type(value, '$.{field}') IS NULL THEN {missing}
              WHEN json_type(value, '$.{field}') = 'NULL' THEN {null}
              WHEN json_type(value, '$.{field}') IN ('OBJECT', 'ARRAY') OR NOT ({fits}) THEN 'mistyped'
         END AS reason
  FROM whole"""


@check(f"""
WITH sent AS (SELECT event_id, {_record_sql(K)} AS value FROM events),
whole AS (SELECT * FROM sent WHERE json_valid(value) AND json_type(value) = 'OBJECT')
SELECT event_id, NULL::VARCHAR AS field, 'broken' AS reason FROM sent
WHERE event_id NOT IN (SELECT event_id FROM whole)
UNION ALL SELECT * FROM (
  {_reason_sql("id_stacji", True, "TRUE")}
  UNION ALL {_reason_sql("stan_wody_data_pomiaru", True, "TRUE")}
  UNION ALL {_reason_sql("stan_wody", True, "regexp_full_match(value->>'$.stan_wody', '[0-9]+')")}
  UNION ALL {_reason_sql("przeplyw", False, "TRY_CAST(value->>'$.przeplyw' AS DOUBLE) IS NOT NULL")})
WHERE reason IS NOT NULL""")
def reject_field_reasons(spark, sf_dir):
    """Records as text, told apart by what is wrong with each field."""
    rows = with_k(events(spark, sf_dir)).select("event_id", F.expr(_record_sql("k")).alias("value"))
    return reject_reasons(rows, "value")


_NEW_HYDRO = f"""
WITH {RAW_HYDRO_SQL},
good AS (SELECT * EXCLUDE (bad_flow) FROM raw_hydro
         WHERE measurement_timestamp IS NOT NULL AND water_level_cm IS NOT NULL
           AND NOT bad_flow),
fresh AS (SELECT DISTINCT gauge_id, measurement_timestamp FROM good
          WHERE measurement_timestamp >= '2024-01-10T00:00:00Z')"""

# Every record is sent twice, the second time with the level 7, which is never missing.
_TWICE = f"""
WITH {RAW_HYDRO_SQL},
twice AS (
  SELECT gauge_id, measurement_timestamp, water_level_cm, flow_m3s, is_warning, ts, event_id,
         0 AS copy FROM raw_hydro WHERE NOT bad_flow AND water_level_cm IS NOT NULL
  UNION ALL
  SELECT gauge_id, measurement_timestamp, 7, flow_m3s, is_warning, ts, event_id, 1
  FROM raw_hydro WHERE NOT bad_flow),
first AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY gauge_id, measurement_timestamp
                                 ORDER BY ts, event_id, copy) AS rn
    FROM twice WHERE measurement_timestamp IS NOT NULL) WHERE rn = 1)
SELECT gauge_id, measurement_timestamp, water_level_cm, flow_m3s, is_warning FROM first"""
_PAYLOAD = ("gauge_id", "measurement_timestamp", "water_level_cm", "flow_m3s", "is_warning")


def _second_poll(spark, sf_dir):
    """All records, of which those before the 10th were published earlier."""
    raw = raw_hydro(events(spark, sf_dir))
    seen = usable(judged_hydro(
        raw.filter(F.col("stan_wody_data_pomiaru") < "2024-01-10"), AS_OF))
    return ingest(raw, "hydro", seen.select("gauge_id", "measurement_timestamp"), AS_OF)


@check(f"{_TWICE} WHERE measurement_timestamp >= '2024-01-10T00:00:00Z'")
def ingest_new(spark, sf_dir):
    """The first copies that were not published before the 10th."""
    raw = sent_twice(raw_hydro(events(spark, sf_dir).repartition(7), arrival=True))
    seen = usable(judged_hydro(
        raw.filter(F.col("stan_wody_data_pomiaru") < "2024-01-10"), AS_OF))
    new = ingest(raw, "hydro", seen.select("gauge_id", "measurement_timestamp"), AS_OF).new
    return new.select(*_PAYLOAD)


@check("""
SELECT DISTINCT 'H_' || user_id AS gauge_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS measurement_timestamp FROM events""")
def published_keys(spark, sf_dir):
    """Keys through a text file of lines, some of them blank or padded."""
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    gauge = F.concat(F.lit("H_"), F.col("user_id").cast("string"))
    key = logical_key(gauge, time)
    lines = F.explode(F.array(key, F.lit(" "), F.concat(F.lit("  "), key)))
    path = shared_folder(spark, "seen-keys")
    events(spark, sf_dir).select(lines.alias("value")).write.text(path)
    return seen_keys(spark, path, "gauge_id").distinct()


@check(f"""{_NEW_HYDRO}
SELECT 'hydro' AS topic, (SELECT count(*) FROM good) AS fetched,
       (SELECT count(*) FROM fresh) AS sent,
       (SELECT count(*) FROM raw_hydro WHERE measurement_timestamp IS NOT NULL)
         - (SELECT count(*) FROM good) AS rejected""")
def ingest_counts(spark, sf_dir):
    return ingest_report(_second_poll(spark, sf_dir), "hydro")


@check(_TWICE)
def ingest_job(spark, sf_dir):
    """The feed as a stream into a topic folder, run again from a new checkpoint: nothing twice."""
    root = shared_folder(spark, "ingest")
    stream = landed(spark, events(spark, sf_dir))
    for run in ("first", "second"):
        job = start_ingest_job(
            sent_twice(raw_hydro(stream)), "hydro", folder_writer(f"{root}/{run}"),
            folder_writer(f"{root}/{run}-rejects"), f"{root}/seen", f"{root}/{run}-checkpoint",
            once=True)
        job.awaitTermination()
    sent = spark.read.parquet(f"{root}/first").unionByName(spark.read.parquet(f"{root}/second"))
    return decoded(sent, HYDRO_MESSAGE).select(*_PAYLOAD)


@check("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts) AS rn FROM events)
WHERE rn = 1""")
def dedup_first(spark, sf_dir):
    return first_per_key(events(spark, sf_dir), ["event_type", "user_id"], ["ts"])


@check("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts) AS rn FROM events)
WHERE rn = 1""")
def dedup_stream(spark, sf_dir):
    """Streaming deduplication over three batches: the first copy of every key stays."""
    rows = landed(spark, events(spark, sf_dir)).withColumn("at", F.col("ts").cast("timestamp"))
    kept = first_in_stream(rows, ["event_type", "user_id"], "at", timedelta(days=60))
    return _written(spark, kept).drop("at")


@check(_TWICE)
def ingest_dedup_stream(spark, sf_dir):
    """Feed records normalised and deduplicated in stream state, over three batches."""
    stream = landed(spark, events(spark, sf_dir))
    new = ingest_stream(sent_twice(raw_hydro(stream)), "hydro", timedelta(days=60))
    return _written(spark, new).select(*_PAYLOAD)


def _written(spark, stream):
    out = shared_folder(spark, "stream")
    job = (stream.writeStream.format("parquet").trigger(availableNow=True)
           .option("checkpointLocation", shared_folder(spark, "stream-checkpoint")).start(out))
    job.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


_ABSENT = f"""
WITH {HYDRO},
keyed AS (SELECT 'H_' || user_id % 100 AS gauge_id,
                 date_trunc('hour', ts) AS measurement_timestamp,
                 CAST(floor(value) AS INTEGER) AS water_level_cm, ts AS ingestion_timestamp,
                 ts >= TIMESTAMP '2024-01-15' AS late
          FROM events)
SELECT gauge_id, measurement_timestamp, water_level_cm FROM (
  SELECT *, row_number() OVER (PARTITION BY gauge_id, measurement_timestamp
                               ORDER BY late, ingestion_timestamp) AS rn FROM keyed)
WHERE rn = 1"""


def _inserted(spark, sf_dir, buckets):
    """Two loads and a repeat of the second: the first row of every key stays."""
    rows = events(spark, sf_dir).select(
        F.concat(F.lit("H_"), (F.col("user_id") % 100).cast("string")).alias("gauge_id"),
        F.date_trunc("hour", "ts").alias("measurement_timestamp"),
        F.floor("value").cast("int").alias("water_level_cm"),
        F.lit(None).cast("double").alias("flow_m3s"), F.lit(False).alias("is_warning"),
        F.col("ts").cast("timestamp").alias("ingestion_timestamp"))
    root = shared_folder(spark, "history")
    create_tables(spark, root, [HYDRO_MEASUREMENTS], buckets)
    early = F.col("ingestion_timestamp") < "2024-01-15"
    for part in (rows.filter(early), rows.filter(~early), rows.filter(~early)):
        insert_absent(part, root, HYDRO_MEASUREMENTS)
    return root


@check(_ABSENT)
def insert_if_absent(spark, sf_dir):
    root = _inserted(spark, sf_dir, 0)
    return zoneless(read_table(spark, root, HYDRO_MEASUREMENTS).select(
        "gauge_id", "measurement_timestamp", "water_level_cm"))


@check(_ABSENT)
def insert_if_absent_by_key(spark, sf_dir):
    """The same in a table of four buckets a day."""
    root = _inserted(spark, sf_dir, 4)
    return zoneless(read_table(spark, root, HYDRO_MEASUREMENTS).select(
        "gauge_id", "measurement_timestamp", "water_level_cm"))


@check(f"""
SELECT * FROM ({_ABSENT})
WHERE gauge_id = 'H_7' AND measurement_timestamp BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR
                           AND TIMESTAMP '{AS_OF}' ORDER BY measurement_timestamp LIMIT 1000""")
def series_of_gauge_by_key(spark, sf_dir):
    """One gauge's last day out of such a table: a bucket of each day is opened."""
    root = _inserted(spark, sf_dir, 4)
    rows = read_days(spark, root, HYDRO_MEASUREMENTS, AS_OF, key="H_7")
    return zoneless(hydro_series(rows, "H_7", AS_OF, limit=1000).select(
        "gauge_id", "measurement_timestamp", "water_level_cm"))


def _history(spark, sf_dir, topic):
    """One of three topics in one message stream of three batches, stored in its history table."""
    rows = landed(spark, events(spark, sf_dir))
    alerts = alert_messages(rows).select(
        F.lit("alerts").alias("topic"), F.lit(0).alias("partition"), "offset",
        F.lit(None).cast("timestamp").alias("timestamp"), "key", "value")
    sent = (messages(rows, hydro(rows), "hydro", "gauge_id")
            .unionByName(messages(rows, synop(rows), "synop", "station_id"))
            .unionByName(alerts))
    root = shared_folder(spark, "history")
    for run in ("first", "again"):
        job = start_history_job(sent, root, shared_folder(spark, f"history-{run}"), (topic,),
                                once=True)
        job.awaitTermination()
    return root


@check(f"WITH {HYDRO} SELECT * FROM hydro")
def hydro_history(spark, sf_dir):
    """History from a message stream, replayed from the start: every reading once."""
    root = _history(spark, sf_dir, "hydro")
    return zoneless(read_table(spark, root, HYDRO_MEASUREMENTS).drop("day"))


@check(f"WITH {SYNOP} SELECT * FROM synop")
def synop_history(spark, sf_dir):
    root = _history(spark, sf_dir, "synop")
    return zoneless(read_table(spark, root, SYNOP_MEASUREMENTS).drop("day"))


@check(f"""
WITH {RAW_ALERTS}
SELECT alert_id, alert_type, station_id, lat, lon, severity, msg, value,
       CAST(event_timestamp[:19] AS TIMESTAMP) AS event_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY ingestion_timestamp, arrival)
        AS rn FROM raw_alerts)
WHERE rn = 1""")
def alerts_history(spark, sf_dir):
    """The first version of every alert stays in the history."""
    root = _history(spark, sf_dir, "alerts")
    return zoneless(read_table(spark, root, ALERTS_HISTORY).select(
        "alert_id", "alert_type", "station_id", "lat", "lon", "severity", "msg", "value",
        "event_timestamp"))


@check(f"WITH {PREDICTIONS} SELECT * FROM predictions")
def prediction_history(spark, sf_dir):
    """Predictions stored twice: the first stays."""
    made = predictions(events(spark, sf_dir))
    root = shared_folder(spark, "predictions")
    create_tables(spark, root, [HYDRO_PREDICTIONS])
    insert_absent(made, root, HYDRO_PREDICTIONS, ["created_at"])
    insert_absent(made.withColumn("predicted_water_level", F.lit(0.0)), root, HYDRO_PREDICTIONS,
                  ["created_at"])
    return zoneless(read_table(spark, root, HYDRO_PREDICTIONS).drop("day"))


