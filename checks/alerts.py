"""Sliding windows, storm and flood alerts, the alert stream, the alert board."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from checks.standins import (
    AS_OF, HYDRO, HYDRO_STATIONS, K, RAW_ALERTS, SYNOP, WEATHER_STATIONS, check, events,
    events_stream, files_for, half_up, hydro, land, landed, messages, raw_alerts, stations, synop,
    with_k, zoneless)
from tidewarden.operators.joins import only_new
from tidewarden.operators.rules import Rule, classified
from tidewarden.operators.windows import fall, rise, sliding_extremes
from tidewarden.plans import alerts as plans
from tidewarden.plans import board, board_store
from tidewarden.schemas import ALERT
from tidewarden.session import shared_folder
from tidewarden.sources.messages import decoded, folder_writer, keyed_json, landed_stream
from tidewarden.streaming import watch
from tidewarden.streaming.jobs import start_alert_job

HOUR = timedelta(hours=1)


def windows_sql(source: str, key: str, ts: str, value: str, hours: int, top: str = "NULL") -> str:
    return f"""
  SELECT {key}, ws AS window_start, ws + INTERVAL {hours} HOUR AS window_end,
         arg_min({value}, {ts}) AS first_value, arg_max({value}, {ts}) AS last_value,
         max({top}) AS top
  FROM (SELECT *, date_trunc('hour', {ts}) - to_hours(CAST(shift AS INTEGER)) AS ws
        FROM {source}, range({hours}) AS r(shift))
  GROUP BY {key}, ws"""


_DELTA = f"""
SELECT event_type, window_start, window_end, first_value, last_value, top AS max_k,
       first_value - last_value AS fall, last_value - first_value AS rise
FROM (%s)"""


def _delta(spark, sf_dir, hours, panes):
    rows = with_k(events(spark, sf_dir))
    return (sliding_extremes(rows, ["event_type"], "ts", "value", hours * HOUR, HOUR, ["k"],
                             panes=panes)
            .withColumn("fall", fall()).withColumn("rise", rise()))


@check(_DELTA % windows_sql("events", "event_type", "ts", "value", 3, K))
def sliding_delta(spark, sf_dir):
    return _delta(spark, sf_dir, 3, panes=False)


@check(_DELTA % windows_sql("events", "event_type", "ts", "value", 6, K))
def sliding_delta_panes(spark, sf_dir):
    return _delta(spark, sf_dir, 6, panes=True)


@check(f"""
SELECT event_type, window_start, first_value - last_value AS fall, top AS max_k,
       CASE WHEN first_value - last_value >= 90 OR top >= 99 THEN 'Red'
            WHEN first_value - last_value >= 60 OR top >= 97 THEN 'Orange'
            WHEN first_value - last_value >= 30 OR top >= 95 THEN 'Yellow' END AS severity
FROM ({windows_sql("events", "event_type", "ts", "value", 3, K)})
WHERE first_value - last_value >= 30 OR top >= 95""")
def severity_classes(spark, sf_dir):
    """Own thresholds over two metrics."""
    rules = [Rule("fall", {"Yellow": 30, "Orange": 60, "Red": 90}),
             Rule("max_k", {"Yellow": 95, "Orange": 97, "Red": 99})]
    return classified(_delta(spark, sf_dir, 3, panes=False), rules).select(
        "event_type", "window_start", "fall", "max_k", "severity")


def _storm_sql(closed: str = "TRUE", synop: str = SYNOP) -> str:
    return f"""
WITH {synop}, {WEATHER_STATIONS},
windows AS ({windows_sql("synop", "station_id", "measurement_timestamp", "pressure_hpa", 3,
                         "wind_speed")}),
scored AS (
  SELECT *, first_value - last_value AS fallen, top AS wind,
         CASE WHEN first_value - last_value >= 9 OR top >= 25 THEN 'Red'
              WHEN first_value - last_value >= 6 OR top >= 20 THEN 'Orange'
              WHEN first_value - last_value >= 3 OR top >= 15 THEN 'Yellow' END AS severity
  FROM windows WHERE {closed})
SELECT 'STORM_' || station_id || '_' || strftime(window_start, '%Y%m%d%H') AS alert_id,
       'storm' AS alert_type, 'spark-weather' AS source, station_id, lat, lon, severity,
       CASE WHEN fallen >= 3
            THEN 'Spadek ciśnienia ' || CAST({half_up('fallen', 1)} AS VARCHAR)
                 || ' hPa/3h — ryzyko wichury'
            ELSE 'Silny wiatr ' || CAST({half_up('wind', 1)} AS VARCHAR)
                 || ' m/s — ryzyko wichury' END AS msg,
       CASE WHEN fallen >= 3 THEN {half_up('fallen', 1)}
            ELSE {half_up('wind', 1)} END AS value,
       '2024-01-20T00:00:00Z' AS event_timestamp, '2024-01-20T12:00:00Z' AS expires,
       '2024-01-20T00:00:00Z' AS ingestion_timestamp
FROM scored LEFT JOIN weather_stations ON station_id = id
WHERE severity IS NOT NULL"""


def _flood_sql(closed: str = "TRUE") -> str:
    return f"""
WITH {HYDRO}, {HYDRO_STATIONS},
windows AS ({windows_sql("hydro", "gauge_id", "measurement_timestamp", "water_level_cm", 6)}),
scored AS (
  SELECT *, last_value - first_value AS risen,
         CASE WHEN last_value - first_value >= 100 THEN 'Red'
              WHEN last_value - first_value >= 60 THEN 'Orange'
              WHEN last_value - first_value >= 30 THEN 'Yellow' END AS severity
  FROM windows WHERE {closed})
SELECT 'FLOOD_' || gauge_id || '_' || strftime(window_start, '%Y%m%d%H') AS alert_id,
       'flood' AS alert_type, 'spark-hydro' AS source, gauge_id AS station_id, lat, lon,
       severity,
       'Wzrost poziomu wody ' || risen || ' cm/6h — ryzyko podtopienia (poziom '
         || last_value || ' cm)' AS msg,
       CAST(risen AS DOUBLE) AS value,
       '2024-01-20T00:00:00Z' AS event_timestamp, '2024-01-21T00:00:00Z' AS expires,
       '2024-01-20T00:00:00Z' AS ingestion_timestamp
FROM scored LEFT JOIN hydro_stations ON gauge_id = id
WHERE severity IS NOT NULL"""


def _closed(hours: int) -> str:
    """Windows a stream has emitted: their end is not after the watermark."""
    return f"window_end <= (SELECT max(ts) - INTERVAL {hours} HOUR FROM events)"


def _storm(spark, sf_dir, panes=False):
    return plans.storm_alerts(
        synop(events(spark, sf_dir)), stations(spark, sf_dir, "weather"), as_of=AS_OF,
        ts="measurement_timestamp", panes=panes)


@check(_storm_sql())
def storm_alerts(spark, sf_dir):
    return _storm(spark, sf_dir)


@check(_flood_sql())
def flood_alerts(spark, sf_dir):
    return plans.flood_alerts(
        hydro(events(spark, sf_dir)), stations(spark, sf_dir, "hydro"), as_of=AS_OF,
        ts="measurement_timestamp")


@check(f"SELECT alert_id AS key, * FROM ({_storm_sql()})")
def alert_json(spark, sf_dir):
    """Keyed JSON messages, read back."""
    sent = keyed_json(_storm(spark, sf_dir), "alert_id")
    return decoded(sent, ALERT, keep=["key"])


@check(_storm_sql(_closed(1)))
def storm_stream(spark, sf_dir):
    """Messages to published alerts as a stream: windows closed by the watermark."""
    rows = events_stream(spark, sf_dir)
    readings = plans.synop_readings(messages(rows, synop(rows), "synop", "station_id"))
    found = plans.storm_alerts(readings, stations(spark, sf_dir, "weather"), as_of=AS_OF)
    return _published(spark, found)


@check(_storm_sql(_closed(1)))
def storm_stream_panes(spark, sf_dir):
    """The same windows from one row of state per station and hour, over three batches."""
    rows = landed(spark, events(spark, sf_dir))
    readings = plans.synop_readings(messages(rows, synop(rows), "synop", "station_id"))
    found = plans.storm_alerts(readings, stations(spark, sf_dir, "weather"), as_of=AS_OF,
                               panes=True)
    return _published(spark, found)


@check(_flood_sql(_closed(2)))
def flood_stream_panes(spark, sf_dir):
    rows = landed(spark, events(spark, sf_dir))
    readings = plans.hydro_readings(messages(rows, hydro(rows), "hydro", "gauge_id"))
    found = plans.flood_alerts(readings, stations(spark, sf_dir, "hydro"), as_of=AS_OF, panes=True)
    return _published(spark, found)


# Every reading arrives again a second later with other values; only the first copy counts.
REPEATED = SYNOP.replace("synop AS (", "once AS (", 1) + """,
copies AS (
  SELECT * FROM once UNION ALL
  SELECT station_id, measurement_timestamp, temperature, humidity, pressure_hpa + 40,
         wind_speed + 30, ingestion_timestamp + INTERVAL 1 SECOND FROM once),
synop AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, measurement_timestamp
                                 ORDER BY ingestion_timestamp) AS rn FROM copies) WHERE rn = 1)"""


def repeated(readings):
    """The same rows: each reading, then its copy."""
    copy = F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")
    rows = readings.select("*", copy)
    return rows.select(
        "station_id", "measurement_timestamp", "temperature", "humidity",
        (F.col("pressure_hpa") + 40 * F.col("copy")).alias("pressure_hpa"),
        (F.col("wind_speed") + 30 * F.col("copy")).alias("wind_speed"),
        (F.col("ingestion_timestamp") + F.make_dt_interval(secs=F.col("copy")))
        .alias("ingestion_timestamp"))


@check(_storm_sql(synop=REPEATED))
def storm_alerts_repeats(spark, sf_dir):
    """Repeated readings with other values don't move the windows."""
    rows = repeated(synop(events(spark, sf_dir))).repartition(5)
    return plans.storm_alerts(rows, stations(spark, sf_dir, "weather"), as_of=AS_OF,
                              ts="measurement_timestamp")


@check(_storm_sql(_closed(1), REPEATED))
def storm_stream_repeats(spark, sf_dir):
    """The same as a stream of three batches, state carried over."""
    rows = landed(spark, events(spark, sf_dir))
    sent = messages(rows, repeated(synop(rows)), "synop", "station_id")
    found = plans.storm_alerts(plans.synop_readings(sent), stations(spark, sf_dir, "weather"),
                               as_of=AS_OF)
    return _published(spark, found)


def _late(spark, sf_dir):
    """Two batches, a stop, and a restart with a third one and readings of the first day that come
    too late; the folders of the alerts and of the checkpoint."""
    folder = shared_folder(spark, "landed")
    readings = synop(events(spark, sf_dir))
    time = F.col("measurement_timestamp")
    sent = messages(readings, readings, "synop", "station_id")
    late = readings.filter(time < "2024-01-02").withColumn("pressure_hpa", F.lit(1.0)).withColumn(
        "measurement_timestamp", time + F.make_dt_interval(mins=F.lit(1)))
    out, checkpoint = shared_folder(spark, "alerts"), shared_folder(spark, "alerts-checkpoint")
    stamp = F.col("timestamp")
    runs = ([sent.filter(stamp < "2024-01-08"),
             sent.filter((stamp >= "2024-01-08") & (stamp < "2024-01-16"))],
            [sent.filter(stamp >= "2024-01-16"), messages(late, late, "synop", "station_id")])
    files = files_for([part for parts in runs for part in parts], "key")
    for parts in runs:
        for part in parts:
            land(part, folder, "key", ["timestamp", "offset"], files)
        stream = landed_stream(spark, folder, maxFilesPerTrigger=str(files))
        found = plans.storm_alerts(plans.synop_readings(stream),
                                   stations(spark, sf_dir, "weather"), as_of=AS_OF)
        start_alert_job(found, folder_writer(out), checkpoint, once=True).awaitTermination()
    return out, checkpoint


@check(_storm_sql(_closed(1)))
def storm_stream_late(spark, sf_dir):
    """Late readings change nothing, and no window comes twice."""
    return decoded(spark.read.parquet(_late(spark, sf_dir)[0]), ALERT)


@check(f"""
WITH {SYNOP}
SELECT station_id, window_start, window_end, first_value, last_value, top AS max_wind_speed
FROM ({windows_sql("synop", "station_id", "measurement_timestamp", "pressure_hpa", 3, "wind_speed")})
WHERE NOT {_closed(1)}""")
def open_windows(spark, sf_dir):
    """The windows that the stream holds after its last batch, out of its state."""
    held = watch.open_windows(spark, _late(spark, sf_dir)[1], "station_id", ("wind_speed",))
    return zoneless(held.drop("first_time", "last_time"))


@check("""
SELECT 'dedupe' AS operator, count(*) AS dropped FROM events WHERE ts < TIMESTAMP '2024-01-02'
UNION ALL SELECT 'stateStoreSave', 0""")
def late_rows(spark, sf_dir):
    """The late readings, all dropped before the windows, by what a listener stored."""
    stored = shared_folder(spark, "state-rows")
    listener = watch.StateWatch(spark, stored)
    spark.streams.addListener(listener)
    try:
        _late(spark, sf_dir)
        listener.wait(2, 60)
    finally:
        spark.streams.removeListener(listener)
    return watch.late_rows(spark, stored).groupBy("operator").agg(F.sum("dropped").alias("dropped"))


@check(_flood_sql(_closed(2)))
def flood_stream(spark, sf_dir):
    rows = events_stream(spark, sf_dir)
    readings = plans.hydro_readings(messages(rows, hydro(rows), "hydro", "gauge_id"))
    found = plans.flood_alerts(readings, stations(spark, sf_dir, "hydro"), as_of=AS_OF)
    return _published(spark, found)


def _published(spark, found):
    out = shared_folder(spark, "alerts")
    job = start_alert_job(found, folder_writer(out), shared_folder(spark, "alerts-checkpoint"),
                          once=True)
    job.awaitTermination()
    return decoded(spark.read.parquet(out), ALERT)


def alert_messages(rows):
    """The alert topic: versions of alerts as JSON, with their offset."""
    versions = raw_alerts(rows)
    body = [c for c in versions.columns if c != "offset"]
    return versions.select("offset", F.col("alert_id").cast("binary").alias("key"),
                           F.to_json(F.struct(*body)).cast("binary").alias("value"))


def _current(spark, sf_dir):
    return board.current_alerts(alert_messages(events(spark, sf_dir)))


@check(f"WITH {RAW_ALERTS} SELECT * EXCLUDE (arrival) FROM current_alerts")
def current_alerts(spark, sf_dir):
    return _current(spark, sf_dir)


_BOARD = f"""
WITH {RAW_ALERTS}
SELECT alert_id,
       CASE severity WHEN 'Yellow' THEN 'Żółty' WHEN 'Orange' THEN 'Pomarańczowy'
            WHEN 'Red' THEN 'Czerwony' ELSE coalesce(severity, '?') END AS severity_label,
       CASE severity WHEN 'Yellow' THEN '#D97706' WHEN 'Orange' THEN '#EA580C'
            WHEN 'Red' THEN '#DC2626' ELSE '#888' END AS color,
       CASE alert_type WHEN 'storm' THEN 'Burza' WHEN 'flood' THEN 'Powódź'
            ELSE upper(alert_type) END AS type_label,
       coalesce(event_timestamp, '?') AS shown_timestamp, coalesce(msg, 'brak opisu') AS msg,
       station_id, value,
       CASE WHEN value IS NULL THEN '' ELSE ' | wartość: ' || CAST(value AS VARCHAR) END
         AS value_text,
       CASE WHEN expires IS NULL THEN '' ELSE ' | wygasa: ' || expires END AS expires_text
FROM current_alerts"""


@check(_BOARD)
def alert_board(spark, sf_dir):
    return board.alert_board(_current(spark, sf_dir))


def _increments(spark, sf_dir):
    """The topic in four increments, each of which also brings broken and nameless messages that come
    after the good ones of their ids."""
    sent = alert_messages(events(spark, sf_dir)).withColumn(
        "partition", F.pmod(F.crc32("key"), F.lit(4)).cast("int"))
    text = F.col("value").cast("string")
    bodies = F.array(
        F.col("value"), F.substr(text, F.lit(1), F.length(text) - 3).cast("binary"),
        F.replace(text, F.lit("alert_id"), F.lit("other_id")).cast("binary"),
        F.lit(None).cast("binary"))
    mixed = sent.select("partition", "offset", "key", F.posexplode(F.when(
        F.col("offset") % 3 == 0, bodies).otherwise(F.array("value"))).alias("later", "body")).select(
            F.lit("alerts").alias("topic"), "partition",
            (F.col("offset") * 4 + F.col("later")).alias("offset"),
            F.lit(None).cast("timestamp").alias("timestamp"), "key", F.col("body").alias("value"),
            F.col("offset").alias("at"))
    last = mixed.agg(F.max("at")).first()[0]
    cuts = [last * i // 4 for i in (1, 2, 3)]
    folder, board_path = shared_folder(spark, "alert-topic"), shared_folder(spark, "board")
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = mixed if low is None else mixed.filter(F.col("at") >= low)
        part = part if high is None else part.filter(F.col("at") < high)
        part.drop("at").repartition("partition").write.mode("append").parquet(folder)
        found = board_store.refresh_board(spark, board_path, board_store.landed_reader(spark, folder))
    return found


@check(_BOARD)
def alert_board_increments(spark, sf_dir):
    """The board from a store that took in the topic in four refreshes."""
    return board.alert_board(_increments(spark, sf_dir).alerts)


@check(f"""
WITH {RAW_ALERTS}
SELECT * EXCLUDE (arrival) FROM current_alerts
WHERE alert_id NOT IN (SELECT alert_id FROM raw_alerts WHERE arrival < (
  SELECT max(event_id) * 3 // 4 FROM events))""")
def new_alerts_increments(spark, sf_dir):
    """The alerts that came first with the last refresh."""
    return _increments(spark, sf_dir).new


@check(f"WITH {RAW_ALERTS} SELECT count(*) AS alerts FROM current_alerts")
def alert_total(spark, sf_dir):
    return board.alert_total(_current(spark, sf_dir))


@check(f"""
WITH {RAW_ALERTS}
SELECT * EXCLUDE (arrival) FROM current_alerts
WHERE alert_id NOT IN (SELECT alert_id FROM raw_alerts WHERE ingestion_timestamp
                       < '2024-01-20T00:00:00Z')""")
def new_alerts(spark, sf_dir):
    """Alerts that were not on the board at midnight."""
    sent = alert_messages(events(spark, sf_dir))
    before = board.current_alerts(sent.filter(
        F.get_json_object(F.col("value").cast("string"), "$.ingestion_timestamp")
        < "2024-01-20T00:00:00Z"))
    return board.new_alerts(board.current_alerts(sent), before)


@check(f"""
WITH {RAW_ALERTS}
SELECT * EXCLUDE (arrival) FROM current_alerts
WHERE alert_type NOT IN ('storm', 'flood') OR severity IS NULL
   OR severity NOT IN ('Yellow', 'Orange', 'Red')""")
def contract_violations(spark, sf_dir):
    return plans.contract_violations(_current(spark, sf_dir))


@check(f"""
WITH {SYNOP}, {WEATHER_STATIONS}
SELECT * FROM synop WHERE station_id NOT IN (SELECT id FROM weather_stations)""")
def unlisted_readings(spark, sf_dir):
    """Readings of stations that the dictionary does not list."""
    listed = stations(spark, sf_dir, "weather").select(F.col("id").alias("station_id"))
    return only_new(synop(events(spark, sf_dir)), listed, ["station_id"])
