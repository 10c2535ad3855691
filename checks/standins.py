"""The given tables as telemetry: events are readings, suppliers are stations.

Each stand-in has a Spark form and an SQL form (a common table expression) of the same rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.session import shared_folder

AS_OF = "2024-01-20 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function name, with the SQL it is compared to."""
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The operators expect UTC; the caller may hand in a session of its own making.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = events(spark, sf_dir).schema
    # A pattern, as the source takes a plain path for a folder and the table may be one file.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema.fields])


def zoned(df: DataFrame) -> DataFrame:
    """The same times as the history tables have them."""
    return df.select(*[
        F.col(f.name).cast("timestamp").alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name) for f in df.schema.fields])


def with_k(rows: DataFrame) -> DataFrame:
    """The second metric as a column of its own, parsed once per row."""
    return rows.select("*", F.inline(F.array(F.from_json("props", "k int"))))


def half_up(number: str, digits: int) -> str:
    """SQL that rounds the decimal form of a double half up; rounding the double itself would
    first scale it, which can carry a value just below the half over it."""
    return f"CAST(round(CAST(CAST({number} AS VARCHAR) AS DECIMAL(30, 16)), {digits}) AS DOUBLE)"


K = "CAST(props->>'$.k' AS INTEGER)"


def synop(rows: DataFrame) -> DataFrame:
    k = F.col("k")
    return with_k(rows).select(
        F.concat(F.lit("IMGW_"), F.col("user_id").cast("string")).alias("station_id"),
        F.col("ts").alias("measurement_timestamp"),
        (F.col("value") / 10).alias("temperature"), k.alias("humidity"),
        F.col("value").alias("pressure_hpa"), (k / 4.0).alias("wind_speed"),
        F.col("ts").alias("ingestion_timestamp"))


SYNOP = f"""synop AS (
  SELECT 'IMGW_' || user_id AS station_id, ts AS measurement_timestamp,
         value / 10 AS temperature, {K} AS humidity, value AS pressure_hpa,
         {K} / 4.0::DOUBLE AS wind_speed, ts AS ingestion_timestamp
  FROM events)"""


def hydro(rows: DataFrame) -> DataFrame:
    k = F.col("k")
    return with_k(rows).select(
        F.concat(F.lit("H_"), F.col("user_id").cast("string")).alias("gauge_id"),
        F.col("ts").alias("measurement_timestamp"),
        F.floor("value").cast("int").alias("water_level_cm"),
        F.when(k % 3 != 0, k / 4.0).alias("flow_m3s"),
        (F.col("value") > 40).alias("is_warning"), F.col("ts").alias("ingestion_timestamp"))


def levels(rows: DataFrame) -> DataFrame:
    """Only what level history and forecasts read, so that the scan leaves out the rest."""
    return rows.select(
        F.concat(F.lit("H_"), F.col("user_id").cast("string")).alias("gauge_id"),
        F.col("ts").alias("measurement_timestamp"),
        F.floor("value").cast("int").alias("water_level_cm"))


HYDRO = f"""hydro AS (
  SELECT 'H_' || user_id AS gauge_id, ts AS measurement_timestamp,
         CAST(floor(value) AS INTEGER) AS water_level_cm,
         CASE WHEN {K} % 3 <> 0 THEN {K} / 4.0::DOUBLE END AS flow_m3s,
         value > 40 AS is_warning, ts AS ingestion_timestamp
  FROM events)"""


#: Numbers of files that a batch of a landed stream may have, each a multiple of the next.
FILES = (256, 128, 64, 32, 16, 8, 4, 2, 1)
#: Rows in a file on average, if it has more than 8.
FILE_ROWS = 50_000


def files_for(parts: list[DataFrame], key: str) -> int:
    """Into how many files the rows of each part can be dealt by their key, so that none is empty."""
    slot = F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(FILES[0])).alias("slot")
    slots = functools.reduce(DataFrame.union, [
        part.select(F.lit(i).alias("part"), slot) for i, part in enumerate(parts)])
    counts: list[dict[int, int]] = [{} for _ in parts]
    for row in slots.na.drop().groupBy("part", "slot").count().collect():
        counts[row["part"]][row["slot"]] = row["count"]
    rows = min(sum(filled.values()) for filled in counts)
    for n in FILES:
        if (n <= max(8, rows // FILE_ROWS)
                and all(len({slot % n for slot in filled}) == n for filled in counts)):
            return n
    return 1


def land(part: DataFrame, folder: str, key: str, order: list[str], files: int) -> None:
    """Writes the rows as so many files, in order in each, all rows of a key in one."""
    slot = F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(files))
    (part.withColumn("slot", slot).repartition("slot").sortWithinPartitions("slot", *order)
     .write.mode("append").partitionBy("slot").parquet(folder))


def landed(spark, rows: DataFrame, parts: int = 3, order: tuple[str, ...] = ("ts", "event_id"),
           key: str = "user_id") -> DataFrame:
    """The rows as a stream of several batches in time order, each dealt by key over files."""
    folder = shared_folder(spark, "landed")
    time = F.unix_micros(F.col(order[0]).cast("timestamp"))
    cuts = rows.select(F.percentile_approx(time, [i / parts for i in range(1, parts)])).first()[0]
    pieces = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = rows if low is None else rows.filter(time >= low)
        pieces.append(part if high is None else part.filter(time < high))
    files = files_for(pieces, key)
    for piece in pieces:
        land(piece, folder, key, list(order), files)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(
        folder).select(*rows.columns)


def stations(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    prefix = {"weather": "IMGW_", "hydro": "H_"}[kind]
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit(prefix), F.col("s_suppkey").cast("string")).alias("id"),
        (F.col("s_nationkey") / 4.0 + 49).alias("lat"),
        ((F.col("s_suppkey") % 40) / 4.0 + 14).alias("lon"),
        F.col("s_name").alias("name"), F.lit(kind).alias("type"))


def _stations_sql(kind: str, prefix: str) -> str:
    return f"""{kind}_stations AS (
  SELECT '{prefix}' || s_suppkey AS id, s_nationkey / 4.0::DOUBLE + 49 AS lat,
         (s_suppkey % 40) / 4.0::DOUBLE + 14 AS lon, s_name AS name, '{kind}' AS type
  FROM supplier)"""


WEATHER_STATIONS = _stations_sql("weather", "IMGW_")
HYDRO_STATIONS = _stations_sql("hydro", "H_")


def predictions(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.concat(F.lit("H_"), F.col("user_id").cast("string")).alias("gauge_id"),
        (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("prediction_timestamp"),
        F.col("value").alias("predicted_water_level"),
        (F.col("event_id") % 2 + 2).cast("int").alias("horizon_hours"),
        F.col("ts").alias("created_at"))


PREDICTIONS = """predictions AS (
  SELECT 'H_' || user_id AS gauge_id, ts + INTERVAL 2 HOUR AS prediction_timestamp,
         value AS predicted_water_level, CAST(event_id % 2 + 2 AS INTEGER) AS horizon_hours,
         ts AS created_at
  FROM events)"""

# Readings carry microseconds, so that each has a time of its own.
TEXT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def messages(rows: DataFrame, readings: DataFrame, topic: str, key: str) -> DataFrame:
    """Readings as rows of a message topic, in the column order of a broker's rows."""
    text = readings.select(*[
        F.date_format(f.name, TEXT_TIME).alias(f.name) if "timestamp" in f.name
        else F.col(f.name) for f in readings.schema.fields])
    time = readings.columns[1] if "measurement_timestamp" in readings.columns \
        else "event_timestamp"
    return text.select(
        F.lit(topic).alias("topic"),
        F.pmod(F.crc32(F.col(key).cast("binary")), F.lit(4)).cast("int").alias("partition"),
        # Copies of a reading that differ in their arrival differ in their offset.
        (F.unix_micros(F.to_timestamp(time)) * 2 + F.coalesce(F.unix_seconds(
            F.to_timestamp("ingestion_timestamp")) % 2, F.lit(0))).alias("offset"),
        F.to_timestamp(readings.columns[1] if "measurement_timestamp" in readings.columns
                       else "event_timestamp").alias("timestamp"),
        F.col(key).cast("binary").alias("key"),
        F.to_json(F.struct(*text.columns)).cast("binary").alias("value"))


def raw_alerts(rows: DataFrame) -> DataFrame:
    """Alert versions: several per id, some with gaps or codes outside the contract."""
    k = F.col("k")
    return with_k(rows).select(
        F.concat(F.lit("STORM_"), F.col("event_type"), F.lit("_"),
                 F.date_format("ts", "yyyyMMddHH")).alias("alert_id"),
        F.when(k % 3 == 0, "storm").when(k % 3 == 1, "flood").otherwise("hail")
        .alias("alert_type"),
        F.lit("spark-weather").alias("source"),
        F.concat(F.lit("IMGW_"), F.col("user_id").cast("string")).alias("station_id"),
        F.when(k % 4 != 0, k / 4.0 + 49).alias("lat"),
        F.when(k % 4 != 0, k / 4.0 + 14).alias("lon"),
        F.when(k % 5 == 0, "Yellow").when(k % 5 == 1, "Orange").when(k % 5 == 2, "Red")
        .when(k % 5 == 3, "Purple").alias("severity"),
        F.when(k % 7 != 0, F.concat(F.lit("k="), k.cast("string"))).alias("msg"),
        F.when(k % 6 != 0, k / 4.0).alias("value"),
        F.when(k % 11 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("event_timestamp"),
        F.when(k % 9 != 0, F.date_format(F.col("ts") + F.expr("INTERVAL 12 HOURS"),
                                         "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("expires"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ingestion_timestamp"),
        F.col("event_id").alias("offset"))


RAW_ALERTS = f"""numbered AS (SELECT *, {K} AS k FROM events),
raw_alerts AS (
  SELECT 'STORM_' || event_type || '_' || strftime(ts, '%Y%m%d%H') AS alert_id,
         CASE k % 3 WHEN 0 THEN 'storm' WHEN 1 THEN 'flood' ELSE 'hail' END AS alert_type,
         'spark-weather' AS source, 'IMGW_' || user_id AS station_id,
         CASE WHEN k % 4 <> 0 THEN k / 4.0::DOUBLE + 49 END AS lat,
         CASE WHEN k % 4 <> 0 THEN k / 4.0::DOUBLE + 14 END AS lon,
         CASE k % 5 WHEN 0 THEN 'Yellow' WHEN 1 THEN 'Orange' WHEN 2 THEN 'Red'
                    WHEN 3 THEN 'Purple' END AS severity,
         CASE WHEN k % 7 <> 0 THEN 'k=' || k END AS msg,
         CASE WHEN k % 6 <> 0 THEN k / 4.0::DOUBLE END AS value,
         CASE WHEN k % 11 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS event_timestamp,
         CASE WHEN k % 9 <> 0 THEN strftime(ts + INTERVAL 12 HOUR, '%Y-%m-%dT%H:%M:%SZ')
              END AS expires,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ingestion_timestamp, event_id AS arrival
  FROM numbered),
current_alerts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY arrival DESC) AS rn
    FROM raw_alerts) WHERE rn = 1)"""
