"""Command line of the live jobs: ``python -m tidewarden.streaming.run JOB``, where JOB is
``ingest-synop``, ``ingest-hydro``, ``storm``, ``flood``, ``history`` or ``score``.

Brokers, topics, files and folders come from the environment.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewarden.plans.alerts import flood_alerts, hydro_readings, storm_alerts, synop_readings
from tidewarden.schemas import RAW_HYDRO, RAW_WEATHER
from tidewarden.session import build_session
from tidewarden.sources.feeds import raw_feed_stream
from tidewarden.sources.messages import folder_writer, kafka_writer, message_stream
from tidewarden.sources.stations import read_stations
from tidewarden.streaming.jobs import (
    start_alert_job, start_history_job, start_ingest_job, start_scoring_job)

# Environment names and their defaults.
BROKERS = ("KAFKA_BOOTSTRAP", "broker:9092")
STATIONS = ("STATIONS_CSV", "stations.csv")
ALERTS_TOPIC = ("ALERTS_TOPIC", "alerts")
FEED_TOPIC = {"ingest-synop": ("SYNOP_TOPIC", "synop"), "ingest-hydro": ("HYDRO_TOPIC", "hydro")}
SOURCE_TOPIC = {"storm": ("SOURCE_TOPIC", "synop"), "flood": ("SOURCE_TOPIC", "hydro")}
CHECKPOINT = {"ingest-synop": "CHECKPOINT_SYNOP", "ingest-hydro": "CHECKPOINT_HYDRO_FEED",
              "storm": "CHECKPOINT_WEATHER", "flood": "CHECKPOINT_HYDRO",
              "history": "CHECKPOINT_HISTORY", "score": "CHECKPOINT_SCORE"}
#: What a job cannot do without.
NEEDED = {"ingest-synop": ("feed", "rejects", "tables"),
          "ingest-hydro": ("feed", "rejects", "tables"),
          "history": ("tables",), "score": ("tables", "models")}


def _env(setting: tuple[str, str]) -> str:
    return os.getenv(*setting)


def _checkpoint(spark: SparkSession, job: str) -> str:
    named = os.getenv(CHECKPOINT[job])
    if named:
        return named
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise SystemExit(f"set {CHECKPOINT[job]} or spark.checkpoint.dir to a shared folder")
    return f"{root.rstrip('/')}/{job}"


def _alerts(spark: SparkSession, job: str) -> DataFrame:
    messages = message_stream(spark, _env(BROKERS), [_env(SOURCE_TOPIC[job])], "latest")
    stations = read_stations(spark, _env(STATIONS))
    if job == "storm":
        return storm_alerts(synop_readings(messages), stations)
    return flood_alerts(hydro_readings(messages), stations)


def _ingest(spark: SparkSession, job: str, args: argparse.Namespace,
            checkpoint: str) -> StreamingQuery:
    kind = job.removeprefix("ingest-")
    raw = raw_feed_stream(spark, args.feed, {"synop": RAW_WEATHER, "hydro": RAW_HYDRO}[kind])
    return start_ingest_job(
        raw, kind, kafka_writer(_env(BROKERS), _env(FEED_TOPIC[job])),
        folder_writer(args.rejects), args.tables, checkpoint, warning_level=args.warning_level)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=list(CHECKPOINT))
    parser.add_argument("--feed", help="folder where polls of the raw feed land")
    parser.add_argument("--rejects", help="folder of the records that could not be used")
    parser.add_argument("--tables", help="root folder of the history tables")
    parser.add_argument("--models", help="folder of the level models")
    parser.add_argument("--preview", action="store_true", help="also show alerts on the console")
    parser.add_argument("--warning-level", type=float, help="water level in cm to warn of")
    parser.add_argument("--offsets", default="1000000",
                        help="most messages that one batch of the history job takes")
    args = parser.parse_args()
    for name in NEEDED.get(args.job, ()):
        if not getattr(args, name):
            parser.error(f"{args.job} needs --{name}")
    if args.warning_level is not None and args.job != "ingest-hydro":
        parser.error("--warning-level is for ingest-hydro")
    spark = build_session(f"tidewarden-{args.job}", os.getenv("SPARK_MASTER"))
    checkpoint = _checkpoint(spark, args.job)
    if args.job in FEED_TOPIC:
        query = _ingest(spark, args.job, args, checkpoint)
    elif args.job in SOURCE_TOPIC:
        write = kafka_writer(_env(BROKERS), _env(ALERTS_TOPIC))
        query = start_alert_job(_alerts(spark, args.job), write, checkpoint, args.preview)
    elif args.job == "history":
        messages = message_stream(spark, _env(BROKERS), ["hydro", "synop", "alerts"], "earliest",
                                  maxOffsetsPerTrigger=args.offsets)
        rejects = folder_writer(args.rejects) if args.rejects else None
        query = start_history_job(messages, args.tables, checkpoint, write_rejects=rejects)
    else:
        ticks = message_stream(spark, _env(BROKERS), ["hydro"], "latest")
        query = start_scoring_job(ticks, args.tables, args.models, checkpoint)
    query.awaitTermination()


if __name__ == "__main__":
    main()
