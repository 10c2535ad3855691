"""Structured Streaming jobs: alerts, history, ingest and periodic scoring."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewarden.functions.times import Instant, event_time
from tidewarden.operators.normalize import usable
from tidewarden.plans.forecast import (
    HORIZONS, create_model_store, forecast_levels, load_models, save_models)
from tidewarden.plans.ingest import JUDGES, LOGICAL_KEYS, ingest
from tidewarden.plans.rollups import update_rollup
from tidewarden.plans.training import (
    complete_days, models_from_days, read_days_of_levels, update_days)
from tidewarden.schemas import (
    HYDRO_MEASUREMENTS, HYDRO_PREDICTIONS, SYNOP_MEASUREMENTS, TOPICS, TableSpec)
from tidewarden.sources.messages import BatchWriter, decoded, keyed_json, row_json
from tidewarden.sources.latest import has_latest, read_latest, update_latest
from tidewarden.sources.tables import (
    create_tables, insert_absent, keyless, read_table, stored_rows, touched_days)

SCORING_INTERVAL = timedelta(seconds=300)
RETRAIN_EVERY = 6


@contextmanager
def _caching() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Caches what it is given and releases all of it at the end, also after an error."""
    with ExitStack() as held:
        def cached(rows: DataFrame) -> DataFrame:
            held.callback(rows.unpersist)
            return rows.persist()

        yield cached


def _started(stream: DataFrame, step, checkpoint: str, every: timedelta | None,
             once: bool) -> StreamingQuery:
    writer = (stream.writeStream.foreachBatch(step).outputMode("append")
              .option("checkpointLocation", checkpoint))
    if once:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=f"{int(every.total_seconds())} seconds")
    return writer.start()


def start_alert_job(alerts: DataFrame, write: BatchWriter, checkpoint: str,
                    preview: bool = False, every: timedelta | None = None,
                    once: bool = False) -> StreamingQuery:
    """Publishes an alert stream as keyed JSON, with an optional preview on the console.

    One query feeds both sinks, so the window state exists once.
    """
    def publish(batch: DataFrame, batch_id: int) -> None:
        # Cached with the added column: the bare batch still claims an order by a column that it
        # no longer has, which caching does not accept.
        rows = batch.withColumn("value_json", row_json(batch))
        with _caching() as cached:
            if preview:
                cached(rows)
            write(rows.select(F.col("alert_id").alias("key"), F.col("value_json").alias("value")),
                  batch_id)
            if preview:
                rows.select("alert_id", "severity", "value", "msg").show(truncate=False)

    return _started(alerts, publish, checkpoint, every, once)


def history_rows(messages: DataFrame, topic: str) -> tuple[DataFrame, TableSpec]:
    """A topic's messages as rows of its history table, with their arrival order."""
    schema, spec = TOPICS[topic]
    rows = decoded(messages.filter(F.col("topic") == topic), schema, keep=["partition", "offset"])
    times = {f.name: event_time(F.col(f.name)) for f in spec.schema.fields
             if f.dataType != schema[f.name].dataType}
    return rows.withColumns(times), spec


def start_history_job(messages: DataFrame, root: str, checkpoint: str,
                      topics: tuple[str, ...] = tuple(TOPICS),
                      every: timedelta | None = None, once: bool = False,
                      write_rejects: BatchWriter | None = None) -> StreamingQuery:
    """Stores every topic in its history table, insert-if-absent, and keeps the latest rows of each
    station and gauge, the levels' daily training statistics and the weather's minute rollups beside
    it. Rows without a whole key go to ``write_rejects``, as JSON under their topic's name.

    The append and the checkpoint are two commits; a batch that is repeated after a crash finds
    its rows stored and adds nothing. Keep to one writer per table. Messages of other topics are
    dropped as they come.
    """
    create_tables(messages.sparkSession, root)
    wanted = messages.filter(F.col("topic").isin(*topics))

    def store(batch: DataFrame, batch_id: int) -> None:
        arrival = ("ingestion_timestamp", "partition", "offset")
        with _caching() as cached:
            if len(topics) > 1:  # the rows of a single one are all that is read of the batch
                cached(batch)
            lost: list[DataFrame] = []
            for topic in topics:
                rows, spec = history_rows(batch, topic)
                cached(rows)  # the insert reads them twice: once for their days
                insert_absent(rows, root, spec, arrival)
                if len(spec.key) == 2:
                    update_latest(rows, root, spec, arrival)
                days = touched_days(rows, spec)
                if spec is HYDRO_MEASUREMENTS:
                    update_days(rows.sparkSession, root, days)
                if spec is SYNOP_MEASUREMENTS:
                    update_rollup(rows.sparkSession, root, spec, days)
                lost.append(keyed_json(
                    keyless(rows, spec).withColumn("topic", F.lit(topic)), "topic"))
            if write_rejects is not None:
                write_rejects(functools.reduce(DataFrame.unionByName, lost), batch_id)

    return _started(wanted, store, checkpoint, every, once)


def start_ingest_job(raw: DataFrame, topic: str, write: BatchWriter, write_rejects: BatchWriter,
                     seen_root: str, checkpoint: str, every: timedelta | None = None,
                     once: bool = False, warning_level: float | None = None) -> StreamingQuery:
    """Normalises a raw feed stream, publishes readings not published before, keeps rejects.

    The logical keys published so far are kept as a table, so they outlast a restart, each with
    the batch that published it. A batch is published before its keys are stored, and keys stored
    by an earlier run of the same batch do not count as seen: a repeated batch writes the same
    readings again rather than losing them. Give every new checkpoint a folder name of its own.
    """
    spec = _seen_spec(topic)
    create_tables(raw.sparkSession, seen_root, [spec])

    def publish(batch: DataFrame, batch_id: int) -> None:
        with _caching() as cached:
            cached(batch)
            origin = f"{checkpoint}#{batch_id}"
            seen = (stored_rows(usable(JUDGES[topic](batch)), seen_root, spec)
                    .filter(F.col("origin") != origin))
            result = ingest(batch, topic, seen, warning_level=warning_level)
            new = cached(result.new)
            write(keyed_json(new, spec.key[0]), batch_id)
            write_rejects(result.rejected, batch_id)
            insert_absent(new.select(*spec.key, F.lit(origin).alias("origin")), seen_root, spec,
                          spec.key)

    return _started(raw, publish, checkpoint, every, once)


def _seen_spec(topic: str) -> TableSpec:
    """The table of a topic's published keys."""
    keys = LOGICAL_KEYS[topic]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*keys, "origin")])
    return TableSpec(f"seen_{topic}", schema, keys,
                     lambda: event_time(F.col("measurement_timestamp")).cast("date"))


def score(spark, root: str, models_path: str, cycle: int, retrain_every: int = RETRAIN_EVERY,
          as_of: Instant = None) -> int:
    """One scoring cycle: retrain from the daily statistics when due or when there is no model,
    forecast from the latest rows, store the forecasts insert-if-absent. Returns the number of
    gauges with new ones. The history job keeps both beside the history, of which no folder is
    opened but days of before they were kept, once."""
    models = load_models(spark, models_path)
    if cycle % retrain_every == 0 or models.isEmpty():
        complete_days(spark, root)
        save_models(models_from_days(read_days_of_levels(spark, root)), models_path, as_of)
        models = load_models(spark, models_path)
    if not has_latest(spark, root, HYDRO_MEASUREMENTS):
        update_latest(read_table(spark, root, HYDRO_MEASUREMENTS), root, HYDRO_MEASUREMENTS)
    recent = read_latest(spark, root, HYDRO_MEASUREMENTS)
    forecasts = forecast_levels(recent, models, as_of=as_of).persist()
    added = insert_absent(forecasts, root, HYDRO_PREDICTIONS, ["created_at"])
    forecasts.unpersist()
    return added // len(HORIZONS)


def start_scoring_job(ticks: DataFrame, root: str, models_path: str, checkpoint: str,
                      every: timedelta = SCORING_INTERVAL, retrain_every: int = RETRAIN_EVERY,
                      once: bool = False, as_of: Instant = None) -> StreamingQuery:
    """Scores on every micro-batch of ``ticks``, for instance the hydro messages: without new
    readings there is no new forecast to make."""
    create_tables(ticks.sparkSession, root, [HYDRO_MEASUREMENTS, HYDRO_PREDICTIONS])
    create_model_store(ticks.sparkSession, models_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        score(batch.sparkSession, root, models_path, batch_id, retrain_every, as_of)

    return _started(ticks, run, checkpoint, every, once)
