"""What a running window job holds and drops: open windows from its state, late rows from its progress."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

STATE_ROWS = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("run", T.StringType()),
    T.StructField("batch", T.LongType()), T.StructField("at", T.StringType()),
    T.StructField("watermark", T.StringType()), T.StructField("operator", T.StringType()),
    T.StructField("place", T.IntegerType()), T.StructField("rows", T.LongType()),
    T.StructField("updated", T.LongType()), T.StructField("dropped", T.LongType())])


def open_windows(spark: SparkSession, checkpoint: str, key: str,
                 maxima: tuple[str, ...] = ()) -> DataFrame:
    """The windows that a job of ``sliding_extremes`` still holds, with what it knows of them: the
    columns that it will emit, and the times of the first and last values so far.

    Read from the state of the job's last complete batch; the job may be running. Of a job with
    panes these are the windows of its closed panes.
    """
    aggregates = spark.read.format("state-metadata").load(checkpoint).filter(
        "operatorName = 'stateStoreSave'")
    # The last aggregate of the plan, which makes the windows, has the lowest number.
    number = aggregates.agg(F.min("operatorId")).scalar()
    found = spark.range(1).select(number.alias("id")).first().id
    state = spark.read.format("statestore").option("operatorId", found).load(checkpoint)
    # The aggregates' buffers in their order, whose own names repeat.
    names = ["first_value", "first_time", "last_value", "last_time", *[f"max_{c}" for c in maxima]]
    kinds = [f.dataType for f in state.schema["value"].dataType.fields]
    buffers = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return state.select(
        F.col("key")[key].alias(key), F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"), F.col("value").cast(buffers).alias("value")
    ).select(key, "window_start", "window_end", "value.*")


class StateWatch(StreamingQueryListener):
    """Stores for every batch and stateful operator the rows held, updated and dropped as late, as
    rows of ``STATE_ROWS`` in a folder.

    ``spark.streams.addListener(StateWatch(spark, path))`` watches all queries of the session. An
    operator's place counts from the end of the plan.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path
        self._ended, self._count = threading.Condition(), 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        rows = [(progress.get("name") or progress["id"], progress["runId"], progress["batchId"],
                 progress["timestamp"], progress.get("eventTime", {}).get("watermark"),
                 operator["operatorName"], place, operator["numRowsTotal"],
                 operator["numRowsUpdated"], operator["numRowsDroppedByWatermark"])
                for place, operator in enumerate(progress["stateOperators"])]
        if rows:
            self._spark.createDataFrame(rows, STATE_ROWS).coalesce(1).write.mode("append").parquet(
                self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._ended:
            self._count += 1
            self._ended.notify_all()

    def wait(self, queries: int, seconds: float) -> bool:
        """Whether within the time the progress of so many ended queries is all stored: events come in
        order, but later than the queries end."""
        with self._ended:
            return self._ended.wait_for(lambda: self._count >= queries, seconds)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came too late, per query and operator, from what a watch stored."""
    return spark.read.schema(STATE_ROWS).parquet(path).groupBy("query", "operator", "place").agg(
        F.sum("dropped").alias("dropped"), F.max("rows").alias("most_rows"))
