"""A stored alert board that takes in only what came since the last refresh.

The store holds the newest message of every alert id and, for each partition of the topic, the offset
up to which messages are taken in. A refresh reads the messages from there on, folds them in and
writes the next version beside the last, whose positions are written last: a refresh that fails
leaves no version, and the next one starts from where the last complete one ended.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.operators.joins import only_new
from tidewarden.plans.board import named_messages, parsed_alerts
from tidewarden.schemas import MESSAGE
from tidewarden.sources.folders import children, remove
from tidewarden.sources.messages import kafka_options

#: Partition to the first offset that isn't taken in yet.
Positions = dict[int, int]
#: Reads the messages from some positions on; partitions without one from their start.
Reader = Callable[[Positions], DataFrame]

_NAMED = T.StructType([
    T.StructField("alert_id", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("value", T.BinaryType())])
_POSITIONS = T.StructType([
    T.StructField("partition", T.IntegerType()), T.StructField("next", T.LongType())])


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions, oldest first."""
    return [name for name in children(spark, path)
            if "_SUCCESS" in children(spark, f"{path}/{name}/positions")]


def _rows(spark: SparkSession, path: str, version: str | None) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], _NAMED)
    return spark.read.schema(_NAMED).parquet(f"{path}/{version}/rows")


def positions(spark: SparkSession, path: str) -> Positions:
    """Where the next refresh goes on; a number for each partition of the topic."""
    versions = _versions(spark, path)
    if not versions:
        return {}
    stored = spark.read.schema(_POSITIONS).parquet(f"{path}/{versions[-1]}/positions")
    return {r.partition: r.next for r in stored.collect()}


@dataclass(frozen=True)
class Board:
    """The alerts of the last refresh, and those among them that the refresh before did not hold;
    none are new on the first."""

    alerts: DataFrame
    new: DataFrame


def read_board(spark: SparkSession, path: str) -> Board:
    versions = _versions(spark, path)
    rows = _rows(spark, path, versions[-1] if versions else None)
    if len(versions) < 2:
        return Board(parsed_alerts(rows), parsed_alerts(rows.limit(0)))
    before = _rows(spark, path, versions[-2])
    return Board(parsed_alerts(rows), parsed_alerts(only_new(rows, before, ["alert_id"])))


def refresh_board(spark: SparkSession, path: str, read: Reader) -> Board:
    """Takes in the messages since the last refresh; the later of an id's messages stays.

    A message that is no JSON object or names no id is passed over, and so is one whose offset was
    taken in before. Two versions are kept, so that readers of the last are not disturbed. For one
    writer; safe to repeat.
    """
    reached = positions(spark, path)
    versions = _versions(spark, path)
    number = int(versions[-1]) + 1 if versions else 0
    folder = f"{path}/{number:012d}"
    found = beyond(read(reached), reached)
    # The messages are read once; what they hold beside the ids is not parsed before it is shown.
    found = found.select("partition", "offset", "value").persist()
    try:
        ends = found.groupBy("partition").agg((F.max("offset") + 1).alias("next"))
        now = reached | {r.partition: r.next for r in ends.collect()}
        newest = Window.partitionBy("alert_id").orderBy(F.col("offset").desc())
        held = _rows(spark, path, versions[-1] if versions else None)
        rows = held.unionByName(named_messages(found).select(*_NAMED.names))
        (rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
         .write.mode("overwrite").parquet(f"{folder}/rows"))
    finally:
        found.unpersist()
    spark.createDataFrame(sorted(now.items()), _POSITIONS).coalesce(1).write.mode(
        "overwrite").parquet(f"{folder}/positions")
    for name in versions[:-1]:
        remove(spark, f"{path}/{name}")
    return read_board(spark, path)


def beyond(messages: DataFrame, reached: Positions) -> DataFrame:
    """The messages that are not taken in yet; the bounds go down to the file scan."""
    if not reached:
        return messages
    new = ~F.col("partition").isin(*reached)
    for partition, position in reached.items():
        new = new | ((F.col("partition") == partition) & (F.col("offset") >= position))
    return messages.filter(new)


def topic_reader(spark: SparkSession, bootstrap: str, topic: str) -> Reader:
    """Reads a topic from the positions to its end. A topic that got further partitions is read from
    its start, as the reader asks for all or none of them; what is known is passed over."""
    def read(reached: Positions) -> DataFrame:
        starts = json.dumps({topic: {str(p): at for p, at in sorted(reached.items())}})
        options = kafka_options(bootstrap, [topic], starts if reached else "earliest", "latest")
        return spark.read.format("kafka").options(**options).load()
    return read


def landed_reader(spark: SparkSession, path: str) -> Reader:
    """Reads message files; those without a message beyond the positions are skipped by their
    statistics."""
    return lambda reached: beyond(spark.read.schema(MESSAGE).parquet(path), reached)
