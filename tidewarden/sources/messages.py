"""Keyed message streams: Kafka topics, or message rows landed as files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.schemas import MESSAGE

BatchWriter = Callable[[DataFrame, int], None]


def kafka_options(bootstrap: str, topics: Sequence[str], starting: str,
                  ending: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": bootstrap, "subscribe": ",".join(topics),
               "startingOffsets": starting}
    if ending:
        options["endingOffsets"] = ending
    return options


def message_stream(spark: SparkSession, bootstrap: str, topics: Sequence[str],
                   starting: str = "latest", **limits: str) -> DataFrame:
    """Live topics. ``starting`` counts only while there is no checkpoint; ``limits`` are further
    reader options such as ``maxOffsetsPerTrigger``."""
    return (spark.readStream.format("kafka")
            .options(**kafka_options(bootstrap, topics, starting), **limits).load())


def message_replay(spark: SparkSession, bootstrap: str, topics: Sequence[str]) -> DataFrame:
    """All messages of all partitions, from the beginning up to now, as a batch."""
    return (spark.read.format("kafka")
            .options(**kafka_options(bootstrap, topics, "earliest", "latest")).load())


def landed_stream(spark: SparkSession, path: str, **limits: str) -> DataFrame:
    """The same rows from Parquet files, as a stream."""
    return spark.readStream.schema(MESSAGE).options(**limits).parquet(path)


def landed_replay(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE).parquet(path)


def decoded(messages: DataFrame, schema: T.StructType, required: Sequence[str] = (),
            keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns of the JSON value, after the message columns named in ``keep``.

    Invalid UTF-8 is replaced, invalid JSON gives nulls; rows that lack a ``required`` field are
    dropped. The parsed struct goes through ``inline``, as a plain projection would let filters on
    its fields move below it and parse every message again for each of them.
    """
    text = F.make_valid_utf8(F.col("value").cast("string"))
    rows = messages.select(*keep, F.inline(F.array(F.from_json(text, schema))))
    for name in required:
        rows = rows.filter(F.col(name).isNotNull())
    return rows


def row_json(df: DataFrame) -> Column:
    """The whole row as JSON, with its null fields."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def keyed_json(df: DataFrame, key: str) -> DataFrame:
    """A message per row: ``key``, and the row as JSON in ``value``."""
    return df.select(F.col(key).alias("key"), row_json(df).alias("value"))


def kafka_writer(bootstrap: str, topic: str) -> BatchWriter:
    """Appends keyed JSON to a topic; a repeated batch repeats its messages under their keys."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("topic", topic).save())
    return write


def folder_writer(path: str) -> BatchWriter:
    """One folder per batch, replaced if the batch is repeated, so nothing is written twice."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write
