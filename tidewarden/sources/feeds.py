"""Raw feed records: arrays of all-text JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.operators.normalize import PLACE, POLLED_AT


def raw_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of landed files, each file one JSON array (one poll of the feed), with the time of
    the poll in ``polled_at``."""
    return _polled(spark.read.schema(schema).option("multiLine", True).json(path))


def raw_feed_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The same as a stream: every new file is one poll."""
    return _polled(spark.readStream.schema(schema).option("multiLine", True).json(path))


def _polled(records: DataFrame) -> DataFrame:
    return records.select("*", F.col("_metadata.file_modification_time").alias(POLLED_AT))


def feed_records(documents: DataFrame, schema: T.StructType, text: str = "value",
                 polled_at: str | None = None) -> DataFrame:
    """Records of feed documents held as text, one array per row; where a column tells the time of the
    poll, with that and the place in the array."""
    records = F.from_json(F.col(text), T.ArrayType(schema))
    if polled_at is None:
        return documents.select(F.explode(records).alias("_record")).select("_record.*")
    return documents.select(F.col(polled_at).alias(POLLED_AT),
                            F.posexplode(records).alias(PLACE, "_record")).select(
                                "_record.*", POLLED_AT, PLACE)


def seen_keys(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Published keys of a text file, one ``id|time`` per line; empty lines are skipped."""
    line = F.trim("value")
    parts = F.split(line, r"\|", 2)
    return (spark.read.text(path).filter(line != "")
            .select(parts[0].alias(key), F.get(parts, F.lit(1)).alias("measurement_timestamp")))
