"""The newest rows of every key of a history table: kept beside it as a small table of their own, and
of any time, from as few days of the history as hold them."""

from __future__ import annotations

import functools
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.functions.times import Instant, instant, up_to
from tidewarden.operators.dedup import first_per_key
from tidewarden.operators.recent import recent_rows
from tidewarden.schemas import TableSpec
from tidewarden.session import shared_folder
from tidewarden.sources.folders import children, remove
from tidewarden.sources.tables import read_folders, stored_days, table_path

#: Rows kept of every key; ``latest_of_table`` doesn't rely on the number.
KEPT = 3


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions, oldest first."""
    return [name for name in children(spark, path)
            if "_SUCCESS" in children(spark, f"{path}/{name}")]


def has_latest(spark: SparkSession, root: str, spec: TableSpec) -> bool:
    return bool(_versions(spark, f"{table_path(root, spec)}_latest"))


def read_latest(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The newest rows by the second column of the key, of each first column."""
    path = f"{table_path(root, spec)}_latest"
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], spec.schema)
    return spark.read.schema(spec.schema).parquet(f"{path}/{versions[-1]}")


def update_latest(rows: DataFrame, root: str, spec: TableSpec,
                  order: tuple[str, ...] = ("ingestion_timestamp",), count: int = KEPT) -> None:
    """Takes a batch of rows in; the first row of a key stays, as in the history table.

    It reads the last version and writes the next, whose size is that of the keys, never of the
    history; the one before the last is removed. Safe to repeat for one writer.
    """
    spark, (key, ts) = rows.sparkSession, spec.key
    path = f"{table_path(root, spec)}_latest"
    versions = _versions(spark, path)
    number = int(versions[-1]) + 1 if versions else 0
    # A batch can add only what is among its own newest.
    first = first_per_key(rows.na.drop(subset=[key, ts]), spec.key, order)
    added = recent_rows(first.select(*spec.schema.names), key, ts, count, "_rank")
    held = read_latest(spark, root, spec)
    both = held.withColumn("_rank", F.lit(0)).unionByName(added)
    merged = recent_rows(first_per_key(both, spec.key, ["_rank"]).drop("_rank"), key, ts, count,
                         "_rank")
    merged.select(*spec.schema.names).hint("rebalance").write.mode("overwrite").parquet(
        f"{path}/{number:012d}")
    for name in versions[:-1]:
        remove(spark, f"{path}/{name}")


def latest_of_table(spark: SparkSession, root: str, spec: TableSpec, as_of: Instant = None,
                    keys: DataFrame | None = None, oldest: date | None = None) -> DataFrame:
    """The newest stored row not after a time, of each key: the table's columns.

    ``keys`` names the keys to look for in its first column, for instance those of the dictionary;
    by default they are all that the table has. The kept latest rows answer for keys that have one
    by then. For the others, those with newer rows only, days are opened from the newest back, one,
    then two, then four at a time, each time for the keys still without a row, until none is left or
    ``oldest`` is passed, before which no row counts. A key without a row is left out. Of a table without latest rows all keys
    are looked for in the days, to the oldest one if no ``keys`` are given.
    """
    key, ts = spec.key
    now = spark.range(1).select(instant(as_of, spec.schema[ts].dataType).alias("now"),
                                instant(as_of).cast("date").alias("day")).first()
    held = read_latest(spark, root, spec)
    known = has_latest(spark, root, spec)
    if keys is not None:
        wanted = keys.select(F.col(keys.columns[0]).alias(key)).na.drop().distinct()
    else:
        wanted = held.select(key).distinct() if known else None

    def step(rows: DataFrame) -> DataFrame:
        if wanted is not None:
            rows = rows.join(wanted, key, "left_semi")
        if oldest is not None:
            rows = rows.filter(F.col(ts) >= F.lit(oldest).cast(spec.schema[ts].dataType))
        newest = recent_rows(up_to(rows, ts, F.lit(now.now)), key, ts, 1, "_rank")
        return _kept(newest.select(*spec.schema.names), "found")

    found = [step(held)]
    days = [day for day in reversed(stored_days(spark, root, spec))
            if day <= now.day and (oldest is None or day >= oldest)]
    count = 1
    while days:
        if wanted is not None:
            wanted = _kept(wanted.join(found[-1], key, "left_anti"), "wanted")
            if wanted.isEmpty():
                break
        opened, days = days[:count], days[count:]
        rows = read_folders(spark, root, spec, opened)
        if wanted is None:  # nothing tells when to stop: what is found is left out
            for part in found:
                rows = rows.join(part, key, "left_anti")
        found.append(step(rows))
        count *= 2
    return functools.reduce(DataFrame.unionByName, found)


def last_seen_of_table(spark: SparkSession, root: str, spec: TableSpec, as_of: Instant = None,
                       keys: DataFrame | None = None, oldest: date | None = None) -> DataFrame:
    """The newest stored time not after a time, of each key, in ``last_ts``."""
    key, ts = spec.key
    return latest_of_table(spark, root, spec, as_of, keys, oldest).select(
        key, F.col(ts).alias("last_ts"))


def _kept(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written so that a later step doesn't open the days again."""
    spark = rows.sparkSession
    folder = shared_folder(spark, purpose)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)
