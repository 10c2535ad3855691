"""First reading per logical key, on batches and on streams."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str],
                  order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in ``order``.

    The rank filter becomes a group limit ahead of the shuffle, so each map task sends at most
    one row per key however many copies it holds.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def first_in_stream(df: DataFrame, keys: Sequence[str], ts: str,
                    lateness: timedelta) -> DataFrame:
    """Keeps the first copy of a key among those that arrive within ``lateness`` of each other.

    The copies of a key come through one partition of their topic, hence through one task and in
    order, and state keeps the first it sees.
    """
    return df.withWatermark(ts, f"{int(lateness.total_seconds())} seconds") \
        .dropDuplicatesWithinWatermark(list(keys))


def first_readings(df: DataFrame, key: str, ts: str, arrival: Sequence[str] = (),
                   lateness: timedelta | None = None) -> DataFrame:
    """The first copy of each reading, that is of ``key`` and time, on a batch or a stream.

    A batch is ordered by those of the ``arrival`` columns that it has. A stream, whose copies come
    in order as above, needs the ``lateness`` after which copies are dropped as late anyway.
    """
    if df.isStreaming:
        return df.withWatermark(ts, f"{int(lateness.total_seconds())} seconds") \
            .dropDuplicates([key, ts])
    order = [name for name in arrival if name in df.columns]
    return first_per_key(df, [key, ts], order or [ts])
