"""Latest and most recent rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def recent_rows(df: DataFrame, key: str, ts: str, count: int, rank: str = "rank") -> DataFrame:
    """The ``count`` newest rows of every key, newest first in ``rank``.

    The rank filter is applied per map task ahead of the shuffle (window group limit), so a hot
    key sends ``count`` rows per task.
    """
    newest = Window.partitionBy(key).orderBy(F.col(ts).desc())
    return df.withColumn(rank, F.row_number().over(newest)).filter(F.col(rank) <= count)


def latest_per_key(df: DataFrame, key: str, ts: str, columns: Sequence[str]) -> DataFrame:
    """The newest row of every key: ``key``, ``columns`` and ``ts``.

    Fixed-width columns go through a hash aggregate, which needs no sort; text and nested columns
    would turn it into a sort aggregate, so they go through the rank.
    """
    kinds = [df.schema[c].dataType for c in columns]
    if all(isinstance(k, _FIXED_WIDTH) and not isinstance(k, T.DecimalType) for k in kinds):
        newest = [F.max_by(c, ts).alias(c) for c in columns]
        return (df.filter(F.col(ts).isNotNull())
                .groupBy(key).agg(*newest, F.max(ts).alias(ts)))
    kept = df.filter(F.col(ts).isNotNull()).select(key, *columns, ts)
    return recent_rows(kept, key, ts, 1, "_rank").drop("_rank")


def recent_lags(df: DataFrame, key: str, ts: str, value: str, count: int = 3) -> DataFrame:
    """The ``count`` newest values of every key side by side: ``ts``, ``lag_0`` ... newest first.

    Keys with fewer rows, or with a missing value among them, are left out. Ranking and pivot
    share one shuffle.
    """
    ranked = recent_rows(df.select(key, ts, value), key, ts, count, "_rank")
    lags = [F.max(F.when(F.col("_rank") == i + 1, F.col(value))).alias(f"lag_{i}")
            for i in range(count)]
    return (ranked.groupBy(key)
            .agg(F.max(ts).alias(ts), F.count(value).alias("_present"), *lags)
            .filter(F.col("_present") == count).drop("_present"))
