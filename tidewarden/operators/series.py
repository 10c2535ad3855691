"""Time buckets, trailing series, key lists and series summaries."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.functions.times import Instant, clock_text, trailing, up_to

DAY = timedelta(hours=24)


def of_key(df: DataFrame, key: str, value) -> DataFrame:
    """Rows of one key; with ``value`` None, rows of all keys."""
    return df if value is None else df.filter(F.col(key) == F.lit(value))


def bucket_means(df: DataFrame, key: str, ts: str, columns: Sequence[str],
                 unit: str = "minute", as_of: Instant = None, back: timedelta = DAY,
                 only=None) -> DataFrame:
    """Means per key and time bucket over the trailing span, in column ``bucket``."""
    recent = trailing(of_key(df, key, only), ts, as_of, back)
    start = F.date_trunc(unit, F.col(ts)).cast(df.schema[ts].dataType).alias("bucket")
    return recent.groupBy(key, start).agg(*[F.avg(c).alias(c) for c in columns])


def trailing_series(df: DataFrame, key: str, ts: str, columns: Sequence[str],
                    as_of: Instant = None, back: timedelta = DAY,
                    ahead: timedelta = timedelta(0), only=None,
                    limit: int | None = None) -> DataFrame:
    """The trailing rows; those of one key in time order, of which ``limit`` keeps the oldest."""
    rows = (trailing(of_key(df, key, only), ts, as_of, back, ahead)
            .select(key, ts, *columns))
    if only is None:
        if limit is not None:
            raise ValueError("a limit is for the series of one key")
        return rows
    ordered = rows.orderBy(ts)
    return ordered if limit is None else ordered.limit(limit)


def last_seen(df: DataFrame, key: str, ts: str, as_of: Instant = None, only=None) -> DataFrame:
    """Newest time per key that is not in the future, in ``last_ts``."""
    return (up_to(of_key(df, key, only), ts, as_of)
            .groupBy(key).agg(F.max(ts).alias("last_ts")))


def key_list(df: DataFrame, key: str, ts: str, as_of: Instant = None, limit: int | None = None,
             back: timedelta | None = None, ahead: timedelta = timedelta(0)) -> DataFrame:
    """The keys in order that have a row in the span (no ``back``: all past), or the first
    ``limit`` of them."""
    rows = up_to(df, ts, as_of) if back is None else trailing(df, ts, as_of, back, ahead)
    keys = rows.select(key).distinct().orderBy(key)
    return keys if limit is None else keys.limit(limit)


def series_summary(df: DataFrame, key: str, ts: str, present: Sequence[str] = ()) -> DataFrame:
    """Row count, newest time with its clock text, and whether each column has any value."""
    return (df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("readings"), F.max(ts).alias("last_ts"),
                 *[F.max(F.col(c).isNotNull()).alias(f"has_{c}") for c in present])
            .withColumn("last_clock", clock_text(F.col("last_ts"))))


def warnings_of(df: DataFrame, flag: str = "is_warning") -> DataFrame:
    return df.filter(F.col(flag))


def ordered_set(column: str | Column) -> Column:
    """Distinct values of a group as a sorted array; for columns of few distinct values."""
    return F.sort_array(F.collect_set(column))
