"""Event-time parsing, reference instants and time predicates."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text formats of the message contract and of the view captions.
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"
CLOCK = "HH:mm 'UTC'"

Instant = str | datetime | Column | None


def event_time(text: Column) -> Column:
    """Timestamp of ISO text, null where the text is not a timestamp."""
    return F.try_to_timestamp(text)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_UTC)


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, CLOCK)


def instant(value: Instant, kind: T.DataType | None = None) -> Column:
    """``value`` as a column of type ``kind``; None means the current time.

    Text and datetimes become literals of the compared column's own type, so that a comparison
    needs no cast on the column side and reaches the file scan.
    """
    if value is None:
        column = F.current_timestamp()
    elif isinstance(value, Column):
        column = value
    else:
        if isinstance(value, datetime):
            if value.tzinfo:
                value = value.astimezone(timezone.utc).replace(tzinfo=None)
            value = value.isoformat(sep=" ")
        column = F.lit(value)
    return column.cast(kind or T.TimestampType())


def span(length: timedelta) -> Column:
    return F.make_dt_interval(secs=F.lit(length.total_seconds()))


def up_to(df: DataFrame, ts: str, as_of: Instant = None) -> DataFrame:
    """Rows that are not later than ``as_of``."""
    return df.filter(F.col(ts) <= instant(as_of, df.schema[ts].dataType))


def trailing(df: DataFrame, ts: str, as_of: Instant = None,
             back: timedelta = timedelta(hours=24),
             ahead: timedelta = timedelta(0)) -> DataFrame:
    """Rows within ``[as_of - back, as_of + ahead]``, both ends included."""
    kind = df.schema[ts].dataType
    now = instant(as_of, kind)
    return df.filter((F.col(ts) >= (now - span(back)).cast(kind))
                     & (F.col(ts) <= (now + span(ahead)).cast(kind)))
