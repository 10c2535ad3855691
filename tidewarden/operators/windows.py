"""First, last and largest values in sliding event-time windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(length: timedelta) -> str:
    return f"{int(length.total_seconds())} seconds"


def sliding_extremes(readings: DataFrame, keys: Sequence[str], ts: str, value: str,
                     size: timedelta, slide: timedelta, maxima: Sequence[str] = (),
                     lateness: timedelta | None = None,
                     panes: bool = False) -> DataFrame:
    """Per key and sliding window: ``first_value``, ``last_value`` by time, ``max_<column>``.

    Works on a batch and on a stream; ``lateness`` sets the watermark of a stream. Aggregates are
    on plain columns, so they stay hash aggregates with a map-side partial step: a hot key sends
    one row per window and map task over the shuffle.

    ``panes`` first reduces the readings to one row per key and slide and builds the windows from
    those, by a second aggregate. It needs ``size`` to be a multiple of ``slide``. On a batch it
    costs a second shuffle and pays off when a key has hundreds of readings per slide, as raw rows
    are not repeated ``size / slide`` times. On a stream a reading updates one row of state instead
    of ``size / slide``; panes go on to their windows when the watermark has passed them, so a
    reading behind the watermark counts in no window, where without panes it would count in those
    that are still open. After ``first_readings``, which drops such readings, both give the same.
    """
    if lateness is not None:
        readings = readings.withWatermark(ts, _text(lateness))
    first, last = F.min_by(value, ts), F.max_by(value, ts)
    tops = [F.max(c).alias(f"max_{c}") for c in maxima]
    if panes:
        if size % slide:
            raise ValueError("panes need a window size that is a multiple of the slide")
        pane = F.window(ts, _text(slide))
        readings = readings.groupBy(pane, *keys).agg(
            first.alias("first"), F.min(ts).alias("first_ts"), last.alias("last"),
            F.max(ts).alias("last_ts"), *[F.max(c).alias(c) for c in maxima])
        # The pane's last microsecond lies in the windows that hold the pane; on a stream it carries
        # the watermark on.
        readings = readings.withColumn("pane_time", F.window_time("window")).drop("window")
        ts, first, last = "pane_time", F.min_by("first", "first_ts"), F.max_by("last", "last_ts")
    return (
        readings.groupBy(F.window(ts, _text(size), _text(slide)).alias("window"), *keys)
        .agg(first.alias("first_value"), last.alias("last_value"), *tops)
        .select(*keys, F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"),
                "first_value", "last_value", *[f"max_{c}" for c in maxima]))


def fall() -> Column:
    """How far the value went down from the first to the last reading of the window."""
    return F.col("first_value") - F.col("last_value")


def rise() -> Column:
    return F.col("last_value") - F.col("first_value")
