"""Positional lag and lead features of per-key time series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lag_lead(df: DataFrame, key: str, ts: str, value: str, lags: int = 3,
             leads: Sequence[int] = (2, 3), part: str | None = "day") -> DataFrame:
    """``lag_0 .. lag_{lags-1}`` and ``lead_k`` by row position within each key's time order.

    A window over a whole key would sort all rows of a hot key in one task. With ``part`` (a
    ``date_trunc`` unit) the window runs per key and time slice instead; rows whose neighbours
    lie in another slice are finished in a second window over the slice edges alone, which hold
    at most ``2 * (lags - 1 + max(leads))`` rows per slice. ``part=None`` is the plain window,
    cheaper when every key is known to be small.
    """
    back, ahead = lags - 1, max(leads)

    def shifts(window) -> list[Column]:
        return ([F.lag(value, i).over(window).alias(f"lag_{i}") if i
                 else F.col(value).alias("lag_0") for i in range(lags)]
                + [F.lead(value, i).over(window).alias(f"lead_{i}") for i in leads])

    names = [f"lag_{i}" for i in range(lags)] + [f"lead_{i}" for i in leads]
    across = Window.partitionBy(key).orderBy(ts)
    rows = df.select(key, ts, value)
    if part is None:
        return rows.select(key, ts, *shifts(across))

    within = Window.partitionBy(key, "_part").orderBy(ts)
    placed = (
        rows.withColumn("_part", F.date_trunc(part, ts))
        .withColumn("_before", F.row_number().over(within) - 1)
        .withColumn("_after", F.count(F.lit(1)).over(Window.partitionBy(key, "_part"))
                    - F.col("_before") - 1))
    settled = (F.col("_before") >= back) & (F.col("_after") >= ahead)
    inner = placed.select(key, ts, *shifts(within), "_before", "_after").filter(settled)
    near_edge = (F.col("_before") < back + ahead) | (F.col("_after") < back + ahead)
    edges = (placed.filter(near_edge)
             .select(key, ts, *shifts(across), "_before", "_after").filter(~settled))
    return inner.select(key, ts, *names).unionByName(edges.select(key, ts, *names))
