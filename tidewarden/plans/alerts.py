"""Storm and flood alerts from readings; the same code for a batch and a stream."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.functions.times import Instant, event_time, instant, iso_text, span
from tidewarden.operators.dedup import first_readings
from tidewarden.operators.joins import with_station
from tidewarden.operators.rules import Rule, classified
from tidewarden.operators.windows import fall, rise, sliding_extremes
from tidewarden.schemas import ALERT, ALERT_TYPES, HYDRO, SEVERITIES, SYNOP
from tidewarden.sources.messages import decoded


@dataclass(frozen=True)
class AlertKind:
    prefix: str
    alert_type: str
    source: str
    rules: tuple[Rule, ...]
    size: timedelta
    slide: timedelta
    lateness: timedelta
    lifetime: timedelta


# Thresholds, windows, lifetimes and names of the two kinds of alert.
STORM = AlertKind(
    prefix="STORM", alert_type="storm", source="spark-weather",
    rules=(Rule("drop", {"Yellow": 3.0, "Orange": 6.0, "Red": 9.0}),
           Rule("wind", {"Yellow": 15.0, "Orange": 20.0, "Red": 25.0})),
    size=timedelta(hours=3), slide=timedelta(hours=1), lateness=timedelta(hours=1),
    lifetime=timedelta(hours=12))
FLOOD = AlertKind(
    prefix="FLOOD", alert_type="flood", source="spark-hydro",
    rules=(Rule("rise", {"Yellow": 30.0, "Orange": 60.0, "Red": 100.0}),),
    size=timedelta(hours=6), slide=timedelta(hours=1), lateness=timedelta(hours=2),
    lifetime=timedelta(hours=24))
# Message texts; {span} is the window size, the other names are columns.
PRESSURE_TEXT = "Spadek ciśnienia {drop} hPa/{span} — ryzyko wichury"
WIND_TEXT = "Silny wiatr {wind} m/s — ryzyko wichury"
LEVEL_TEXT = "Wzrost poziomu wody {rise} cm/{span} — ryzyko podtopienia (poziom {level} cm)"


#: Columns that order a batch's readings by arrival, as far as it has them.
ARRIVAL = ("ingestion_timestamp", "partition", "offset")


def _filled(template: str, kind: AlertKind, **values: Column) -> Column:
    """The template with its names replaced by column values."""
    hours = f"{int(kind.size.total_seconds() // 3600)}h"
    parts = []
    for piece in template.replace("{span}", hours).split("{"):
        name, closed, rest = piece.partition("}")
        parts += [values[name].cast("string"), F.lit(rest)] if closed else [F.lit(piece)]
    return F.concat(*parts)


def synop_readings(messages: DataFrame) -> DataFrame:
    """Weather readings of a message stream with their event time; unusable ones dropped."""
    return timed_readings(decoded(messages, SYNOP), "pressure_hpa")


def hydro_readings(messages: DataFrame) -> DataFrame:
    return timed_readings(decoded(messages, HYDRO), "water_level_cm")


def timed_readings(rows: DataFrame, metric: str) -> DataFrame:
    """Rows with ``event_time`` from the measurement text; needs it and ``metric`` present."""
    return (rows.withColumn("event_time", event_time(F.col("measurement_timestamp")))
            .filter(F.col(metric).isNotNull() & F.col("event_time").isNotNull()))


def _payload(scored: DataFrame, kind: AlertKind, stations: DataFrame, station: str,
             msg: Column, value: Column, as_of: Instant) -> DataFrame:
    """The alert contract's columns; classified rows only reach the join with the dictionary."""
    now = instant(as_of)
    window_hour = F.date_format("window_start", "yyyyMMddHH")
    columns = {
        "alert_id": F.concat_ws("_", F.lit(kind.prefix), F.col(station), window_hour),
        "alert_type": F.lit(kind.alert_type),
        "source": F.lit(kind.source),
        "station_id": F.col(station).cast("string"),
        "lat": F.col("lat"),
        "lon": F.col("lon"),
        "severity": F.col("severity"),
        "msg": msg,
        "value": value.cast("double"),
        "event_timestamp": iso_text(now),
        "expires": iso_text(now + span(kind.lifetime)),
        "ingestion_timestamp": iso_text(now),
    }
    placed = with_station(classified(scored, kind.rules), stations, station)
    return placed.select(*[columns[n].alias(n) for n in ALERT.names])


def storm_alerts(readings: DataFrame, stations: DataFrame, kind: AlertKind = STORM,
                 as_of: Instant = None, station: str = "station_id", ts: str = "event_time",
                 pressure: str = "pressure_hpa", wind: str = "wind_speed",
                 panes: bool = False, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """Alerts on a pressure drop within the window, or on strong wind.

    The message and value tell the drop if it reaches the lowest level, else the wind. Of several
    readings of a station at one time only the first to arrive counts.
    """
    first = first_readings(readings, station, ts, arrival, kind.lateness)
    # A stream has its watermark from the step before.
    extremes = sliding_extremes(first, [station], ts, pressure, kind.size, kind.slide, [wind],
                                None, panes)
    scored = extremes.withColumn("drop", fall()).withColumn("wind", F.col(f"max_{wind}"))
    dropped = F.col("drop") >= kind.rules[0].levels["Yellow"]
    rounded = {n: F.round(n, 1) for n in ("drop", "wind")}
    msg = (F.when(dropped, _filled(PRESSURE_TEXT, kind, **rounded))
           .otherwise(_filled(WIND_TEXT, kind, **rounded)))
    value = F.when(dropped, rounded["drop"]).otherwise(rounded["wind"])
    return _payload(scored, kind, stations, station, msg, value, as_of)


def flood_alerts(readings: DataFrame, stations: DataFrame, kind: AlertKind = FLOOD,
                 as_of: Instant = None, station: str = "gauge_id", ts: str = "event_time",
                 level: str = "water_level_cm", panes: bool = False,
                 arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """Alerts on a water-level rise within the window; the first of repeated readings counts."""
    first = first_readings(readings, station, ts, arrival, kind.lateness)
    extremes = sliding_extremes(first, [station], ts, level, kind.size, kind.slide, (), None, panes)
    scored = extremes.withColumn("rise", rise())
    rounded = F.round("rise", 0)
    msg = _filled(LEVEL_TEXT, kind, rise=rounded, level=F.col("last_value"))
    return _payload(scored, kind, stations, station, msg, rounded, as_of)


def contract_violations(alerts: DataFrame, types: Sequence[str] = ALERT_TYPES,
                        severities: Sequence[str] = SEVERITIES) -> DataFrame:
    """Alerts outside the contract: no id, or a type or severity that is not allowed."""
    allowed = F.col("alert_type").isin(*types) & F.col("severity").isin(*severities)
    return alerts.filter(F.col("alert_id").isNull() | ~F.coalesce(allowed, F.lit(False)))
