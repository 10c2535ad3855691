"""Message, table and dictionary schemas, and the natural key of every stored table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _D, _I, _B, _TS = (
    T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.TimestampType())

# Field names and types of the raw feeds and of the three message topics.
RAW_WEATHER = _struct(
    id_stacji=_S, stacja=_S, data_pomiaru=_S, godzina_pomiaru=_S, temperatura=_S,
    predkosc_wiatru=_S, kierunek_wiatru=_S, wilgotnosc_wzgledna=_S, suma_opadu=_S, cisnienie=_S)
RAW_HYDRO = _struct(
    id_stacji=_S, stacja=_S, rzeka=_S, lat=_S, lon=_S, stan_wody=_S,
    stan_wody_data_pomiaru=_S, przeplyw=_S)
SYNOP = _struct(
    station_id=_S, measurement_timestamp=_S, temperature=_D, humidity=_I,
    pressure_hpa=_D, wind_speed=_D, ingestion_timestamp=_S)
HYDRO = _struct(
    gauge_id=_S, measurement_timestamp=_S, water_level_cm=_I, flow_m3s=_D,
    is_warning=_B, ingestion_timestamp=_S)
ALERT = _struct(
    alert_id=_S, alert_type=_S, source=_S, station_id=_S, lat=_D, lon=_D, severity=_S,
    msg=_S, value=_D, event_timestamp=_S, expires=_S, ingestion_timestamp=_S)
ALERT_TYPES = ("storm", "flood")
SEVERITIES = ("Yellow", "Orange", "Red")

MESSAGE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
])
STATION = _struct(id=_S, lat=_D, lon=_D, name=_S)
TYPED_STATION = T.StructType([*STATION.fields, T.StructField("type", _S)])
MODEL = T.StructType([
    T.StructField("gauge_id", _S), T.StructField("horizon", _I), T.StructField("intercept", _D),
    T.StructField("b0", _D), T.StructField("b1", _D), T.StructField("b2", _D),
    T.StructField("n", T.LongType())])


#: Days of the year 1 that stand for no day.
UNDATED = 64


@dataclass(frozen=True)
class TableSpec:
    """A stored table.

    ``day`` is the partition column. It is computed from the natural key alone, so two rows with
    one key always fall into one partition and the insert-if-absent check can prune to the days
    of the incoming rows.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    day: Callable[[], Column]

    def stored_day(self) -> Column:
        """``day``, and where the key tells none, one of ``UNDATED`` days of the year 1 by the key's
        hash, so that undated rows share neither one folder nor one task."""
        slot = F.pmod(F.xxhash64(*self.key), F.lit(UNDATED)).cast("int")
        return F.coalesce(self.day(), F.date_add(F.make_date(F.lit(1), F.lit(1), F.lit(1)), slot))

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("day", T.DateType())])


def _with_times(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([
        T.StructField(f.name, _TS if f.name in names else f.dataType) for f in schema.fields])


HYDRO_MEASUREMENTS = TableSpec(
    "hydro_measurements",
    _with_times(HYDRO, "measurement_timestamp", "ingestion_timestamp"),
    ("gauge_id", "measurement_timestamp"),
    lambda: F.to_date("measurement_timestamp"))
SYNOP_MEASUREMENTS = TableSpec(
    "synop_measurements",
    _with_times(SYNOP, "measurement_timestamp", "ingestion_timestamp"),
    ("station_id", "measurement_timestamp"),
    lambda: F.to_date("measurement_timestamp"))
# An alert id ends in the window start as yyyyMMddHH; ids of another form have no day.
ALERTS_HISTORY = TableSpec(
    "alerts_history",
    _with_times(ALERT, "event_timestamp", "expires", "ingestion_timestamp"),
    ("alert_id",),
    lambda: F.try_to_timestamp(
        F.regexp_extract("alert_id", r"_(\d{8})\d{2}$", 1), F.lit("yyyyMMdd")).cast("date"))
HYDRO_PREDICTIONS = TableSpec(
    "hydro_predictions",
    _struct(gauge_id=_S, prediction_timestamp=_TS, predicted_water_level=_D,
            horizon_hours=_I, created_at=_TS),
    ("gauge_id", "prediction_timestamp", "horizon_hours"),
    lambda: F.to_date("prediction_timestamp"))

TABLES = {t.name: t for t in (
    HYDRO_MEASUREMENTS, SYNOP_MEASUREMENTS, ALERTS_HISTORY, HYDRO_PREDICTIONS)}

# Topic -> (message schema, table that keeps its history).
TOPICS = {
    "hydro": (HYDRO, HYDRO_MEASUREMENTS),
    "synop": (SYNOP, SYNOP_MEASUREMENTS),
    "alerts": (ALERT, ALERTS_HISTORY),
}
