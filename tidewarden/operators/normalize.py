"""Raw feed records to measurement messages, with the unusable records set apart."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.functions.text import prefixed, zero_padded
from tidewarden.functions.times import Instant, instant, iso_text
from tidewarden.schemas import HYDRO, SYNOP

# Id prefixes of the message contract.
WEATHER_PREFIX = "IMGW_"
HYDRO_PREFIX = "H_"

#: When a record came: the time of its poll, and its place there.
POLLED_AT, PLACE = "polled_at", "place_in_poll"
ARRIVAL = (POLLED_AT, PLACE)


def _number(text: str) -> Column:
    return F.col(text).try_cast("double")


def _judged(raw: DataFrame, fields: dict[str, Column], problems: dict[str, Column]) -> DataFrame:
    """Converted fields plus ``usable``, ``record`` (source as JSON) and ``reason`` (names of bad
    fields).

    The time of the poll that brought the record stays, and its place there, if the source tells it.
    """
    arrival = [c for c in raw.columns if c in ARRIVAL]
    reason = F.concat_ws(", ", *[F.when(bad, F.lit(name)) for name, bad in problems.items()])
    record = F.to_json(F.struct(*[c for c in raw.columns if c not in ARRIVAL]),
                       {"ignoreNullFields": "false"})
    return raw.select(*[c.alias(n) for n, c in fields.items()], *arrival,
                      (~reduce(or_, problems.values())).alias("usable"),
                      record.alias("record"), reason.alias("reason"))


def judged_weather(raw: DataFrame, as_of: Instant = None) -> DataFrame:
    """Weather records with a pressure, converted and judged.

    A record without pressure is skipped; any other null or malformed field marks the record.
    """
    fields = {
        "station_id": prefixed(WEATHER_PREFIX, F.col("id_stacji")),
        "measurement_timestamp": F.concat(
            F.col("data_pomiaru"), F.lit("T"), zero_padded(F.col("godzina_pomiaru")),
            F.lit(":00:00Z")),
        "temperature": _number("temperatura"),
        "humidity": _number("wilgotnosc_wzgledna").try_cast("int"),
        "pressure_hpa": _number("cisnienie"),
        "wind_speed": _number("predkosc_wiatru"),
        "ingestion_timestamp": iso_text(instant(as_of)),
    }
    required = [n for n in SYNOP.names if n != "ingestion_timestamp"]
    return _judged(raw.filter(F.col("cisnienie").isNotNull()), fields,
                   {n: fields[n].isNull() for n in required})


def judged_hydro(raw: DataFrame, as_of: Instant = None,
                 warning_level: Column | None = None) -> DataFrame:
    """Hydro records with a level time, converted and judged.

    A record without a level time is skipped; the level must be a whole number; a missing flow is
    fine, a malformed one is not. ``warning_level`` sets ``is_warning``, which is false without.
    """
    level = F.col("stan_wody").try_cast("int")
    flow = _number("przeplyw")
    warning = F.lit(False) if warning_level is None else F.coalesce(
        level >= warning_level, F.lit(False))
    fields = {
        "gauge_id": prefixed(HYDRO_PREFIX, F.col("id_stacji")),
        "measurement_timestamp": F.concat(
            F.replace(F.col("stan_wody_data_pomiaru"), F.lit(" "), F.lit("T")), F.lit("Z")),
        "water_level_cm": level,
        "flow_m3s": flow,
        "is_warning": warning,
        "ingestion_timestamp": iso_text(instant(as_of)),
    }
    return _judged(raw.filter(F.col("stan_wody_data_pomiaru").isNotNull()), fields, {
        "gauge_id": fields["gauge_id"].isNull(),
        "water_level_cm": level.isNull(),
        "flow_m3s": F.col("przeplyw").isNotNull() & flow.isNull(),
    })


def usable(judged: DataFrame) -> DataFrame:
    return judged.filter("usable").drop("usable", "record", "reason")


def rejected(judged: DataFrame) -> DataFrame:
    """Source record and the fields that made it unusable."""
    return judged.filter("NOT usable").select("record", "reason")


def normalize_weather(raw: DataFrame, as_of: Instant = None) -> DataFrame:
    return usable(judged_weather(raw, as_of)).select(*SYNOP.names)


def normalize_hydro(raw: DataFrame, as_of: Instant = None,
                    warning_level: Column | None = None) -> DataFrame:
    return usable(judged_hydro(raw, as_of, warning_level)).select(*HYDRO.names)


def field_reasons(text: Column, fields: Mapping[str, tuple[str, bool]]) -> Column:
    """What is wrong with a JSON record, as an array of (field, reason), empty if nothing is.

    ``fields`` gives each field's type and whether it must be there. A required field is ``absent``,
    or ``null``, or any field ``mistyped``: an object or an array, or a value that the type doesn't
    take, where numbers may come as text. Text that is no JSON object is ``broken``, of no field.
    """
    record = F.try_parse_json(text)
    found = []
    for name, (kind, required) in fields.items():
        value = F.try_variant_get(record, f"$.{name}", "variant")
        plain = F.try_variant_get(record, f"$.{name}", "string")
        nested = F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
        problem = F.when(value.isNull(), F.lit("absent" if required else None)).when(
            F.is_variant_null(value), F.lit("null" if required else None)).when(
            nested | plain.try_cast(kind).isNull(), F.lit("mistyped"))
        found.append(F.struct(F.lit(name).alias("field"), problem.alias("reason")))
    broken = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit("broken").alias("reason")))
    whole = F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))
    return F.when(whole, F.filter(F.array(*found), lambda f: f.reason.isNotNull())).otherwise(broken)


#: Type and presence that a raw river record needs.
HYDRO_FIELDS = {"id_stacji": ("string", True), "stan_wody_data_pomiaru": ("string", True),
                "stan_wody": ("int", True), "przeplyw": ("double", False)}


def reject_reasons(rows: DataFrame, text: str, fields: Mapping[str, tuple[str, bool]] | None = None
                   ) -> DataFrame:
    """The rows' other columns with field and reason, a row for each thing wrong with a record."""
    reasons = F.inline(field_reasons(F.col(text), HYDRO_FIELDS if fields is None else fields))
    return rows.select(*[c for c in rows.columns if c != text], reasons)
