"""The alert board: latest version of every alert, labelled, newest first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.functions.text import (
    ALERT_TYPE_LABELS, OTHER_COLOR, SEVERITY_COLORS, SEVERITY_LABELS, looked_up, optional)
from tidewarden.operators.joins import only_new
from tidewarden.schemas import ALERT
from tidewarden.sources.messages import decoded

# Texts of the board.
NO_MESSAGE = "brak opisu"
VALUE_TEXT = " | wartość: "
EXPIRES_TEXT = " | wygasa: "
UNKNOWN = "?"


def named_messages(messages: DataFrame, arrival: str = "offset") -> DataFrame:
    """The alert id of every message that has one, with its ``arrival`` and ``value``; a message that
    is no valid JSON object, or names no id, is skipped. Only the id is read."""
    texts = messages.filter(F.ltrim(F.col("value").cast("string"), F.lit(" \t\r\n")).startswith("{"))
    return decoded(texts, T.StructType([ALERT["alert_id"]]), ["alert_id"],
                   keep=[arrival, "value"]).filter("alert_id != ''")


def parsed_alerts(messages: DataFrame) -> DataFrame:
    return decoded(messages, ALERT, ["alert_id"])


def current_alerts(messages: DataFrame, arrival: str = "offset") -> DataFrame:
    """The last message of every alert id. All messages of an id are in one partition of the
    topic, so the offset orders them.

    Of the messages that name an id, the newest of each id is found, and only that is parsed in full.
    """
    return parsed_alerts(_newest(named_messages(messages, arrival), "alert_id", arrival))


def _newest(rows: DataFrame, key: str, arrival: str) -> DataFrame:
    newest = Window.partitionBy(key).orderBy(F.col(arrival).desc())
    return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def alert_board(alerts: DataFrame) -> DataFrame:
    """Board rows, newest ``event_timestamp`` text first and missing ones last."""
    level = F.coalesce("severity", F.lit(UNKNOWN))
    kind = F.coalesce("alert_type", F.lit(""))
    return alerts.select(
        "alert_id", looked_up(level, SEVERITY_LABELS, level).alias("severity_label"),
        looked_up(level, SEVERITY_COLORS, F.lit(OTHER_COLOR)).alias("color"),
        looked_up(kind, ALERT_TYPE_LABELS, F.upper(kind)).alias("type_label"),
        F.coalesce("event_timestamp", F.lit(UNKNOWN)).alias("shown_timestamp"),
        F.coalesce("msg", F.lit(NO_MESSAGE)).alias("msg"),
        F.coalesce("station_id", F.lit(UNKNOWN)).alias("station_id"), "value",
        optional(VALUE_TEXT, F.col("value")).alias("value_text"),
        optional(EXPIRES_TEXT, F.nullif("expires", F.lit(""))).alias("expires_text"),
        F.coalesce("event_timestamp", F.lit("")).alias("_order"),
    ).orderBy(F.col("_order").desc(), "alert_id").drop("_order")


def alert_total(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count(F.lit(1)).alias("alerts"))


def new_alerts(alerts: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Alerts that the previous snapshot did not hold; none on the first load."""
    if previous is None:
        return alerts.limit(0)
    return only_new(alerts, previous, ["alert_id"])
