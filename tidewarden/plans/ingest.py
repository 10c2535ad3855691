"""Raw feed records to new, deduplicated measurement messages."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.functions.times import Instant, event_time
from tidewarden.operators.dedup import first_in_stream, first_per_key
from tidewarden.operators.joins import only_new
from tidewarden.operators.normalize import (
    ARRIVAL, judged_hydro, judged_weather, rejected, usable)

LOGICAL_KEYS = {"synop": ("station_id", "measurement_timestamp"),
                "hydro": ("gauge_id", "measurement_timestamp")}
JUDGES = {"synop": judged_weather, "hydro": judged_hydro}


def judged(raw: DataFrame, topic: str, as_of: Instant = None,
           warning_level: Column | float | None = None) -> DataFrame:
    """A feed's records, converted and judged; gauges at ``warning_level`` or above are warned of.
    """
    if warning_level is None:
        return JUDGES[topic](raw, as_of)
    if topic != "hydro":
        raise ValueError("a warning level is for water levels")
    level = warning_level if isinstance(warning_level, Column) else F.lit(warning_level)
    return judged_hydro(raw, as_of, level)


@dataclass(frozen=True)
class Ingested:
    """Usable records, the new ones among them, and the rejects, all from ``judged``."""

    judged: DataFrame
    new: DataFrame

    @property
    def usable(self) -> DataFrame:
        return usable(self.judged).drop(*ARRIVAL)

    @property
    def rejected(self) -> DataFrame:
        return rejected(self.judged)


def ingest(raw: DataFrame, topic: str, seen: DataFrame | None = None, as_of: Instant = None,
           warning_level: Column | float | None = None) -> Ingested:
    """Polls of a feed as a batch: usable records, those not ``seen`` before, and the rejects with
    their reasons.

    Of several records with one logical key the earliest poll wins, then the earlier place in it: by
    the columns of ``ARRIVAL`` that the feed has. Only where these don't tell, as in a feed without
    them, it is the order in which the rows are read, which depends on how the files are split.
    """
    records = judged(raw, topic, as_of, warning_level)
    placed = usable(records).withColumn("_place", F.monotonically_increasing_id())
    keys = LOGICAL_KEYS[topic]
    new = first_per_key(placed, keys, [c for c in (*ARRIVAL, "_place") if c in placed.columns])
    if seen is not None:
        new = only_new(new, seen, keys)
    return Ingested(records, new.drop(*ARRIVAL, "_place"))


def ingest_stream(raw: DataFrame, topic: str,
                  lateness: timedelta = timedelta(days=1),
                  warning_level: Column | float | None = None) -> DataFrame:
    """The new usable records of a feed stream, one per logical key within ``lateness``.

    State is bounded by the lateness; repeats over all time are kept out by the history tables.
    """
    good = (usable(judged(raw, topic, warning_level=warning_level)).drop(*ARRIVAL)
            .withColumn("event_time", event_time(F.col("measurement_timestamp")))
            .filter(F.col("event_time").isNotNull()))
    return first_in_stream(good, LOGICAL_KEYS[topic], "event_time", lateness).drop("event_time")


def ingest_report(result: Ingested, topic: str) -> DataFrame:
    """One row: records fetched, records newly sent, records rejected."""
    none = F.lit(0).cast("long")
    judged = result.judged.agg(F.count_if("usable").alias("fetched"), none.alias("sent"),
                               F.count_if(~F.col("usable")).alias("rejected"))
    sent = result.new.agg(none.alias("fetched"), F.count(F.lit(1)).alias("sent"),
                          none.alias("rejected"))
    return (judged.unionByName(sent)
            .agg(*[F.sum(c).alias(c) for c in ("fetched", "sent", "rejected")])
            .select(F.lit(topic).alias("topic"), "fetched", "sent", "rejected"))
