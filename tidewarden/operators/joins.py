"""Joins with the station dictionary and between snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_station(df: DataFrame, stations: DataFrame, key: str,
                 columns: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """Adds dictionary columns; rows of unknown stations stay, with nulls.

    No broadcast hint: Spark broadcasts the dictionary while its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it, where adaptive execution
    splits skewed keys.
    """
    found = stations.select(F.col("id").alias("_station"), *columns)
    return df.join(found, F.col(key) == F.col("_station"), "left").drop("_station")


def named(df: DataFrame, stations: DataFrame, key: str, into: str = "name") -> DataFrame:
    """The station's name, or its id where the dictionary has none. Of several entries of an id
    the last counts."""
    placed = stations.select("id", "name", F.monotonically_increasing_id().alias("_place"))
    found = placed.groupBy(F.col("id").alias("_station")).agg(
        F.max_by("name", "_place").alias("_name"))
    return (df.join(found, F.col(key) == F.col("_station"), "left")
            .withColumn(into, F.coalesce("_name", F.col(key)))
            .drop("_station", "_name"))


def only_new(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``seen``."""
    return df.join(seen.select(*keys), list(keys), "left_anti")
