"""The station dictionary: reading, combining, building, writing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.functions.text import fold_polish, prefixed
from tidewarden.operators.normalize import HYDRO_PREFIX
from tidewarden.schemas import STATION, TYPED_STATION


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """``id, lat, lon, name`` of a CSV with a header; coordinates that are no numbers are null,
    and so is the name if the file has none."""
    text = spark.read.option("header", True).csv(path)
    name = F.col("name") if "name" in text.columns else F.lit(None).cast("string").alias("name")
    return text.select("id", *[F.col(c).try_cast("double").alias(c) for c in ("lat", "lon")],
                       name)


def combined_stations(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Union of dictionaries, each tagged with its ``type``; missing files are skipped."""
    combined = spark.createDataFrame([], TYPED_STATION)
    for kind, path in paths.items():
        try:
            stations = read_stations(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        combined = combined.unionByName(stations.withColumn("type", F.lit(kind)))
    return combined


def build_stations(raw_hydro: DataFrame) -> DataFrame:
    """Dictionary rows of the gauges that have coordinates, named ``name (river)`` in ASCII.

    Missing is what is null, empty text or the number 0; the text ``0`` is a coordinate.
    """
    placed = raw_hydro
    for c in ("lat", "lon"):
        nothing = "" if isinstance(raw_hydro.schema[c].dataType, T.StringType) else 0
        placed = placed.filter(F.col(c).isNotNull() & (F.col(c) != F.lit(nothing)))
    name = F.concat(F.coalesce("stacja", F.lit("")), F.lit(" ("),
                    F.coalesce("rzeka", F.lit("")), F.lit(")"))
    return placed.select(prefixed(HYDRO_PREFIX, F.col("id_stacji")).alias("id"),
                         *[F.col(c).try_cast("double").alias(c) for c in ("lat", "lon")],
                         fold_polish(name).alias("name"))


def write_stations(stations: DataFrame, path: str) -> None:
    (stations.select(*STATION.names).write.mode("overwrite")
     .option("header", True).csv(path))
