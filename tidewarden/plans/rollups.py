"""Sums and counts per station and minute, kept beside a history table, for the minute means of a series.

A day's rollup is worked out again from that day's stored rows whenever a batch touches it and replaces
the day whole, so a repeated batch, or one that failed half way, changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.functions.times import Instant, instant, span
from tidewarden.operators.series import of_key
from tidewarden.schemas import TableSpec
from tidewarden.sources.folders import children
from tidewarden.sources.tables import read_folders, stored_days, table_path

DAY = timedelta(hours=24)


def _metrics(spec: TableSpec) -> list[str]:
    return [f.name for f in spec.schema.fields if isinstance(f.dataType, T.NumericType)]


def rollup_schema(spec: TableSpec) -> T.StructType:
    """The key, the minute, the newest time in it, and a sum and a count of each metric."""
    fields = [spec.schema[spec.key[0]], T.StructField("minute", T.TimestampType()),
              T.StructField("last_ts", T.TimestampType()), T.StructField("readings", T.LongType())]
    for name in _metrics(spec):
        fields += [T.StructField(f"sum_{name}", T.DoubleType()), T.StructField(f"n_{name}", T.LongType())]
    return T.StructType([*fields, T.StructField("day", T.DateType())])


def minute_rollup(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """A row for each key and minute, as in ``rollup_schema``."""
    key, ts = spec.key
    sums = [column for name in _metrics(spec) for column in (
        F.sum(F.col(name).cast("double")).alias(f"sum_{name}"), F.count(name).alias(f"n_{name}"))]
    return rows.filter(F.col(ts).isNotNull()).groupBy(key, F.date_trunc("minute", ts).alias("minute")).agg(
        F.max(ts).alias("last_ts"), F.count("*").alias("readings"), *sums).withColumn(
            "day", F.to_date("minute")).select(*rollup_schema(spec).names)


def _path(root: str, spec: TableSpec) -> str:
    return f"{table_path(root, spec)}_minutes"


def update_rollup(spark: SparkSession, root: str, spec: TableSpec, days: Iterable[date]) -> None:
    """Renews the rollup of some days from their stored rows. For one writer; safe to repeat."""
    days = list(days)
    if days:
        (minute_rollup(read_folders(spark, root, spec, days), spec).hint("rebalance", "day")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day").parquet(_path(root, spec)))


def complete_rollup(spark: SparkSession, root: str, spec: TableSpec) -> None:
    """Adds the days that have no rollup yet: those of a table of before it was kept."""
    known = set(children(spark, _path(root, spec)))
    update_rollup(spark, root, spec, [day for day in stored_days(spark, root, spec)
                                      if f"day={day.isoformat()}" not in known])


def read_rollup(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    if not any(name.startswith("day=") for name in children(spark, _path(root, spec))):
        return spark.createDataFrame([], rollup_schema(spec))
    return spark.read.schema(rollup_schema(spec)).parquet(_path(root, spec))


def rolled_means(spark: SparkSession, root: str, spec: TableSpec, as_of: Instant = None,
                 back: timedelta = DAY, only=None) -> DataFrame:
    """Means per key and minute over the trailing span, in the columns of the table, in time order.

    The minutes that the span's ends cut through are taken from the stored rows of these two minutes'
    days, all others from the rollup.
    """
    key, ts = spec.key
    now = spark.range(1).select(instant(as_of).alias("now"), (instant(as_of) - span(back)).alias("start"))
    ends = now.first()
    low, high = F.lit(ends.start), F.lit(ends.now)
    inside = of_key(read_rollup(spark, root, spec), key, only).filter(
        F.col("day").between(F.to_date(low), F.to_date(high))
        & (F.col("minute") >= low) & (F.col("minute") + F.expr("INTERVAL 1 MINUTE") <= high))
    cut = of_key(read_folders(spark, root, spec, {ends.start.date(), ends.now.date()}), key, only).filter(
        F.col(ts).between(low, high)
        & ((F.date_trunc("minute", ts) < low)
           | (F.date_trunc("minute", ts) + F.expr("INTERVAL 1 MINUTE") > high)))
    rolled = inside.unionByName(minute_rollup(cut, spec))
    return rolled.select(key, F.col("minute").alias(ts), *[
        F.try_divide(f"sum_{name}", f"n_{name}").alias(name) for name in _metrics(spec)]).orderBy(key, ts)


def rolled_summary(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """Readings, newest time and whether each metric has any value, of every key, over all days."""
    return read_rollup(spark, root, spec).groupBy(spec.key[0]).agg(
        F.sum("readings").alias("readings"), F.max("last_ts").alias("last_ts"),
        *[(F.sum(f"n_{name}") > 0).alias(f"has_{name}") for name in _metrics(spec)])
