"""History tables: Parquet partitioned by day, written insert-if-absent.

A table may be laid out by key as well: each day's folder then has one for each bucket, by a hash of the
key's first column, so an insert opens only the buckets that its keys fall in, and a series of one
station opens one bucket of each day. The layout is fixed when the table is created and told by a
mark in its folder; a table without the mark lies by day alone. Rows read have no bucket column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.functions.times import Instant, instant, span
from tidewarden.operators.dedup import first_per_key
from tidewarden.operators.joins import only_new
from tidewarden.schemas import TABLES, TableSpec
from tidewarden.session import shared_folder
from tidewarden.sources.folders import children, make


def table_path(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/{spec.name}"


#: Name of the folder that tells a table's number of buckets; hidden from readers.
_MARK = "_buckets-"


def buckets_of(spark: SparkSession, root: str, spec: TableSpec) -> int:
    """Buckets of each day of the table; 0 if it lies by day alone."""
    for name in children(spark, table_path(root, spec)):
        if name.startswith(_MARK):
            return int(name.removeprefix(_MARK))
    return 0


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _placed(rows: DataFrame, spec: TableSpec, buckets: int) -> tuple[DataFrame, list[str]]:
    """The rows with their partition columns, and the names of these."""
    placed = rows.withColumn("day", spec.stored_day())
    if not buckets:
        return placed, ["day"]
    return placed.withColumn("bucket", _bucket(F.col(spec.key[0]), buckets)), ["day", "bucket"]


def _scan(spark: SparkSession, root: str, spec: TableSpec, buckets: int,
          paths: Sequence[str] = ()) -> DataFrame:
    """The table, or some folders of it, with all partition columns."""
    schema = spec.stored_schema
    if buckets:
        schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    base = table_path(root, spec)
    return spark.read.schema(schema).option("basePath", base).parquet(*(paths or [base]))


def create_tables(spark: SparkSession, root: str,
                  specs: Sequence[TableSpec] = tuple(TABLES.values()), buckets: int = 0) -> None:
    """Creates the tables that do not exist yet, with so many buckets a day."""
    for spec in specs:
        path = table_path(root, spec)
        if buckets and not children(spark, path):
            make(spark, f"{path}/{_MARK}{buckets}")
        (spark.createDataFrame([], spec.stored_schema).write.mode("ignore")
         .partitionBy("day").parquet(path))


def read_table(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    return _scan(spark, root, spec, buckets_of(spark, root, spec)).drop("bucket")


def read_days(spark: SparkSession, root: str, spec: TableSpec, as_of: Instant = None,
              back: timedelta = timedelta(hours=24),
              ahead: timedelta = timedelta(0), key: str | None = None) -> DataFrame:
    """The table's days that ``[as_of - back, as_of + ahead]`` touches: what a trailing series
    needs of it, of one ``key`` or of all. For tables whose day is that of their time column."""
    now = instant(as_of)
    buckets = buckets_of(spark, root, spec)
    rows = _scan(spark, root, spec, buckets).filter(
        F.col("day").between(F.to_date(now - span(back)), F.to_date(now + span(ahead))))
    if key is not None:
        rows = rows.filter(F.col(spec.key[0]) == key)
        if buckets:
            rows = rows.filter(F.col("bucket") == _bucket(F.lit(key), buckets))
    return rows.drop("bucket")


def read_folders(spark: SparkSession, root: str, spec: TableSpec, days: Iterable[date],
                 parts: Iterable[tuple[date, int]] | None = None) -> DataFrame:
    """The rows of some days; only the folders of these are listed and opened. With ``parts``, of a
    table with buckets, only those of these days and buckets."""
    base = table_path(root, spec)
    buckets = buckets_of(spark, root, spec)
    wanted = {f"day={day.isoformat()}" for day in days}
    present = [name for name in children(spark, base) if name in wanted] if wanted else []
    if parts is not None:
        inside = {f"day={day.isoformat()}/bucket={bucket}" for day, bucket in parts}
        present = [f"{day}/{name}" for day in present for name in children(spark, f"{base}/{day}")
                   if f"{day}/{name}" in inside]
    if not present:
        return spark.createDataFrame([], spec.stored_schema)
    return _scan(spark, root, spec, buckets, [f"{base}/{name}" for name in present]).drop("bucket")


def register_tables(spark: SparkSession, root: str, back: timedelta = timedelta(hours=24),
                    ahead: timedelta = timedelta(hours=4)) -> None:
    """Makes the history tables known to SQL under their own names, with their ``day``, and as
    ``<name>_recent`` the days from ``back`` before now to ``ahead`` after it, for statements about
    the last hours: only these days' folders are opened."""
    for spec in TABLES.values():
        read_table(spark, root, spec).createOrReplaceTempView(spec.name)
        read_days(spark, root, spec, None, back, ahead).createOrReplaceTempView(
            f"{spec.name}_recent")


def keyless(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that cannot be stored, as a part of their key is missing."""
    missing = F.lit(False)
    for name in spec.key:
        missing = missing | F.col(name).isNull()
    return rows.filter(missing)


def absent_rows(rows: DataFrame, stored: DataFrame, key: Sequence[str],
                order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key that is not stored yet; rows with a null in the key are left out.
    """
    return only_new(first_per_key(rows.na.drop(subset=list(key)), key, order), stored, key)


def touched_days(rows: DataFrame, spec: TableSpec) -> list[date]:
    """The days that the rows' keys fall on, one value per day."""
    days = rows.na.drop(subset=list(spec.key)).select(spec.stored_day().alias("day")).distinct()
    return sorted(d.day for d in days.collect())


def stored_rows(rows: DataFrame, root: str, spec: TableSpec) -> DataFrame:
    """The stored rows of the days, and buckets, that ``rows`` touch, which hold every key they may
    share: a row's place follows from its key. One value per day or bucket reaches the driver."""
    spark = rows.sparkSession
    buckets = buckets_of(spark, root, spec)
    if not buckets:
        return read_folders(spark, root, spec, touched_days(rows, spec))
    placed, names = _placed(rows.na.drop(subset=list(spec.key)), spec, buckets)
    parts = {(p.day, p.bucket) for p in placed.select(*names).distinct().collect()}
    return read_folders(spark, root, spec, {day for day, _ in parts}, parts)


def stored_days(spark: SparkSession, root: str, spec: TableSpec) -> list[date]:
    """The days that the table holds, from its folder's names alone."""
    return [date.fromisoformat(name.removeprefix("day="))
            for name in children(spark, table_path(root, spec)) if name.startswith("day=")]


def insert_absent(rows: DataFrame, root: str, spec: TableSpec,
                  order: Sequence[str | Column] = ("ingestion_timestamp",)) -> int:
    """Appends the rows whose key the table does not hold; the first writer wins. Returns the
    number of rows added.

    Safe to repeat for one writer per table. The check joins on day and key, with one plan for every
    size. The rebalance keeps files large and splits a day that is too big for one task. ``rows``
    are read twice, for their days and for themselves: cache them if they are costly.
    """
    placed, names = _placed(rows, spec, buckets_of(rows.sparkSession, root, spec))
    stored = stored_rows(rows, root, spec)
    added = Observation()
    fresh = only_new(first_per_key(placed.na.drop(subset=list(spec.key)), spec.key, order), stored,
                     ["day", *spec.key])
    (fresh.select(*spec.schema.names, *names).hint("rebalance", *names)
     .observe(added, F.count(F.lit(1)).alias("rows"))
     .write.mode("append").partitionBy(*names).parquet(table_path(root, spec)))
    return added.get.get("rows", 0)


def compact(spark: SparkSession, root: str, spec: TableSpec, days: Iterable[date]) -> None:
    """Rewrites some days into few files each. For the table's writer, between two of its batches.

    The rows are first copied to the shared folder, so that a failed rewrite can be repeated from
    there; each day is replaced whole.
    """
    copy = shared_folder(spark, f"compact-{spec.name}")
    read_folders(spark, root, spec, days).write.parquet(copy)
    rows = spark.read.schema(spec.stored_schema).parquet(copy).select(*spec.schema.names)
    placed, names = _placed(rows, spec, buckets_of(spark, root, spec))
    (placed.hint("rebalance", *names).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*names)
     .parquet(table_path(root, spec)))
