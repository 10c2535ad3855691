"""History tables laid out by day and key."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidewarden.schemas import ALERTS_HISTORY
from tidewarden.schemas import HYDRO_MEASUREMENTS as SPEC
from tidewarden.sources import tables
from tidewarden.sources.latest import latest_of_table, update_latest
from tidewarden.streaming.jobs import complete_days
from tidewarden.plans.training import read_days_of_levels

DAY = 86_400
NOON = 1_781_006_400  # 2026-06-09 12:00 UTC


def rows_of(spark, gauges, days, level=1):
    """A reading of each gauge on each day."""
    return spark.createDataFrame(
        [(f"H_{g}", NOON + DAY * d, level) for g in gauges for d in days],
        "gauge_id string, s long, water_level_cm int").select(
            "gauge_id", F.timestamp_seconds("s").alias("measurement_timestamp"), "water_level_cm",
            F.lit(None).cast("double").alias("flow_m3s"), F.lit(False).alias("is_warning"),
            F.timestamp_seconds("s").alias("ingestion_timestamp"))


def folders(rows):
    """Day and bucket folders of the files that a frame opens."""
    return {tuple(name.split("/")[-3:-1]) for name in rows.inputFiles()}


def test_insert_opens_the_buckets_of_its_keys(spark, tmp_path):
    root = str(tmp_path)
    tables.create_tables(spark, root, [SPEC], buckets=16)
    assert tables.insert_absent(rows_of(spark, range(200), range(4)), root, SPEC) == 800
    stored = tables.stored_rows(rows_of(spark, [7], [1, 2]), root, SPEC)
    assert len(folders(stored)) == 2 and {d for d, _ in folders(stored)} == {
        "day=2026-06-10", "day=2026-06-11"}
    # A bucket that no key of the batch falls in may hold anything.
    used = {b for _, b in folders(stored)}
    other = next(b for b in os.listdir(f"{root}/{SPEC.name}/day=2026-06-10") if b not in used)
    (tmp_path / SPEC.name / "day=2026-06-10" / other / "part.parquet").write_text("no Parquet")
    assert tables.insert_absent(rows_of(spark, [7], [1, 2, 9], level=5), root, SPEC) == 1
    assert tables.stored_rows(rows_of(spark, [7], [1]), root, SPEC).filter(
        "gauge_id = 'H_7' AND water_level_cm = 1").count() == 1


def test_series_of_a_gauge_opens_a_bucket_of_each_day(spark, tmp_path):
    root = str(tmp_path)
    tables.create_tables(spark, root, [SPEC], buckets=16)
    tables.insert_absent(rows_of(spark, range(200), range(6)), root, SPEC)
    series = tables.read_days(spark, root, SPEC, "2026-06-12 13:00:00", key="H_7")
    assert len(series.collect()) == 2
    plan = series._jdf.queryExecution().executedPlan().toString()
    # Two days of one bucket, of 6 days of 16.
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "bucket#" in scan.split("PartitionFilters: [")[1].split("]")[0]
    read = {tuple(r.name.split("/")[-3:-1]) for r in series.select(
        F.input_file_name().alias("name")).collect()}
    assert len(read) == 2 and len({bucket for _, bucket in read}) == 1


def test_tables_by_day_alone_stay_readable(spark, tmp_path):
    root = str(tmp_path)
    tables.create_tables(spark, root, [SPEC])
    tables.insert_absent(rows_of(spark, range(5), range(2)), root, SPEC)
    tables.create_tables(spark, root, [SPEC], buckets=8)  # there is one already
    assert tables.buckets_of(spark, root, SPEC) == 0
    assert tables.insert_absent(rows_of(spark, range(6), range(3)), root, SPEC) == 8
    assert tables.read_days(spark, root, SPEC, "2026-06-10 12:00:00", key="H_3").count() == 2


def test_all_readers_see_the_same_columns(spark, tmp_path):
    root = str(tmp_path)
    tables.create_tables(spark, root, buckets=4)
    given = rows_of(spark, range(20), range(3))
    tables.insert_absent(given, root, SPEC)
    update_latest(given, root, SPEC)
    assert tables.read_table(spark, root, SPEC).columns == SPEC.stored_schema.names
    tables.register_tables(spark, root)
    assert spark.sql("SELECT count(*) FROM hydro_measurements").first()[0] == 60
    assert latest_of_table(spark, root, SPEC, "2026-06-10 00:00:00").count() == 20
    complete_days(spark, root)
    assert read_days_of_levels(spark, root).count() == 60
    before = sorted(tables.read_table(spark, root, SPEC).collect())
    tables.insert_absent(rows_of(spark, [50], range(3)), root, SPEC)
    tables.compact(spark, root, SPEC, tables.stored_days(spark, root, SPEC))
    after = tables.read_table(spark, root, SPEC)
    assert sorted(after.filter("gauge_id <> 'H_50'").collect()) == before
    assert all(b.startswith("bucket=") for _, b in folders(after))


def test_undated_keys_have_buckets(spark, tmp_path):
    root = str(tmp_path)
    tables.create_tables(spark, root, [ALERTS_HISTORY], buckets=4)
    rows = spark.range(100).select(*[
        (F.concat(F.lit("odd-"), F.col("id").cast("string")) if f.name == "alert_id"
         else F.lit(None)).cast(f.dataType).alias(f.name) for f in ALERTS_HISTORY.schema.fields])
    assert tables.insert_absent(rows, root, ALERTS_HISTORY) == 100
    assert tables.insert_absent(rows, root, ALERTS_HISTORY) == 0
