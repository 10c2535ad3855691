"""What the optimizer makes of the queries: the properties they rely on at scale."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from checks.standins import QUERIES
from tidewarden.schemas import ALERTS_HISTORY, HYDRO_PREDICTIONS, TABLES
from tidewarden.sources import tables

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def plan_of(spark, name):
    return plan(QUERIES[name](spark, SF_DIR))


BATCH = [n for n in QUERIES
         if not n.endswith(("_stream", "_job", "_history", "_export"))]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_no_row_at_a_time_python(spark, name):
    text = plan_of(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text


@pytest.mark.parametrize("name", [
    "dedup_first", "current_alerts", "recent_three", "recent_levels", "latest_text"])
def test_rank_filters_limit_groups_ahead_of_the_shuffle(spark, name):
    text = plan_of(spark, name)
    assert "WindowGroupLimit" in text and "row_number()" in text
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


@pytest.mark.parametrize("name", [
    "sliding_delta", "storm_alerts", "flood_alerts", "latest_weather", "latest_hydro",
    "ols_stats", "weather_series", "last_weather"])
def test_aggregates_stay_hash_aggregates_with_a_partial_step(spark, name):
    text = plan_of(spark, name)
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert "partial_" in text


@pytest.mark.parametrize("name, pushed", [
    ("latest_weather", "LessThanOrEqual(ts,2024-01-20T00:00)"),
    ("weather_series", "GreaterThanOrEqual(ts,2024-01-19T00:00)"),
    ("hydro_series", "GreaterThanOrEqual(ts,2024-01-19T00:00)"),
    ("measured_series", "EqualTo(event_type,error)")])
def test_filters_reach_the_scan(spark, name, pushed):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES[name](spark, SF_DIR).explain("formatted")
    assert pushed in out.getvalue()


def test_scan_reads_the_needed_columns_only(spark):
    text = plan_of(spark, "recent_levels")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text


def test_top_k_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "measured_series")
    assert "TakeOrderedAndProject" in plan_of(spark, "weather_stations")


def test_messages_are_parsed_once(spark):
    assert plan_of(spark, "json_decode").count("from_json(StructField(k") == 2  # input and value


def test_features_shuffle_the_readings_once(spark):
    df = QUERIES["lag_lead_busy_keys"](spark, SF_DIR)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_large_dictionaries_are_not_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan_of(spark, "storm_alerts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "SortMergeJoin" in plan_of(spark, "storm_alerts")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_insert_opens_only_the_days_of_its_batch(spark, tmp_path):
    root, spec = str(tmp_path), HYDRO_PREDICTIONS
    tables.create_tables(spark, root, [spec])

    def rows(first, last):
        return spark.range(first, last).select(
            F.lit("a").alias("gauge_id"),
            F.timestamp_seconds(F.col("id") * 3600 + 1_700_000_000).alias("prediction_timestamp"),
            F.lit(1.0).alias("predicted_water_level"), F.lit(2).alias("horizon_hours"),
            F.current_timestamp().alias("created_at"))

    assert tables.insert_absent(rows(0, 240), root, spec, ["created_at"]) == 240
    stored = tables.stored_rows(rows(230, 250), root, spec)
    assert len({name.rsplit("/", 2)[1] for name in stored.inputFiles()}) == 1
    # A folder that no batch touches may hold anything.
    (tmp_path / spec.name / "day=2020-01-01").mkdir()
    (tmp_path / spec.name / "day=2020-01-01" / "part.parquet").write_text("no Parquet")
    assert tables.insert_absent(rows(230, 250), root, spec, ["created_at"]) == 10
    assert tables.insert_absent(rows(0, 260), root, spec, ["created_at"]) == 10


def test_undated_rows_are_dealt_over_folders(spark, tmp_path):
    root, spec = str(tmp_path), ALERTS_HISTORY
    tables.create_tables(spark, root, [spec])
    rows = spark.range(300).select(*[
        (F.concat(F.lit("odd-"), F.col("id").cast("string")) if f.name == "alert_id"
         else F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.schema.fields])
    assert tables.insert_absent(rows, root, spec) == 300
    assert tables.insert_absent(rows, root, spec) == 0
    stored = tables.read_table(spark, root, spec)
    assert stored.filter("day IS NULL").isEmpty()
    assert stored.groupBy("day").count().filter("count > 30").isEmpty()


def test_compaction_keeps_the_rows_and_leaves_few_files(spark, tmp_path):
    root, spec = str(tmp_path), HYDRO_PREDICTIONS
    tables.create_tables(spark, root, [spec])
    for i in range(4):
        at = F.timestamp_seconds(F.lit(1_700_000_000 + 60 * i))
        tables.insert_absent(spark.range(1).select(
            F.lit("a").alias("gauge_id"), at.alias("prediction_timestamp"),
            F.lit(1.0).alias("predicted_water_level"), F.lit(2).alias("horizon_hours"),
            at.alias("created_at")), root, spec, ["created_at"])
    before = tables.read_table(spark, root, spec)
    rows, days = before.collect(), [r.day for r in before.select("day").distinct().collect()]
    assert len(before.inputFiles()) >= 4
    tables.compact(spark, root, spec, days)
    after = tables.read_table(spark, root, spec)
    assert sorted(after.collect()) == sorted(rows) and len(after.inputFiles()) == 1


@pytest.mark.parametrize("statement", [
    "SELECT avg(temperature) FROM synop_measurements_recent WHERE station_id = 'a'"
    " AND measurement_timestamp >= now() - INTERVAL '24 hours'",
    "SELECT * FROM hydro_measurements_recent WHERE gauge_id = 'a'"
    " AND measurement_timestamp >= now() - INTERVAL '24 hours'",
    "SELECT * FROM hydro_predictions_recent WHERE prediction_timestamp"
    " <= now() + INTERVAL '4 hours'",
    "SELECT * FROM hydro_measurements WHERE day = DATE '2024-01-01'"])
def test_statements_prune_days(spark, tmp_path, statement):
    tables.create_tables(spark, str(tmp_path))
    for spec in TABLES.values():
        tables.insert_absent(spark.range(1).select(*[
            (F.current_timestamp() if "timestamp" in f.name else F.lit("1")).cast(f.dataType)
            .alias(f.name) if f.name in spec.key else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spec.schema.fields]), str(tmp_path), spec, spec.key)
    tables.register_tables(spark, str(tmp_path))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        spark.sql(statement).explain("formatted")
    assert "day#" in out.getvalue().split("PartitionFilters: [")[1].split("]")[0]


def test_trailing_reads_touch_only_their_days(spark, tmp_path):
    root, spec = str(tmp_path), HYDRO_PREDICTIONS
    tables.create_tables(spark, root, [spec])
    at = F.lit("2026-06-09 11:00:00").cast("timestamp")
    tables.insert_absent(spark.range(1).select(
        F.lit("a").alias("gauge_id"), at.alias("prediction_timestamp"),
        F.lit(1.0).alias("predicted_water_level"), F.lit(2).alias("horizon_hours"),
        at.alias("created_at")), root, spec, ["created_at"])
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        tables.read_days(spark, root, spec, "2026-06-09 10:00:00").explain("formatted")
    assert "PartitionFilters: [" in out.getvalue()
    assert "(day#" in out.getvalue().split("PartitionFilters: [")[1].split("]")[0]
