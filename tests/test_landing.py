"""Tables landed as streams of several batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins


def test_landed_batches_have_files_for_their_size(spark, tmp_path, monkeypatch):
    """More rows lie in more files, each key in one, and a part with few keys sets the number."""
    monkeypatch.setattr(standins, "FILE_ROWS", 50)
    many = spark.range(2000).select((F.col("id") % 1000).alias("key"), "id")
    few = spark.range(4000).select((F.col("id") % 5).alias("key"), "id")
    unkeyed = many.withColumn("key", F.when(F.col("id") > 9, F.col("key")))
    files = standins.files_for([many, many], "key")
    assert files == 32
    assert standins.files_for([many, few], "key") < 8
    assert standins.files_for([many, unkeyed.filter("key IS NULL")], "key") == 1
    standins.land(many, str(tmp_path / "landed"), "key", ["id"], files)
    places = spark.read.parquet(str(tmp_path / "landed")).withColumn("file", F.input_file_name())
    assert places.select("file").distinct().count() == files
    assert places.select("file", "key").distinct().count() == 1000
