"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.session import shared_folder


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table below ``spark.checkpoint.dir``: lineage ends here, and a lost
    executor costs nothing that was computed before."""
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def text_of(name: str) -> Column:
    """A text column; null is the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ship_package(spark: SparkSession) -> None:
    """Sends this package's modules to the executors once, for functions that run there."""
    context = spark.sparkContext
    if getattr(context, "_tidewarden_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="modules-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for module in sorted(root.rglob("*.py")):
            archive.write(module, module.relative_to(root.parent))
    context.addPyFile(str(target))
    context._tidewarden_shipped = True
