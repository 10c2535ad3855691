"""Training from statistics that are kept per gauge and day, so that no retraining reads the history.

A day's row of a gauge holds the number of its readings, count, means and co-moments of the complete
cases whose lags and leads all lie inside the day, and the readings near the day's ends. Training merges
the rows of all days pairwise and adds the cases that reach over the ends of days, which the kept
readings give. A late reading changes the row of its own day alone; what it does to cases of the
neighbouring days follows from the kept ends at the next training.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.plans.forecast import HORIZONS, LAGS, MIN_COMPLETE, MIN_HISTORY
from tidewarden.operators.regression import solved
from tidewarden.schemas import HYDRO_MEASUREMENTS
from tidewarden.sources.folders import children
from tidewarden.sources.tables import read_folders, stored_days, table_path

TARGETS = tuple(f"lead_{h}" for h in HORIZONS)
CASE = (*LAGS, *TARGETS)
#: Pairs of a case's values that have a co-moment: all with an input.
PAIRS = tuple((i, j) for i in range(len(LAGS)) for j in range(i, len(CASE)))
BACK, AHEAD = len(LAGS) - 1, max(HORIZONS)

_DOUBLES = T.ArrayType(T.DoubleType())
_END = T.StructType([
    T.StructField("ts", T.TimestampType()), T.StructField("level", T.IntegerType()),
    T.StructField("inside", T.BooleanType())])
LEVEL_DAYS = T.StructType([
    T.StructField("gauge_id", T.StringType()), T.StructField("readings", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("means", _DOUBLES),
    T.StructField("moments", _DOUBLES), T.StructField("ends", T.ArrayType(_END)),
    T.StructField("day", T.DateType())])


def _shifted(level: str, window) -> list[Column]:
    lags = [F.lag(level, i).over(window).alias(name) for i, name in enumerate(LAGS)]
    return lags + [F.lead(level, h).over(window).alias(f"lead_{h}") for h in HORIZONS]


def _moments(counted: Column) -> list[Column]:
    """Count, means and co-moments of the rows for which ``counted`` holds."""
    case = [F.when(counted, F.col(c)).cast("double") for c in CASE]
    n = F.count_if(counted)
    return [n.alias("n"),
            F.array(*[F.coalesce(F.avg(c), F.lit(0.0)) for c in case]).alias("means"),
            F.array(*[F.coalesce(F.covar_pop(case[i], case[j]) * n, F.lit(0.0))
                      for i, j in PAIRS]).alias("moments")]


def _complete() -> Column:
    present = F.lit(True)
    for name in CASE:
        present = present & F.col(name).isNotNull()
    return present


def day_statistics(history: DataFrame, gauge: str = "gauge_id", ts: str = "measurement_timestamp",
                   level: str = "water_level_cm") -> DataFrame:
    """A row for each gauge and day of the history, as in ``LEVEL_DAYS``."""
    within = Window.partitionBy("gauge_id", "day").orderBy("ts")
    placed = history.select(
        F.col(gauge).alias("gauge_id"), F.col(ts).alias("ts"),
        F.col(level).cast("int").alias("level"), F.to_date(ts).alias("day"),
    ).filter("day IS NOT NULL").select(
        "gauge_id", "day", "ts", "level", *_shifted("level", within),
        (F.row_number().over(within) - 1).alias("before"),
        F.count("*").over(Window.partitionBy("gauge_id", "day")).alias("size"))
    after = F.col("size") - F.col("before") - 1
    inside = (F.col("before") >= BACK) & (after >= AHEAD)
    near = (F.col("before") < BACK + AHEAD) | (after < BACK + AHEAD)
    return placed.groupBy("gauge_id", "day").agg(
        F.count("*").alias("readings"), *_moments(inside & _complete()),
        F.sort_array(F.collect_list(F.when(near, F.struct("ts", "level", inside.alias("inside")))))
        .alias("ends")).select(*LEVEL_DAYS.names)


def merged(a: Column, b: Column) -> Column:
    """Count, means and co-moments of two sets together."""
    n = (a["n"] + b["n"]).cast("long")
    share = F.when(n > 0, b["n"] / n).otherwise(F.lit(0.0))
    apart = F.zip_with(a["means"], b["means"], lambda x, y: y - x)
    weight = a["n"] * share
    return F.struct(
        n.alias("n"),
        F.zip_with(a["means"], apart, lambda x, d: x + d * share).alias("means"),
        F.array(*[a["moments"][k] + b["moments"][k] + apart[i] * apart[j] * weight
                  for k, (i, j) in enumerate(PAIRS)]).alias("moments"))


def _over_day_ends(days: DataFrame) -> DataFrame:
    """Count, means and co-moments of each gauge's cases that reach over the ends of days."""
    across = Window.partitionBy("gauge_id").orderBy("ts")
    ends = days.select("gauge_id", F.inline("ends")).select(
        "gauge_id", "inside", *_shifted("level", across))
    return ends.groupBy("gauge_id").agg(*_moments(~F.col("inside") & _complete()))


def stats_from_days(days: DataFrame, min_complete: int = MIN_COMPLETE) -> DataFrame:
    """Per gauge with enough complete cases: count, means and covariances. A gauge's days are merged in
    their order, so the result doesn't depend on how they are read."""
    columns = ["gauge_id", "day", "n", "means", "moments"]
    parts = days.select(*columns).union(
        _over_day_ends(days).withColumn("day", F.lit(None).cast("date")).select(*columns))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.array_repeat(F.lit(0.0), len(CASE)).alias("means"),
                    F.array_repeat(F.lit(0.0), len(PAIRS)).alias("moments"))
    whole = parts.filter("n > 0").groupBy("gauge_id").agg(F.sort_array(
        F.collect_list(F.struct("day", "n", "means", "moments"))).alias("parts")).select(
            "gauge_id", F.aggregate("parts", zero, merged).alias("all"))
    return whole.select(
        "gauge_id", F.col("all.n").alias("n"),
        *[F.col("all.means")[i].alias(f"mean_{c}") for i, c in enumerate(CASE)],
        *[(F.col("all.moments")[k] / F.col("all.n")).alias(f"cov_{CASE[i]}_{CASE[j]}")
          for k, (i, j) in enumerate(PAIRS)]).filter(F.col("n") >= min_complete)


def models_from_days(days: DataFrame, min_history: int = MIN_HISTORY,
                     min_complete: int = MIN_COMPLETE) -> DataFrame:
    """The models that training on the history behind the days would give."""
    readings = days.agg(F.sum("readings").alias("n")).scalar()
    stats = stats_from_days(days, min_complete).filter(readings >= min_history)
    return solved(stats, "gauge_id", LAGS, {f"lead_{h}": h for h in HORIZONS})


def _days_path(root: str) -> str:
    return f"{table_path(root, HYDRO_MEASUREMENTS)}_days"


def read_days_of_levels(spark: SparkSession, root: str) -> DataFrame:
    """The kept statistics of all days."""
    if not any(name.startswith("day=") for name in children(spark, _days_path(root))):
        return spark.createDataFrame([], LEVEL_DAYS)
    return spark.read.schema(LEVEL_DAYS).parquet(_days_path(root))


def update_days(spark: SparkSession, root: str, days: Iterable[date]) -> None:
    """Renews the statistics of some days from these days' folders of the stored levels.

    Each day is replaced whole, so it is safe to repeat, for one writer.
    """
    days = list(days)
    if not days:
        return
    rows = read_folders(spark, root, HYDRO_MEASUREMENTS, days)
    (day_statistics(rows).hint("rebalance", "day").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(_days_path(root)))


def complete_days(spark: SparkSession, root: str) -> None:
    """Adds the statistics of days that have none yet: those of a table of before they were kept."""
    known = set(children(spark, _days_path(root)))
    update_days(spark, root, [day for day in stored_days(spark, root, HYDRO_MEASUREMENTS)
                              if f"day={day.isoformat()}" not in known])
