"""Severity classes from a table of thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_SEVERE_FIRST = ("Red", "Orange", "Yellow")


@dataclass(frozen=True)
class Rule:
    """Lowest value of ``metric`` for each severity."""

    metric: str
    levels: Mapping[str, float]


def severity(rules: Sequence[Rule]) -> Column:
    """The highest severity that any metric reaches; null if none does.

    A missing metric never fires and does not keep another one from firing.
    """
    result = F.lit(None).cast("string")
    for name in reversed(MOST_SEVERE_FIRST):
        reached = reduce(or_, (F.col(r.metric) >= r.levels[name] for r in rules))
        result = F.when(reached, F.lit(name)).otherwise(result)
    return result


def classified(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that reach a severity, with it in ``severity``."""
    return df.withColumn("severity", severity(rules)).filter(F.col("severity").isNotNull())
