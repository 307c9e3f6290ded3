"""Most frequent value per group, in two aggregation levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mode_per_group(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """(key, alias): the most frequent non-null value; ties go to the smallest; all-null -> NULL.

    Values are counted per (key, value) first, so no task holds the distinct values of a group.
    """
    counts = df.groupBy(key, F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.when(F.col("_value").isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col("_value")))
    return counts.groupBy(key).agg(F.min_by("_value", rank).alias(alias))
