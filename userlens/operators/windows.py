"""Ranking window: first row per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import TRACK_KEYS


def top1_per_group(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """``row_number() over (partition by keys order by order) = 1``.

    Spark plans this with a partial ``WindowGroupLimit`` before the shuffle,
    so each task ships at most one row per group.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def row_number_first(footprint: DataFrame, time_col: str = "begintime") -> DataFrame:
    """First-use row per track key, time ascending with nulls first."""
    return top1_per_group(footprint, TRACK_KEYS, [F.col(time_col).asc_nulls_first()])
