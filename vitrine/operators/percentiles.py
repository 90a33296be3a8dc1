"""Exact interpolated percentiles of counted values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(counted: DataFrame, group: list[str], value: str, n: str) -> DataFrame:
    """Add ``_upto`` and ``_total``: how many non-NULL values of the group are not above this one, and in all.

    ``counted`` has one row per group and value, ``n`` of each. The window sorts and spills like any
    other, so a group may have more distinct values than fit in memory, which the built-in percentile,
    holding them in a map, would not survive.
    """
    weight = F.when(F.col(value).isNotNull(), F.col(n)).otherwise(F.lit(0).cast("long"))
    ordered = Window.partitionBy(*group).orderBy(F.col(value).asc_nulls_first())
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counted.select(
        "*", F.sum(weight).over(running).alias("_upto"), F.sum(weight).over(whole).alias("_total")
    )


def percentile_of_ranked(value: str, p: float) -> Column:
    """Aggregate over a group of ``ranked`` rows: the value at fraction ``p``, between neighbours linearly."""
    position = F.lit(p) * (F.col("_total") - 1)

    def value_at(index: Column) -> Column:
        return F.min(F.when(F.col("_upto") > index, F.col(value))).cast("double")

    below, above = value_at(F.floor(position)), value_at(F.ceil(position))
    return below + (above - below) * F.max(position - F.floor(position))
