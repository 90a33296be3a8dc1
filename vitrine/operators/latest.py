"""Newest version of each key in a change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order_col: str | list[str], nulls: str = "first") -> DataFrame:
    """One row per key: the one with the greatest ``order_col``.

    Of several order columns the later ones decide between rows that are equal in the earlier ones. Where
    the columns given do not tell two rows of a key apart, which of them is taken is open.

    ``nulls="first"`` lets a NULL order value win, as a descending sort does in the warehouse dialect.
    The rank filter is planned as a WindowGroupLimit on both sides of the shuffle, so a task sends at
    most one row per key however many copies of that key it read.
    """
    columns = [F.col(c) for c in ([order_col] if isinstance(order_col, str) else order_col)]
    order = [c.desc_nulls_first() if nulls == "first" else c.desc_nulls_last() for c in columns]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
