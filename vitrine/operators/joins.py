"""Many-to-one joins whose many side may be dominated by one key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HASHABLE = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _row_hash(df: DataFrame, on: list[str], spread: list[str] | None) -> Column:
    others = [f.name for f in df.schema.fields if f.name not in on and isinstance(f.dataType, _HASHABLE)]
    # One column by default: a hash of whole rows would keep unused columns alive through the shuffle.
    return F.xxhash64(*(spread or others[:1] or on))


def _hash_input(name: str, a: T.DataType, b: T.DataType) -> Column:
    """The key column in a form that hashes alike on both sides wherever the join finds it equal."""
    if a != b and not (isinstance(a, T.NumericType) and isinstance(b, T.NumericType)):
        raise TypeError(f"join column {name}: {a.simpleString()} against {b.simpleString()}")
    if a != b or isinstance(a, (T.DoubleType, T.FloatType)):
        return F.col(name).cast("double") + F.lit(0.0)
    return F.col(name)


def lookup(
    rows: DataFrame,
    reference: DataFrame,
    on: list[str],
    how: str = "left",
    null_safe: bool = False,
    spread: list[str] | None = None,
) -> DataFrame:
    """Join ``rows`` to ``reference`` (one row per key) on equally named columns.

    The reference side is broadcast only when the optimiser, or AQE with measured sizes, finds it
    under ``autoBroadcastJoinThreshold``; there is no hint. Past that size it is a sort-merge join,
    made safe for hot keys in two steps:

    * AQE splits a hot partition only if both inputs of the join come straight from an exchange. A
      reference that was just de-duplicated or aggregated by its key would skip that exchange, so a
      hash of the key joins the condition: neither side is partitioned by it yet, both get exchanged.
    * Rows with a NULL key can match nothing, so their hash is taken from ``spread``, columns that tell
      rows apart (by default the first that is no key). They spread over all partitions instead of
      meeting in one.
    """
    shared = set(rows.columns) & set(reference.columns) - set(on)
    if shared and how not in ("left_anti", "left_semi"):
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    slot = F.xxhash64(*[_hash_input(k, rows.schema[k].dataType, reference.schema[k].dataType) for k in on])
    if not null_safe:
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
        left = rows.withColumn("_slot", F.when(missing, _row_hash(rows, on, spread)).otherwise(slot))
    else:
        left = rows.withColumn("_slot", slot)
    left = left.alias("_row")
    right = reference.withColumn("_slot", slot).alias("_ref")

    condition = F.col("_row._slot") == F.col("_ref._slot")
    for k in on:
        a, b = F.col(f"_row.{k}"), F.col(f"_ref.{k}")
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)

    joined = left.join(right, condition, how)
    keep = [F.col(f"_row.{c}") for c in rows.columns]
    if how not in ("left_anti", "left_semi"):
        keep += [F.col(f"_ref.{c}") for c in reference.columns if c not in on]
    return joined.select(*keep)
