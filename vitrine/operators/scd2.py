"""Validity intervals replayed from a change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from vitrine.operators.joins import lookup


def scd2_replay(
    changes: DataFrame,
    entities: DataFrame,
    current: DataFrame,
    *,
    entity: str,
    keys: list[str],
    ts: str,
    tie_break: str,
    old: str,
    new: str,
    value: str,
    origin: str,
    attrs: list[str],
) -> DataFrame:
    """Half-open intervals ``[valid_from, valid_to)`` of ``value`` per ``keys``.

    ``changes``  (keys, attrs, ts, tie_break, old, new)   one row per change
    ``entities`` (entity, origin)                          when the entity came to be; one row each
    ``current``  (keys, attrs, value)                      present value, used where no change exists

    * the earliest change with a known old value adds ``[origin, ts)`` at that old value;
    * each change opens ``[ts, next ts)`` at its new value, reaching back to ``origin`` when it sits
      at the earliest instant and the earliest change has no old value;
    * keys without changes hold their present value from ``origin`` on.

    Keys of unknown entities yield nothing. Changes at one instant are ordered by ``tie_break``. A key with
    a NULL part equals no key, itself included: its changes open no intervals and its present value stands,
    but the interval before its earliest change needs no such match and is kept.

    No window takes in all rows of a key. Changes are ordered inside (key, day); what reaches across days
    comes from the first row of each day, at most one per key and day. Both steps read the same
    columns, so that they share one exchange of the changes.
    """
    dated = changes.select(*keys, *attrs, ts, tie_break, old, new).withColumn("_day", F.to_date(ts))
    in_day = Window.partitionBy(*keys, "_day").orderBy(ts, tie_break)
    rows = dated.select("*", F.lead(ts).over(in_day).alias("_next_in_day"), _opens_day(in_day).alias("_opens_day"))

    by_key = Window.partitionBy(*keys).orderBy("_day")
    first_rows = rows.filter("_opens_day").select(
        *keys,
        "_day",
        F.lead(ts).over(by_key).alias("_next_day_first"),
        (F.row_number().over(by_key) == 1).alias("_is_first_day"),
        F.first(F.struct(ts, old, new, *attrs)).over(by_key).alias("_earliest"),
    )
    spans = lookup(first_rows, entities.select(entity, origin), [entity], "inner")

    started_unpriced = F.col(f"_earliest.{old}").isNull()
    from_changes = rows.join(spans, [*keys, "_day"], "inner").select(
        *keys,
        *attrs,
        F.col(new).alias(value),
        F.when((F.col(ts) == F.col(f"_earliest.{ts}")) & started_unpriced, F.col(origin))
        .otherwise(F.col(ts))
        .alias("valid_from"),
        F.coalesce("_next_in_day", "_next_day_first").alias("valid_to"),
    )
    before = spans.filter(F.col("_is_first_day") & ~started_unpriced).select(
        *keys,
        *[F.col(f"_earliest.{a}").alias(a) for a in attrs],
        F.col(f"_earliest.{old}").alias(value),
        F.col(origin).alias("valid_from"),
        F.col(f"_earliest.{ts}").alias("valid_to"),
    )

    # The keys that have changes, one row each, out of the same exchange of the changes.
    changed_keys = first_rows.filter("_is_first_day").select(*keys)
    unchanged = lookup(current.select(*keys, *attrs, value), changed_keys, keys, "left_anti")
    from_current = lookup(unchanged, entities.select(entity, origin), [entity], "inner").select(
        *keys,
        *attrs,
        value,
        F.col(origin).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )

    return from_changes.unionByName(before).unionByName(from_current).withColumn("is_current", F.col("valid_to").isNull())


def previous_end(intervals: DataFrame, keys: list[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Each interval with the end of the one before it, as ``prev_valid_to``.

    Intervals are ordered by start, then end with the open one last. As in ``scd2_replay`` the order is
    taken inside (key, day), and only the first row of a day looks at the day before.
    """
    far = F.coalesce(F.col(end), F.lit("9999-12-31").cast("timestamp"))
    dated = intervals.select(*keys, start, end).withColumn("_far", far).withColumn("_day", F.to_date(start))
    in_day = Window.partitionBy(*keys, "_day").orderBy(start, "_far")
    whole_day = in_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = dated.select(
        "*",
        _opens_day(in_day).alias("_opens_day"),
        F.lag(end).over(in_day).alias("_prev_in_day"),
        F.last(end).over(whole_day).alias("_day_last"),
    )
    by_key = Window.partitionBy(*keys).orderBy("_day")
    carried = rows.filter("_opens_day").select(*keys, start, end, F.lag("_day_last").over(by_key).alias("prev_valid_to"))
    inside = rows.filter("not _opens_day").select(*keys, start, end, F.col("_prev_in_day").alias("prev_valid_to"))
    return carried.unionByName(inside)


def _opens_day(in_day: WindowSpec) -> Column:
    """True on the first row of the window partition. Not written as a rank: a rank filter would be pushed
    below the exchange, which could then not be shared with the rows that stay."""
    return F.lag(F.lit(1)).over(in_day).isNull()
