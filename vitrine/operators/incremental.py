"""Results kept from one build to the next: what they hold, and how a batch of new rows moves them on.

Each function takes the state as a DataFrame and gives the next one. Storing it is up to ``vitrine.sinks``.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.operators.joins import lookup
from vitrine.operators.latest import latest_by
from vitrine.operators.scd2 import scd2_replay

#: Days that an activity mask remembers, at most: the bits of a long but its sign, and one to spare.
MASK_DAYS = 62


def newest_of(state: DataFrame, batch: DataFrame, keys: list[str], order_col: str | list[str], nulls: str = "first") -> DataFrame:
    """The newest version of each key of ``state``, which holds one per key, and a ``batch`` of further versions.

    Batches may come in any order and more than once: as the greatest version wins, folding them gives what ``latest_by``
    gives on all of them together. The batch is reduced to one row per key before it meets the state.
    """
    return latest_by(state.unionByName(latest_by(batch, keys, order_col, nulls)), keys, order_col, nulls)


def scd2_splice(
    intervals: DataFrame,
    changes: DataFrame,
    fresh: DataFrame,
    entities: DataFrame,
    current: DataFrame,
    again: DataFrame | None = None,
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
    """What ``scd2_replay`` gives on all ``changes``, from the ``intervals`` it gave before the ``fresh`` ones came.

    ``changes``  all changes, the fresh ones among them; read only for keys that are replayed
    ``fresh``    changes that the intervals do not know
    ``again``    (keys) whose changes were altered or withdrawn, or whose entity or present value is new or other

    * Keys without fresh changes keep their intervals.
    * Where all fresh changes of a key come after the start of its open interval, and that is not its first, the open
      interval is closed at the earliest of them, and they open intervals of their own. Nothing else of the key is read.
    * All other keys, late changes and first ones among them, are replayed from their changes.

    Keys with a NULL part are always replayed. Fresh changes of keys without a known entity open no intervals.
    """
    names = [*keys, *attrs, value, "valid_from", "valid_to", "is_current"]
    first = fresh.groupBy(*keys).agg(F.min(ts).alias("_first"), F.count_if(F.col(ts).isNull()).alias("_undated"))
    stored = lookup(intervals.select(*keys, "valid_from", "is_current"), first, keys, "inner")
    # One row per key with fresh changes that has intervals.
    ends = stored.groupBy(*keys).agg(
        F.max(F.when(F.col("is_current"), F.col("valid_from"))).alias("_open"),
        F.min("valid_from").alias("_least"),
        F.count_if("is_current").alias("_n_open"),
        F.first("_first").alias("_first"),
        F.first("_undated").alias("_undated"),
    )
    simple = (F.col("_n_open") == 1) & (F.col("_undated") == 0) & (F.col("_open") > F.col("_least")) & (F.col("_first") > F.col("_open"))
    spliced = ends.filter(simple).select(*keys, "_first", F.lit(True).alias("_splice"))
    altered = again.select(*keys).distinct() if again is not None else fresh.select(*keys).limit(0)
    spliced = lookup(spliced, altered, keys, "left_anti")
    others = lookup(first.select(*keys), spliced, keys, "left_anti", null_safe=True)
    replayed = others.unionByName(altered).distinct().withColumns({"_first": F.lit(None).cast(fresh.schema[ts].dataType), "_splice": F.lit(False)})

    marked = lookup(intervals.select(*names), spliced.unionByName(replayed), keys, null_safe=True, spread=["valid_from"])
    closes = F.col("is_current") & F.coalesce("_splice", F.lit(False))
    kept = marked.filter(F.coalesce("_splice", F.lit(True))).select(
        *keys, *attrs, value, "valid_from", F.when(closes, F.col("_first")).otherwise(F.col("valid_to")).alias("valid_to"), (F.col("is_current") & ~closes).alias("is_current")
    )

    added = lookup(fresh.select(*keys, *attrs, ts, tie_break, new), spliced.select(*keys), keys, "left_semi").withColumn("_day", F.to_date(ts))
    in_day = Window.partitionBy(*keys, "_day").orderBy(ts, tie_break)
    rows = added.withColumns({"_next": F.lead(ts).over(in_day), "_opens": F.lag(F.lit(1)).over(in_day).isNull()})
    days = rows.filter("_opens").select(*keys, "_day", F.lead(ts).over(Window.partitionBy(*keys).orderBy("_day")).alias("_next_day"))
    opened = rows.join(days, [*keys, "_day"], "inner").select(
        *keys, *attrs, F.col(new).alias(value), F.col(ts).alias("valid_from"), F.coalesce("_next", "_next_day").alias("valid_to")
    )
    opened = opened.withColumn("is_current", F.col("valid_to").isNull())

    wanted = replayed.select(*keys)
    whole = scd2_replay(
        lookup(changes, wanted, keys, "left_semi", null_safe=True),
        entities,
        lookup(current, wanted, keys, "left_semi", null_safe=True),
        entity=entity,
        keys=keys,
        ts=ts,
        tie_break=tie_break,
        old=old,
        new=new,
        value=value,
        origin=origin,
        attrs=attrs,
    )
    return reduce(DataFrame.unionByName, [kept, opened, whole.select(*names)])


def _bit(lag: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), lag)


def activity_masks(df: DataFrame, *, date: str, member: str, as_of: dt.date, bits: int = MASK_DAYS) -> DataFrame:
    """(member, mask): bit k says whether the member was active k days before ``as_of``.

    Rows after ``as_of``, older than ``bits`` days or without a date are left out. Masks are put together in each task.
    """
    if not 0 < bits <= MASK_DAYS:
        raise ValueError(f"a mask has 1 to {MASK_DAYS} days")
    lag = F.datediff(F.lit(as_of), F.col(date))
    near = df.select(F.col(member).alias("member"), lag.alias("_lag")).filter((F.col("_lag") >= 0) & (F.col("_lag") < bits))
    return near.groupBy("member").agg(F.bit_or(_bit(F.col("_lag"))).alias("mask"))


def roll_masks(masks: DataFrame, batch: DataFrame, days: int, bits: int = MASK_DAYS) -> DataFrame:
    """Masks ``days`` later, with the activity of a ``batch`` of masks that count from the later day.

    Members without activity in the last ``bits`` days are dropped, so that the state does not grow for ever.
    """
    if days < 0:
        raise ValueError("masks move forward only")
    old = masks.select("member", F.col("mask").alias("_old")).alias("o")
    new = batch.select("member", F.col("mask").alias("_new")).alias("n")
    full = (1 << bits) - 1
    moved = F.call_function("shiftleft", F.col("_old"), F.lit(days)).bitwiseAND(F.lit(full)) if days < bits else F.lit(0).cast("long")
    both = old.join(new, F.col("o.member").eqNullSafe(F.col("n.member")), "full")
    mask = F.coalesce(moved, F.lit(0).cast("long")).bitwiseOR(F.coalesce("_new", F.lit(0).cast("long")))
    member = F.when(F.col("_new").isNotNull(), F.col("n.member")).otherwise(F.col("o.member"))
    return both.select(member.alias("member"), mask.alias("mask")).filter("mask != 0")


def trailing_of_masks(masks: DataFrame, *, as_of: dt.date, date: str, days: int, back: int = 0, bits: int = MASK_DAYS) -> DataFrame:
    """What ``trailing_distinct`` gives for ``as_of`` and the ``back`` days before it, from the masks of ``as_of``.

    One aggregate over the masks; no window and no join. The masks must remember ``days + back`` days.
    """
    if days + back > bits:
        raise ValueError(f"masks of {bits} days do not tell {days} days on each of {back + 1}")
    window = (1 << days) - 1
    aggregates = []
    for k in range(back + 1):
        seen = F.call_function("shiftright", F.col("mask"), F.lit(k))
        aggregates += [F.count_if(seen.bitwiseAND(F.lit(1)) != 0).alias(f"d{k}"), F.count_if(seen.bitwiseAND(F.lit(window)) != 0).alias(f"t{k}")]
    row = masks.agg(*aggregates)
    per_day = [
        F.struct(F.lit(as_of - dt.timedelta(days=k)).alias(date), F.col(f"d{k}").alias("daily"), F.col(f"t{k}").alias("trailing")) for k in range(back + 1)
    ]
    return row.select(F.explode(F.array(*per_day)).alias("_d")).select("_d.*").filter("daily > 0")
