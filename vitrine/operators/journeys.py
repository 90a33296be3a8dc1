"""What members do next: conversion after a start, and funnels inside a session."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions import ratio_or_zero
from vitrine.operators.joins import lookup
from vitrine.operators.percentiles import percentile_of_ranked, ranked


def conversion(
    starts: DataFrame,
    ends: DataFrame,
    *,
    keys: list[str],
    start_ts: str,
    end_ts: str,
    group: list[str],
) -> DataFrame:
    """Share of starts followed, strictly later, by any end with the same keys; per ``group``.

    Days to convert are midnights between the start and the first end after it. That makes the day
    the unit of work: a start before the last end of its own day converts in 0 days; any other one
    converts on the next day that has an end. So starts meet one row per (keys, day) instead of every
    end of their keys, and the window that finds the next day has at most two rows per key and day.
    NULL keys match each other, as hashed keys do.
    """
    end_days = (
        ends.select(*keys, F.to_date(end_ts).alias("_day"), F.col(end_ts).alias("_end"))
        .filter(F.col("_end").isNotNull())
        .groupBy(*keys, "_day")
        .agg(F.max("_end").alias("_last_end"))
    )
    dated = starts.select(*keys, F.to_date(start_ts).alias("_day"), F.col(start_ts).alias("_start"))
    same_day = F.col("_start") < F.col("_last_end")
    start_days = (
        lookup(dated, end_days, [*keys, "_day"], null_safe=True)
        .groupBy(*keys, "_day")
        .agg(
            F.count_if(same_day).alias("_same_day"),
            F.count_if(~F.coalesce(same_day, F.lit(False))).alias("_later"),
        )
    )
    # Reading the day off _last_end keeps both uses of end_days one plan, so its exchange is reused.
    both = start_days.unionByName(
        end_days.select(*keys, "_day", F.unix_date(F.to_date("_last_end")).alias("_end_no")),
        allowMissingColumns=True,
    ).withColumn("_day_no", F.unix_date("_day"))
    following = (
        Window.partitionBy(*keys).orderBy(F.col("_day_no").desc()).rangeBetween(Window.unboundedPreceding, -1)
    )
    wait = F.when(F.col("_day_no").isNotNull(), F.min("_end_no").over(following) - F.col("_day_no"))
    waits = both.select(*keys, "_same_day", "_later", wait.alias("_wait")).filter(F.col("_later").isNotNull())
    counted = (
        waits.select(
            *group,
            F.explode(
                F.array(
                    F.struct(F.lit(0).alias("_days"), F.col("_same_day").alias("_n")),
                    F.struct(F.col("_wait").alias("_days"), F.col("_later").alias("_n")),
                )
            ).alias("_w"),
        )
        .select(*group, "_w.*")
        .groupBy(*group, "_days")
        .agg(F.sum("_n").alias("_n"))
    )
    # NULL days are the starts that never convert; they rank nowhere and do not count in _total.
    return (
        ranked(counted, group, "_days", "_n")
        .groupBy(*group)
        .agg(
            F.sum("_n").alias("start_count"),
            F.max("_total").alias("converted_count"),
            percentile_of_ranked("_days", 0.5).alias("median_days_to_convert"),
        )
        .withColumn("conversion_rate", ratio_or_zero("converted_count", "start_count"))
    )


def converted_counts(
    starts: DataFrame,
    ends: DataFrame,
    *,
    keys: list[str],
    start_ts: str,
    end_ts: str,
    group: list[str],
) -> DataFrame:
    """Starts and converted starts per ``group`` by another road than ``conversion``: some end is later
    than the start exactly if the last end of its keys is. Used to check the mart."""
    last = ends.groupBy(*keys).agg(F.max(end_ts).alias("_last"))
    scored = lookup(starts.select(*keys, start_ts), last, keys, null_safe=True)
    return scored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("start_count"),
        F.count_if(F.col(start_ts) < F.col("_last")).alias("converted_count"),
    )


def funnel(
    events: DataFrame,
    *,
    session: list[str],
    name: str,
    ts: str,
    stages: list[str],
) -> DataFrame:
    """First time each stage was seen per session, and whether it was. Order is not enforced.

    Events outside ``stages`` are ignored. One aggregate with map-side partials; a session of any
    length leaves a task as one row.
    """
    kept = events.filter(F.col(name).isin(stages)).select(*session, name, ts)
    seen = kept.groupBy(*session).agg(
        F.min(ts).alias("session_started_at"),
        *[F.min(F.when(F.col(name) == s, F.col(ts))).alias(f"{s}_at") for s in stages],
    )
    return seen.select(
        *session,
        F.to_date("session_started_at").alias("session_date"),
        "session_started_at",
        *[f"{s}_at" for s in stages],
        *[F.col(f"{s}_at").isNotNull().alias(f"has_reached_{s}") for s in stages],
    )


def stage_order_violations(sessions: DataFrame, *, session_key: str, stages: list[str]) -> DataFrame:
    """Stages first seen before an earlier stage of the same session key.

    Sessions sharing a key are read as one. Within a stage times ascend, so only a stage's first time
    against the last time of the stage before it can be out of order; that is two values per stage and
    at most ``len(stages)`` rows per key in the window.
    """
    pairs = ", ".join(f"{i}, {s}_at" for i, s in enumerate(stages, start=1))
    unpivoted = sessions.selectExpr(session_key, f"stack({len(stages)}, {pairs}) as (stage_order, stage_at)")
    per_stage = (
        unpivoted.filter(F.col("stage_at").isNotNull())
        .groupBy(session_key, "stage_order")
        .agg(F.min("stage_at").alias("stage_at"), F.max("stage_at").alias("_last"))
    )
    by_key = Window.partitionBy(session_key).orderBy("stage_order")
    return per_stage.select(
        session_key, "stage_order", "stage_at", F.lag("_last").over(by_key).alias("prev_stage_at")
    ).filter(F.col("stage_at") < F.col("prev_stage_at"))
