"""Activity counts: trailing actives, session lengths, daily counts, peaks, calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions import ratio_or_null
from vitrine.operators.percentiles import percentile_of_ranked, ranked


def trailing_distinct(df: DataFrame, *, date: str, member: str, days: int = 7) -> DataFrame:
    """(date, daily, trailing): distinct members on the date, and over the ``days`` ending on it.

    Only dates with activity appear. A member active on d counts for d .. d+days-1; cutting that run
    at the member's next active date leaves every (member, date) covered once, so the trailing count
    needs no distinct and no range join: the covered days collapse to one row per date in each task.
    The window sees at most one row per member and day.
    """
    active = df.select(F.col(date).alias("_day"), F.col(member).alias("_member")).distinct()
    by_member = Window.partitionBy("_member").orderBy("_day")
    reach = F.date_add("_day", days - 1)
    next_day = F.lead("_day").over(by_member)
    runs = active.select("_day", F.least(reach, F.date_sub(next_day, 1)).alias("_until"))
    covered = runs.select("_day", F.explode(F.sequence("_day", "_until")).alias(date))
    return (
        covered.groupBy(date)
        .agg(
            F.count_if(F.col("_day") == F.col(date)).alias("daily"),
            F.count(F.lit(1)).alias("trailing"),
        )
        .filter(F.col("daily") > 0)
    )


def cohort_percentiles(
    df: DataFrame,
    *,
    member: str,
    entity: str,
    date: str,
    value: str,
    is_open: str,
    probs: dict[str, float],
) -> DataFrame:
    """Count, mean and exact interpolated percentiles of ``value`` per (date, entity, cohort).

    A row is 'new' on the member's first date for that entity, counting open rows, else 'returning'.
    Open rows set the first date but are not measured. ``probs`` maps output names to fractions.
    ``value`` is a whole number (minutes, days, units).

    ``df`` is read once. Equal rows are counted before anything is grouped by member, and equal values
    again before the percentile: a busy member costs the window one row per date and distinct value, a
    popular entity costs the percentile one row per distinct value.
    """
    pair = [member, entity]
    counted = df.groupBy(*pair, date, is_open, value).agg(F.count(F.lit(1)).alias("_n"))
    first = F.min(date).over(Window.partitionBy(*pair))
    cohort = F.when(F.col(date) == first, "new").otherwise("returning")
    group = [date, entity, "user_cohort"]
    closed = counted.withColumn("user_cohort", cohort).filter(~F.col(is_open))
    per_value = closed.groupBy(*group, value).agg(F.sum("_n").alias("_n"))
    ranks = ranked(per_value, group, value, "_n")
    return ranks.groupBy(*group).agg(
        F.sum("_n").alias("session_count"),
        ratio_or_null(F.sum(F.col(value) * F.col("_n")), F.max("_total")).alias("average"),
        *[percentile_of_ranked(value, p).alias(name) for name, p in probs.items()],
    )


def daily_count(df: DataFrame, dims: list[str], out: str) -> DataFrame:
    """Rows per combination of ``dims``."""
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias(out))


def peak_of_totals(df: DataFrame, *, instant: str, date: str, value: str, out: str) -> DataFrame:
    """Greatest per-instant total of ``value`` on each date."""
    totals = df.groupBy(instant, date).agg(F.sum(value).alias("_total"))
    return totals.groupBy(date).agg(F.max("_total").alias(out))


def date_spine(bounds: DataFrame, out: str = "date_day") -> DataFrame:
    """Every day from ``first_day`` up to, not including, ``end_day`` of a one-row ``bounds``."""
    last = F.date_sub("end_day", 1)
    return bounds.filter(F.col("first_day") <= last).select(F.explode(F.sequence("first_day", last)).alias(out))
