"""Currency conversion, refunds and daily ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.joins import lookup


def fx_convert(
    df: DataFrame,
    rates: DataFrame,
    *,
    ts: str,
    currency: str,
    cents: str,
    out: str,
) -> DataFrame:
    """Add ``out``: cents / 100 * rate of (day of ``ts``, currency). NULL where no rate is known.

    ``rates`` has (date, currency, rate_to_usd). Rows are kept whether or not they find a rate.
    """
    keyed = df.withColumn("_day", F.to_date(ts)).withColumn("_currency", F.col(currency))
    by_day = rates.select(F.col("date").alias("_day"), F.col("currency").alias("_currency"), "rate_to_usd")
    amount = F.col(cents).cast("double") / F.lit(100.0) * F.col("rate_to_usd")
    return lookup(keyed, by_day, ["_day", "_currency"], spread=[ts, cents]).select(*df.columns, amount.alias(out))


def refund_valuation(refunds: DataFrame, purchases: DataFrame, key: str) -> DataFrame:
    """Refunds with the columns of the purchase they reverse; those without one are dropped.

    The NULL keys go first and the join is null-safe: a plain one would add a NOT NULL filter below the
    purchases, which could then not share their exchange with other uses of the purchases.
    """
    return lookup(refunds.filter(F.col(key).isNotNull()), purchases, [key], "inner", null_safe=True)


def exact(amount: str | Column) -> Column:
    """An amount as a decimal of six digits, as many as cents times a rate of four digits have.

    Its sums do not depend on the order in which tasks finish, so a half cent rounds alike on every retry.
    """
    return (F.col(amount) if isinstance(amount, str) else amount).cast("decimal(28,6)")


def cents(amount: str) -> Column:
    """Whole cents of a sum of ``exact`` amounts."""
    return F.round(F.col(amount) * 100).cast("long")


def signed_daily(
    inflow: DataFrame,
    outflow: DataFrame,
    members: DataFrame,
    *,
    member: str,
    date: str,
    amount: str,
    flag: str,
    dims: list[str],
) -> DataFrame:
    """Money in and out per (date, dims of the member, flag).

    ``inflow``  (member, date, amount), always on rows with flag = false
    ``outflow`` (member, date, amount, flag)
    ``members`` (member, dims); movements of unknown members are dropped

    One tagged union is summed per (member, date, flag) before it meets ``members``: however many
    movements a member has, the join sees a few rows per day. NULL dims group with each other. Rows
    whose flag is NULL keep their grain row but contribute nothing.
    """
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    none = exact(F.lit(None))
    moved = inflow.select(
        member,
        date,
        F.lit(False).alias(flag),
        exact(amount).alias("_in"),
        one.alias("_in_n"),
        none.alias("_out"),
        zero.alias("_out_n"),
    ).unionByName(
        outflow.select(
            member,
            date,
            flag,
            none.alias("_in"),
            zero.alias("_in_n"),
            exact(amount).alias("_out"),
            one.alias("_out_n"),
        )
    )
    return _ledger(moved, members, member, date, flag, dims)


def refunded_daily(
    purchases: DataFrame,
    refunds: DataFrame,
    members: DataFrame,
    *,
    key: str,
    member: str,
    date: str,
    amount: str,
    refund_date: str,
    flag: str,
    dims: list[str],
) -> DataFrame:
    """``signed_daily`` of purchases, and of the refunds that reverse them at the purchase's amount.

    ``purchases`` (key, member, date, amount)   one row per key
    ``refunds``   (key, refund_date, flag)      refunds of unknown purchases are dropped

    Refunds are counted per (key, day, flag) and brought to their purchase, whose row gives both legs. Purchases are
    read once and, where they are already partitioned by their key, not shuffled before they are summed.
    """
    counted = refunds.filter(F.col(key).isNotNull()).groupBy(key, refund_date, flag).agg(F.count(F.lit(1)).alias("_n"))
    per_key = counted.groupBy(key).agg(F.collect_list(F.struct(refund_date, flag, "_n")).alias("_refunds"))
    zero = F.lit(0).cast("long")
    value = exact(amount)

    def leg(day: Column, flagged: Column, got: Column, got_n: Column, given: Column, given_n: Column) -> Column:
        return F.struct(
            day.alias(date),
            flagged.alias(flag),
            got.alias("_in"),
            got_n.alias("_in_n"),
            given.alias("_out"),
            given_n.alias("_out_n"),
        )

    bought = leg(F.col(date), F.lit(False), value, F.lit(1).cast("long"), exact(F.lit(None)), zero)
    back = F.transform(
        "_refunds", lambda r: leg(r[refund_date], r[flag], exact(F.lit(None)), zero, exact(value * r["_n"]), r["_n"])
    )
    legs = F.when(F.col("_refunds").isNull(), F.array(bought)).otherwise(F.concat(F.array(bought), back))
    moved = purchases.join(per_key, key, "left").select(member, F.explode(legs).alias("_leg")).select(member, "_leg.*")
    return _ledger(moved, members, member, date, flag, dims)


def _ledger(moved: DataFrame, members: DataFrame, member: str, date: str, flag: str, dims: list[str]) -> DataFrame:
    zero = F.lit(0).cast("long")
    parts = ["_in", "_in_n", "_out", "_out_n"]
    per_member = moved.groupBy(member, date, flag).agg(*[F.sum(p).alias(p) for p in parts])
    daily = (
        per_member.join(members.select(member, *dims), member, "inner")
        .groupBy(date, *dims, flag)
        .agg(*[F.sum(p).alias(p) for p in parts])
    )
    counted = F.col(flag).isNotNull()
    return daily.select(
        date,
        *dims,
        flag,
        F.coalesce(F.when(counted, cents("_in")), zero).alias("in_cents"),
        F.coalesce(F.when(counted, cents("_out")), zero).alias("out_cents"),
        F.when(counted, F.col("_in_n")).otherwise(zero).alias("in_count"),
        F.when(counted, F.col("_out_n")).otherwise(zero).alias("out_count"),
        F.when(F.col(flag), F.col("_out_n")).otherwise(zero).alias("flagged_count"),
    )
