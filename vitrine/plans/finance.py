"""Finance team marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import surrogate_key
from vitrine.operators import peak_of_totals, refunded_daily
from vitrine.plans.intermediate import purchases_in_usd
from vitrine.plans.staging import live
from vitrine.plans.warehouse import Warehouse, model

FINANCE = "marts_finance"


@model(FINANCE)
def fct_finance_revenue_daily(wh: Warehouse) -> DataFrame:
    # Refunds count on the day of the refund, not of the purchase.
    bought = purchases_in_usd(wh).filter(~F.col("is_deleted"))
    ledger = refunded_daily(
        bought.select("purchase_id", "user_id", F.col("purchase_date").alias("revenue_date"), "amount_usd"),
        live(wh, "refunds").select("purchase_id", F.to_date("refunded_at").alias("refund_date"), "is_chargeback"),
        live(wh, "users").select("user_id", "country"),
        key="purchase_id",
        member="user_id",
        date="revenue_date",
        amount="amount_usd",
        refund_date="refund_date",
        flag="is_chargeback",
        dims=["country"],
    )
    return ledger.select(
        "revenue_date",
        "country",
        "is_chargeback",
        surrogate_key("revenue_date", "country", "is_chargeback").alias("finance_revenue_daily_key"),
        F.col("in_cents").alias("revenue_cents"),
        F.col("out_cents").alias("refunded_cents"),
        F.col("in_count").alias("purchase_count"),
        F.col("out_count").alias("refund_count"),
        F.col("flagged_count").alias("chargeback_count"),
    )


@model(FINANCE)
def fct_finance_capacity_daily(wh: Warehouse) -> DataFrame:
    snapshots = live(wh, "concurrent_player_snapshots").select(
        "snapshot_at", F.to_date("snapshot_at").alias("capacity_date"), "player_count"
    )
    peaks = peak_of_totals(
        snapshots, instant="snapshot_at", date="capacity_date", value="player_count", out="peak_concurrent_players"
    )
    return peaks.select(
        "capacity_date",
        surrogate_key("capacity_date").alias("finance_capacity_daily_key"),
        "peak_concurrent_players",
    )
