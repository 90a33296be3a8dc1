"""Conformed dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import days_between, minutes_between, surrogate_key, timestamp_text
from vitrine.operators import date_spine, refund_valuation
from vitrine.plans.intermediate import purchases_in_usd
from vitrine.plans.staging import live
from vitrine.plans.warehouse import Warehouse, model

CORE = "marts_core"


@model(CORE)
def dim_users(wh: Warehouse) -> DataFrame:
    return live(wh, "users").select(
        surrogate_key("user_id").alias("user_key"),
        "user_id",
        "username",
        "country",
        "campaign_id",
        "created_at",
        F.to_date("created_at").alias("signup_date"),
        days_between("created_at", F.lit(wh.as_of).cast("timestamp")).alias("tenure_days"),
    )


@model(CORE)
def dim_games(wh: Warehouse) -> DataFrame:
    return live(wh, "games").select(
        surrogate_key("game_id").alias("game_key"),
        "game_id",
        "name",
        "developer",
        "publisher",
        "genres",
        "languages",
        "tags",
        "created_at",
    )


@model(CORE)
def dim_marketing_campaigns(wh: Warehouse) -> DataFrame:
    return live(wh, "marketing_campaigns").select(
        surrogate_key("marketing_campaign_id").alias("marketing_campaign_key"),
        "marketing_campaign_id",
        "name",
        "channel",
        "spend_cents",
        "currency",
        "starts_at",
        "ends_at",
        "created_at",
    )


@model(CORE)
def dim_date(wh: Warehouse) -> DataFrame:
    if callable(wh.calendar):
        bounds = wh.calendar()
    else:
        first, end = wh.calendar
        bounds = wh.spark.range(1).select(F.lit(first).alias("first_day"), F.lit(end).alias("end_day"))
    sunday_is_zero = F.dayofweek("date_day") - 1
    return date_spine(bounds).select(
        "date_day",
        F.year("date_day").alias("year"),
        F.quarter("date_day").alias("quarter"),
        F.month("date_day").alias("month"),
        F.dayofmonth("date_day").alias("day_of_month"),
        sunday_is_zero.alias("day_of_week"),
        F.dayname("date_day").alias("day_name"),
        F.weekofyear("date_day").alias("week_of_year"),
        sunday_is_zero.isin(0, 6).alias("is_weekend"),
    )


@model(CORE)
def dim_game_prices(wh: Warehouse) -> DataFrame:
    replayed = wh["int_game_prices_replayed"]
    return replayed.select(
        surrogate_key("game_id", "region", timestamp_text("valid_from")).alias("game_price_key"),
        "game_id",
        "region",
        "currency",
        "price_cents",
        "valid_from",
        "valid_to",
        "is_current",
    )


@model(CORE)
def fct_purchases(wh: Warehouse) -> DataFrame:
    kept = wh["int_purchases_with_fx"].filter(~F.col("is_deleted"))
    return kept.drop("purchase_id", "is_deleted")


def valued_refunds(wh: Warehouse) -> DataFrame:
    """Live refunds of live purchases, at the value of the purchase, on natural ids."""
    bought = (
        purchases_in_usd(wh)
        .filter(~F.col("is_deleted"))
        .select("purchase_id", "user_id", "game_id", "purchased_at", F.col("amount_usd").alias("refunded_amount_usd"))
    )
    refunds = live(wh, "refunds").select("refund_id", "purchase_id", "is_chargeback", "refunded_at")
    return refund_valuation(refunds, bought, "purchase_id").withColumn("refund_date", F.to_date("refunded_at"))


@model(CORE)
def fct_refunds(wh: Warehouse) -> DataFrame:
    return valued_refunds(wh).select(
        surrogate_key("refund_id").alias("refund_key"),
        surrogate_key("purchase_id").alias("purchase_key"),
        surrogate_key("user_id").alias("user_key"),
        surrogate_key("game_id").alias("game_key"),
        "refunded_at",
        "refund_date",
        "is_chargeback",
        "refunded_amount_usd",
    )


@model(CORE)
def fct_ownership_grants(wh: Warehouse) -> DataFrame:
    return live(wh, "ownership_grants").select(
        surrogate_key("ownership_grant_id").alias("ownership_grant_key"),
        surrogate_key("user_id").alias("user_key"),
        surrogate_key("game_id").alias("game_key"),
        "source",
        "granted_at",
        "revoked_at",
    )


def measured_sessions(wh: Warehouse) -> DataFrame:
    """Live play sessions with day, open flag and length, on natural ids. Open ones have no length."""
    return live(wh, "playtime_sessions").select(
        "playtime_session_id",
        "user_id",
        "game_id",
        "started_at",
        F.to_date("started_at").alias("started_date"),
        F.col("ended_at").isNull().alias("is_open"),
        minutes_between("started_at", "ended_at").alias("duration_minutes"),
    )


@model(CORE)
def fct_playtime_sessions(wh: Warehouse) -> DataFrame:
    return measured_sessions(wh).select(
        surrogate_key("playtime_session_id").alias("playtime_session_key"),
        surrogate_key("user_id").alias("user_key"),
        surrogate_key("game_id").alias("game_key"),
        "started_at",
        "started_date",
        "is_open",
        "duration_minutes",
    )


@model(CORE)
def fct_concurrent_player_snapshots(wh: Warehouse) -> DataFrame:
    return live(wh, "concurrent_player_snapshots").select(
        surrogate_key("concurrent_player_snapshot_id").alias("concurrent_player_snapshot_key"),
        surrogate_key("game_id").alias("game_key"),
        "player_count",
        "snapshot_at",
        F.to_date("snapshot_at").alias("snapshot_date"),
    )


@model(CORE)
def fct_wishlist_items(wh: Warehouse) -> DataFrame:
    return live(wh, "wishlist_items").select(
        surrogate_key("wishlist_item_id").alias("wishlist_item_key"),
        surrogate_key("user_id").alias("user_key"),
        surrogate_key("game_id").alias("game_key"),
        "added_at",
        F.to_date("added_at").alias("added_date"),
        "removed_at",
    )
