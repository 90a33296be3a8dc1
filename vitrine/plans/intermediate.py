"""Logic shared by several marts.

Marts work on natural ids, eight bytes each, through every shuffle. The hashed ``*_key`` columns are
pure functions of the ids and are added where a published table needs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import surrogate_key
from vitrine.operators import first_touch, fx_convert, scd2_replay
from vitrine.plans.staging import live
from vitrine.plans.warehouse import Warehouse, model


def purchases_in_usd(wh: Warehouse) -> DataFrame:
    """Every purchase, deleted ones too, with ``purchase_date`` and ``amount_usd``."""
    converted = fx_convert(
        wh["stg_purchases"],
        wh.fx_rates,
        ts="purchased_at",
        currency="currency",
        cents="amount_cents",
        out="amount_usd",
    )
    return converted.withColumn("purchase_date", F.to_date("purchased_at"))


@model("int")
def int_purchases_with_fx(wh: Warehouse) -> DataFrame:
    return purchases_in_usd(wh).select(
        "purchase_id",
        surrogate_key("purchase_id").alias("purchase_key"),
        surrogate_key("user_id").alias("user_key"),
        surrogate_key("game_id").alias("game_key"),
        "purchased_at",
        "purchase_date",
        "amount_cents",
        "currency",
        "amount_usd",
        "payment_method",
        "is_deleted",
    )


@model("int")
def int_game_prices_replayed(wh: Warehouse) -> DataFrame:
    # Deleted games still date their prices; deleted changes and prices do not count.
    return scd2_replay(
        live(wh, "price_changes"),
        wh["stg_games"].select("game_id", F.col("created_at").alias("game_created_at")),
        live(wh, "game_prices"),
        entity="game_id",
        keys=["game_id", "region"],
        ts="changed_at",
        tie_break="price_change_id",
        old="old_price_cents",
        new="new_price_cents",
        value="price_cents",
        origin="game_created_at",
        attrs=["currency"],
    )


def attribute(wh: Warehouse, users: DataFrame) -> DataFrame:
    """Rows with a ``campaign_id`` and the campaign they came from; channel 'organic' without one."""
    campaigns = live(wh, "marketing_campaigns").select(
        "marketing_campaign_id",
        F.col("marketing_campaign_id").alias("found_campaign_id"),
        "channel",
    )
    return first_touch(
        users, campaigns, fk="campaign_id", pk="marketing_campaign_id", label="channel", default="organic"
    )


@model("int")
def int_users_campaign_attribution(wh: Warehouse) -> DataFrame:
    users = live(wh, "users").select("user_id", "campaign_id", F.to_date("created_at").alias("signup_date"))
    found = F.col("found_campaign_id")
    return attribute(wh, users).select(
        surrogate_key("user_id").alias("user_key"),
        "signup_date",
        "campaign_id",
        F.when(found.isNotNull(), surrogate_key("found_campaign_id")).alias("marketing_campaign_key"),
        "channel",
    )
