"""Marketing team marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import surrogate_key
from vitrine.operators import daily_count, ratio_per_entity, rollup_via_bridge
from vitrine.plans.intermediate import attribute, purchases_in_usd
from vitrine.plans.staging import live
from vitrine.plans.warehouse import Warehouse, model

MARKETING = "marts_marketing"


@model(MARKETING)
def fct_marketing_signups_daily(wh: Warehouse) -> DataFrame:
    # Users are counted per (day, campaign) first: the campaign join sees counts, not users.
    users = live(wh, "users").select(F.to_date("created_at").alias("signup_date"), "campaign_id")
    per_campaign = daily_count(users, ["signup_date", "campaign_id"], "_n")
    per_channel = attribute(wh, per_campaign).groupBy("signup_date", "channel")
    return per_channel.agg(F.sum("_n").alias("signup_count")).select(
        "signup_date",
        "channel",
        surrogate_key("signup_date", "channel").alias("marketing_signups_daily_key"),
        "signup_count",
    )


@model(MARKETING)
def fct_marketing_campaign_cpa(wh: Warehouse) -> DataFrame:
    campaigns = live(wh, "marketing_campaigns").select("marketing_campaign_id", "channel", "spend_cents")
    users = live(wh, "users").select(F.col("campaign_id").alias("marketing_campaign_id"))
    per_campaign = ratio_per_entity(
        campaigns,
        users,
        key="marketing_campaign_id",
        numerator="spend_cents",
        count_out="attributed_signup_count",
        ratio_out="cpa_usd",
        scale=100,
    ).withColumn("marketing_campaign_key", surrogate_key("marketing_campaign_id"))
    return per_campaign.select(
        surrogate_key("marketing_campaign_key").alias("marketing_campaign_cpa_key"),
        "marketing_campaign_key",
        "channel",
        "spend_cents",
        "attributed_signup_count",
        "cpa_usd",
    )


@model(MARKETING)
def fct_marketing_campaign_revenue(wh: Warehouse) -> DataFrame:
    revenue = rollup_via_bridge(
        purchases_in_usd(wh).filter(~F.col("is_deleted")),
        live(wh, "users").select("user_id", F.col("campaign_id").alias("marketing_campaign_id")),
        member="user_id",
        entity="marketing_campaign_id",
        value="amount_usd",
        out="attributed_revenue_usd",
    )
    campaigns = live(wh, "marketing_campaigns").select("marketing_campaign_id", "channel")
    per_campaign = campaigns.join(revenue, "marketing_campaign_id", "left").withColumn(
        "marketing_campaign_key", surrogate_key("marketing_campaign_id")
    )
    return per_campaign.select(
        surrogate_key("marketing_campaign_key").alias("marketing_campaign_revenue_key"),
        "marketing_campaign_key",
        "channel",
        F.coalesce("attributed_revenue_usd", F.lit(0.0)).alias("attributed_revenue_usd"),
    )
