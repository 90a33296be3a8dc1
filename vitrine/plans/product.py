"""Product team marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import surrogate_key
from vitrine.operators import cohort_percentiles, conversion, funnel, trailing_distinct
from vitrine.plans.core import measured_sessions
from vitrine.plans.staging import live
from vitrine.plans.warehouse import Warehouse, model

PRODUCT = "marts_product"

# Funnel stages in order.
FUNNEL_STAGES = [
    "store_page_view",
    "game_page_view",
    "add_to_wishlist",
    "begin_checkout",
    "purchase_complete",
]


@model(PRODUCT)
def fct_product_active_users_daily(wh: Warehouse) -> DataFrame:
    actives = trailing_distinct(measured_sessions(wh), date="started_date", member="user_id", days=7)
    return actives.select(
        F.col("started_date").alias("active_date"),
        surrogate_key("started_date").alias("active_users_daily_key"),
        F.col("daily").alias("dau"),
        F.col("trailing").alias("wau"),
    )


@model(PRODUCT)
def fct_product_session_length_daily(wh: Warehouse) -> DataFrame:
    lengths = cohort_percentiles(
        measured_sessions(wh),
        member="user_id",
        entity="game_id",
        date="started_date",
        value="duration_minutes",
        is_open="is_open",
        probs={"p50_duration_minutes": 0.5, "p90_duration_minutes": 0.9},
    ).withColumn("game_key", surrogate_key("game_id"))
    return lengths.select(
        "started_date",
        "game_key",
        "user_cohort",
        surrogate_key("started_date", "game_key", "user_cohort").alias("session_length_daily_key"),
        "session_count",
        F.col("average").alias("avg_duration_minutes"),
        "p50_duration_minutes",
        "p90_duration_minutes",
    )


@model(PRODUCT)
def fct_product_wishlist_conversion(wh: Warehouse) -> DataFrame:
    per_game = conversion(
        live(wh, "wishlist_items"),
        live(wh, "ownership_grants"),
        keys=["user_id", "game_id"],
        start_ts="added_at",
        end_ts="granted_at",
        group=["game_id"],
    ).withColumn("game_key", surrogate_key("game_id"))
    return per_game.select(
        "game_key",
        surrogate_key("game_key").alias("wishlist_conversion_key"),
        F.col("start_count").alias("wishlist_add_count"),
        "converted_count",
        "conversion_rate",
        "median_days_to_convert",
    )


@model(PRODUCT)
def fct_product_funnel_sessions(wh: Warehouse) -> DataFrame:
    sessions = funnel(
        live(wh, "client_events"),
        session=["session_id", "user_id"],
        name="event_name",
        ts="occurred_at",
        stages=FUNNEL_STAGES,
    )
    measures = [c for c in sessions.columns if c not in ("session_id", "user_id")]
    return sessions.select(
        "session_id", "user_id", surrogate_key("session_id").alias("funnel_session_key"), *measures
    )
