"""Newest row of every landing table, cast and renamed. Deleted rows stay, marked by ``is_deleted``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators import latest_by
from vitrine.plans.warehouse import Warehouse, model
from vitrine.sources import LANDING

# Name of the primary key after staging.
KEY_NAMES = {
    "users": "user_id",
    "games": "game_id",
    "game_prices": "game_price_id",
    "marketing_campaigns": "marketing_campaign_id",
    "purchases": "purchase_id",
    "ownership_grants": "ownership_grant_id",
    "gifts": "gift_id",
    "key_redemptions": "key_redemption_id",
    "refunds": "refund_id",
    "family_shares": "family_share_id",
    "wishlist_items": "wishlist_item_id",
    "playtime_sessions": "playtime_session_id",
    "reviews": "review_id",
    "price_changes": "price_change_id",
    "concurrent_player_snapshots": "concurrent_player_snapshot_id",
    "client_events": "event_id",
}
RENAMED = {"reviews": {"recommended": "is_recommended"}}


def stage(landed: DataFrame, name: str, reduced: bool = False) -> DataFrame:
    """Staging of one landing table, of all its versions or, ``reduced``, of the newest of each key.

    The newest version wins before deletions are looked at, so a newest tombstone is kept as deleted.
    Columns no consumer asks for are pruned below the shuffle by the optimiser.
    """
    table = LANDING[name]
    renamed = {table.key: KEY_NAMES[name], **RENAMED.get(name, {})}
    newest = landed if reduced else latest_by(landed, [table.key], "record_metadata.offset")

    def column(c: str):
        value = F.col(c)
        if c in table.timestamps:
            value = value.cast("timestamp")
        elif c in table.json:
            value = F.parse_json(value)
        return value.alias(renamed.get(c, c))

    return newest.select(
        *[column(c) for c in table.columns],
        F.coalesce(F.col("__deleted"), F.lit(False)).alias("is_deleted"),
    )


def _register(name: str) -> None:
    @model("stg", f"stg_{name}")
    def staged(wh: Warehouse) -> DataFrame:
        if wh.newest is not None:
            return stage(wh.newest(name), name, reduced=True)
        return stage(wh.landing(name), name)


for _name in LANDING:
    _register(_name)


def live(wh: Warehouse, name: str) -> DataFrame:
    """Staged rows that are not deleted."""
    staged = wh[f"stg_{name}"]
    return staged.filter(~F.col("is_deleted")).drop("is_deleted")
