"""Landing tables: change events as they arrive, one row per emitted version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LONG, _TEXT, _FLAG, _LIST = T.LongType(), T.StringType(), T.BooleanType(), T.ArrayType(T.StringType())
_TS = "timestamp text"
_JSON = "json text"

# Written next to the business columns by the change-data-capture connector.
BOOKKEEPING = T.StructType(
    [
        T.StructField("__op", _TEXT),
        T.StructField("__source_ts_ms", _LONG),
        T.StructField("__source_lsn", _LONG),
        T.StructField("__source_snapshot", _TEXT),
        T.StructField("__source_table", _TEXT),
        T.StructField("__source_txid", _LONG),
        T.StructField("__deleted", _FLAG),
        T.StructField(
            "record_metadata",
            T.StructType(
                [
                    T.StructField("offset", _LONG),
                    T.StructField("partition", T.IntegerType()),
                    T.StructField("topic", _TEXT),
                ]
            ),
        ),
    ]
)


@dataclass(frozen=True)
class Landing:
    """Columns of one landing table. Timestamps and JSON land as text and are cast in staging."""

    key: str
    columns: dict[str, object]

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(n, _TEXT if t in (_TS, _JSON) else t) for n, t in self.columns.items()]
        return T.StructType(fields + BOOKKEEPING.fields)

    @property
    def timestamps(self) -> list[str]:
        return [n for n, t in self.columns.items() if t == _TS]

    @property
    def json(self) -> list[str]:
        return [n for n, t in self.columns.items() if t == _JSON]


# Names and columns of the landing tables.
LANDING: dict[str, Landing] = {
    "users": Landing(
        "id",
        {"id": _LONG, "username": _TEXT, "email": _TEXT, "country": _TEXT, "campaign_id": _LONG, "created_at": _TS},
    ),
    "games": Landing(
        "id",
        {
            "id": _LONG,
            "name": _TEXT,
            "developer": _TEXT,
            "publisher": _TEXT,
            "genres": _LIST,
            "languages": _LIST,
            "tags": _JSON,
            "created_at": _TS,
        },
    ),
    "game_prices": Landing(
        "id",
        {"id": _LONG, "game_id": _LONG, "region": _TEXT, "currency": _TEXT, "price_cents": _LONG, "updated_at": _TS},
    ),
    "marketing_campaigns": Landing(
        "id",
        {
            "id": _LONG,
            "name": _TEXT,
            "channel": _TEXT,
            "spend_cents": _LONG,
            "currency": _TEXT,
            "starts_at": _TS,
            "ends_at": _TS,
            "created_at": _TS,
        },
    ),
    "purchases": Landing(
        "id",
        {
            "id": _LONG,
            "user_id": _LONG,
            "game_id": _LONG,
            "amount_cents": _LONG,
            "currency": _TEXT,
            "payment_method": _TEXT,
            "purchased_at": _TS,
            "recorded_at": _TS,
        },
    ),
    "ownership_grants": Landing(
        "id",
        {
            "id": _LONG,
            "user_id": _LONG,
            "game_id": _LONG,
            "source": _TEXT,
            "source_id": _LONG,
            "granted_at": _TS,
            "revoked_at": _TS,
            "recorded_at": _TS,
        },
    ),
    "gifts": Landing(
        "id",
        {
            "id": _LONG,
            "purchase_id": _LONG,
            "sender_id": _LONG,
            "recipient_id": _LONG,
            "sent_at": _TS,
            "redeemed_at": _TS,
            "recorded_at": _TS,
        },
    ),
    "key_redemptions": Landing(
        "id",
        {
            "id": _LONG,
            "key_hash": _TEXT,
            "user_id": _LONG,
            "game_id": _LONG,
            "redeemed_at": _TS,
            "recorded_at": _TS,
        },
    ),
    "refunds": Landing(
        "id",
        {
            "id": _LONG,
            "purchase_id": _LONG,
            "reason": _TEXT,
            "is_chargeback": _FLAG,
            "refunded_at": _TS,
            "recorded_at": _TS,
        },
    ),
    "family_shares": Landing(
        "id",
        {
            "id": _LONG,
            "owner_id": _LONG,
            "borrower_id": _LONG,
            "started_at": _TS,
            "ended_at": _TS,
            "recorded_at": _TS,
        },
    ),
    "wishlist_items": Landing(
        "id",
        {"id": _LONG, "user_id": _LONG, "game_id": _LONG, "added_at": _TS, "removed_at": _TS, "recorded_at": _TS},
    ),
    "playtime_sessions": Landing(
        "id",
        {"id": _LONG, "user_id": _LONG, "game_id": _LONG, "started_at": _TS, "ended_at": _TS, "recorded_at": _TS},
    ),
    "reviews": Landing(
        "id",
        {
            "id": _LONG,
            "user_id": _LONG,
            "game_id": _LONG,
            "recommended": _FLAG,
            "playtime_at_review_minutes": _LONG,
            "submitted_at": _TS,
            "recorded_at": _TS,
        },
    ),
    "price_changes": Landing(
        "id",
        {
            "id": _LONG,
            "game_id": _LONG,
            "region": _TEXT,
            "currency": _TEXT,
            "old_price_cents": _LONG,
            "new_price_cents": _LONG,
            "changed_at": _TS,
            "recorded_at": _TS,
        },
    ),
    "concurrent_player_snapshots": Landing(
        "id",
        {"id": _LONG, "game_id": _LONG, "player_count": _LONG, "snapshot_at": _TS, "recorded_at": _TS},
    ),
    "client_events": Landing(
        "event_id",
        {
            "event_id": _LONG,
            "occurred_at": _TS,
            "user_id": _LONG,
            "session_id": _TEXT,
            "game_id": _LONG,
            "event_name": _TEXT,
            "props": _JSON,
            "recorded_at": _TS,
        },
    ),
}

# Hours after which a source is (stale, overdue).
FRESHNESS_DEFAULT_HOURS = (12, 24)
FRESHNESS_HOURS = {
    **{name: FRESHNESS_DEFAULT_HOURS for name in LANDING},
    "playtime_sessions": (3, 12),
    "concurrent_player_snapshots": (1, 3),
    "client_events": (2, 6),
}


def read_landing(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Landing table ``name`` from ``root/name`` parquet; the schema is given, never inferred."""
    return spark.read.schema(LANDING[name].schema).parquet(f"{root.rstrip('/')}/{name}")
