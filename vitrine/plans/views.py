"""SQL text of the models that are stored as views, over the stored tables they read."""

from __future__ import annotations

from collections.abc import Callable

from vitrine.functions.scalar import KEY_NULL_TEXT


def _key(column: str) -> str:
    return f"md5(coalesce(cast({column} AS string), '{KEY_NULL_TEXT}'))"


# Model -> tables it reads and its text. The replay orders changes inside (key, day) and looks across days only from the
# first row of each, as the operator does.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "int_purchases_with_fx": (
        ("stg_purchases", "fx_rates"),
        f"""
        SELECT p.purchase_id, {_key("p.purchase_id")} AS purchase_key, {_key("p.user_id")} AS user_key, {_key("p.game_id")} AS game_key,
               p.purchased_at, to_date(p.purchased_at) AS purchase_date, p.amount_cents, p.currency,
               cast(p.amount_cents AS double) / cast(100 AS double) * r.rate_to_usd AS amount_usd, p.payment_method, p.is_deleted
        FROM {{stg_purchases}} p LEFT JOIN {{fx_rates}} r ON r.date = to_date(p.purchased_at) AND r.currency = p.currency
        """,
    ),
    "int_game_prices_replayed": (
        ("stg_price_changes", "stg_games", "stg_game_prices"),
        """
        WITH ordered AS (
            SELECT game_id, region, currency, changed_at, old_price_cents, new_price_cents, to_date(changed_at) AS day,
                   lead(changed_at) OVER in_day AS next_in_day, row_number() OVER in_day = 1 AS opens_day
            FROM {stg_price_changes} WHERE NOT is_deleted
            WINDOW in_day AS (PARTITION BY game_id, region, to_date(changed_at) ORDER BY changed_at, price_change_id)
        ), days AS (
            SELECT game_id, region, day, lead(changed_at) OVER by_key AS next_day, row_number() OVER by_key = 1 AS is_first,
                   first(named_struct('at', changed_at, 'old', old_price_cents, 'currency', currency)) OVER by_key AS earliest
            FROM ordered WHERE opens_day WINDOW by_key AS (PARTITION BY game_id, region ORDER BY day)
        ), spans AS (
            SELECT d.*, g.created_at AS origin FROM days d JOIN {stg_games} g ON g.game_id = d.game_id
        ), intervals AS (
            SELECT o.game_id, o.region, o.currency, o.new_price_cents AS price_cents,
                   CASE WHEN o.changed_at = s.earliest.at AND s.earliest.old IS NULL THEN s.origin ELSE o.changed_at END AS valid_from,
                   coalesce(o.next_in_day, s.next_day) AS valid_to
            FROM ordered o JOIN spans s ON s.game_id = o.game_id AND s.region = o.region AND s.day = o.day
            UNION ALL
            SELECT game_id, region, earliest.currency, earliest.old, origin, earliest.at FROM spans WHERE is_first AND earliest.old IS NOT NULL
            UNION ALL
            SELECT p.game_id, p.region, p.currency, p.price_cents, g.created_at, cast(NULL AS timestamp)
            FROM {stg_game_prices} p JOIN {stg_games} g ON g.game_id = p.game_id
                 LEFT ANTI JOIN (SELECT game_id, region FROM days WHERE is_first) c ON c.game_id = p.game_id AND c.region = p.region
            WHERE NOT p.is_deleted
        )
        SELECT *, valid_to IS NULL AS is_current FROM intervals
        """,
    ),
    "int_users_campaign_attribution": (
        ("stg_users", "stg_marketing_campaigns"),
        f"""
        SELECT {_key("u.user_id")} AS user_key, to_date(u.created_at) AS signup_date, u.campaign_id,
               CASE WHEN c.marketing_campaign_id IS NOT NULL THEN {_key("c.marketing_campaign_id")} END AS marketing_campaign_key,
               coalesce(c.channel, 'organic') AS channel
        FROM {{stg_users}} u LEFT JOIN (SELECT marketing_campaign_id, channel FROM {{stg_marketing_campaigns}} WHERE NOT is_deleted) c
             ON c.marketing_campaign_id = u.campaign_id
        WHERE NOT u.is_deleted
        """,
    ),
}


def view_query(name: str, stored: Callable[[str], str | None]) -> str | None:
    """The text of a model over the places of its inputs, or None where it has no text or an input is not stored."""
    if name not in VIEWS:
        return None
    inputs, text = VIEWS[name]
    places = {i: stored(i) for i in inputs}
    return None if None in places.values() else text.format(**places)
