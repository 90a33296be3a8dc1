"""DuckDB statements that repeat the registered queries over the same parquet tables.

They state the semantics the plain way (QUALIFY, range joins, full joins, correlated EXISTS), not the
way the Spark plans are built, so agreement means something. ``RELATIONS`` are shared subqueries;
``compose`` puts the ones a statement needs in front of it.
"""

from __future__ import annotations

import re

from vitrine.functions import KEY_NULL_TEXT
from vitrine.plans.checks import CHECKS
from vitrine.plans.product import FUNNEL_STAGES
from vitrine.sources import FRESHNESS_HOURS, LANDING

AS_OF = "TIMESTAMP '2024-01-31 02:00:00'"


def key(*parts: str) -> str:
    texts = [f"coalesce(cast({p} as varchar), '{KEY_NULL_TEXT}')" for p in parts]
    return f"md5({' || \'-\' || '.join(texts)})"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def emitted(table: str, k: str, where: str = "true") -> str:
    """Rows of a driver table with their version number v."""
    return f"(select *, unnest(case when {k} % 4 = 0 then [0, 1] else [0] end) as v from {table} where {where})"


def landed(source: str, k: str, dead: str, clock: str, columns: dict[str, str]) -> str:
    body = ",\n  ".join(f"{e} as {c}" for c, e in columns.items())
    return f"""select {body},
  case when v = 1 then 'r' else 'c' end as __op,
  cast(epoch_us({clock}) // 1000 + v * 1000 as bigint) as __source_ts_ms,
  cast({k} * 2 + v as bigint) as "offset",
  case when ({dead}) and ({k} % 4 <> 0 or v = 1) then true when {k} % 3 = 0 then null else false end as __deleted
from {source}"""


BOUGHT = "(o_orderdate + to_seconds(o_orderkey % 86400))"
SPARE = "to_seconds(v)"
RECORDED = f"(ts + to_minutes(1) + {SPARE})"


def _landing_relations() -> dict[str, str]:
    out = {}
    start = "(TIMESTAMP '1994-01-01' + to_days(cast(c_custkey % 365 as integer)))"
    out["users"] = landed(
        f"{emitted('customer', 'c_custkey')} c left join nation on c_nationkey = n_nationkey",
        "c_custkey",
        "c_custkey % 97 = 0",
        start,
        {
            "id": "c_custkey",
            "username": "c_name || '~' || v",
            "email": "lower(c_name) || '@example.org'",
            "country": "case when c_nationkey % 5 = 0 then null else n_name end",
            "campaign_id": (
                "case when c_custkey % 3 = 0 or (c_custkey // 13) % 10 = 7 then null else c_custkey // 13 end"
            ),
            "created_at": start,
        },
    )
    start = "(TIMESTAMP '1994-06-01' + to_days(cast(p_partkey % 30 as integer)))"
    out["games"] = landed(
        emitted("part", "p_partkey"),
        "p_partkey",
        "p_partkey % 101 = 0",
        start,
        {
            "id": "p_partkey",
            "name": "p_name || '~' || v",
            "developer": "p_brand",
            "publisher": "p_type",
            "genres": "p_type",
            "languages": "'en,' || p_brand",
            "tags": "'{\"size\":' || p_size || '}'",
            "created_at": start,
        },
    )
    start = "(TIMESTAMP '1994-07-01' + to_days(cast(p_partkey % 30 as integer)))"
    out["game_prices"] = landed(
        emitted("(select *, unnest([0, 1, 2, 3, 4]) as r from part)", "(p_partkey * 5 + r)"),
        "(p_partkey * 5 + r)",
        "(p_partkey * 5 + r) % 89 = 0",
        start,
        {
            "id": "p_partkey * 5 + r",
            "game_id": "p_partkey",
            "region": "'R' || r",
            "currency": "'USD'",
            "price_cents": "cast(round(p_retailprice * 100) as bigint) + v",
            "updated_at": start,
        },
    )
    start = "(TIMESTAMP '1994-01-01' + to_days(cast(s_suppkey % 365 as integer)))"
    out["marketing_campaigns"] = landed(
        emitted("supplier", "s_suppkey"),
        "s_suppkey",
        "s_suppkey % 10 = 9",
        start,
        {
            "id": "s_suppkey",
            "name": "s_name || '~' || v",
            "channel": (
                "case when s_suppkey % 17 = 16 then 'billboard' when s_suppkey % 5 = 0 then 'paid_search' "
                "when s_suppkey % 5 = 1 then 'paid_social' when s_suppkey % 5 = 2 then 'email' "
                "when s_suppkey % 5 = 3 then 'influencer' else 'affiliate' end"
            ),
            "spend_cents": "(s_suppkey + 1) * 100000 + v",
            "currency": "'USD'",
            "starts_at": start,
            "ends_at": f"{start} + to_days(30)",
            "created_at": f"{start} - to_days(10)",
        },
    )
    recorded = f"({BOUGHT} + to_minutes(1))"
    out["purchases"] = landed(
        emitted("orders", "o_orderkey"),
        "o_orderkey",
        "o_orderkey % 61 = 0",
        recorded,
        {
            "id": "o_orderkey",
            "user_id": "o_custkey",
            "game_id": "o_orderkey % 200",
            "amount_cents": "cast(round(o_totalprice * 100) as bigint) + v",
            "currency": (
                "case when o_orderkey % 1000 = 998 then null when o_orderkey % 1000 = 999 then 'XXX' "
                "when o_orderkey % 5 = 0 then 'USD' when o_orderkey % 5 = 1 then 'EUR' "
                "when o_orderkey % 5 = 2 then 'GBP' when o_orderkey % 5 = 3 then 'BRL' else 'JPY' end"
            ),
            "payment_method": "o_orderpriority",
            "purchased_at": BOUGHT,
            "recorded_at": recorded,
        },
    )
    shift = "case when o_orderkey % 500 = 0 then -1 else cast(o_orderkey % 45 as integer) end"
    refunded = f"({BOUGHT} + to_days({shift}))"
    out["refunds"] = landed(
        emitted("orders", "o_orderkey"),
        "o_orderkey",
        "o_orderkey % 53 = 0",
        refunded,
        {
            "id": "o_orderkey",
            "purchase_id": "o_orderkey",
            "reason": "o_orderpriority || '~' || v",
            "is_chargeback": "case when o_orderkey % 211 = 0 then null else o_orderkey % 7 = 0 end",
            "refunded_at": refunded,
            "recorded_at": refunded,
        },
    )
    out["price_changes"] = landed(
        emitted("orders", "o_orderkey"),
        "o_orderkey",
        "o_orderkey % 71 = 0",
        "o_orderdate",
        {
            "id": "o_orderkey",
            "game_id": "case when o_orderkey % 97 = 0 then -1 else o_orderkey % 100 end",
            "region": "case when o_orderkey % 79 = 0 then null else 'R' || ((o_orderkey // 100) % 5) end",
            "currency": "'USD'",
            "old_price_cents": "case when o_orderkey % 4 = 0 then null else cast(round(o_totalprice) as bigint) end",
            "new_price_cents": "cast(round(o_totalprice) as bigint) + 1 + v",
            "changed_at": "o_orderdate",
            "recorded_at": "o_orderdate",
        },
    )
    recorded = f"({BOUGHT} + to_minutes(2) + {SPARE})"
    out["gifts"] = landed(
        emitted("orders", "o_orderkey"),
        "o_orderkey",
        "o_orderkey % 59 = 0",
        recorded,
        {
            "id": "o_orderkey",
            "purchase_id": "o_orderkey",
            "sender_id": "o_custkey",
            "recipient_id": "(o_custkey * 7) % 1000",
            "sent_at": BOUGHT,
            "redeemed_at": f"case when o_orderkey % 4 = 1 then null else {BOUGHT} + to_days(2) end",
            "recorded_at": recorded,
        },
    )
    recorded = f"(o_orderdate + to_minutes(2) + {SPARE})"
    out["key_redemptions"] = landed(
        emitted("orders", "o_orderkey"),
        "o_orderkey",
        "o_orderkey % 59 = 0",
        recorded,
        {
            "id": "o_orderkey",
            "key_hash": "md5(cast(o_orderkey as varchar))",
            "user_id": "o_custkey",
            "game_id": "o_orderkey % 200",
            "redeemed_at": "o_orderdate",
            "recorded_at": recorded,
        },
    )

    def from_events(dead: str, columns: dict[str, str], where: str = "true") -> str:
        return landed(emitted("events", "event_id", where), "event_id", dead, RECORDED, columns)

    out["wishlist_items"] = from_events(
        "event_id % 83 = 0",
        {
            "id": "event_id",
            "user_id": "user_id",
            "game_id": "event_id % 5",
            "added_at": "ts",
            "removed_at": (
                "case when event_id % 60 = 0 then ts - to_days(1) when event_id % 6 = 0 then ts + to_days(1) end"
            ),
            "recorded_at": RECORDED,
        },
    )
    out["ownership_grants"] = from_events(
        "event_id % 83 = 0",
        {
            "id": "event_id",
            "user_id": "user_id",
            "game_id": "event_id % 5",
            "source": (
                "case when event_id % 29 = 0 then 'bundle' when event_id % 3 = 0 then 'purchase' "
                "when event_id % 3 = 1 then 'gift' else 'key_redemption' end"
            ),
            "source_id": "event_id * 7",
            "granted_at": "ts",
            "revoked_at": "case when event_id % 9 = 0 then ts + to_days(5) end",
            "recorded_at": RECORDED,
        },
    )
    out["playtime_sessions"] = from_events(
        "event_id % 83 = 0",
        {
            "id": "event_id",
            "user_id": "user_id",
            "game_id": "event_id % 5",
            "started_at": "ts",
            "ended_at": (
                "case when event_id % 10 = 0 then null "
                "else ts + to_seconds(cast(floor(value * 60) as bigint) + v) end"
            ),
            "recorded_at": RECORDED,
        },
    )
    out["concurrent_player_snapshots"] = from_events(
        "event_id % 83 = 0",
        {
            "id": "event_id",
            "game_id": "event_id % 40",
            "player_count": "cast(floor(value * 10) as bigint) + v",
            "snapshot_at": "date_trunc('hour', ts)",
            "recorded_at": RECORDED,
        },
    )
    out["client_events"] = from_events(
        "event_id % 83 = 0",
        {
            "event_id": "event_id",
            "occurred_at": "ts",
            "user_id": "user_id",
            "session_id": (
                "case when event_id % 19 = 0 then null "
                "else user_id || '-' || strftime(ts, '%Y-%m-%d') end"
            ),
            "game_id": "case when event_id % 7 = 0 then null else event_id % 5 end",
            "event_name": (
                "case when event_id % 23 = 0 then 'page_scroll' when event_type = 'view' then 'store_page_view' "
                "when event_type = 'click' then 'game_page_view' when event_type = 'signup' then 'add_to_wishlist' "
                "when event_type = 'error' then 'begin_checkout' else 'purchase_complete' end"
            ),
            "props": "props",
            "recorded_at": RECORDED,
        },
    )
    out["family_shares"] = from_events(
        "event_id % 59 = 0",
        {
            "id": "event_id",
            "owner_id": "user_id",
            "borrower_id": "user_id + 1 + event_id % 7",
            "started_at": "ts",
            "ended_at": "case when event_id % 3 = 0 then null else ts + to_days(10) end",
            "recorded_at": RECORDED,
        },
    )
    out["reviews"] = from_events(
        "event_id % 59 = 0",
        {
            "id": "event_id",
            "user_id": "user_id",
            "game_id": "event_id % 5",
            "recommended": "event_id % 2 = 0",
            "playtime_at_review_minutes": "cast(floor(value) as bigint) + v",
            "submitted_at": "ts",
            "recorded_at": RECORDED,
        },
    )
    return {f"landing_{n}": s for n, s in out.items()}


def _staged(name: str, pk: str) -> str:
    table = LANDING[name]
    renames = {table.key: pk, "recommended": "is_recommended"}
    columns = ", ".join(f"{c} as {renames.get(c, c)}" for c in table.columns)
    return (
        f"select {columns}, coalesce(__deleted, false) as is_deleted from landing_{name} "
        f'qualify row_number() over (partition by {table.key} order by "offset" desc nulls first) = 1'
    )


from vitrine.plans.staging import KEY_NAMES  # noqa: E402

RELATIONS: dict[str, str] = _landing_relations()
RELATIONS.update({f"stg_{n}": _staged(n, pk) for n, pk in KEY_NAMES.items()})

_RATE = """case when ccy = 'USD' then 1.0::double
  when ccy = 'JPY' and n % 97 = 0 then 0.00005::double
  else (case ccy when 'EUR' then 1.05::double when 'GBP' then 1.25::double when 'BRL' then 0.2::double
        else 0.007::double end) + (n % 30) * 0.001::double end"""

RELATIONS.update(
    {
        "order_days": "select min(o_orderdate)::date as first_day, max(o_orderdate)::date + 1 as end_day from orders",
        "fx_rates": f"""select d as date, ccy as currency, {_RATE} as rate_to_usd
from (select d, date_diff('day', DATE '1970-01-01', d) as n, unnest(['USD', 'EUR', 'GBP', 'BRL', 'JPY']) as ccy
      from (select unnest(generate_series(first_day::timestamp, (end_day - 1)::timestamp, interval 1 day))::date as d
            from order_days))""",
        "purchase_usd": """select p.*, p.purchased_at::date as purchase_date,
  p.amount_cents::double / 100.0::double * r.rate_to_usd as amount_usd
from stg_purchases p left join fx_rates r on r.date = p.purchased_at::date and r.currency = p.currency""",
        "int_purchases_with_fx": f"""select purchase_id, {key('purchase_id')} as purchase_key,
  {key('user_id')} as user_key, {key('game_id')} as game_key, purchased_at, purchase_date, amount_cents, currency,
  amount_usd, payment_method, is_deleted from purchase_usd""",
        # Price history: who came first, what came next, and the two kinds of opening interval.
        "changes": "select * from stg_price_changes where not is_deleted",
        "opening": """select distinct on (game_id, region) game_id, region, currency, old_price_cents, changed_at
from changes order by game_id, region, changed_at, price_change_id""",
        "int_game_prices_replayed": """
select o.game_id, o.region, o.currency, o.old_price_cents as price_cents, g.created_at as valid_from,
  o.changed_at as valid_to, o.changed_at is null as is_current
from opening o join stg_games g using (game_id) where o.old_price_cents is not null
union all
select c.game_id, c.region, c.currency, c.new_price_cents,
  case when o.old_price_cents is null and o.changed_at = c.changed_at then g.created_at else c.changed_at end,
  c.next_at, c.next_at is null
from (select *, lead(changed_at) over (partition by game_id, region order by changed_at, price_change_id) as next_at
      from changes) c
join opening o on o.game_id = c.game_id and o.region = c.region
join stg_games g on g.game_id = c.game_id
union all
select p.game_id, p.region, p.currency, p.price_cents, g.created_at, null, true
from stg_game_prices p join stg_games g using (game_id)
where not p.is_deleted
  and not exists (select 1 from changes c where c.game_id = p.game_id and c.region = p.region)""",
        "dim_users": f"""select {key('user_id')} as user_key, user_id, username, country, campaign_id, created_at,
  created_at::date as signup_date, cast(date_diff('day', created_at::date, ({AS_OF})::date) as integer) as tenure_days
from stg_users where not is_deleted""",
        "dim_games": f"""select {key('game_id')} as game_key, game_id, name, developer, publisher, genres, languages,
  tags, created_at from stg_games where not is_deleted""",
        "dim_marketing_campaigns": f"""select {key('marketing_campaign_id')} as marketing_campaign_key,
  marketing_campaign_id, name, channel, spend_cents, currency, starts_at, ends_at, created_at
from stg_marketing_campaigns where not is_deleted""",
        "int_users_campaign_attribution": """select u.user_key, u.signup_date, u.campaign_id,
  c.marketing_campaign_key, coalesce(c.channel, 'organic') as channel
from dim_users u left join dim_marketing_campaigns c on c.marketing_campaign_id = u.campaign_id""",
        "dim_date": """select d as date_day, cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter,
  cast(month(d) as integer) as month, cast(day(d) as integer) as day_of_month,
  cast(dayofweek(d) as integer) as day_of_week, strftime(d, '%a') as day_name,
  cast(weekofyear(d) as integer) as week_of_year, dayofweek(d) in (0, 6) as is_weekend
from (select unnest(generate_series(first_day::timestamp, (end_day - 1)::timestamp, interval 1 day))::date as d
      from order_days)""",
        "dim_game_prices": f"""select {key('game_id', 'region', "strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')")}
  as game_price_key, * from int_game_prices_replayed""",
        "fct_purchases": """select purchase_key, user_key, game_key, purchased_at, purchase_date, amount_cents, currency,
  amount_usd, payment_method from int_purchases_with_fx where not is_deleted""",
        "fct_refunds": f"""select {key('r.refund_id')} as refund_key, p.purchase_key, p.user_key, p.game_key,
  r.refunded_at, r.refunded_at::date as refund_date, r.is_chargeback, p.amount_usd as refunded_amount_usd
from stg_refunds r join int_purchases_with_fx p on p.purchase_id = r.purchase_id
where not r.is_deleted and not p.is_deleted""",
        "fct_ownership_grants": f"""select {key('ownership_grant_id')} as ownership_grant_key,
  {key('user_id')} as user_key, {key('game_id')} as game_key, source, granted_at, revoked_at
from stg_ownership_grants where not is_deleted""",
        "fct_playtime_sessions": f"""select {key('playtime_session_id')} as playtime_session_key,
  {key('user_id')} as user_key, {key('game_id')} as game_key, started_at, started_at::date as started_date,
  ended_at is null as is_open, date_diff('minute', started_at, ended_at) as duration_minutes
from stg_playtime_sessions where not is_deleted""",
        "fct_concurrent_player_snapshots": f"""select
  {key('concurrent_player_snapshot_id')} as concurrent_player_snapshot_key, {key('game_id')} as game_key,
  player_count, snapshot_at, snapshot_at::date as snapshot_date
from stg_concurrent_player_snapshots where not is_deleted""",
        "fct_wishlist_items": f"""select {key('wishlist_item_id')} as wishlist_item_key, {key('user_id')} as user_key,
  {key('game_id')} as game_key, added_at, added_at::date as added_date, removed_at
from stg_wishlist_items where not is_deleted""",
        "run_results": """select 'test.' || (o_custkey % 120) as unique_id,
  case when o_orderkey % 10 = 0 then 'model' else 'test' end as resource_type,
  case when o_orderkey % 7 = 0 then 'fail' else 'pass' end as status, o_orderdate as created_at from orders""",
        "test_registry": """select 'test.' || s_suppkey as unique_id,
  'model.' || (s_suppkey // 2 + 1) as parent_model_unique_id from supplier""",
        "model_registry": """select 'model.' || s_suppkey as unique_id, 'layer_' || s_nationkey as schema_name
from supplier""",
        "freshness_results": """select 'run.' || event_id as source_freshness_execution_id,
  'source.' || user_id as unique_id,
  case event_type when 'error' then 'error' when 'click' then 'warn' else 'pass' end as status, ts as max_loaded_at,
  value as max_loaded_at_time_ago_in_s, ts + to_hours(1) as snapshotted_at,
  case when event_type = 'error' then 'no rows' end as error, ts + to_minutes(61) as created_at from events""",
        "source_registry": """select 'source.' || s_suppkey as unique_id, 'store' as source_name,
  lower(s_name) || '_' || g as name, 'layer_' || s_nationkey as schema_name,
  TIMESTAMP '2024-01-01' + to_days(g) as generated_at from (select *, unnest([0, 1]) as g from supplier)""",
        "fct_dbt_test_results": """select r.created_at::date as run_date, m.schema_name,
  cast(count(*) as bigint) as test_count, cast(count(*) filter (r.status = 'pass') as bigint) as pass_count,
  count(*) filter (r.status = 'pass') / nullif(count(*), 0) as pass_rate
from run_results r join test_registry t on t.unique_id = r.unique_id join model_registry m on m.unique_id = t.parent_model_unique_id
where r.resource_type = 'test' group by all""",
        "fct_source_freshness": """select r.source_freshness_execution_id, r.unique_id, s.source_name,
  s.name as table_name, s.schema_name, r.status, r.max_loaded_at, r.max_loaded_at_time_ago_in_s, r.snapshotted_at,
  r.error, r.created_at
from freshness_results r
join (select * from source_registry
      qualify row_number() over (partition by unique_id order by generated_at desc) = 1) s using (unique_id)""",
        # Range join over calendar days, as the measure is defined.
        "active_days": "select distinct user_key, started_date as day from fct_playtime_sessions",
        "fct_product_active_users_daily": f"""select d.day as active_date, {key('d.day')} as active_users_daily_key,
  cast(count(distinct a.user_key) filter (a.day = d.day) as bigint) as dau,
  cast(count(distinct a.user_key) as bigint) as wau
from (select distinct day from active_days) d join active_days a on a.day between d.day - 6 and d.day
group by d.day""",
        "session_cohorts": """select s.*, case when started_date = (min(started_date) over (partition by user_key, game_key))
  then 'new' else 'returning' end as user_cohort from fct_playtime_sessions s""",
        "fct_product_session_length_daily": f"""select started_date, game_key, user_cohort,
  {key('started_date', 'game_key', 'user_cohort')} as session_length_daily_key,
  cast(count(*) as bigint) as session_count, avg(duration_minutes) as avg_duration_minutes,
  cast(median(duration_minutes) as double) as p50_duration_minutes,
  quantile_cont(duration_minutes, 0.9) as p90_duration_minutes
from session_cohorts where not is_open group by started_date, game_key, user_cohort""",
        "wish_outcome": """select w.wishlist_item_key, w.game_key, w.added_at, min(g.granted_at) as got_at
from fct_wishlist_items w
left join fct_ownership_grants g on g.user_key = w.user_key and g.game_key = w.game_key and g.granted_at > w.added_at
group by all""",
        "fct_product_wishlist_conversion": f"""select game_key, {key('game_key')} as wishlist_conversion_key,
  cast(count(*) as bigint) as wishlist_add_count, cast(count(got_at) as bigint) as converted_count,
  count(got_at) / count(*) as conversion_rate,
  cast(median(date_diff('day', added_at, got_at)) as double) as median_days_to_convert
from wish_outcome group by game_key""",
        "fct_product_funnel_sessions": f"""select session_id, user_id, {key('session_id')} as funnel_session_key,
  min(occurred_at)::date as session_date, min(occurred_at) as session_started_at,
  {', '.join(f"min(occurred_at) filter (event_name = '{s}') as {s}_at" for s in FUNNEL_STAGES)},
  {', '.join(f"count(*) filter (event_name = '{s}') > 0 as has_reached_{s}" for s in FUNNEL_STAGES)}
from stg_client_events where not is_deleted and event_name in {_in(FUNNEL_STAGES)} group by session_id, user_id""",
        "fct_marketing_signups_daily": f"""select signup_date, channel,
  {key('signup_date', 'channel')} as marketing_signups_daily_key, cast(count(*) as bigint) as signup_count
from int_users_campaign_attribution group by signup_date, channel""",
        "fct_marketing_campaign_cpa": f"""select {key('c.marketing_campaign_key')} as marketing_campaign_cpa_key,
  c.marketing_campaign_key, c.channel, c.spend_cents, cast(count(a.user_key) as bigint) as attributed_signup_count,
  case when count(a.user_key) > 0 then c.spend_cents::double / 100.0::double / count(a.user_key) end as cpa_usd
from dim_marketing_campaigns c
left join int_users_campaign_attribution a on a.marketing_campaign_key = c.marketing_campaign_key
group by c.marketing_campaign_key, c.channel, c.spend_cents""",
        "fct_marketing_campaign_revenue": f"""select {key('c.marketing_campaign_key')} as marketing_campaign_revenue_key,
  c.marketing_campaign_key, c.channel, coalesce(sum(p.amount_usd), 0) as attributed_revenue_usd
from dim_marketing_campaigns c
left join int_users_campaign_attribution a on a.marketing_campaign_key = c.marketing_campaign_key
left join fct_purchases p on p.user_key = a.user_key
group by c.marketing_campaign_key, c.channel""",
        "bought_daily": """select p.purchase_date as d, u.country, false as flag,
  cast(round(sum(cast(p.amount_usd as decimal(28, 6))) * 100) as bigint) as cents, cast(count(*) as bigint) as n
from fct_purchases p join dim_users u on u.user_key = p.user_key group by all""",
        "refunded_daily": """select r.refund_date as d, u.country, r.is_chargeback as flag,
  cast(round(sum(cast(r.refunded_amount_usd as decimal(28, 6))) * 100) as bigint) as cents, cast(count(*) as bigint) as n
from fct_refunds r join dim_users u on u.user_key = r.user_key group by all""",
        "fct_finance_revenue_daily": f"""select g.d as revenue_date, g.country, g.flag as is_chargeback,
  {key('g.d', 'g.country', 'g.flag')} as finance_revenue_daily_key,
  coalesce(b.cents, 0) as revenue_cents, coalesce(r.cents, 0) as refunded_cents,
  coalesce(b.n, 0) as purchase_count, coalesce(r.n, 0) as refund_count,
  case when g.flag then coalesce(r.n, 0) else 0 end as chargeback_count
from (select d, country, flag from bought_daily union select d, country, flag from refunded_daily) g
left join bought_daily b on b.d = g.d and b.country is not distinct from g.country and b.flag = g.flag
left join refunded_daily r on r.d = g.d and r.country is not distinct from g.country and r.flag = g.flag""",
        "fct_finance_capacity_daily": f"""select day as capacity_date, {key('day')} as finance_capacity_daily_key,
  cast(max(total) as bigint) as peak_concurrent_players
from (select snapshot_at::date as day, sum(player_count) as total from fct_concurrent_player_snapshots
      group by snapshot_at) group by day""",
    }
)

_TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
_COUNTS = " union all ".join(
    f"select '{t}' as table_name, cast(count(*) as bigint) as row_count from {t}" for t in _TABLE_NAMES
)
RELATIONS["fct_row_counts"] = f"""select 'testdata' as schema_name, table_name, snapshot_date, row_count
from ({_COUNTS}), (values (DATE '2024-01-30'), (DATE '2024-01-31')) days(snapshot_date)
union all
select 'testdata', 'returned_lines', DATE '2024-01-31', cast(count(*) as bigint) from lineitem where l_returnflag = 'R'"""

_WORD = re.compile(r"\b[a-z_]+\b")


def _needed(sql: str, found: list[str], seen: set[str]) -> None:
    for word in _WORD.findall(sql):
        if word in RELATIONS and word not in seen:
            seen.add(word)
            _needed(RELATIONS[word], found, seen)
            found.append(word)


def compose(sql: str) -> str:
    """``sql`` preceded by the shared relations it reads, each after those it needs itself."""
    found: list[str] = []
    _needed(sql, found, set())
    if not found:
        return sql
    ctes = ",\n".join(f"{n} as (\n{RELATIONS[n]}\n)" for n in found)
    return f"with {ctes}\n{sql}"


_ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ') as {c}"


def scan_sql(name: str) -> str:
    table = LANDING[name]
    columns = [_ISO.format(c=c) if c in table.timestamps else c for c in table.columns]
    return (
        f'select {", ".join(columns)}, __op, __source_ts_ms, cast("offset" * 10 as bigint) as __source_lsn, '
        "case when __op = 'r' then 'true' else 'false' end as __source_snapshot, "
        f"'{name}' as __source_table, cast({table.key} as bigint) as __source_txid, __deleted, "
        f"\"offset\" as kafka_offset, 0 as kafka_partition, 'store.{name}' as kafka_topic from landing_{name}"
    )


HEALTH_RELATIONS = {
    "run_results": "run_results",
    "tests": "test_registry",
    "models": "model_registry",
    "source_freshness_results": "freshness_results",
    "sources": "source_registry",
}


def stage_sql(name: str) -> str:
    columns = "* replace (replace(props, ' ', '') as props)" if name == "client_events" else "*"
    return f"select {columns} from stg_{name}"


MODEL_SQL = {
    name: f"select * from {name}"
    for name in RELATIONS
    if name.startswith(("int_", "dim_", "fct_")) and name not in ("fct_row_counts",)
}
MODEL_SQL["fct_marketing_campaign_revenue"] = (
    "select * replace (round(attributed_revenue_usd, 2) as attributed_revenue_usd) from fct_marketing_campaign_revenue"
)
MODEL_SQL["fct_product_session_length_daily"] = (
    "select * replace (round(avg_duration_minutes, 6) as avg_duration_minutes, "
    "round(p90_duration_minutes, 6) as p90_duration_minutes) from fct_product_session_length_daily"
)
MODEL_SQL["fct_row_counts"] = "select * from fct_row_counts"


def freshness_sql() -> str:
    parts = [
        f"select 'source.{n}' as unique_id, {w} * 3600.0 as warn_s, {e} * 3600.0 as error_s, max(__source_ts_ms) as ms "
        f"from landing_{n}"
        for n, (w, e) in FRESHNESS_HOURS.items()
    ]
    return f"""select md5(unique_id || '-' || epoch_ms({AS_OF})) as source_freshness_execution_id, unique_id,
  case when ms is null or age > error_s then 'error' when age > warn_s then 'warn' else 'pass' end as status,
  make_timestamp(ms * 1000) as max_loaded_at, age as max_loaded_at_time_ago_in_s, {AS_OF} as snapshotted_at,
  cast(null as varchar) as error, {AS_OF} as created_at
from (select *, (epoch_ms({AS_OF}) - ms)::double / 1000.0::double as age from ({' union all '.join(parts)}))"""


def checks_sql(table: str) -> str:
    """(check_name, failures) of the declared checks of one table."""
    out = []
    for c in CHECKS[table]:
        col = c.columns[0]
        if c.kind == "not_null":
            bad = f"select 1 from {table} where {col} is null"
        elif c.kind == "unique":
            bad = f"select {col} from {table} where {col} is not null group by {col} having count(*) > 1"
        elif c.kind == "accepted_values":
            bad = f"select distinct {col} from {table} where {col} not in {_in(c.values)}"
        elif c.kind == "unique_combination":
            bad = f"select 1 from {table} group by {', '.join(c.columns)} having count(*) > 1"
        else:
            parent, field = c.parent
            bad = (
                f"select 1 from {table} child where child.{col} is not null "
                f"and not exists (select 1 from {parent} p where p.{field} = child.{col})"
            )
        out.append(f"select '{c.name(table)}' as check_name, cast(count(*) as bigint) as failures from ({bad})")
    return "\nunion all\n".join(out)


def _below_zero(table: str, *cols: str, extra: str = "", columns: str = "*") -> str:
    return f"select {columns} from {table} where " + " or ".join(f"{c} < 0" for c in cols) + extra


_PREVIOUS = """(select game_id, region, valid_from, valid_to, lag(valid_to) over (
  partition by game_id, region order by valid_from, valid_to nulls last) as prev_valid_to
from dim_game_prices)"""

INVARIANT_SQL = {
    "dim_game_prices_gapless_coverage": f"select * from {_PREVIOUS} where valid_from <> prev_valid_to",
    "dim_game_prices_no_overlapping_intervals": f"select * from {_PREVIOUS} where valid_from < prev_valid_to",
    "dim_game_prices_one_current_row": """select game_id, region,
  cast(count(*) filter (is_current) as bigint) as current_row_count
from dim_game_prices group by game_id, region having count(*) filter (is_current) <> 1""",
    "fct_finance_capacity_daily_non_negative": _below_zero("fct_finance_capacity_daily", "peak_concurrent_players"),
    "fct_finance_revenue_daily_non_negative": _below_zero(
        "fct_finance_revenue_daily",
        "revenue_cents",
        "refunded_cents",
        "purchase_count",
        "refund_count",
        "chargeback_count",
    ),
    "fct_finance_revenue_daily_refunds_by_refund_date": """select * from (
  select coalesce(e.d, a.revenue_date) as revenue_date, coalesce(e.country, a.country) as country,
    coalesce(e.flag, a.is_chargeback) as is_chargeback, coalesce(e.cents, 0) as expected_refunded_cents,
    coalesce(a.refunded_cents, 0) as actual_refunded_cents
  from refunded_daily e full join fct_finance_revenue_daily a
    on a.revenue_date = e.d and a.country is not distinct from e.country and a.is_chargeback = e.flag)
where expected_refunded_cents <> actual_refunded_cents""",
    "fct_marketing_campaign_cpa_non_negative": _below_zero(
        "fct_marketing_campaign_cpa", "spend_cents", "attributed_signup_count", "cpa_usd"
    ),
    "fct_marketing_campaign_revenue_non_negative": _below_zero(
        "fct_marketing_campaign_revenue", "attributed_revenue_usd"
    ),
    "fct_marketing_signups_daily_non_negative": _below_zero("fct_marketing_signups_daily", "signup_count"),
    "fct_marketing_signups_daily_organic_logic": """select * from (
  select coalesce(e.signup_date, a.signup_date) as signup_date, coalesce(e.channel, a.channel) as channel,
    coalesce(e.n, 0) as expected_signup_count, coalesce(a.signup_count, 0) as actual_signup_count
  from (select u.signup_date, coalesce(c.channel, 'organic') as channel, count(*) as n
        from dim_users u left join dim_marketing_campaigns c on c.marketing_campaign_id = u.campaign_id
        group by all) e
  full join fct_marketing_signups_daily a on a.signup_date = e.signup_date and a.channel = e.channel)
where expected_signup_count <> actual_signup_count""",
    "fct_product_active_users_daily_non_negative": _below_zero(
        "fct_product_active_users_daily", "dau", "wau", extra=" or wau < dau"
    ),
    "fct_product_funnel_sessions_stages_monotonic": f"""select * from (
  select funnel_session_key, stage_order, stage_at, lag(stage_at) over (
    partition by funnel_session_key order by stage_order, stage_at) as prev_stage_at
  from ({' union all '.join(
      f"select funnel_session_key, {i} as stage_order, {s}_at as stage_at from fct_product_funnel_sessions"
      for i, s in enumerate(FUNNEL_STAGES, start=1))}) where stage_at is not null)
where stage_at < prev_stage_at""",
    "fct_product_session_length_daily_non_negative": _below_zero(
        "fct_product_session_length_daily",
        "session_count",
        "avg_duration_minutes",
        "p50_duration_minutes",
        "p90_duration_minutes",
    ),
    "fct_product_wishlist_conversion_logic": """select * from (
  select coalesce(e.game_key, a.game_key) as game_key, coalesce(e.adds, 0) as expected_wishlist_add_count,
    coalesce(e.hits, 0) as expected_converted_count, coalesce(a.wishlist_add_count, 0) as actual_wishlist_add_count,
    coalesce(a.converted_count, 0) as actual_converted_count
  from (select game_key, count(*) as adds, count(*) filter (hit) as hits
        from (select w.game_key, exists (select 1 from fct_ownership_grants g where g.user_key = w.user_key
                and g.game_key = w.game_key and g.granted_at > w.added_at) as hit from fct_wishlist_items w)
        group by game_key) e
  full join fct_product_wishlist_conversion a on a.game_key = e.game_key)
where expected_wishlist_add_count <> actual_wishlist_add_count or expected_converted_count <> actual_converted_count""",
    "fct_product_wishlist_conversion_non_negative": _below_zero(
        "fct_product_wishlist_conversion",
        "wishlist_add_count",
        "converted_count",
        "conversion_rate",
        "median_days_to_convert",
        extra=" or conversion_rate > 1",
    ),
    "fct_purchases_amount_usd_not_null": """select * from fct_purchases
where amount_usd is null and currency is not null""",
    "fct_purchases_amount_usd_sane_ratio": """select * from (
  select *, amount_usd / (amount_cents::double / 100.0::double) as implied_rate_to_usd from fct_purchases
  where amount_cents <> 0 and amount_usd is not null)
where implied_rate_to_usd < 0.0001::double or implied_rate_to_usd > 10""",
    "fct_refunds_after_purchase": """select r.refund_key, r.refunded_at, p.purchased_at
from fct_refunds r join fct_purchases p on p.purchase_key = r.purchase_key where r.refunded_at < p.purchased_at""",
    "fct_wishlist_items_removed_after_added": "select * from fct_wishlist_items where removed_at < added_at",
}

__all__ = [
    "HEALTH_RELATIONS",
    "INVARIANT_SQL",
    "MODEL_SQL",
    "checks_sql",
    "compose",
    "freshness_sql",
    "key",
    "scan_sql",
    "stage_sql",
]
