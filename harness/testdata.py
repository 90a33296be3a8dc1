"""Storefront inputs derived from the driver's parquet tables.

Every landing table comes from a whole driver table by integer arithmetic that DuckDB repeats exactly
(``oracle.py``). One row in four is emitted twice, the copy at a higher offset with one attribute
changed, as a connector restart would. Where a key is deleted, only its newest version says so.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.plans import Warehouse
from vitrine.session import configure
from vitrine.sources import LANDING

AS_OF = dt.datetime(2024, 1, 31, 2, 0, 0, tzinfo=dt.timezone.utc)


# Schemas of the driver tables, so that no read has to open a file to learn them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
_ZONELESS = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its zone-less timestamps are UTC instants."""
    df = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name in _ZONELESS:
        df = df.withColumn(_ZONELESS[name], F.col(_ZONELESS[name]).cast("timestamp"))
    return df


def _emitted(df: DataFrame, key: str) -> DataFrame:
    """Rows with their version number ``v``; every fourth key has a version 1."""
    return df.withColumn("v", F.expr(f"explode(if({key} % 4 = 0, array(0, 1), array(0)))"))


def _landed(df: DataFrame, name: str, dead: str, clock: str, columns: dict[str, str]) -> DataFrame:
    """Project ``columns`` to the landing schema and add what the connector writes."""
    layout = LANDING[name]
    business = []
    for c in layout.columns:
        value = F.expr(columns[c])
        if c in layout.timestamps:
            value = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        business.append(value.alias(c))
    key = F.expr(columns[layout.key])
    offset = (key * 2 + F.col("v")).cast("long")
    deleted = (
        F.when(F.expr(dead) & ((key % 4 != 0) | (F.col("v") == 1)), F.lit(True))
        .when(key % 3 == 0, F.lit(None).cast("boolean"))
        .otherwise(F.lit(False))
    )
    again = F.col("v") == 1
    return df.select(
        *business,
        F.when(again, "r").otherwise("c").alias("__op"),
        (F.unix_millis(F.expr(clock)) + F.col("v") * 1000).cast("long").alias("__source_ts_ms"),
        (offset * 10).alias("__source_lsn"),
        F.when(again, "true").otherwise("false").alias("__source_snapshot"),
        F.lit(name).alias("__source_table"),
        key.cast("long").alias("__source_txid"),
        deleted.alias("__deleted"),
        F.struct(
            offset.alias("offset"), F.lit(0).alias("partition"), F.concat(F.lit("store."), F.lit(name)).alias("topic")
        ).alias("record_metadata"),
    )


_PURCHASED = "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)"


def landing(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Landing table ``name`` in its contract schema."""

    def read(t: str) -> DataFrame:
        return table(spark, sf_dir, t)

    if name == "users":
        nation = read("nation").select("n_nationkey", "n_name")
        base = read("customer").join(nation, F.expr("c_nationkey = n_nationkey"), "left")
        start = "timestamp'1994-01-01' + make_dt_interval(c_custkey % 365)"
        return _landed(
            _emitted(base, "c_custkey"),
            name,
            "c_custkey % 97 = 0",
            start,
            {
                "id": "c_custkey",
                "username": "concat(c_name, '~', v)",
                "email": "concat(lower(c_name), '@example.org')",
                "country": "if(c_nationkey % 5 = 0, null, n_name)",
                "campaign_id": "if(c_custkey % 3 = 0 or (c_custkey div 13) % 10 = 7, null, c_custkey div 13)",
                "created_at": start,
            },
        )
    if name == "games":
        start = "timestamp'1994-06-01' + make_dt_interval(int(p_partkey % 30))"
        return _landed(
            _emitted(read("part"), "p_partkey"),
            name,
            "p_partkey % 101 = 0",
            start,
            {
                "id": "p_partkey",
                "name": "concat(p_name, '~', v)",
                "developer": "p_brand",
                "publisher": "p_type",
                "genres": "array(p_type)",
                "languages": "array('en', p_brand)",
                "tags": "concat('{\"size\":', p_size, '}')",
                "created_at": start,
            },
        )
    if name == "game_prices":
        # A part makes 5 to 10 rows: dealt out before it does, so that no task makes and sorts those of a whole row group.
        # As many partitions as were asked for, since the parts are small beside what becomes of them.
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = read("part").repartition(parts, "p_partkey", "p_retailprice")
        base = dealt.withColumn("r", F.expr("explode(sequence(0, 4))"))
        start = "timestamp'1994-07-01' + make_dt_interval(int(p_partkey % 30))"
        return _landed(
            _emitted(base, "(p_partkey * 5 + r)"),
            name,
            "(p_partkey * 5 + r) % 89 = 0",
            start,
            {
                "id": "p_partkey * 5 + r",
                "game_id": "p_partkey",
                "region": "concat('R', r)",
                "currency": "'USD'",
                "price_cents": "cast(round(p_retailprice * 100) as bigint) + v",
                "updated_at": start,
            },
        )
    if name == "marketing_campaigns":
        start = "timestamp'1994-01-01' + make_dt_interval(int(s_suppkey % 365))"
        channel = (
            "case when s_suppkey % 17 = 16 then 'billboard' when s_suppkey % 5 = 0 then 'paid_search' "
            "when s_suppkey % 5 = 1 then 'paid_social' when s_suppkey % 5 = 2 then 'email' "
            "when s_suppkey % 5 = 3 then 'influencer' else 'affiliate' end"
        )
        return _landed(
            _emitted(read("supplier"), "s_suppkey"),
            name,
            "s_suppkey % 10 = 9",
            start,
            {
                "id": "s_suppkey",
                "name": "concat(s_name, '~', v)",
                "channel": channel,
                "spend_cents": "(s_suppkey + 1) * 100000 + v",
                "currency": "'USD'",
                "starts_at": start,
                "ends_at": f"{start} + make_dt_interval(30)",
                "created_at": f"{start} - make_dt_interval(10)",
            },
        )
    if name == "purchases":
        currency = (
            "case when o_orderkey % 1000 = 998 then null when o_orderkey % 1000 = 999 then 'XXX' "
            "when o_orderkey % 5 = 0 then 'USD' when o_orderkey % 5 = 1 then 'EUR' "
            "when o_orderkey % 5 = 2 then 'GBP' when o_orderkey % 5 = 3 then 'BRL' else 'JPY' end"
        )
        recorded = f"{_PURCHASED} + make_dt_interval(0, 0, 1)"
        return _landed(
            _emitted(read("orders"), "o_orderkey"),
            name,
            "o_orderkey % 61 = 0",
            recorded,
            {
                "id": "o_orderkey",
                "user_id": "o_custkey",
                "game_id": "o_orderkey % 200",
                "amount_cents": "cast(round(o_totalprice * 100) as bigint) + v",
                "currency": currency,
                "payment_method": "o_orderpriority",
                "purchased_at": _PURCHASED,
                "recorded_at": recorded,
            },
        )
    if name == "refunds":
        refunded = f"{_PURCHASED} + make_dt_interval(if(o_orderkey % 500 = 0, -1, int(o_orderkey % 45)))"
        return _landed(
            _emitted(read("orders"), "o_orderkey"),
            name,
            "o_orderkey % 53 = 0",
            refunded,
            {
                "id": "o_orderkey",
                "purchase_id": "o_orderkey",
                "reason": "concat(o_orderpriority, '~', v)",
                "is_chargeback": "if(o_orderkey % 211 = 0, null, o_orderkey % 7 = 0)",
                "refunded_at": refunded,
                "recorded_at": refunded,
            },
        )
    if name == "price_changes":
        return _landed(
            _emitted(read("orders"), "o_orderkey"),
            name,
            "o_orderkey % 71 = 0",
            "o_orderdate",
            {
                "id": "o_orderkey",
                "game_id": "if(o_orderkey % 97 = 0, -1, o_orderkey % 100)",
                "region": "if(o_orderkey % 79 = 0, null, concat('R', (o_orderkey div 100) % 5))",
                "currency": "'USD'",
                "old_price_cents": "if(o_orderkey % 4 = 0, null, cast(round(o_totalprice) as bigint))",
                "new_price_cents": "cast(round(o_totalprice) as bigint) + 1 + v",
                "changed_at": "o_orderdate",
                "recorded_at": "o_orderdate",
            },
        )
    if name == "gifts":
        recorded = f"{_PURCHASED} + make_dt_interval(0, 0, 2, v)"
        return _landed(
            _emitted(read("orders"), "o_orderkey"),
            name,
            "o_orderkey % 59 = 0",
            recorded,
            {
                "id": "o_orderkey",
                "purchase_id": "o_orderkey",
                "sender_id": "o_custkey",
                "recipient_id": "(o_custkey * 7) % 1000",
                "sent_at": _PURCHASED,
                "redeemed_at": f"if(o_orderkey % 4 = 1, null, {_PURCHASED} + make_dt_interval(2))",
                "recorded_at": recorded,
            },
        )
    if name == "key_redemptions":
        recorded = "o_orderdate + make_dt_interval(0, 0, 2, v)"
        return _landed(
            _emitted(read("orders"), "o_orderkey"),
            name,
            "o_orderkey % 59 = 0",
            recorded,
            {
                "id": "o_orderkey",
                "key_hash": "md5(cast(o_orderkey as string))",
                "user_id": "o_custkey",
                "game_id": "o_orderkey % 200",
                "redeemed_at": "o_orderdate",
                "recorded_at": recorded,
            },
        )

    # The rest comes from the event stream.
    recorded = "ts + make_dt_interval(0, 0, 1, v)"
    source = read("events")
    if name == "wishlist_items":
        dead = "event_id % 83 = 0"
        columns = {
            "id": "event_id",
            "user_id": "user_id",
            "game_id": "event_id % 5",
            "added_at": "ts",
            "removed_at": (
                "case when event_id % 60 = 0 then ts - make_dt_interval(1) "
                "when event_id % 6 = 0 then ts + make_dt_interval(1) end"
            ),
            "recorded_at": recorded,
        }
    elif name == "ownership_grants":
        dead = "event_id % 83 = 0"
        columns = {
            "id": "event_id",
            "user_id": "user_id",
            "game_id": "event_id % 5",
            "source": (
                "case when event_id % 29 = 0 then 'bundle' when event_id % 3 = 0 then 'purchase' "
                "when event_id % 3 = 1 then 'gift' else 'key_redemption' end"
            ),
            "source_id": "event_id * 7",
            "granted_at": "ts",
            "revoked_at": "if(event_id % 9 = 0, ts + make_dt_interval(5), null)",
            "recorded_at": recorded,
        }
    elif name == "playtime_sessions":
        dead = "event_id % 83 = 0"
        columns = {
            "id": "event_id",
            "user_id": "user_id",
            "game_id": "event_id % 5",
            "started_at": "ts",
            "ended_at": "if(event_id % 10 = 0, null, ts + make_dt_interval(0, 0, 0, floor(value * 60) + v))",
            "recorded_at": recorded,
        }
    elif name == "concurrent_player_snapshots":
        dead = "event_id % 83 = 0"
        columns = {
            "id": "event_id",
            "game_id": "event_id % 40",
            "player_count": "cast(floor(value * 10) as bigint) + v",
            "snapshot_at": "date_trunc('hour', ts)",
            "recorded_at": recorded,
        }
    elif name == "client_events":
        dead = "event_id % 83 = 0"
        columns = {
            "event_id": "event_id",
            "occurred_at": "ts",
            "user_id": "user_id",
            "session_id": "if(event_id % 19 = 0, null, concat(user_id, '-', cast(cast(ts as date) as string)))",
            "game_id": "if(event_id % 7 = 0, null, event_id % 5)",
            "event_name": (
                "case when event_id % 23 = 0 then 'page_scroll' when event_type = 'view' then 'store_page_view' "
                "when event_type = 'click' then 'game_page_view' when event_type = 'signup' then 'add_to_wishlist' "
                "when event_type = 'error' then 'begin_checkout' else 'purchase_complete' end"
            ),
            "props": "props",
            "recorded_at": recorded,
        }
    elif name == "family_shares":
        dead = "event_id % 59 = 0"
        columns = {
            "id": "event_id",
            "owner_id": "user_id",
            "borrower_id": "user_id + 1 + event_id % 7",
            "started_at": "ts",
            "ended_at": "if(event_id % 3 = 0, null, ts + make_dt_interval(10))",
            "recorded_at": recorded,
        }
    elif name == "reviews":
        dead = "event_id % 59 = 0"
        columns = {
            "id": "event_id",
            "user_id": "user_id",
            "game_id": "event_id % 5",
            "recommended": "event_id % 2 = 0",
            "playtime_at_review_minutes": "cast(floor(value) as bigint) + v",
            "submitted_at": "ts",
            "recorded_at": recorded,
        }
    else:
        raise KeyError(name)
    return _landed(_emitted(source, "event_id"), name, dead, recorded, columns)


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: first day of the orders, and the day after the last."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    return days.agg(F.min("d").alias("first_day"), F.date_add(F.max("d"), 1).alias("end_day"))


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rates of five currencies over the days of the orders; JPY is broken on some days."""
    days = order_days(spark, sf_dir).selectExpr("explode(sequence(first_day, date_sub(end_day, 1))) as date")
    rows = days.selectExpr("date", "unix_date(date) as n", "explode(array('USD','EUR','GBP','BRL','JPY')) as currency")
    base = (
        "case currency when 'EUR' then 1.05D when 'GBP' then 1.25D when 'BRL' then 0.2D else 0.007D end"
        " + (n % 30) * 0.001D"
    )
    rate = f"case when currency = 'USD' then 1.0D when currency = 'JPY' and n % 97 = 0 then 0.00005D else {base} end"
    return rows.selectExpr("date", "currency", f"{rate} as rate_to_usd")


def health(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Check-runner tables derived from orders, suppliers and events."""
    if name == "run_results":
        return table(spark, sf_dir, "orders").selectExpr(
            "concat('test.', o_custkey % 120) as unique_id",
            "if(o_orderkey % 10 = 0, 'model', 'test') as resource_type",
            "if(o_orderkey % 7 = 0, 'fail', 'pass') as status",
            "o_orderdate as created_at",
        )
    if name == "tests":
        return table(spark, sf_dir, "supplier").selectExpr(
            "concat('test.', s_suppkey) as unique_id",
            "concat('model.', s_suppkey div 2 + 1) as parent_model_unique_id",
        )
    if name == "models":
        return table(spark, sf_dir, "supplier").selectExpr(
            "concat('model.', s_suppkey) as unique_id", "concat('layer_', s_nationkey) as schema_name"
        )
    if name == "source_freshness_results":
        return table(spark, sf_dir, "events").selectExpr(
            "concat('run.', event_id) as source_freshness_execution_id",
            "concat('source.', user_id) as unique_id",
            "if(event_type = 'error', 'error', if(event_type = 'click', 'warn', 'pass')) as status",
            "ts as max_loaded_at",
            "value as max_loaded_at_time_ago_in_s",
            "ts + make_dt_interval(0, 1) as snapshotted_at",
            "if(event_type = 'error', 'no rows', null) as error",
            "ts + make_dt_interval(0, 1, 1) as created_at",
        )
    if name == "sources":
        twice = table(spark, sf_dir, "supplier").selectExpr("*", "explode(array(0, 1)) as g")
        return twice.selectExpr(
            "concat('source.', s_suppkey) as unique_id",
            "'store' as source_name",
            "concat(lower(s_name), '_', g) as name",
            "concat('layer_', s_nationkey) as schema_name",
            "timestamp'2024-01-01' + make_dt_interval(g) as generated_at",
        )
    raise KeyError(name)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A run over the driver tables of one scale factor."""
    configure(spark)
    return Warehouse(
        spark,
        landing=lambda name: landing(spark, sf_dir, name),
        fx=lambda: fx_rates(spark, sf_dir),
        as_of=AS_OF,
        health=lambda name: health(spark, sf_dir, name),
        calendar=lambda: order_days(spark, sf_dir),
    )
