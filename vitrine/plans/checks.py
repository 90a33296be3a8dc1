"""The declared checks of every table, the invariants between tables, and their runner."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators import (
    check_unique_combination,
    converted_counts,
    diff_by_key,
    lookup,
    previous_end,
    stage_order_violations,
    value_counts,
)
from vitrine.operators.money import cents, exact
from vitrine.plans.core import CORE
from vitrine.plans.product import FUNNEL_STAGES
from vitrine.plans.staging import KEY_NAMES
from vitrine.plans.warehouse import LAYER_OF, Warehouse
from vitrine.sources import HEALTH_SCHEMAS, LANDING

# The accepted sets.
CHANNELS = ["paid_search", "paid_social", "email", "influencer", "affiliate"]
GRANT_SOURCES = ["purchase", "gift", "key_redemption"]
COHORTS = ["new", "returning"]


@dataclass(frozen=True)
class Check:
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    parent: tuple[str, str] | None = None

    def name(self, table: str) -> str:
        return "_".join([self.kind, table, *self.columns])


def _unique(col: str) -> list[Check]:
    return [Check("unique", (col,))]


def _filled(*cols: str) -> list[Check]:
    return [Check("not_null", (c,)) for c in cols]


def _key(col: str) -> list[Check]:
    return _unique(col) + _filled(col)


def _among(col: str, values: list[str]) -> list[Check]:
    return [Check("accepted_values", (col,), values=tuple(values))]


def _refers(col: str, table: str, field: str | None = None) -> list[Check]:
    return [Check("relationships", (col,), parent=(table, field or col))]


def _together(*cols: str) -> list[Check]:
    return [Check("unique_combination", cols)]


_USER = _filled("user_key") + _refers("user_key", "dim_users")
_GAME = _filled("game_key") + _refers("game_key", "dim_games")
_CAMPAIGN = (
    _key("marketing_campaign_key")
    + _refers("marketing_campaign_key", "dim_marketing_campaigns")
    + _filled("channel")
    + _among("channel", CHANNELS)
)

# The declared checks of each table.
CHECKS: dict[str, list[Check]] = {
    **{f"stg_{name}": _key(key) for name, key in KEY_NAMES.items()},
    "dim_users": _key("user_key")
    + _key("user_id")
    + _refers("campaign_id", "dim_marketing_campaigns", "marketing_campaign_id"),
    "dim_marketing_campaigns": _key("marketing_campaign_key")
    + _key("marketing_campaign_id")
    + _filled("channel")
    + _among("channel", CHANNELS),
    "dim_games": _key("game_key") + _key("game_id"),
    "dim_date": _key("date_day"),
    "dim_game_prices": _key("game_price_key"),
    "fct_purchases": _key("purchase_key") + _USER + _GAME,
    "fct_refunds": _key("refund_key")
    + _filled("purchase_key")
    + _refers("purchase_key", "fct_purchases")
    + _USER
    + _GAME,
    "fct_ownership_grants": _key("ownership_grant_key") + _USER + _GAME + _among("source", GRANT_SOURCES),
    "fct_playtime_sessions": _key("playtime_session_key") + _USER + _GAME + _filled("is_open"),
    "fct_concurrent_player_snapshots": _key("concurrent_player_snapshot_key") + _GAME,
    "fct_wishlist_items": _key("wishlist_item_key") + _USER + _GAME,
    "fct_dbt_test_results": _together("run_date", "schema_name")
    + _filled("run_date", "schema_name", "test_count", "pass_count"),
    "fct_source_freshness": _key("source_freshness_execution_id") + _filled("unique_id", "status"),
    "fct_row_counts": _together("schema_name", "table_name", "snapshot_date")
    + _filled("schema_name", "table_name", "snapshot_date", "row_count"),
    "fx_rates": _together("date", "currency") + _filled("date", "currency", "rate_to_usd"),
    "fct_product_active_users_daily": _key("active_users_daily_key") + _key("active_date") + _filled("dau", "wau"),
    "fct_product_session_length_daily": _key("session_length_daily_key")
    + _filled("started_date")
    + _GAME
    + _filled("user_cohort")
    + _among("user_cohort", COHORTS),
    "fct_product_wishlist_conversion": _key("wishlist_conversion_key")
    + _unique("game_key")
    + _GAME
    + _filled("wishlist_add_count", "converted_count", "conversion_rate"),
    "fct_product_funnel_sessions": _key("funnel_session_key")
    + _key("session_id")
    + _filled("user_id")
    + _refers("user_id", "dim_users")
    + _filled("session_date", "session_started_at"),
    "fct_marketing_signups_daily": _key("marketing_signups_daily_key")
    + _filled("signup_date", "channel")
    + _among("channel", [*CHANNELS, "organic"])
    + _filled("signup_count"),
    "fct_marketing_campaign_cpa": _key("marketing_campaign_cpa_key")
    + _CAMPAIGN
    + _filled("spend_cents", "attributed_signup_count"),
    "fct_marketing_campaign_revenue": _key("marketing_campaign_revenue_key")
    + _CAMPAIGN
    + _filled("attributed_revenue_usd"),
    "fct_finance_revenue_daily": _key("finance_revenue_daily_key") + _filled("revenue_date", "is_chargeback"),
    "fct_finance_capacity_daily": _key("finance_capacity_daily_key")
    + _key("capacity_date")
    + _filled("peak_concurrent_players"),
}


def failures(table: str, df: DataFrame, checks: list[Check], parent: Callable[[str], DataFrame]) -> DataFrame:
    """(check_name, failures) of one table.

    NULLs are counted in one aggregate. The values of all columns that must be unique, have a parent or be
    among given ones are counted together, as fingerprints of their text, in one more pass; of the last kind only values
    that are none of the given ones. Only checks of column combinations take passes of their own.
    """
    zero = F.lit(0).cast("long")
    parts = []
    filled = [c for c in checks if c.kind == "not_null"]
    if filled:
        row = df.agg(*[F.count_if(F.col(c.columns[0]).isNull()).alias(f"n{i}") for i, c in enumerate(filled)])
        parts.append(_one_row_each(row, [(c.name(table), f"n{i}") for i, c in enumerate(filled)]))
    cells, number = {}, {}
    for c in checks:
        text = F.col(c.columns[0]).cast("string")
        if c.kind in ("unique", "relationships"):
            number[c] = number.setdefault(("value", c.columns[0]), len(cells))
            cells[number[c]] = text
        elif c.kind == "accepted_values":
            number[c] = len(cells)
            cells[number[c]] = F.when(~text.isin([str(v) for v in c.values]), text)
    if cells:
        counts = value_counts(df, cells)
        answers = [c for c in checks if c.kind in ("unique", "accepted_values")]
        if answers:
            wrong = {c: (F.col("c") == number[c]) & (F.col("n") > (1 if c.kind == "unique" else 0)) for c in answers}
            row = counts.agg(*[F.count_if(wrong[c]).alias(f"n{i}") for i, c in enumerate(answers)])
            parts.append(_one_row_each(row, [(c.name(table), f"n{i}") for i, c in enumerate(answers)]))
        for c in (c for c in checks if c.kind == "relationships"):
            known = value_counts(parent(c.parent[0]), {number[c]: F.col(c.parent[1]).cast("string")}).select("c", "p", "q")
            orphans = counts.filter(F.col("c") == number[c]).join(known, ["c", "p", "q"], "left_anti")
            row = orphans.agg(F.coalesce(F.sum("n"), zero).alias("failures"))
            parts.append(row.select(F.lit(c.name(table)).alias("check_name"), "failures"))
    for c in (c for c in checks if c.kind == "unique_combination"):
        repeated = check_unique_combination(df, list(c.columns)).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(repeated.select(F.lit(c.name(table)).alias("check_name"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def _one_row_each(row: DataFrame, answers: list[tuple[str, str]]) -> DataFrame:
    """The columns of a single row as rows of their own."""
    named = [F.struct(F.lit(name).alias("check_name"), F.col(column).alias("failures")) for name, column in answers]
    return row.select(F.explode(F.array(*named)).alias("_a")).select("_a.*")


def table_failures(wh: Warehouse, table: str, df: DataFrame | None = None) -> DataFrame:
    """Failures of the declared checks of ``table``, as a lazy plan."""
    checks = CHECKS[table]
    if df is None:
        df = wh.fx_rates if table == "fx_rates" else wh[table]
    df = df.select(*dict.fromkeys(col for c in checks for col in c.columns))
    return failures(table, df, checks, lambda name: wh[name])


# Invariant name -> (table it guards, function of a Warehouse returning the violating rows).
INVARIANTS: dict[str, tuple[str, Callable[[Warehouse], DataFrame]]] = {}


def invariant(table: str):
    def register(fn):
        INVARIANTS[fn.__name__] = (table, fn)
        return fn

    return register


def _negative(*cols: str):
    return reduce(lambda a, b: a | b, [F.col(c) < 0 for c in cols])


@invariant("dim_game_prices")
def dim_game_prices_gapless_coverage(wh: Warehouse) -> DataFrame:
    """Intervals that do not start where the one before them ends."""
    prices = previous_end(wh["dim_game_prices"], ["game_id", "region"])
    return prices.filter(F.col("valid_from") != F.col("prev_valid_to"))


@invariant("dim_game_prices")
def dim_game_prices_no_overlapping_intervals(wh: Warehouse) -> DataFrame:
    """Intervals that start before the one before them ends."""
    prices = previous_end(wh["dim_game_prices"], ["game_id", "region"])
    return prices.filter(F.col("valid_from") < F.col("prev_valid_to"))


@invariant("dim_game_prices")
def dim_game_prices_one_current_row(wh: Warehouse) -> DataFrame:
    """Games and regions that do not have exactly one current price."""
    per_region = wh["dim_game_prices"].groupBy("game_id", "region")
    return per_region.agg(F.count_if("is_current").alias("current_row_count")).filter("current_row_count <> 1")


@invariant("fct_finance_capacity_daily")
def fct_finance_capacity_daily_non_negative(wh: Warehouse) -> DataFrame:
    return wh["fct_finance_capacity_daily"].filter(_negative("peak_concurrent_players"))


@invariant("fct_finance_revenue_daily")
def fct_finance_revenue_daily_non_negative(wh: Warehouse) -> DataFrame:
    return wh["fct_finance_revenue_daily"].filter(
        _negative("revenue_cents", "refunded_cents", "purchase_count", "refund_count", "chargeback_count")
    )


@invariant("fct_finance_revenue_daily")
def fct_finance_revenue_daily_refunds_by_refund_date(wh: Warehouse) -> DataFrame:
    """Refunded cents, summed again from the refunds by refund date, against the mart."""
    per_user = (
        wh["fct_refunds"]
        .groupBy("user_key", "refund_date", "is_chargeback")
        .agg(F.sum(exact("refunded_amount_usd")).alias("usd"))
    )
    expected = (
        per_user.join(wh["dim_users"].select("user_key", "country"), "user_key", "inner")
        .groupBy(F.col("refund_date").alias("revenue_date"), "country", "is_chargeback")
        .agg(F.sum("usd").alias("usd"))
        .withColumn("refunded_cents", cents("usd"))
    )
    return diff_by_key(
        expected,
        wh["fct_finance_revenue_daily"],
        keys=["revenue_date", "country", "is_chargeback"],
        measures=["refunded_cents"],
        null_safe=["country"],
    )


@invariant("fct_marketing_campaign_cpa")
def fct_marketing_campaign_cpa_non_negative(wh: Warehouse) -> DataFrame:
    return wh["fct_marketing_campaign_cpa"].filter(_negative("spend_cents", "attributed_signup_count", "cpa_usd"))


@invariant("fct_marketing_campaign_revenue")
def fct_marketing_campaign_revenue_non_negative(wh: Warehouse) -> DataFrame:
    return wh["fct_marketing_campaign_revenue"].filter(_negative("attributed_revenue_usd"))


@invariant("fct_marketing_signups_daily")
def fct_marketing_signups_daily_non_negative(wh: Warehouse) -> DataFrame:
    return wh["fct_marketing_signups_daily"].filter(_negative("signup_count"))


@invariant("fct_marketing_signups_daily")
def fct_marketing_signups_daily_organic_logic(wh: Warehouse) -> DataFrame:
    """Signups counted again, user by user, from the two dimensions, against the mart."""
    channels = wh["dim_marketing_campaigns"].select(F.col("marketing_campaign_id").alias("campaign_id"), "channel")
    expected = (
        lookup(wh["dim_users"].select("signup_date", "campaign_id"), channels, ["campaign_id"])
        .groupBy("signup_date", F.coalesce("channel", F.lit("organic")).alias("channel"))
        .agg(F.count(F.lit(1)).alias("signup_count"))
    )
    return diff_by_key(
        expected, wh["fct_marketing_signups_daily"], keys=["signup_date", "channel"], measures=["signup_count"]
    )


@invariant("fct_product_active_users_daily")
def fct_product_active_users_daily_non_negative(wh: Warehouse) -> DataFrame:
    return wh["fct_product_active_users_daily"].filter(_negative("dau", "wau") | (F.col("wau") < F.col("dau")))


@invariant("fct_product_funnel_sessions")
def fct_product_funnel_sessions_stages_monotonic(wh: Warehouse) -> DataFrame:
    return stage_order_violations(
        wh["fct_product_funnel_sessions"], session_key="funnel_session_key", stages=FUNNEL_STAGES
    )


@invariant("fct_product_session_length_daily")
def fct_product_session_length_daily_non_negative(wh: Warehouse) -> DataFrame:
    return wh["fct_product_session_length_daily"].filter(
        _negative("session_count", "avg_duration_minutes", "p50_duration_minutes", "p90_duration_minutes")
    )


@invariant("fct_product_wishlist_conversion")
def fct_product_wishlist_conversion_logic(wh: Warehouse) -> DataFrame:
    """Adds and conversions counted again by the last grant, against the mart."""
    expected = converted_counts(
        wh["fct_wishlist_items"],
        wh["fct_ownership_grants"],
        keys=["user_key", "game_key"],
        start_ts="added_at",
        end_ts="granted_at",
        group=["game_key"],
    ).withColumnRenamed("start_count", "wishlist_add_count")
    return diff_by_key(
        expected,
        wh["fct_product_wishlist_conversion"],
        keys=["game_key"],
        measures=["wishlist_add_count", "converted_count"],
    )


@invariant("fct_product_wishlist_conversion")
def fct_product_wishlist_conversion_non_negative(wh: Warehouse) -> DataFrame:
    return wh["fct_product_wishlist_conversion"].filter(
        _negative("wishlist_add_count", "converted_count", "conversion_rate", "median_days_to_convert")
        | (F.col("conversion_rate") > 1)
    )


@invariant("fct_purchases")
def fct_purchases_amount_usd_not_null(wh: Warehouse) -> DataFrame:
    """Purchases in a currency for which no rate was found."""
    return wh["fct_purchases"].filter(F.col("currency").isNotNull() & F.col("amount_usd").isNull())


@invariant("fct_purchases")
def fct_purchases_amount_usd_sane_ratio(wh: Warehouse) -> DataFrame:
    """Purchases whose implied rate is no plausible exchange rate."""
    rated = wh["fct_purchases"].filter(F.col("amount_usd").isNotNull() & (F.col("amount_cents") != 0))
    implied = F.col("amount_usd") / (F.col("amount_cents").cast("double") / F.lit(100.0))
    return rated.withColumn("implied_rate_to_usd", implied).filter(~F.col("implied_rate_to_usd").between(0.0001, 10.0))


@invariant("fct_refunds")
def fct_refunds_after_purchase(wh: Warehouse) -> DataFrame:
    """Refunds dated before their purchase."""
    bought = wh["fct_purchases"].select("purchase_key", "purchased_at")
    refunds = wh["fct_refunds"].select("refund_key", "purchase_key", "refunded_at")
    return (
        lookup(refunds, bought, ["purchase_key"], "inner")
        .filter(F.col("refunded_at") < F.col("purchased_at"))
        .select("refund_key", "refunded_at", "purchased_at")
    )


@invariant("fct_wishlist_items")
def fct_wishlist_items_removed_after_added(wh: Warehouse) -> DataFrame:
    return wh["fct_wishlist_items"].filter(F.col("removed_at") < F.col("added_at"))


RESULT_SCHEMA = "unique_id string, resource_type string, status string, created_at timestamp"


def run_checks(
    wh: Warehouse,
    at: dt.datetime,
    *,
    tables: list[str] | None = None,
    invariants: list[str] | None = None,
    extra: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Run checks and return their results in the ``run_results`` shape.

    What reaches the driver is one count per check. Write the models first (``publish``), so that
    checks scan tables instead of repeating the models. ``extra`` holds tables that are no models.
    """
    extra = extra or {}
    counted: list[tuple[str, int]] = []
    for table in CHECKS if tables is None else tables:
        rows = table_failures(wh, table, extra.get(table)).collect()
        counted += [(r["check_name"], r["failures"]) for r in rows]
    for name in INVARIANTS if invariants is None else invariants:
        counted.append((f"assert_{name}", INVARIANTS[name][1](wh).count()))
    rows = [(f"test.{name}", "test", "pass" if n == 0 else "fail", at) for name, n in counted]
    return wh.spark.createDataFrame(rows, RESULT_SCHEMA)


def check_registry(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    """The ``tests`` and ``models`` registries that belong to ``run_checks``."""
    tests = [(f"test.{c.name(t)}", f"model.{t}") for t, checks in CHECKS.items() for c in checks]
    tests += [(f"test.assert_{name}", f"model.{table}") for name, (table, _) in INVARIANTS.items()]
    models = [(f"model.{name}", layer) for name, layer in {**LAYER_OF, "fct_row_counts": CORE}.items()]
    return (
        wh.spark.createDataFrame(tests, "unique_id string, parent_model_unique_id string"),
        wh.spark.createDataFrame(models, "unique_id string, schema_name string"),
    )


def source_registry(wh: Warehouse, source: str = "storefront", schema: str = "landing") -> DataFrame:
    """The ``sources`` registry that belongs to ``source_freshness``, as of ``wh.as_of``."""
    rows = [(f"source.{name}", source, name, schema, wh.as_of) for name in LANDING]
    return wh.spark.createDataFrame(rows, HEALTH_SCHEMAS["sources"])
