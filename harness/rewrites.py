"""The plain shape of four models, in Spark, next to the shape the package uses.

Both give the same rows (``tests/test_rewrites.py``); ``bench.py --rewrites`` times them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions import surrogate_key
from vitrine.operators import latest_by
from vitrine.operators.money import cents, exact
from vitrine.plans import Warehouse
from vitrine.plans.core import valued_refunds
from vitrine.plans.intermediate import purchases_in_usd
from vitrine.plans.staging import live


def actives_by_range_join(wh: Warehouse) -> DataFrame:
    """Distinct members within seven days of each active date, by a range join on dates."""
    active = wh["fct_playtime_sessions"].select("user_key", F.col("started_date").alias("day")).distinct()
    dates = active.select(F.col("day").alias("active_date")).distinct()
    near = (F.col("day") <= F.col("active_date")) & (F.col("day") >= F.date_sub("active_date", 6))
    joined = dates.join(active, near)
    on_day = F.col("day") == F.col("active_date")
    return joined.groupBy("active_date").agg(
        F.countDistinct(F.when(on_day, F.col("user_key"))).alias("dau"), F.countDistinct("user_key").alias("wau")
    )


def revenue_by_grain_join(wh: Warehouse) -> DataFrame:
    """Purchases and refunds summed apart, then joined to the distinct union of their grains."""
    users = live(wh, "users").select("user_id", "country")
    grain = ["revenue_date", "country", "is_chargeback"]
    bought = (
        purchases_in_usd(wh)
        .filter(~F.col("is_deleted"))
        .join(users, "user_id")
        .groupBy(F.col("purchase_date").alias("revenue_date"), "country", F.lit(False).alias("is_chargeback"))
        .agg(F.sum(exact("amount_usd")).alias("usd"), F.count(F.lit(1)).alias("purchase_count"))
        .withColumn("revenue_cents", cents("usd"))
    )
    refunded = (
        valued_refunds(wh)
        .join(users, "user_id")
        .groupBy(F.col("refund_date").alias("revenue_date"), "country", "is_chargeback")
        .agg(F.sum(exact("refunded_amount_usd")).alias("usd"), F.count(F.lit(1)).alias("refund_count"))
        .withColumn("refunded_cents", cents("usd"))
    )
    keys = bought.select(*grain).union(refunded.select(*grain)).distinct().alias("g")

    def matches(side: str):
        return (
            (F.col("g.revenue_date") == F.col(f"{side}.revenue_date"))
            & F.col("g.country").eqNullSafe(F.col(f"{side}.country"))
            & (F.col("g.is_chargeback") == F.col(f"{side}.is_chargeback"))
        )

    joined = keys.join(bought.alias("b"), matches("b"), "left").join(refunded.alias("r"), matches("r"), "left")
    zero = F.lit(0).cast("long")
    refunds = F.coalesce("r.refund_count", zero)
    return joined.select(
        *[F.col(f"g.{c}").alias(c) for c in grain],
        surrogate_key(*[F.col(f"g.{c}") for c in grain]).alias("finance_revenue_daily_key"),
        F.coalesce("b.revenue_cents", zero).alias("revenue_cents"),
        F.coalesce("r.refunded_cents", zero).alias("refunded_cents"),
        F.coalesce("b.purchase_count", zero).alias("purchase_count"),
        refunds.alias("refund_count"),
        F.when(F.col("g.is_chargeback"), refunds).otherwise(zero).alias("chargeback_count"),
    )


def prices_by_self_join(wh: Warehouse) -> DataFrame:
    """Price intervals by one window per (game, region) and a join to the earliest change."""
    changes = live(wh, "price_changes")
    games = wh["stg_games"].select("game_id", F.col("created_at").alias("born"))
    by_key = Window.partitionBy("game_id", "region").orderBy("changed_at", "price_change_id")
    first = changes.withColumn("n", F.row_number().over(by_key)).filter("n = 1")
    first = first.select(
        "game_id", "region", "currency", F.col("old_price_cents").alias("old"), F.col("changed_at").alias("first_at")
    )
    columns = ["game_id", "region", "currency", "price_cents", "valid_from", "valid_to"]
    opening = first.filter("old is not null").join(games, "game_id")
    opening = opening.selectExpr(
        "game_id", "region", "currency", "old as price_cents", "born as valid_from", "first_at as valid_to"
    )
    each = changes.withColumn("valid_to", F.lead("changed_at").over(by_key))
    each = each.join(first.drop("currency"), ["game_id", "region"]).join(games, "game_id")
    each = each.selectExpr(
        "game_id",
        "region",
        "currency",
        "new_price_cents as price_cents",
        "if(old is null and changed_at = first_at, born, changed_at) as valid_from",
        "valid_to",
    )
    rest = live(wh, "game_prices").join(first.select("game_id", "region"), ["game_id", "region"], "left_anti")
    rest = rest.join(games, "game_id").selectExpr(
        "game_id", "region", "currency", "price_cents", "born as valid_from", "cast(null as timestamp) as valid_to"
    )
    every = opening.select(columns).unionByName(each.select(columns)).unionByName(rest.select(columns))
    return every.withColumn("is_current", F.col("valid_to").isNull())


def latest_by_max(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Newest version by ``max_by`` over whole rows."""
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), order_col).alias("_r"))
    return newest.select("_r.*")


def resnapshotted(wh: Warehouse, times: int) -> DataFrame:
    """The purchases as ``times`` connector restarts leave them: every row emitted again at new offsets."""
    again = wh.landing("purchases").withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    moved = F.col("record_metadata.offset") + F.col("n").cast("long") * 10**9
    return again.withColumn("record_metadata", F.col("record_metadata").withField("offset", moved)).drop("n")


REWRITES = {
    "actives": (actives_by_range_join, lambda wh: wh["fct_product_active_users_daily"].drop("active_users_daily_key")),
    "revenue": (revenue_by_grain_join, lambda wh: wh["fct_finance_revenue_daily"]),
    "prices": (prices_by_self_join, lambda wh: wh["int_game_prices_replayed"]),
    "latest": (
        lambda wh: latest_by_max(wh.landing("purchases"), ["id"], "record_metadata.offset"),
        lambda wh: latest_by(wh.landing("purchases"), ["id"], "record_metadata.offset"),
    ),
    "latest_10x": (
        lambda wh: latest_by_max(resnapshotted(wh, 10), ["id"], "record_metadata.offset"),
        lambda wh: latest_by(resnapshotted(wh, 10), ["id"], "record_metadata.offset"),
    ),
}
