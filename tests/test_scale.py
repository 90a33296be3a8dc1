"""How the operators behave when one key holds a third of the rows, and what their plans look like."""

import pytest
from pyspark.sql import functions as F

from harness.testdata import SCHEMAS, landing
from vitrine import operators as op
from vitrine.session import cluster_conf

# Sizes at which AQE sees skew in a test: no broadcast, tiny partitions.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def small_sizes(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df):
    """The plan as run, after AQE."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture(scope="module")
def hot(spark):
    """60,000 rows over 8 tasks; a third of them have key 7."""
    return (
        spark.range(60000, numPartitions=8)
        .selectExpr(
            "id",
            "if(id % 3 = 0, 7, pmod(xxhash64(id), 2000)) as k",
            "pmod(xxhash64(id, 1), 50) as g",
            "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, pmod(xxhash64(id, 2), 2592000)) as at",
        )
        .cache()
    )


def versions(spark):
    """A reference table that still has to be reduced to its newest versions."""
    return spark.range(4000, numPartitions=4).selectExpr("id % 2000 as k", "id as v")


def test_lookup_splits_a_hot_key(spark, small_sizes, hot):
    newest = op.latest_by(versions(spark), ["k"], "v")
    plan = final_plan(op.lookup(hot, newest, ["k"], "inner"))
    assert "skew=true" in plan
    # The same join without the helper leaves the hot key to one task.
    assert "skew=true" not in final_plan(hot.join(newest, "k"))
    assert op.lookup(hot, newest, ["k"], "inner").count() == hot.join(newest, "k").count() == 60000


def test_lookup_spreads_null_keys(spark, small_sizes, hot):
    nulls = hot.withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    joined = op.lookup(nulls, op.latest_by(versions(spark), ["k"], "v"), ["k"])
    assert joined.count() == 60000 and joined.filter("v is null").count() >= 20000
    slots = nulls.filter("k is null").select(F.xxhash64("id", "k", "g", "at").alias("s")).distinct().count()
    assert slots == nulls.filter("k is null").count()


def test_cluster_conf():
    big = cluster_conf(20 << 40, cores=4000)
    assert big["spark.sql.shuffle.partitions"] == str(80 * 1024)
    assert cluster_conf(1 << 20, cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_small_reference_is_broadcast_by_size(spark, hot):
    plan = final_plan(op.lookup(hot, versions(spark).filter("v < 10"), ["k"]))
    assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize(
    "build",
    [
        lambda s, h: op.trailing_distinct(h.withColumn("d", F.to_date("at")), date="d", member="k"),
        lambda s, h: op.conversion(
            h.filter("id % 2 = 0"), h.filter("id % 2 = 1"), keys=["k", "g"], start_ts="at", end_ts="at", group=["g"]
        ),
        lambda s, h: op.cohort_percentiles(
            h.selectExpr("k", "g", "to_date(at) as d", "id % 90 as m", "id % 10 = 0 as o"),
            member="k",
            entity="g",
            date="d",
            value="m",
            is_open="o",
            probs={"p": 0.5},
        ),
        lambda s, h: op.scd2_replay(
            h.selectExpr("id", "k", "g", "at", "id as old", "id + 1 as new", "'x' as c"),
            versions(s).selectExpr("k", "timestamp'2023-01-01' as born").distinct(),
            h.selectExpr("k", "g", "id as price", "'x' as c"),
            entity="k",
            keys=["k", "g"],
            ts="at",
            tie_break="id",
            old="old",
            new="new",
            value="price",
            origin="born",
            attrs=["c"],
        ),
        lambda s, h: op.signed_daily(
            h.selectExpr("k", "to_date(at) as d", "double(id) as usd"),
            h.selectExpr("k", "to_date(at) as d", "double(id) as usd", "id % 2 = 0 as f"),
            versions(s).selectExpr("k", "k % 5 as c").distinct(),
            member="k",
            date="d",
            amount="usd",
            flag="f",
            dims=["c"],
        ),
        lambda s, h: op.first_touch(
            h.selectExpr("id", "k as f"), versions(s), fk="f", pk="k", label="v", default=-1
        ),
        lambda s, h: op.check_relationships(h, "k", versions(s), "k"),
    ],
    ids=["trailing", "conversion", "cohort", "scd2", "ledger", "first_touch", "relationships"],
)
def test_no_operator_pairs_rows(spark, small_sizes, hot, build):
    """No nested loop, no cartesian product, no Python in the plan, however large the inputs."""
    plan = build(spark, hot)._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("NestedLoop", "CartesianProduct", "Python", "ArrowEval", "CollectLimit", "SinglePartition"):
        assert forbidden not in plan


def largest_task(df, keys):
    """Rows of the largest group a window over ``keys`` would take in."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0]


def test_groups_shrink_before_they_meet(spark, hot):
    """What the windows and joins receive for the hot key is bounded by days or values, not by rows."""
    days = hot.select(F.to_date("at").alias("d"), "k")
    assert largest_task(days, ["k"]) > 20000 and largest_task(days.distinct(), ["k"]) == 30
    sessions = hot.selectExpr("k", "g", "to_date(at) as d", "id % 3 as m")
    assert largest_task(sessions.distinct(), ["k", "g"]) <= 30 * 3


def test_percentile_counts_values_first(spark, hot):
    df = hot.selectExpr("k", "7 as g", "to_date(at) as d", "id % 90 as m", "false as o")
    out = op.cohort_percentiles(
        df, member="k", entity="g", date="d", value="m", is_open="o", probs={"p50": 0.5, "p90": 0.9}
    )
    got = {(r["d"], r["user_cohort"]): r for r in out.collect()}
    direct = (
        df.join(df.groupBy("k").agg(F.min("d").alias("f")), "k")
        .groupBy("d", F.when(F.col("d") == F.col("f"), "new").otherwise("returning").alias("c"))
        .agg(F.count(F.lit(1)).alias("n"), F.median("m").alias("p50"), F.percentile("m", 0.9).alias("p90"))
        .collect()
    )
    assert len(direct) == len(got)
    for r in direct:
        g = got[(r["d"], r["c"])]
        assert (g["session_count"], g["p50"]) == (r["n"], r["p50"])
        assert g["p90"] == pytest.approx(r["p90"])


def test_price_rows_of_one_row_group_are_dealt_out(spark, tmp_path):
    """However the parts are stored, no task makes, and so sorts, the price rows of all of them."""
    part = spark.range(4000).selectExpr("id", "'n'", "'b'", "'t'", "1", "id / 10d").toDF(*[c.split()[0] for c in SCHEMAS["part"].split(", ")])
    part.selectExpr(*[f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in SCHEMAS["part"].split(", ")]).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    prices = landing(spark, str(tmp_path), "game_prices")
    sizes = [r["count"] for r in prices.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 * 5 * 5 // 4 and max(sizes) < 0.5 * sum(sizes)
    assert prices.select("id", "record_metadata.offset").distinct().count() == sum(sizes)
