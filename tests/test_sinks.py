"""Namespaces, tables, views, upserts, and a whole build with its checks."""

import datetime as dt
import threading
import uuid

import pytest
from conftest import day, rows, ts
from pyspark.sql import functions as F

from harness.testdata import warehouse
from vitrine import sinks
from vitrine.plans import MODELS
from vitrine.plans.checks import CHECKS, INVARIANTS, check_registry, run_checks, table_failures
from vitrine.plans.publish import publish, record_health, record_row_counts, stored_health
from vitrine.plans.pipeline_health import source_freshness
from vitrine.plans.views import VIEWS
from vitrine.session import configure
from vitrine.sinks import tables
from vitrine.sources import FX_RATES_SCHEMA, HEALTH_SCHEMAS, LANDING, read_fx_rates, read_health, read_landing

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def prefix(spark):
    name = "t" + uuid.uuid4().hex[:8]
    yield name
    for db in spark.catalog.listDatabases():
        if db.name.startswith(name):
            spark.sql(f"DROP DATABASE `{db.name}` CASCADE")


def test_layer_namespace():
    assert sinks.layer_namespace("stg", "prod", "ignored") == "stg"
    assert sinks.layer_namespace(" marts_core ", "staging", None) == "marts_core"
    assert sinks.layer_namespace(None, "prod", "base") == "base"
    assert sinks.layer_namespace("stg", "dev", " me ") == "me_stg"
    assert sinks.layer_namespace("stg", "ci", "ci_pr_42") == "ci_pr_42_stg"
    assert sinks.layer_namespace(None, "anything_new", "me") == "me"
    for empty in ("", "  ", None):
        with pytest.raises(ValueError):
            sinks.layer_namespace("stg", "dev", empty)


def test_merge_updates_keeps_and_leaves_other_days(spark, prefix):
    schema = "schema_name string, table_name string, row_count long, snapshot_date date"
    keys = ["schema_name", "table_name", "snapshot_date"]

    def merge(*data):
        incoming = spark.createDataFrame(list(data), schema)
        return sinks.merge_table(spark, prefix, "counts", incoming, keys, "snapshot_date")

    d1, d2 = day("2024-01-01"), day("2024-01-02")
    merge(("s", "a", 1, d1), ("s", "b", 2, d1))
    merge(("s", "a", 10, d2), ("s", "dropped", 5, d2))
    after = merge(("s", "a", 11, d2), ("s", "new", 7, d2))
    assert rows(after, "snapshot_date", "table_name", "row_count") == [
        ("2024-01-01", "a", 1),
        ("2024-01-01", "b", 2),
        ("2024-01-02", "a", 11),
        ("2024-01-02", "dropped", 5),
        ("2024-01-02", "new", 7),
    ]


def test_readers_apply_their_schemas(spark, tmp_path):
    spark.createDataFrame([], LANDING["games"].schema).write.parquet(f"{tmp_path}/games")
    assert read_landing(spark, str(tmp_path), "games").schema.simpleString() == LANDING["games"].schema.simpleString()
    (tmp_path / "fx.csv").write_text("date,currency,rate_to_usd\n2024-01-01,USD,1.0\n")
    assert rows(read_fx_rates(spark, str(tmp_path / "fx.csv"))) == [("2024-01-01", "USD", 1.0)]
    assert FX_RATES_SCHEMA.startswith("date date")
    for name, ddl in HEALTH_SCHEMAS.items():
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{name}")
        assert read_health(spark, str(tmp_path), name).count() == 0


def test_freshness_of_landed_files(spark, tmp_path):
    wh = warehouse(spark, SF)
    for name in LANDING:
        wh.landing(name).write.parquet(f"{tmp_path}/{name}")
    derived = rows(source_freshness(wh))
    wh.landing = lambda name: read_landing(spark, str(tmp_path), name)
    landed = source_freshness(wh)
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<__source_ts_ms:bigint>") == 16
    assert rows(landed) == derived


def test_build_check_and_count(spark, prefix):
    wh = warehouse(spark, SF)
    lazy = {n: warehouse(spark, SF)[n] for n in ("fct_refunds", "fct_finance_revenue_daily", "dim_game_prices")}
    placed = publish(wh, "dev", prefix)
    assert set(placed) == set(MODELS)
    assert placed["fct_purchases"] == f"{prefix}_marts_core" and placed["stg_users"] == f"{prefix}_stg"

    # Reading staging back from tables changes no mart.
    for name, df in lazy.items():
        stored = spark.table(f"`{placed[name]}`.`{name}`")
        assert stored.columns == df.columns
        assert stored.exceptAll(df).count() == 0 and df.exceptAll(stored).count() == 0
    # Views hold the same rows as the lazy models and are read by other sessions; tables of event facts are laid out by day.
    other = spark.newSession()
    configure(other)
    for name in VIEWS:
        view = other.table(f"{prefix}_int.{name}")
        assert view.columns == wh[name].columns
        assert rows(view) == rows(wh[name])
    assert {(t.name, t.tableType) for t in other.catalog.listTables(f"{prefix}_int")} == {(name, "VIEW") for name in VIEWS}
    assert not [t for t in spark.catalog.listTables() if t.isTemporary]
    plan = wh["fct_playtime_sessions"].filter("started_date = date'2024-01-05'")
    assert "PartitionFilters: [isnotnull(started_date" in plan._jdf.queryExecution().executedPlan().toString()

    # Every declared check and invariant runs off the written tables.
    some = ["stg_users", "dim_users", "fct_refunds", "fct_product_funnel_sessions", "fx_rates"]
    at = ts("2024-01-31 03:00:00")
    results = run_checks(wh, at, tables=some, invariants=["fct_refunds_after_purchase", "dim_game_prices_one_current_row"])
    statuses = {r["unique_id"]: r["status"] for r in results.collect()}
    assert len(statuses) == sum(len(CHECKS[t]) for t in some) + 2
    assert statuses["test.unique_stg_users_user_id"] == "pass"
    assert statuses["test.relationships_fct_refunds_user_key"] == "fail"
    assert statuses["test.assert_fct_refunds_after_purchase"] == "fail"

    # Results and registries feed the health marts.
    tests, models = check_registry(wh)
    assert tests.count() == 168 + 19
    health = {"run_results": results, "tests": tests, "models": models}
    wh.written.pop("fct_dbt_test_results")
    wh.health = lambda name: health[name]
    rates = {r["schema_name"]: r for r in wh["fct_dbt_test_results"].collect()}
    assert rates["stg"]["pass_rate"] == 1.0 and rates["marts_core"]["pass_count"] < rates["marts_core"]["test_count"]

    fresh = source_freshness(wh)
    names = fresh.selectExpr(
        "unique_id", "'store' as source_name", "substr(unique_id, 8) as name", "'raw' as schema_name", "created_at as generated_at"
    )
    health.update(source_freshness_results=fresh, sources=names.unionByName(names.withColumn("name", F.lit("old")).withColumn("generated_at", F.lit(ts("2020-01-01")))))
    wh.written.pop("fct_source_freshness")
    assert {r["table_name"] for r in wh["fct_source_freshness"].collect()} == set(LANDING)

    # Row counts: base tables only, the literal health namespace left out, twice a day is one row.
    spark.sql("CREATE DATABASE IF NOT EXISTS elementary")
    sinks.write_table(spark.range(3), "elementary", "internal")
    try:
        spaces = [f"{prefix}_stg", f"{prefix}_marts_core", f"{prefix}_int", "elementary"]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}_int`")
        first = record_row_counts(wh, spaces, "dev", prefix).collect()
        again = record_row_counts(wh, spaces, "dev", prefix)
        counted = {(r["schema_name"], r["table_name"]): r["row_count"] for r in again.collect()}
        assert counted[(f"{prefix}_stg", "stg_users")] == 150
        assert counted[(f"{prefix}_marts_core", "fct_row_counts")] == len(first)
        assert not any(s == "elementary" for s, _ in counted)
        assert again.select("snapshot_date").distinct().count() == 1
        assert rows(table_failures(wh, "fct_row_counts", again), "failures") == [(0,)] * 5
    finally:
        spark.sql("DROP DATABASE elementary CASCADE")


def test_counts_of_declared_checks():
    assert sum(map(len, CHECKS.values())) == 168 and len(INVARIANTS) == 19
    assert len(MODELS) == 41  # and fct_row_counts, which only exists once tables are written


def test_dim_date_default_window(spark):
    wh = warehouse(spark, SF)
    wh.calendar = (dt.date(2023, 1, 1), dt.date(2027, 1, 1))
    dates = wh["dim_date"]
    assert dates.count() == 1461
    first = dates.filter("date_day = date'2023-01-01'").first()
    assert (first["day_of_week"], first["day_name"], first["week_of_year"], first["is_weekend"]) == (0, "Sun", 52, True)


def test_a_failed_rebuild_leaves_the_old_table(spark, prefix):
    sinks.write_table(spark.range(4).withColumn("day", F.lit("a")), prefix, "kept", ["day"])
    broken = spark.createDataFrame([("1",), ("x",)], "id string").select(F.col("id").cast("long"), F.lit("a").alias("day"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sinks.write_table(broken, prefix, "kept", ["day"])
    assert spark.table(f"{prefix}.kept").count() == 4
    assert [t.name for t in spark.catalog.listTables(prefix)] == ["kept"]
    # A table may be rebuilt from itself, partitions with odd and missing values included.
    more = spark.table(f"{prefix}.kept").unionByName(spark.createDataFrame([(9, None), (10, "a/b c=d")], "id long, day string"))
    want = rows(more, "id", "day")
    assert rows(sinks.write_table(more, prefix, "kept", ["day"]), "id", "day") == want
    assert spark.table(f"{prefix}.kept").filter("day = 'a/b c=d'").count() == 1


class Injected(Exception):
    """A failure put between two steps."""


def fail(*_, **__):
    raise Injected


def test_a_rebuild_that_fails_between_two_steps_leaves_whole_rows(spark, prefix, monkeypatch):
    old, new = spark.range(4).withColumn("day", F.lit("a")), spark.range(7).withColumn("day", F.lit("b"))
    for parts in ([], ["day"]):
        name = f"kept{len(parts)}"
        with monkeypatch.context() as m:  # the first build: no table until it is whole
            m.setattr(tables, "_create", fail)
            with pytest.raises(Injected):
                sinks.write_table(old, prefix, name, parts)
        assert not spark.catalog.tableExists(f"{prefix}.{name}")
        sinks.write_table(old, prefix, name, parts)
        with monkeypatch.context() as m:  # written, not switched
            m.setattr(tables, "_switch", fail)
            with pytest.raises(Injected):
                sinks.write_table(new, prefix, name, parts)
        assert rows(spark.table(f"{prefix}.{name}")) == rows(old)
        with monkeypatch.context() as m:  # switched, not cleaned
            m.setattr(tables, "_clean", fail)
            with pytest.raises(Injected):
                sinks.write_table(new, prefix, name, parts)
        assert rows(spark.table(f"{prefix}.{name}")) == rows(new)
        assert rows(sinks.write_table(old, prefix, name, parts)) == rows(old)
        with monkeypatch.context() as m:  # other columns: dropped, not created
            calls = iter([fail, tables._create])
            m.setattr(tables, "_create", lambda *a: next(calls)(*a))
            with pytest.raises(Injected):
                sinks.write_table(new.withColumn("more", F.lit(1)), prefix, name, parts)
        assert rows(spark.table(f"{prefix}.{name}")) == rows(old)
        assert rows(sinks.write_table(new.withColumn("more", F.lit(1)).select("id", "more", "day"), prefix, name, parts)) == rows(new.select("id", F.lit(1), "day"))


def test_readers_of_a_rebuild_see_one_whole_version(spark, prefix):
    for parts in (None, ["day"]):
        name = "read" if parts else "plain"
        build = lambda n: spark.range(n * 1000, n * 1000 + 1000).select("id", F.lit(n).alias("n"), (F.col("id") % 3).alias("day"))
        sinks.write_table(build(0), prefix, name, parts)
        seen, failures, done = set(), [], threading.Event()

        def read(name=name, seen=seen, failures=failures, done=done):
            while not done.is_set():
                try:
                    got = spark.table(f"{prefix}.{name}").agg(F.count("*"), F.min("n"), F.max("n")).first()
                    seen.add(tuple(got))
                except Exception as e:  # noqa: BLE001
                    failures.append(e)

        reader = threading.Thread(target=read)
        reader.start()
        for n in range(1, 6):
            sinks.write_table(build(n), prefix, name, parts)
        done.set()
        reader.join()
        assert not failures
        assert seen <= {(1000, n, n) for n in range(6)} and seen
        assert len(tables.Folder(spark, f"{tables._database_folder(spark, prefix)}/{name}__versions").names()) == 6
        sinks.write_table(build(6), prefix, name, parts, keep_hours=0)
        assert len(tables.Folder(spark, f"{tables._database_folder(spark, prefix)}/{name}__versions").names()) == 2
        assert spark.table(f"{prefix}.{name}").count() == 1000
        sinks.drop_table(spark, prefix, name)
        assert not spark.catalog.tableExists(f"{prefix}.{name}")
        assert not tables.Folder(spark, f"{tables._database_folder(spark, prefix)}/{name}__versions").names()


def test_an_empty_rebuild_and_other_kinds_of_tables(spark, prefix):
    empty = spark.range(0).withColumn("day", F.lit("a"))
    for parts in (None, ["day"]):
        assert sinks.write_table(empty, prefix, f"e{bool(parts)}", parts).columns == ["id", "day"]
        assert sinks.write_table(empty.union(spark.createDataFrame([(1, "x")])), prefix, f"e{bool(parts)}", parts).count() == 1
        assert sinks.write_table(empty, prefix, f"e{bool(parts)}", parts).count() == 0
    # a table that others have made, managed and with partitions in the catalog, is replaced as a whole
    spark.range(3).withColumn("day", F.lit("a")).write.partitionBy("day").saveAsTable(f"{prefix}.managed")
    assert sinks.write_table(spark.table(f"{prefix}.managed").where("id > 0"), prefix, "managed", ["day"]).count() == 2


def test_a_merge_that_fails_changes_nothing_or_is_carried_out(spark, prefix, monkeypatch):
    schema = "k string, d date, n long"
    d1, d2, d3 = (day(f"2024-01-0{i}") for i in (1, 2, 3))
    first = [("a", d1, 1), ("b", d1, 1), ("a", d2, 1), ("c", None, 1)]
    more = [("a", d1, 2), ("a", d2, 2), ("z", d3, 2), ("c", None, 2)]
    after = sorted([("a", "2024-01-01", 2), ("b", "2024-01-01", 1), ("a", "2024-01-02", 2), ("z", "2024-01-03", 2)])
    merge = lambda data: sinks.merge_table(spark, prefix, "m", spark.createDataFrame(data, schema), ["k", "d"], "d")
    with monkeypatch.context() as m:
        m.setattr(tables, "_apply", fail)
        with pytest.raises(Injected):
            merge(first)
    assert spark.table(f"{prefix}.m").count() == 0
    merge(first)  # carries the record out, then merges the same rows again: the NULL day equals no day and comes twice
    before = rows(spark.table(f"{prefix}.m").where("d is not null"), "k", "d", "n")
    assert before == sorted([("a", "2024-01-01", 1), ("b", "2024-01-01", 1), ("a", "2024-01-02", 1)])
    with monkeypatch.context() as m:  # merged files are written, the record is not
        m.setattr(tables.Folder, "write", fail)
        with pytest.raises(Injected):
            merge(more)
    assert rows(spark.table(f"{prefix}.m").where("d is not null"), "k", "d", "n") == before
    assert sinks.recover_table(spark, prefix, "m", "d") == 0
    with monkeypatch.context() as m:  # the record is written, one partition is switched
        sql, calls = spark.sql, iter(range(100))
        broken = lambda q, *a, **k: fail() if "SET LOCATION" in q and next(calls) == 1 else sql(q, *a, **k)
        m.setattr(spark, "sql", broken)
        with pytest.raises(Injected):
            merge(more)
    half = rows(spark.table(f"{prefix}.m").where("d is not null"), "k", "d", "n")
    assert set(half) <= set(before) | set(after)
    assert sinks.recover_table(spark, prefix, "m", "d") == 1
    assert rows(spark.table(f"{prefix}.m").where("d is not null"), "k", "d", "n") == after
    assert rows(merge(more).where("d is not null"), "k", "d", "n") == after
    # files that were replaced go, those in use stay
    merges = tables.Folder(spark, f"{tables._database_folder(spark, prefix)}/m__merges")
    sinks.recover_table(spark, prefix, "m", "d", keep_hours=0)
    assert len(merges.names()) == 1
    assert rows(spark.table(f"{prefix}.m").where("d is not null"), "k", "d", "n") == after


def test_row_counts_come_from_footers(spark, prefix):
    sinks.write_table(spark.range(1000).repartition(3), prefix, "plain")
    sinks.write_table(spark.range(900).select("id", (F.col("id") % 7).alias("day")), prefix, "parted", ["day"])
    sinks.write_table(spark.range(0), prefix, "empty")
    sinks.append_table(spark.range(5), prefix, "appended")
    sinks.append_table(spark.range(6), prefix, "appended")
    counts = spark.createDataFrame([("a", day("2024-01-01"), 1), ("b", day("2024-01-02"), 1)], "k string, d date, n long")
    sinks.merge_table(spark, prefix, "merged", counts, ["k", "d"], "d")
    sinks.merge_table(spark, prefix, "merged", counts.where("k = 'a'").unionByName(counts.withColumn("k", F.lit("c"))), ["k", "d"], "d")
    spark.range(4).write.format("json").saveAsTable(f"{prefix}.text")
    for name, want in {"plain": 1000, "parted": 900, "empty": 0, "appended": 11, "merged": 4, "text": 4}.items():
        df = sinks.footer_count(spark, prefix, name)
        assert sinks.stored_row_count(spark, prefix, name) == want == spark.table(f"{prefix}.{name}").count()
        assert (df is None) == (name == "text")
        if df is not None:
            with tables._conf(spark, tables.FOOTERS):
                plan = df._jdf.queryExecution().toString()
            assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<>" not in plan
    sinks.write_table(spark.table(f"{prefix}.plain").where("id < 10"), prefix, "plain")
    assert sinks.stored_row_count(spark, prefix, "plain") == 10
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_merge_refuses_two_rows_of_one_key_and_takes_none(spark, prefix):
    schema = "k string, d date, n long"
    one = spark.createDataFrame([("a", day("2024-01-01"), 1)], schema)
    for _ in range(2):
        with pytest.raises(ValueError, match="2 incoming rows"):
            sinks.merge_table(spark, prefix, "m", one.union(one), ["k", "d"], "d")
        sinks.merge_table(spark, prefix, "m", one, ["k", "d"], "d")
    assert rows(sinks.merge_table(spark, prefix, "m", one.limit(0), ["k", "d"], "d"), "k", "d", "n") == rows(one, "k", "d", "n")
    wh = warehouse(spark, SF)
    assert record_row_counts(wh, [], "dev", prefix).count() == 0


def test_the_documented_run(spark, prefix):
    wh = warehouse(spark, SF)
    placed = publish(wh, "dev", prefix)
    spaces = [n for n in sorted(set(placed.values())) if spark.catalog.databaseExists(n)]
    record_row_counts(wh, spaces, "dev", prefix)
    results = run_checks(wh, at=ts("2024-01-31 03:00:00"))
    assert results.count() == 168 + 19
    home = record_health(wh, results, "dev", prefix)
    record_health(wh, results.withColumn("created_at", F.lit(ts("2024-02-01 03:00:00"))), "dev", prefix)
    stored_health(wh, home)
    rates = wh["fct_dbt_test_results"]
    assert rates.select("run_date").distinct().count() == 2 and rates.agg(F.sum("test_count")).first()[0] == 2 * (168 + 19 - len(CHECKS["fx_rates"]))  # rates are no model
    assert wh["fct_source_freshness"].count() == 2 * len(LANDING)


def _settled(wh, name, rows_, schema):
    wh.settle(name, wh.spark.createDataFrame(rows_, schema))


def test_invariants_look_at_the_written_tables(spark):
    price = "game_price_key string, game_id long, region string, currency string, price_cents long, valid_from timestamp, valid_to timestamp, is_current boolean"
    a, b, c, d = (ts(f"2024-01-0{k} 00:00:00") for k in (1, 2, 3, 4))
    wh = warehouse(spark, SF)
    _settled(wh, "dim_game_prices", [("1", 1, "R", "USD", 5, a, b, False), ("2", 1, "R", "USD", 5, c, None, True), ("3", 2, "R", "USD", 5, a, c, True), ("4", 2, "R", "USD", 5, b, None, True)], price)
    run = lambda name: rows(INVARIANTS[name][1](wh))
    assert [r[:2] for r in run("dim_game_prices_one_current_row")] == [(2, "R")]
    assert [r[0] for r in run("dim_game_prices_gapless_coverage")] == [1, 2]
    assert [r[0] for r in run("dim_game_prices_no_overlapping_intervals")] == [2]

    _settled(wh, "fct_purchases", [("p", "u", "g", b, day("2024-01-02"), 100, "USD", 1.0, "card")], "purchase_key string, user_key string, game_key string, purchased_at timestamp, purchase_date date, amount_cents long, currency string, amount_usd double, payment_method string")
    _settled(wh, "fct_refunds", [("r", "p", "u", "g", a, day("2024-01-01"), False, 1.0), ("s", "p", "u", "g", c, day("2024-01-03"), False, 1.0)], "refund_key string, purchase_key string, user_key string, game_key string, refunded_at timestamp, refund_date date, is_chargeback boolean, refunded_amount_usd double")
    assert [r[0] for r in run("fct_refunds_after_purchase")] == ["r"]
    _settled(wh, "dim_users", [("u", "DE")], "user_key string, country string")
    revenue = "revenue_date date, country string, is_chargeback boolean, finance_revenue_daily_key string, revenue_cents long, refunded_cents long, purchase_count long, refund_count long, chargeback_count long"
    _settled(wh, "fct_finance_revenue_daily", [(day("2024-01-01"), "DE", False, "k", 0, 100, 0, 1, 0), (day("2024-01-03"), "DE", False, "l", 0, 99, 0, -1, 0)], revenue)
    assert [r[0] for r in run("fct_finance_revenue_daily_refunds_by_refund_date")] == ["2024-01-03"]
    assert [r[0] for r in run("fct_finance_revenue_daily_non_negative")] == ["2024-01-03"]
