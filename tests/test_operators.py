"""Edge rows of each operator, small enough to read."""

import datetime as dt
import hashlib

import pytest
from conftest import day, rows, ts
from pyspark.sql import functions as F

from vitrine import operators as op
from vitrine.functions import days_between, minutes_between, ratio_or_null, ratio_or_zero, surrogate_key
from vitrine.plans.staging import stage
from vitrine.sources import LANDING


def landed(spark, name, versions):
    """Landing rows from (columns, offset, deleted)."""
    layout = LANDING[name]
    data = []
    for columns, offset, deleted in versions:
        row = {f.name: None for f in layout.schema.fields}
        row.update(columns)
        row["__deleted"] = deleted
        row["record_metadata"] = {"offset": offset, "partition": 0, "topic": name}
        data.append(tuple(row[f.name] for f in layout.schema.fields))
    return spark.createDataFrame(data, layout.schema)


def test_latest_version_wins_before_deletion(spark):
    users = [
        ({"id": 1, "username": "old", "created_at": "2024-01-01T00:00:00Z"}, 1, False),
        ({"id": 1, "username": "new", "created_at": "2024-01-01T00:00:00Z"}, 5, None),
        ({"id": 2, "username": "live", "created_at": "2024-01-01T00:00:00Z"}, 2, False),
        ({"id": 2, "username": "gone", "created_at": "2024-01-01T00:00:00Z"}, 6, True),
        ({"id": 3, "username": "only", "created_at": "2024-01-01T02:00:00+02:00"}, 3, False),
    ]
    staged = stage(landed(spark, "users", users), "users")
    assert rows(staged, "user_id", "username", "is_deleted", "created_at") == [
        (1, "new", False, "2024-01-01 00:00:00"),
        (2, "gone", True, "2024-01-01 00:00:00"),
        (3, "only", False, "2024-01-01 00:00:00"),
    ]


def test_latest_null_order_value(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 9, "b")], "k int, o int, v string")
    assert rows(op.latest_by(df, ["k"], "o"), "v") == [("a",)]
    assert rows(op.latest_by(df, ["k"], "o", nulls="last"), "v") == [("b",)]


def test_latest_sends_one_row_per_key_and_task(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as o")
    plan = op.latest_by(df, ["k"], "o")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_staging_parses_json_and_rejects_bad_text(spark):
    ok = landed(spark, "client_events", [({"event_id": 1, "props": '{"k": 7}', "session_id": "s"}, 1, False)])
    staged = stage(ok, "client_events")
    assert staged.select(F.variant_get("props", "$.k", "int")).first()[0] == 7
    bad = landed(spark, "client_events", [({"event_id": 1, "occurred_at": "yesterday"}, 1, False)])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(bad, "client_events").collect()


def test_every_staging_model_names_its_key(spark):
    for name, layout in LANDING.items():
        staged = stage(spark.createDataFrame([], layout.schema), name)
        assert staged.columns[-1] == "is_deleted" and not any(c.startswith("__") for c in staged.columns)
        assert "id" not in staged.columns and "record_metadata" not in staged.columns


def test_scalars(spark):
    df = spark.sql(
        "select timestamp'2024-01-01 00:00:59' a, timestamp'2024-01-01 00:01:01' b,"
        " timestamp'2024-01-01 23:00:00' c, timestamp'2024-01-02 01:00:00' d, 0L z, 4L n, cast(null as bigint) x"
    )
    got = df.select(
        minutes_between("a", "b"),
        minutes_between("b", "a"),
        days_between("c", "d"),
        days_between("a", "b"),
        ratio_or_zero("n", "z"),
        ratio_or_null("n", "z"),
        ratio_or_zero("n", "x"),
        surrogate_key("n", "x"),
    ).first()
    key = hashlib.md5(b"4-_dbt_utils_surrogate_key_null_").hexdigest()
    assert tuple(got) == (1, -1, 1, 0, 0.0, None, None, key)


def test_fx_keeps_rows_without_a_rate(spark):
    buys = spark.createDataFrame(
        [(1, 1000, "EUR", ts("2024-01-01 23:59:59")), (2, 1000, "EUR", ts("2024-01-02 00:00:00")), (3, 5, None, None)],
        "id int, cents long, ccy string, at timestamp",
    )
    rates = spark.createDataFrame([(day("2024-01-01"), "EUR", 1.5)], "date date, currency string, rate_to_usd double")
    out = op.fx_convert(buys, rates, ts="at", currency="ccy", cents="cents", out="usd")
    assert rows(out, "id", "usd") == [(1, 15.0), (2, None), (3, None)]
    doubled = rates.unionByName(rates)
    assert op.fx_convert(buys, doubled, ts="at", currency="ccy", cents="cents", out="usd").count() == 4
    assert rows(op.check_unique_combination(doubled, ["date", "currency"]), "n_records") == [(2,)]


def replay(spark, changes, entities, current):
    return op.scd2_replay(
        spark.createDataFrame(changes, "id int, g int, r string, ccy string, old long, new long, at timestamp"),
        spark.createDataFrame(entities, "g int, born timestamp"),
        spark.createDataFrame(current, "g int, r string, ccy string, price long"),
        entity="g",
        keys=["g", "r"],
        ts="at",
        tie_break="id",
        old="old",
        new="new",
        value="price",
        origin="born",
        attrs=["ccy"],
    )


def test_scd2_replay(spark):
    b = ts("2024-01-01")
    out = replay(
        spark,
        [
            (1, 1, "EU", "EUR", 10, 20, ts("2024-02-01")),
            (2, 1, "EU", "EUR", 20, 30, ts("2024-03-01")),
            (3, 2, "EU", "EUR", None, 5, ts("2024-02-01")),  # no price before
            (4, 2, "EU", "EUR", 5, 6, ts("2024-02-01")),  # tied with the earliest
            (5, 3, "EU", "EUR", 1, 2, ts("2023-06-01")),  # before the entity came to be
            (6, 9, "EU", "EUR", 1, 2, ts("2024-02-01")),  # unknown entity
            (7, 4, "EU", "EUR", 1, 2, ts("2024-02-01 10:00:00")),  # two on one day
            (8, 4, "EU", "EUR", 2, 3, ts("2024-02-01 11:00:00")),
        ],
        [(g, b) for g in (1, 2, 3, 4, 5)],
        [(1, "EU", "EUR", 99), (1, "US", "USD", 7), (5, "EU", "EUR", 8), (9, "US", "USD", 1)],
    )
    assert rows(out, "g", "r", "price", "valid_from", "valid_to", "is_current") == sorted(
        [
            (1, "EU", 10, "2024-01-01 00:00:00", "2024-02-01 00:00:00", False),
            (1, "EU", 20, "2024-02-01 00:00:00", "2024-03-01 00:00:00", False),
            (1, "EU", 30, "2024-03-01 00:00:00", None, True),
            (1, "US", 7, "2024-01-01 00:00:00", None, True),
            (2, "EU", 5, "2024-01-01 00:00:00", "2024-02-01 00:00:00", False),
            (2, "EU", 6, "2024-01-01 00:00:00", None, True),
            (3, "EU", 1, "2024-01-01 00:00:00", "2023-06-01 00:00:00", False),
            (3, "EU", 2, "2023-06-01 00:00:00", None, True),
            (4, "EU", 1, "2024-01-01 00:00:00", "2024-02-01 10:00:00", False),
            (4, "EU", 2, "2024-02-01 10:00:00", "2024-02-01 11:00:00", False),
            (4, "EU", 3, "2024-02-01 11:00:00", None, True),
            (5, "EU", 8, "2024-01-01 00:00:00", None, True),
        ],
        key=lambda t: tuple((c is not None, str(type(c)), c) for c in t),
    )


def test_previous_end(spark):
    df = spark.createDataFrame(
        [
            (1, ts("2024-01-01"), ts("2024-01-05")),
            (1, ts("2024-01-05"), ts("2024-01-09")),
            (1, ts("2024-01-08"), None),
            (2, ts("2024-01-01 01:00:00"), ts("2024-01-01 02:00:00")),
            (2, ts("2024-01-01 03:00:00"), None),
        ],
        "k int, valid_from timestamp, valid_to timestamp",
    )
    out = op.previous_end(df, ["k"])
    gaps = out.filter("valid_from <> prev_valid_to")
    assert rows(gaps, "k", "valid_from") == [(1, "2024-01-08 00:00:00"), (2, "2024-01-01 03:00:00")]
    assert rows(out.filter("valid_from < prev_valid_to"), "k", "valid_from") == [(1, "2024-01-08 00:00:00")]


def ledger(spark, inflow, outflow, members):
    return op.signed_daily(
        spark.createDataFrame(inflow, "u int, d date, usd double"),
        spark.createDataFrame(outflow, "u int, d date, usd double, cb boolean"),
        spark.createDataFrame(members, "u int, country string"),
        member="u",
        date="d",
        amount="usd",
        flag="cb",
        dims=["country"],
    )


def test_signed_daily(spark):
    d1, d2 = day("2024-01-01"), day("2024-01-02")
    out = ledger(
        spark,
        [(1, d1, 1.25), (1, d1, None), (2, d1, 2.0), (8, d1, 50.0)],  # 8 is unknown
        [(1, d2, 1.25, False), (2, d2, 2.0, True), (2, d2, 2.0, None)],
        [(1, None), (2, "BR")],
    )
    got = rows(out, "d", "country", "cb", "in_cents", "out_cents", "in_count", "out_count", "flagged_count")
    assert got == [
        ("2024-01-01", None, False, 125, 0, 2, 0, 0),
        ("2024-01-01", "BR", False, 200, 0, 1, 0, 0),
        ("2024-01-02", None, False, 0, 125, 0, 1, 0),
        ("2024-01-02", "BR", None, 0, 0, 0, 0, 0),
        ("2024-01-02", "BR", True, 0, 200, 0, 1, 1),
    ]


def test_refund_valuation_drops_refunds_without_purchase(spark):
    refunds = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, None)], "id int, p int")
    buys = spark.createDataFrame([(10, 5.0), (12, 6.0)], "p int, usd double")
    assert rows(op.refund_valuation(refunds, buys, "p"), "id", "usd") == [(1, 5.0), (2, 5.0)]


def test_trailing_distinct(spark):
    data = [(day("2024-01-01"), 1), (day("2024-01-01"), 1), (day("2024-01-07"), 2), (day("2024-01-08"), 3)]
    data += [(day("2024-01-01"), None), (day("2024-01-03"), 1)]
    df = spark.createDataFrame(data, "d date, u int")
    assert rows(op.trailing_distinct(df, date="d", member="u"), "d", "daily", "trailing") == [
        ("2024-01-01", 2, 2),
        ("2024-01-03", 1, 2),
        ("2024-01-07", 1, 3),  # day 1 is six days back: in
        ("2024-01-08", 1, 3),  # member 1 stays by day 3; NULL member is seven days back: out
    ]


def test_cohort_percentiles(spark):
    data = [
        (1, 7, day("2024-01-01"), None, True),  # open, sets the first day
        (1, 7, day("2024-01-01"), 10, False),
        (1, 7, day("2024-01-02"), 20, False),
        (2, 7, day("2024-01-02"), 30, False),
        (2, 7, day("2024-01-02"), 40, False),
        (2, 8, day("2024-01-02"), 1, False),
    ]
    df = spark.createDataFrame(data, "u int, g int, d date, m long, open boolean")
    out = op.cohort_percentiles(
        df, member="u", entity="g", date="d", value="m", is_open="open", probs={"p50": 0.5, "p90": 0.9}
    )
    got = rows(out, "d", "g", "user_cohort", "session_count", "average", "p50", F.round("p90", 6))
    assert got == [
        ("2024-01-01", 7, "new", 1, 10.0, 10.0, 10.0),
        ("2024-01-02", 7, "new", 2, 35.0, 35.0, 39.0),
        ("2024-01-02", 7, "returning", 1, 20.0, 20.0, 20.0),
        ("2024-01-02", 8, "new", 1, 1.0, 1.0, 1.0),
    ]


def test_conversion(spark):
    starts = spark.createDataFrame(
        [
            (1, 7, ts("2024-01-01 12:00:00")),  # grant at the same instant, then one two days on
            (2, 7, ts("2024-01-01 12:00:00")),  # grant before only
            (3, 7, ts("2024-01-01 23:00:00")),  # one hour later, past midnight
            (4, 7, ts("2024-01-01 10:00:00")),  # later the same day
            (1, 8, ts("2024-01-01 10:00:00")),  # none
            (None, 7, ts("2024-01-01 10:00:00")),  # NULL keys match
            (5, 7, None),
        ],
        "u int, g int, at timestamp",
    )
    ends = spark.createDataFrame(
        [
            (1, 7, ts("2024-01-01 12:00:00")),
            (1, 7, ts("2024-01-03 00:00:00")),
            (1, 7, ts("2024-01-09 00:00:00")),
            (2, 7, ts("2024-01-01 11:00:00")),
            (3, 7, ts("2024-01-02 00:00:00")),
            (4, 7, ts("2024-01-01 09:00:00")),
            (4, 7, ts("2024-01-01 11:00:00")),
            (None, 7, ts("2024-01-04 11:00:00")),
            (5, 7, ts("2024-01-04 11:00:00")),
            (6, 7, None),
        ],
        "u int, g int, got timestamp",
    )
    args = dict(keys=["u", "g"], start_ts="at", end_ts="got", group=["g"])
    out = op.conversion(starts, ends, **args)
    got = rows(out, "g", "start_count", "converted_count", "conversion_rate", "median_days_to_convert")
    assert got == [(7, 6, 4, 4 / 6, 1.5), (8, 1, 0, 0.0, None)]
    again = op.converted_counts(starts, ends, **args)
    assert rows(again, "g", "start_count", "converted_count") == [(7, 6, 4), (8, 1, 0)]


def test_funnel(spark):
    stages = ["view", "cart", "buy"]
    events = spark.createDataFrame(
        [
            ("a", 1, "view", ts("2024-01-01 10:00:00")),
            ("a", 1, "view", ts("2024-01-01 09:00:00")),
            ("a", 1, "scroll", ts("2024-01-01 08:00:00")),  # no stage
            ("a", 1, "buy", ts("2024-01-02 10:00:00")),  # skipped cart
            ("b", 2, "cart", ts("2024-01-01 10:00:00")),
            ("b", 2, "view", ts("2024-01-01 11:00:00")),  # out of order
            (None, 3, "view", ts("2024-01-01 11:00:00")),
            ("c", 4, "scroll", ts("2024-01-01 08:00:00")),  # nothing left of it
        ],
        "s string, u int, name string, at timestamp",
    )
    out = op.funnel(events, session=["s", "u"], name="name", ts="at", stages=stages)
    assert rows(out, "s", "u", "session_date", "session_started_at", "cart_at", "has_reached_buy") == [
        (None, 3, "2024-01-01", "2024-01-01 11:00:00", None, False),
        ("a", 1, "2024-01-01", "2024-01-01 09:00:00", None, True),
        ("b", 2, "2024-01-01", "2024-01-01 10:00:00", "2024-01-01 10:00:00", False),
    ]
    late = op.stage_order_violations(out, session_key="s", stages=stages)
    assert rows(late, "s", "stage_order", "stage_at", "prev_stage_at") == [
        ("b", 2, "2024-01-01 10:00:00", "2024-01-01 11:00:00")
    ]


def test_attribution(spark):
    users = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, 99)], "u int, c int")
    campaigns = spark.createDataFrame([(5, "email", 1000), (6, "influencer", 500)], "cid int, channel string, spend long")
    found = op.first_touch(users, campaigns, fk="c", pk="cid", label="channel", default="organic")
    assert rows(found, "u", "channel") == [(1, "email"), (2, "email"), (3, "organic"), (4, "organic")]
    ratio = op.ratio_per_entity(
        campaigns,
        users.selectExpr("c as cid"),
        key="cid",
        numerator="spend",
        count_out="n",
        ratio_out="cpa",
        scale=100,
    )
    assert rows(ratio, "cid", "n", "cpa") == [(5, 2, 5.0), (6, 0, None)]
    buys = spark.createDataFrame([(1, 2.0), (1, 3.0), (3, 9.0), (7, 1.0)], "u int, usd double")
    rolled = op.rollup_via_bridge(buys, users, member="u", entity="c", value="usd", out="usd")
    assert rows(rolled, "c", "usd") == [(5, 5.0)]


def test_peaks_and_counts(spark):
    snaps = spark.createDataFrame(
        [(ts("2024-01-01 01:00:00"), 5), (ts("2024-01-01 01:00:00"), 6), (ts("2024-01-01 02:00:00"), 10)],
        "at timestamp, n long",
    ).withColumn("d", F.to_date("at"))
    assert rows(op.peak_of_totals(snaps, instant="at", date="d", value="n", out="peak")) == [("2024-01-01", 11)]
    assert rows(op.daily_count(snaps, ["d"], "c")) == [("2024-01-01", 3)]


def test_date_spine_excludes_its_end(spark):
    bounds = spark.sql("select date'2023-01-01' as first_day, date'2027-01-01' as end_day")
    days = op.date_spine(bounds)
    assert days.count() == 1461 and days.agg(F.max("date_day")).first()[0] == dt.date(2026, 12, 31)
    assert op.date_spine(spark.sql("select date'2023-01-01' as first_day, date'2023-01-01' as end_day")).count() == 0


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, None), (None, None)], "k int, v string")
    assert rows(op.check_unique(df, "k")) == [(1, 2)]
    assert op.check_not_null(df, "k").count() == 2
    assert rows(op.check_accepted_values(df, "v", ["a"])) == [("b", 1)]
    parent = spark.createDataFrame([(2,), (3,), (None,)], "id int")
    assert rows(op.check_relationships(df, "k", parent, "id")) == [(1, 2)]
    assert rows(op.check_unique_combination(df, ["k", "v"])) == [(None, None, 2)]


def test_diff_by_key(spark):
    a = spark.createDataFrame([("x", None, 1), ("y", "p", 2)], "k string, c string, n long")
    b = spark.createDataFrame([("x", None, 1), ("y", "p", 3), ("z", "q", 0)], "k string, c string, n long")
    diff = op.diff_by_key(a, b, keys=["k", "c"], measures=["n"], null_safe=["c"])
    assert rows(diff) == [("y", "p", 2, 3)]
    strict = op.diff_by_key(a, b, keys=["k", "c"], measures=["n"])
    assert rows(strict, "k", "expected_n", "actual_n") == [("x", 0, 1), ("x", 1, 0), ("y", 2, 3)]


def test_freshness_thresholds(spark):
    now = ts("2024-01-02 00:00:00")

    def loaded(hours):
        ms = int((now - dt.timedelta(hours=hours)).timestamp() * 1000)
        return spark.createDataFrame([(ms,), (ms - 10**6,)], "__source_ts_ms long")

    sources = {
        "ok": loaded(12),
        "warn": loaded(12.01),
        "late": loaded(24),
        "error": loaded(24.01),
        "empty": loaded(1).filter("false"),
    }
    out = op.freshness(sources, {n: (12, 24) for n in sources}, now)
    assert rows(out, "unique_id", "status", "error") == [
        ("source.empty", "error", "no rows"),
        ("source.error", "error", None),
        ("source.late", "warn", None),
        ("source.ok", "pass", None),
        ("source.warn", "warn", None),
    ]


def test_pass_rate(spark):
    results = spark.createDataFrame(
        [
            ("t1", "test", "pass", ts("2024-01-01 01:00:00")),
            ("t1", "test", "fail", ts("2024-01-01 23:00:00")),
            ("t2", "test", "pass", ts("2024-01-01 01:00:00")),
            ("t2", "model", "pass", ts("2024-01-01 01:00:00")),
            ("t9", "test", "pass", ts("2024-01-01 01:00:00")),
        ],
        "unique_id string, resource_type string, status string, created_at timestamp",
    )
    tests = spark.createDataFrame([("t1", "m1"), ("t2", "m2")], "unique_id string, parent_model_unique_id string")
    models = spark.createDataFrame([("m1", "core"), ("m2", "core")], "unique_id string, schema_name string")
    out = op.pass_rate(results, tests, models)
    assert rows(out, "run_date", "schema_name", "test_count", "pass_count", "pass_rate") == [
        ("2024-01-01", "core", 3, 2, 2 / 3)
    ]


def test_lookup_types(spark):
    big = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    small = spark.createDataFrame([(1, "a")], "k int, v string")
    assert rows(op.lookup(big, small, ["k"])) == [(None, None), (1, "a"), (2, None)]
    assert rows(op.lookup(big, small, ["k"], "left_anti")) == [(None,), (2,)]
    assert rows(op.lookup(big, small, ["k"], "left_semi")) == [(1,)]
    zero = spark.createDataFrame([(-0.0,)], "k double")
    assert op.lookup(zero, spark.createDataFrame([(0.0, 1)], "k double, v int"), ["k"], "inner").count() == 1
    with pytest.raises(TypeError):
        op.lookup(big, spark.createDataFrame([("1",)], "k string"), ["k"])
    with pytest.raises(ValueError):
        op.lookup(big.withColumn("v", F.lit("b")), small, ["k"])


def test_scd2_replay_keeps_the_opening_interval_of_null_keys(spark):
    """Its changes match no key, itself included, so the present price stands beside it."""
    changes = spark.createDataFrame([(1, 7, None, "USD", ts("2024-01-05 00:00:00"), 100, 200), (2, 7, None, "USD", ts("2024-01-06 00:00:00"), 200, 300)], "id long, g long, r string, cur string, at timestamp, old long, new long")
    games = spark.createDataFrame([(7, ts("2024-01-01 00:00:00"))], "g long, born timestamp")
    current = spark.createDataFrame([(7, None, "USD", 300), (7, "R1", "USD", 50)], "g long, r string, cur string, price long")
    out = op.scd2_replay(changes, games, current, entity="g", keys=["g", "r"], ts="at", tie_break="id", old="old", new="new", value="price", origin="born", attrs=["cur"])
    assert rows(out, "r", "price", "valid_from", "valid_to") == [
        (None, 100, "2024-01-01 00:00:00", "2024-01-05 00:00:00"),
        (None, 300, "2024-01-01 00:00:00", None),
        ("R1", 50, "2024-01-01 00:00:00", None),
    ]


def test_latest_by_breaks_ties_by_further_columns(spark):
    tied = spark.createDataFrame([(1, 5, i) for i in range(200)], "k long, at long, id long")
    for n in (1, 3, 8):
        assert rows(op.latest_by(tied.repartition(n), ["k"], ["at", "id"])) == [(1, 5, 199)]


def test_sums_of_money_do_not_depend_on_row_order(spark):
    values = [0.005, 1e9, -1e9] * 300
    for seed in (1, 2):
        order = sorted(range(len(values)), key=lambda i: (i * 7919 * seed) % 1009)
        moved = spark.createDataFrame([(1, day("2024-01-01"), values[i]) for i in order], "u long, d date, usd double").repartition(seed)
        none = moved.limit(0).withColumn("flag", F.lit(False))
        out = op.signed_daily(moved, none, spark.createDataFrame([(1, "DE")], "u long, c string"), member="u", date="d", amount="usd", flag="flag", dims=["c"])
        assert out.first()["in_cents"] == 150


def test_refunded_daily_shuffles_no_purchase_and_agrees_with_the_two_legs(spark):
    purchases = spark.createDataFrame([(i, i % 7, day("2024-01-01"), None if i % 11 == 0 else i / 8) for i in range(60)], "id long, u long, d date, usd double")
    refunds = spark.createDataFrame([(i % 90 if i % 13 else None, day(f"2024-01-0{1 + i % 3}"), None if i % 17 == 0 else i % 2 == 0) for i in range(150)], "id long, back date, flag boolean")
    users = spark.createDataFrame([(u, None if u == 2 else f"C{u % 2}") for u in range(6)], "u long, c string")
    spread = purchases.repartition(4, "id")
    out = op.refunded_daily(spread, refunds, users, key="id", member="u", date="d", amount="usd", refund_date="back", flag="flag", dims=["c"])
    valued = op.refund_valuation(refunds, purchases.withColumnRenamed("d", "bought"), "id").withColumnRenamed("back", "d")
    both = op.signed_daily(purchases, valued, users, member="u", date="d", amount="usd", flag="flag", dims=["c"])
    assert rows(out, *both.columns) == rows(both)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = purchases.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")
        out = op.refunded_daily(spread, refunds, users, key="id", member="u", date="d", amount="usd", refund_date="back", flag="flag", dims=["c"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len([x for x in plan.split("\n") if "Exchange hashpartitioning(id#" in x and "back#" not in x]) == 2  # purchases as given, refunds per purchase
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
