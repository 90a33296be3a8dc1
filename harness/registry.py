"""Queries over the driver tables, each with the statement DuckDB checks it by."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness import oracle
from harness.testdata import table, warehouse
from vitrine import operators as op
from vitrine.plans import MODELS
from vitrine.plans.checks import CHECKS, INVARIANTS, table_failures
from vitrine.plans.pipeline_health import source_freshness
from vitrine.session import configure
from vitrine.sources import LANDING

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

TABLES = oracle._TABLE_NAMES


def comparable(df: DataFrame) -> DataFrame:
    """Types DuckDB shares: zone-less timestamps, JSON and lists as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.VariantType):
            c = F.to_json(c)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def add(name: str, query: Query, sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return comparable(query(spark, sf_dir))

    QUERIES[name] = run
    ORACLE[name] = oracle.compose(sql)


def on_tables(name: str, sql: str):
    """Register a function of a table reader."""

    def register(fn):
        add(name, lambda spark, sf_dir: fn(lambda t: table(spark, sf_dir, t)), sql)
        return fn

    return register


def _rounded(name: str, columns: dict[str, int]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = warehouse(spark, sf_dir)[name]
        for c, digits in columns.items():
            df = df.withColumn(c, F.round(c, digits))
        return df

    return query


# Sums of doubles and interpolated values are compared to fixed digits.
_DIGITS = {
    "fct_marketing_campaign_revenue": {"attributed_revenue_usd": 2},
    "fct_product_session_length_daily": {"avg_duration_minutes": 6, "p90_duration_minutes": 6},
}


def _scan(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return (
            warehouse(spark, sf_dir)
            .landing(name)
            .select(
                "*",
                F.col("record_metadata.offset").alias("kafka_offset"),
                F.col("record_metadata.partition").alias("kafka_partition"),
                F.col("record_metadata.topic").alias("kafka_topic"),
            )
            .drop("record_metadata")
        )

    return query


for _name in LANDING:
    add(f"scan_landing_{_name}", _scan(_name), oracle.scan_sql(_name))
add("scan_fx_rates", lambda s, d: warehouse(s, d).fx_rates, "select * from fx_rates")



def _scan_health(name: str) -> Query:
    return lambda spark, sf_dir: warehouse(spark, sf_dir).health(name)


for _name, _relation in oracle.HEALTH_RELATIONS.items():
    add(f"scan_health_{_name}", _scan_health(_name), f"select * from {_relation}")

for _name in MODELS:
    _sql = oracle.stage_sql(_name.removeprefix("stg_")) if _name.startswith("stg_") else oracle.MODEL_SQL[_name]
    add(_name, _rounded(_name, _DIGITS.get(_name, {})), _sql)


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's counts of the given tables merged into a history: yesterday's counts, an earlier count of
    today, and one of a table that is gone since."""
    tables = {t: table(spark, sf_dir, t) for t in TABLES}
    today, yesterday = dt.date(2024, 1, 31), dt.date(2024, 1, 30)
    returned = tables["lineitem"].filter("l_returnflag = 'R'")
    history = op.row_counts(tables, "testdata", yesterday).unionByName(
        op.row_counts({"lineitem": returned, "returned_lines": returned}, "testdata", today)
    )
    counted = op.row_counts(tables, "testdata", today)
    return op.upsert(history, counted, ["schema_name", "table_name", "snapshot_date"])


add("fct_row_counts", _row_counts, oracle.MODEL_SQL["fct_row_counts"])
add("source_freshness", lambda s, d: source_freshness(warehouse(s, d)), oracle.freshness_sql())


def _invariant(name: str) -> Query:
    return lambda spark, sf_dir: INVARIANTS[name][1](warehouse(spark, sf_dir))


for _name in INVARIANTS:
    add(f"assert_{_name}", _invariant(_name), oracle.INVARIANT_SQL[_name])


def _declared(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _row_counts(spark, sf_dir) if name == "fct_row_counts" else None
        return table_failures(warehouse(spark, sf_dir), name, df)

    return query


for _name in CHECKS:
    add(f"checks_{_name}", _declared(_name), oracle.checks_sql(_name))


# The five check forms on the driver tables.


@on_tables(
    "check_unique",
    "select l_orderkey as unique_field, cast(count(*) as bigint) as n_records from lineitem "
    "where l_orderkey is not null group by l_orderkey having count(*) > 1",
)
def _(read):
    return op.check_unique(read("lineitem"), "l_orderkey")


add(
    "check_not_null",
    lambda s, d: op.check_not_null(warehouse(s, d)["dim_users"], "country"),
    "select * from dim_users where country is null",
)


@on_tables(
    "check_accepted_values",
    "select event_type as value_field, cast(count(*) as bigint) as n_records from events "
    "where event_type not in ('view', 'click', 'purchase') group by event_type",
)
def _(read):
    return op.check_accepted_values(read("events"), "event_type", ["view", "click", "purchase"])


@on_tables(
    "check_relationships",
    "select o_custkey as from_field, cast(count(*) as bigint) as n_records from orders "
    "left join supplier on s_suppkey = o_custkey where o_custkey is not null and s_suppkey is null group by o_custkey",
)
def _(read):
    return op.check_relationships(read("orders"), "o_custkey", read("supplier"), "s_suppkey")


@on_tables(
    "check_unique_combination",
    "select l_orderkey, l_linenumber, cast(count(*) as bigint) as n_records from lineitem "
    "group by l_orderkey, l_linenumber having count(*) > 1",
)
def _(read):
    return op.check_unique_combination(read("lineitem"), ["l_orderkey", "l_linenumber"])


# The operators on the driver tables, with other column roles than the models give them.


@on_tables(
    "latest_event_per_user",
    "select user_id, event_id, event_type, ts from events "
    "qualify row_number() over (partition by user_id order by event_id desc) = 1",
)
def _(read):
    newest = op.latest_by(read("events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], "event_id")
    return newest


@on_tables(
    "trailing_users_of_events",
    """select d.day, cast(count(distinct e.user_id) filter (e.ts::date = d.day) as bigint) as daily,
  cast(count(distinct e.user_id) as bigint) as trailing
from (select distinct ts::date as day from events) d join events e on e.ts::date between d.day - 13 and d.day
group by d.day""",
)
def _(read):
    events = read("events").select(F.to_date("ts").alias("day"), "user_id")
    return op.trailing_distinct(events, date="day", member="user_id", days=14)


@on_tables(
    "newest_by_batches_of_events",
    "select user_id, event_id, event_type, ts from events "
    "qualify row_number() over (partition by user_id order by event_id desc) = 1",
)
def _(read):
    """All events in three batches that hold earlier and later ones alike."""
    events = read("events").select("user_id", "event_id", "event_type", "ts")
    state = op.latest_by(events.filter("event_id % 3 = 1"), ["user_id"], "event_id")
    for batch in (0, 2):
        state = op.newest_of(state, events.filter(f"event_id % 3 = {batch}"), ["user_id"], "event_id")
    return state


@on_tables(
    "trailing_users_by_masks",
    """select d.day, cast(count(distinct e.user_id) filter (e.ts::date = d.day) as bigint) as daily,
  cast(count(distinct e.user_id) as bigint) as trailing
from (select distinct ts::date as day from events) d join events e on e.ts::date between d.day - 13 and d.day
where d.day > (select max(ts::date) from events) - 49 group by d.day""",
)
def _(read):
    """The days that masks of 62 days tell: the last 49."""
    events = read("events").select(F.to_date("ts").alias("day"), "user_id")
    as_of = events.agg(F.max("day")).first()[0]
    masks = op.activity_masks(events, date="day", member="user_id", as_of=as_of)
    return op.trailing_of_masks(masks, as_of=as_of, date="day", days=14, back=48)


@on_tables(
    "conversion_click_to_purchase",
    """select user_id, cast(count(*) as bigint) as start_count, cast(count(got) as bigint) as converted_count,
  cast(median(date_diff('day', ts, got)) as double) as median_days_to_convert, count(got) / count(*) as conversion_rate
from (select c.user_id, c.event_id, c.ts, min(p.ts) as got from events c
      left join events p on p.event_type = 'purchase' and p.user_id = c.user_id and p.ts > c.ts
      where c.event_type = 'click' group by all)
group by user_id""",
)
def _(read):
    events = read("events")
    return op.conversion(
        events.filter("event_type = 'click'"),
        events.filter("event_type = 'purchase'"),
        keys=["user_id"],
        start_ts="ts",
        end_ts="ts",
        group=["user_id"],
    )


_STEPS = ["view", "click", "purchase"]


@on_tables(
    "funnel_of_user_days",
    f"""select user_id, ts::date as day, min(ts)::date as session_date, min(ts) as session_started_at,
  {', '.join(f"min(ts) filter (event_type = '{s}') as {s}_at" for s in _STEPS)},
  {', '.join(f"count(*) filter (event_type = '{s}') > 0 as has_reached_{s}" for s in _STEPS)}
from events where event_type in ('view', 'click', 'purchase') group by user_id, ts::date""",
)
def _(read):
    events = read("events").withColumn("day", F.to_date("ts"))
    return op.funnel(events, session=["user_id", "day"], name="event_type", ts="ts", stages=_STEPS)


@on_tables(
    "cohort_percentiles_of_quantities",
    """select day, l_linenumber, user_cohort, cast(count(*) as bigint) as session_count,
  round(avg(q), 6) as average, round(cast(median(q) as double), 6) as p50, round(quantile_cont(q, 0.9), 6) as p90
from (select date_trunc('month', l_shipdate)::date as day, l_linenumber, cast(l_quantity as bigint) as q,
        l_returnflag = 'R' as is_open,
        case when day = min(day) over (partition by l_suppkey, l_linenumber) then 'new' else 'returning' end
          as user_cohort
      from lineitem)
where not is_open group by all""",
)
def _(read):
    lines = read("lineitem").select(
        "l_suppkey",
        "l_linenumber",
        F.trunc("l_shipdate", "month").alias("day"),
        F.col("l_quantity").cast("long").alias("q"),
        (F.col("l_returnflag") == "R").alias("is_open"),
    )
    result = op.cohort_percentiles(
        lines,
        member="l_suppkey",
        entity="l_linenumber",
        date="day",
        value="q",
        is_open="is_open",
        probs={"p50": 0.5, "p90": 0.9},
    )
    return result.withColumns({c: F.round(c, 6) for c in ("average", "p50", "p90")})


@on_tables(
    "first_touch_of_customers",
    """select c_custkey, c_nationkey, coalesce(s_name, 'none') as s_name from customer
left join supplier on s_suppkey = c_nationkey""",
)
def _(read):
    return op.first_touch(
        read("customer").select("c_custkey", "c_nationkey"),
        read("supplier").select("s_suppkey", "s_name"),
        fk="c_nationkey",
        pk="s_suppkey",
        label="s_name",
        default="none",
    )


def _lines_in_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        "if(l_returnflag = 'R', 'GBP', if(l_linestatus = 'F', 'EUR', 'CHF')) as currency",
        "cast(round(l_extendedprice * 100) as bigint) as cents",
    )
    rates = warehouse(spark, sf_dir).fx_rates
    return op.fx_convert(lines, rates, ts="l_shipdate", currency="currency", cents="cents", out="usd")


add(
    "fx_convert_lineitem",
    _lines_in_usd,
    """select l.*, l.cents::double / 100.0::double * r.rate_to_usd as usd
from (select l_orderkey, l_linenumber, l_shipdate,
        case when l_returnflag = 'R' then 'GBP' when l_linestatus = 'F' then 'EUR' else 'CHF' end as currency,
        cast(round(l_extendedprice * 100) as bigint) as cents from lineitem) l
left join fx_rates r on r.date = l.l_shipdate::date and r.currency = l.currency""",
)


_REPLAY_SQL = """with c as (select o_custkey as k, o_orderkey as id, o_orderdate as ts, o_orderpriority as tag,
    case when o_orderkey % 5 = 0 then null else round(o_totalprice) end as old_v, round(o_totalprice) + 1 as new_v
  from orders),
f as (select * from c qualify row_number() over (partition by k order by ts, id) = 1),
e as (select c_custkey as k, TIMESTAMP '1994-01-01' + to_days(cast(c_custkey % 365 as integer)) as born, c_acctbal
  from customer)
select k, tag, old_v as v, born as valid_from, ts as valid_to, false as is_current
from f join e using (k) where old_v is not null
union all
select c.k, c.tag, c.new_v, case when f.old_v is null and f.ts = c.ts then e.born else c.ts end, c.next_at,
  c.next_at is null
from (select *, lead(ts) over (partition by k order by ts, id) as next_at from c) c
join f on f.k = c.k join e on e.k = c.k
union all
select k, 'none', c_acctbal, born, null, true from e where k not in (select k from c)"""
_REPLAY = dict(keys=["k"], entity="k", ts="ts", tie_break="id", old="old_v", new="new_v", value="v", origin="born", attrs=["tag"])


def _order_totals(read) -> tuple[DataFrame, DataFrame, DataFrame]:
    changes = read("orders").selectExpr(
        "o_custkey as k",
        "o_orderkey as id",
        "o_orderdate as ts",
        "o_orderpriority as tag",
        "if(o_orderkey % 5 = 0, null, round(o_totalprice)) as old_v",
        "round(o_totalprice) + 1 as new_v",
    )
    born = "timestamp'1994-01-01' + make_dt_interval(int(c_custkey % 365)) as born"
    entities = read("customer").selectExpr("c_custkey as k", born)
    current = read("customer").selectExpr("c_custkey as k", "'none' as tag", "c_acctbal as v")
    return changes, entities, current


@on_tables("scd2_replay_order_totals", _REPLAY_SQL)
def _(read):
    return op.scd2_replay(*_order_totals(read), **_REPLAY)


@on_tables("scd2_splice_order_totals", _REPLAY_SQL)
def _(read):
    """All orders in two builds: every tenth comes late, and so do the last years'."""
    changes, entities, current = _order_totals(read)
    late = (F.col("id") % 10 == 0) | (F.year("ts") >= 1997)
    stored = op.scd2_replay(changes.filter(~late), entities, current, **_REPLAY)
    return op.scd2_splice(stored, changes, changes.filter(late), entities, current, **_REPLAY)


@on_tables(
    "peak_of_shipments",
    """select month, cast(max(total) as bigint) as peak from (
  select date_trunc('month', l_shipdate)::date as month, l_shipdate, sum(cast(l_quantity as bigint)) as total
  from lineitem group by all) group by month""",
)
def _(read):
    lines = read("lineitem").select(
        "l_shipdate", F.trunc("l_shipdate", "month").alias("month"), F.col("l_quantity").cast("long").alias("q")
    )
    return op.peak_of_totals(lines, instant="l_shipdate", date="month", value="q", out="peak")


@on_tables(
    "daily_count_of_events",
    "select ts::date as day, event_type, cast(count(*) as bigint) as n from events group by all",
)
def _(read):
    return op.daily_count(read("events").select(F.to_date("ts").alias("day"), "event_type"), ["day", "event_type"], "n")


@on_tables(
    "signed_daily_of_lineitem",
    """with s as (select s_suppkey, case when s_nationkey % 5 = 0 then null else s_nationkey end as nation from supplier),
i as (select l_shipdate::date as day, nation, false as flag, sum(cast(l_extendedprice as decimal(28, 6))) as usd, count(*) as n
  from lineitem join s on s_suppkey = l_suppkey group by all),
o as (select l_shipdate::date as day, nation, l_linestatus = 'F' as flag, sum(cast(l_extendedprice as decimal(28, 6))) as usd, count(*) as n
  from lineitem join s on s_suppkey = l_suppkey where l_returnflag = 'R' group by all)
select coalesce(i.day, o.day) as day, coalesce(i.nation, o.nation) as nation, coalesce(i.flag, o.flag) as flag,
  coalesce(cast(round(i.usd * 100) as bigint), 0) as in_cents,
  coalesce(cast(round(o.usd * 100) as bigint), 0) as out_cents,
  coalesce(i.n, 0) as in_count, coalesce(o.n, 0) as out_count,
  case when coalesce(i.flag, o.flag) then coalesce(o.n, 0) else 0 end as flagged_count
from i full join o on i.day = o.day and i.nation is not distinct from o.nation and i.flag = o.flag""",
)
def _(read):
    lines = read("lineitem").select(
        "l_suppkey",
        F.to_date("l_shipdate").alias("day"),
        "l_extendedprice",
        "l_returnflag",
        (F.col("l_linestatus") == "F").alias("flag"),
    )
    suppliers = read("supplier").selectExpr("s_suppkey as l_suppkey", "if(s_nationkey % 5 = 0, null, s_nationkey) as nation")
    return op.signed_daily(
        lines,
        lines.filter("l_returnflag = 'R'"),
        suppliers,
        member="l_suppkey",
        date="day",
        amount="l_extendedprice",
        flag="flag",
        dims=["nation"],
    )


@on_tables(
    "ratio_per_customer",
    """select c_custkey, any_value(c_acctbal) as c_acctbal, cast(count(event_id) as bigint) as event_count,
  case when count(event_id) > 0 then any_value(c_acctbal) / 100.0::double / count(event_id) end as per_event
from customer left join events on user_id = c_custkey group by c_custkey""",
)
def _(read):
    return op.ratio_per_entity(
        read("customer").select("c_custkey", "c_acctbal"),
        read("events").selectExpr("user_id as c_custkey"),
        key="c_custkey",
        numerator="c_acctbal",
        count_out="event_count",
        ratio_out="per_event",
        scale=100,
    )


@on_tables(
    "previous_end_of_lines",
    """select l_orderkey, valid_from, valid_to,
  lag(valid_to) over (partition by l_orderkey order by valid_from, valid_to nulls last) as prev_valid_to
from (select l_orderkey, l_shipdate as valid_from,
        case when l_returnflag = 'R' then null else l_shipdate + to_days(cast(l_quantity as integer)) end as valid_to
      from lineitem)""",
)
def _(read):
    lines = read("lineitem").selectExpr(
        "l_orderkey",
        "l_shipdate as valid_from",
        "if(l_returnflag = 'R', null, l_shipdate + make_dt_interval(int(l_quantity))) as valid_to",
    )
    return op.previous_end(lines, ["l_orderkey"])


@on_tables(
    "converted_counts_of_users",
    """select user_id, cast(count(*) as bigint) as start_count, cast(count(*) filter (hit) as bigint) as converted_count
from (select c.user_id, exists (select 1 from events p where p.event_type = 'purchase' and p.user_id = c.user_id
        and p.ts > c.ts) as hit from events c where c.event_type = 'click') group by user_id""",
)
def _(read):
    events = read("events")
    return op.converted_counts(
        events.filter("event_type = 'click'"),
        events.filter("event_type = 'purchase'"),
        keys=["user_id"],
        start_ts="ts",
        end_ts="ts",
        group=["user_id"],
    )


@on_tables(
    "pass_rate_of_orders",
    """select o_orderdate::date as run_date, r_name as schema_name, cast(count(*) as bigint) as test_count,
  cast(count(*) filter (o_orderstatus = 'F') as bigint) as pass_count,
  count(*) filter (o_orderstatus = 'F') / nullif(count(*), 0) as pass_rate
from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
join region on r_regionkey = n_regionkey group by all""",
)
def _(read):
    results = read("orders").selectExpr(
        "cast(o_custkey as string) as unique_id",
        "'test' as resource_type",
        "if(o_orderstatus = 'F', 'pass', 'fail') as status",
        "o_orderdate as created_at",
    )
    tests = read("customer").selectExpr(
        "cast(c_custkey as string) as unique_id", "cast(c_nationkey as string) as parent_model_unique_id"
    )
    models = read("nation").join(read("region"), F.expr("n_regionkey = r_regionkey"))
    return op.pass_rate(
        results, tests, models.selectExpr("cast(n_nationkey as string) as unique_id", "r_name as schema_name")
    )


@on_tables(
    "revenue_rollup_by_nation",
    """select c_nationkey, round(sum(o_totalprice), 2) as revenue from orders join customer on c_custkey = o_custkey
group by c_nationkey""",
)
def _(read):
    rolled = op.rollup_via_bridge(
        read("orders").selectExpr("o_custkey as c_custkey", "o_totalprice"),
        read("customer"),
        member="c_custkey",
        entity="c_nationkey",
        value="o_totalprice",
        out="revenue",
    )
    return rolled.withColumn("revenue", F.round("revenue", 2))


@on_tables(
    "date_spine_of_shipments",
    """select unnest(generate_series(min(l_shipdate), max(l_shipdate), interval 1 day))::date as day from lineitem""",
)
def _(read):
    days = read("lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("first_day"), F.date_add(F.to_date(F.max("l_shipdate")), 1).alias("end_day")
    )
    return op.date_spine(days, "day")


_STATUS_DIFF = """select * from (select coalesce(a.k, b.k) as o_custkey, coalesce(a.n, 0) as expected_n, coalesce(b.n, 0) as actual_n
  from (select o_custkey as k, count(*) as n from orders where o_orderstatus = 'F' group by all) a
  full join (select o_custkey as k, count(*) as n from orders where o_orderstatus = 'O' group by all) b on a.k = b.k)
where expected_n <> actual_n"""


def _orders_per_customer(read) -> list[DataFrame]:
    return [op.daily_count(read("orders").filter(F.col("o_orderstatus") == s), ["o_custkey"], "n") for s in ("F", "O")]


@on_tables("diff_of_order_statuses", _STATUS_DIFF)
def _(read):
    return op.diff_by_key(*_orders_per_customer(read), keys=["o_custkey"], measures=["n"])


@on_tables("checksum_diff_of_order_statuses", _STATUS_DIFF)
def _(read):
    return op.diff_by_checksum(*_orders_per_customer(read), keys=["o_custkey"], measures=["n"])


@on_tables(
    "refund_valuation_of_orders",
    """select o_orderkey, l_linenumber, l_extendedprice, o_custkey, o_totalprice from lineitem
join orders on o_orderkey = l_orderkey where l_returnflag = 'R'""",
)
def _(read):
    returned = read("lineitem").filter("l_returnflag = 'R'")
    returned = returned.selectExpr("l_orderkey as o_orderkey", "l_linenumber", "l_extendedprice")
    return op.refund_valuation(returned, read("orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")
